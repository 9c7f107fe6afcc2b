import random
from fractions import Fraction

from pyspark.sql import functions as F

from strata.functions.money import amount_average, amount_total, sum_sql
from strata.functions.rules import DEFAULT_RULES, Expectation, bind_now, rules_from_dict


def _total(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").agg(amount_total("x").alias("t")).first()["t"]


def test_amounts_are_summed_exactly_and_rounded_once(spark):
    assert _total(spark, [12.3 * 3, 0.1 + 0.2]) == 37.2
    assert _total(spark, [0.004] * 5) == 0.02  # sub-cent amounts count
    assert _total(spark, [-5.005]) == -5.01 and _total(spark, [None]) is None


def test_no_amount_is_dropped(spark):
    assert _total(spark, [10.0, 1e18]) == 1e18 + 10
    assert _total(spark, [float("inf"), 1.25]) == float("inf")
    nan = _total(spark, [float("nan"), 1.25])
    assert nan != nan
    assert _total(spark, [1e40, 1.0]) == 1e40


def test_sums_equal_fractions_at_any_size_and_order(spark):
    rng, groups = random.Random(1), {}
    kinds = [lambda: rng.choice([4e-7, -4e-7, 1e-9]), lambda: rng.uniform(-1, 1) * 10 ** rng.randint(20, 35),
             lambda: rng.uniform(-1, 1) * 10 ** rng.randint(-12, 35), lambda: round(rng.uniform(-1000, 1000), 2),
             lambda: rng.choice([1e31, -1e31, 4e-7, 0.005, 1.005])]
    for g in range(60):
        groups[g] = [kinds[g % len(kinds)]() for _ in range(rng.randint(1, 120))]
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double").repartition(5)
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(F.expr(sum_sql("x")).alias("s")).collect()}
    assert got == {g: float(sum(map(Fraction, xs))) for g, xs in groups.items()}
    assert _total(spark, [4e-7] * 50_000) == 0.02 and _total(spark, [1e31, 0.25, -1e31]) == 0.25


def test_average_rounds_half_away_from_zero(spark):
    rows = [(1, 0.01, 8), (2, 0.05, 2), (3, -0.05, 2), (4, 0.02, 3), (5, 0.07, 0), (6, None, 3)]
    df = spark.createDataFrame(rows, "g int, x double, n bigint")
    got = df.groupBy("g").agg(amount_average("x", F.max("n")).alias("a")).orderBy("g").collect()
    assert [r["a"] for r in got] == [0.0, 0.03, -0.03, 0.01, None, None]


def test_plain_sums_are_used_only_where_they_round_alike(spark):
    """Ties, tiny and huge amounts and NaN round as the sums of the limbs do, in any order of rows."""
    from strata.functions.money import _rounded
    rng, rows = random.Random(3), []
    for g in range(400):
        kind = rng.choice([lambda: round(rng.uniform(-9e4, 9e4), 2), lambda: rng.choice([0.005, -0.005, 0.125, 1.005]),
                           lambda: rng.uniform(-1, 1) * 10 ** rng.randint(-14, 17), lambda: rng.choice([-0.0, 0.0, 4e-7])])
        rows += [(g, kind()) for _ in range(rng.randint(1, 40))]
    rows += [(400, float("nan")), (401, float("inf")), (401, 1.0), (402, None), (403, 1e300), (403, -1e300), (404, 1e-40)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double").repartition(5)
    for digits in (2, 6):
        got = df.groupBy("g").agg(F.expr(_rounded("x", digits)).alias("a"),
                                  F.expr(f"round({sum_sql('x')}, {digits})").alias("b"))
        assert got.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_reference_rule_set():
    names = [r.name for r in DEFAULT_RULES]
    assert names == ["valid_order_id", "valid_store", "positive_qty", "non_negative_amount", "known_channel",
                     "plausible_timestamp", "currency_is_inr"]
    assert [r.action for r in DEFAULT_RULES] == ["drop"] * 3 + ["warn"] * 3 + ["fail"]


def test_bind_now_and_dict_rules():
    assert bind_now("order_ts <= current_timestamp()", "2026-08-31 00:00:00") == \
        "order_ts <= TIMESTAMP '2026-08-31 00:00:00'"
    rs = rules_from_dict({"a": "x > 0", "b": "y IS NOT NULL"}, "drop")
    assert [(r.name, r.action) for r in rs] == [("a", "drop"), ("b", "drop")]
    try:
        Expectation("z", "1=1", "explode")
    except ValueError:
        pass
    else:
        raise AssertionError("bad action accepted")
