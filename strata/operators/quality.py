"""Expectations: warn / drop / fail with per-rule counts.

Build order (hard point H11): the fail check is a filter *below* the metrics
and the drop filter, ``df.filter(fail).observe(metrics).filter(drop)``.  Put
anywhere else, Catalyst may merge it with the drop predicate and skip it for
rows the drop removes, so a row breaking a drop rule *and* a fail rule would
pass silently.  Every rule sees every input row; counts come from one
``observe`` on the same pass that writes the data (no extra job).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.rules import Expectation


FAILED_MARKER = "STRATA_EXPECTATION_FAILED"  # begins the error that a violated fail rule raises


def _all(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols) if cols else F.lit(True)


def fail_message(rule: Expectation, dataset: str) -> str:
    return (f"{FAILED_MARKER}: expectation '{rule.name}' on '{dataset}' "
            f"violated ({rule.predicate}); update aborted")


def metric_columns(rules: Sequence[Expectation], as_of: str | None = None) -> list[Column]:
    """``count(*)``, rows surviving the drop rules (``kept``) and one ``failed_<i>`` per rule.

    NULL predicate results count as failed.
    """
    out = [F.count(F.lit(1)).alias("n"),
           F.count_if(_all([r.passed(as_of) for r in rules if r.action == "drop"])).alias("kept")]
    out += [F.count_if(~r.passed(as_of)).alias(f"failed_{i}") for i, r in enumerate(rules)]
    return out


def apply_expectations(df: DataFrame, rules: Sequence[Expectation], dataset: str = "dataset",
                       as_of: str | None = None, observation: Observation | None = None):
    """Return ``(validated_df, observation)``.

    ``validated_df`` raises on a ``fail`` violation, drops ``drop``
    violations and keeps ``warn`` ones.  Read the counts with
    :func:`observed_counts` after an action on ``validated_df``.
    """
    obs = observation or Observation(f"expectations_{dataset}")
    out = df
    fail_rules = [r for r in rules if r.action == "fail"]
    if fail_rules:
        check = F.lit(True)
        for r in fail_rules:
            check = F.when(~r.passed(as_of), F.raise_error(F.lit(fail_message(r, dataset)))).otherwise(check)
        out = out.filter(check)
    out = out.observe(obs, *metric_columns(rules, as_of))
    drop_rules = [r for r in rules if r.action == "drop"]
    if drop_rules:
        out = out.filter(_all([r.passed(as_of) for r in drop_rules]))
    return out, obs


def observed_counts(obs: Observation, rules: Sequence[Expectation], dataset: str) -> list[dict]:
    """Observation → ``[{name, dataset, passed_records, failed_records}]``."""
    m = obs.get
    n = int(m.get("n") or 0)
    res = []
    for i, r in enumerate(rules):
        failed = int(m.get(f"failed_{i}") or 0)
        res.append({"name": r.name, "dataset": dataset, "passed_records": n - failed, "failed_records": failed})
    return res


def expectation_report(df: DataFrame, rules: Sequence[Expectation], dataset: str = "dataset",
                       as_of: str | None = None) -> DataFrame:
    """Per-rule counts as a DataFrame (no run): ``name, dataset, action, passed_records, failed_records``.

    One global aggregate with map-side partial counts, then a tiny unpivot.
    """
    agg = df.agg(*metric_columns(rules, as_of)).drop("kept")
    rows = [
        F.struct(F.lit(r.name).alias("name"), F.lit(r.action).alias("action"),
                 F.col(f"failed_{i}").alias("failed")) for i, r in enumerate(rules)
    ]
    return (agg.select(F.col("n"), F.explode(F.array(*rows)).alias("r"))
            .select(F.col("r.name").alias("name"), F.lit(dataset).alias("dataset"),
                    F.col("r.action").alias("action"),
                    (F.col("n") - F.col("r.failed")).alias("passed_records"),
                    F.col("r.failed").alias("failed_records")))


def quarantine(df: DataFrame, rules: Sequence[Expectation], as_of: str | None = None,
               actions: Sequence[str] = ("drop",)) -> DataFrame:
    """Rows failing at least one rule of ``actions`` plus ``failed_rules`` (array of names)."""
    chosen = [r for r in rules if r.action in actions]
    names = F.array_compact(F.array(*[F.when(~r.passed(as_of), F.lit(r.name)) for r in chosen]))
    # first the rows, by a filter that compiles; then the names, of those few only
    return df.filter(~_all([r.passed(as_of) for r in chosen])).withColumn("failed_rules", names)
