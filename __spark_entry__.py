"""

Every query reads the driver's tables in ``sf_dir`` (or data Spark derives
from them) over their whole extent.  Order events come from
``strata.sources.adapter`` (one nested event per line item, driver codes mapped
to the order domain, deterministic defects injected on every run).  Queries
that need files or state (ingest, streams, pipeline runs) write below a fresh
folder of the session's state root, never into ``sf_dir``.
"""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.rules import DEFAULT_RULES
from strata.operators import gold, quality, silver
from strata.plans import verify
from strata.plans.dimension import Dimension
from strata.plans.event_log import EXPECTATIONS_PATH_SQL
from strata.plans.pipeline import order_pipeline, table_changes
from strata.plans.refresh import read_view, refresh_view
from strata.session import new_run_dir
from strata.sources import adapter, files, storage
from strata.sources.ingest import IngestOptions, UnknownFieldError, ingest, read_bronze
from strata.streaming import live

# Fixed "now" for the plausible_timestamp rule, so results do not depend on the clock.
AS_OF = "2026-08-31 00:00:00"
SMOKE_DIR = "/root/testdata/sf0.001"
# Parameters of the staged scenarios: events before EVOLVE_AT land without
# ``props`` (the new column arrives later).  The pipeline's first update
# backfills every order up to the last day of ``orders``; the second update
# receives that last day plus the year-2099 defects — a new day arriving —
# and refreshes only the gold dates it touches.
EVOLVE_AT = "2024-01-11 00:00:00"
EVENT_HINTS = "ts TIMESTAMP_NTZ"
RESCUE_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
_RUNS: dict = {}  # (scenario, sf_dir) -> result paths, so queries of one process share a run


# ---------------------------------------------------------------- shared steps
def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.order_lines(adapter.order_events(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated, _ = quality.apply_expectations(_lines(spark, sf_dir), DEFAULT_RULES, "silver_order_lines", AS_OF)
    return validated


# ---------------------------------------------------------------- queries
def q_silver_order_lines(spark, sf_dir):
    """Flatten, cast, drop rows failing drop rules."""
    return _silver(spark, sf_dir)


def q_gold_daily_store_sales(spark, sf_dir):
    """J1 A1 A4 A5 A6 F3."""
    return gold.daily_store_sales(_silver(spark, sf_dir), adapter.stores(spark, sf_dir))


def q_gold_top_items(spark, sf_dir):
    """J2 A1 A4 A5."""
    return gold.top_items(_silver(spark, sf_dir), adapter.menu_items(spark, sf_dir))


def q_gold_channel_mix(spark, sf_dir):
    """A1 A4 A5."""
    return gold.channel_mix(_silver(spark, sf_dir))


def q_expectation_counts(spark, sf_dir):
    """passed/failed per rule over all exploded lines."""
    return quality.expectation_report(_lines(spark, sf_dir), DEFAULT_RULES, "silver_order_lines", AS_OF).drop("dataset")


def q_quarantine(spark, sf_dir):
    """Lines failing a drop rule, with the names of the rules they failed."""
    q = quality.quarantine(_lines(spark, sf_dir), DEFAULT_RULES, AS_OF)
    return q.select("order_id", "item_id", "qty", "store_id", F.array_join("failed_rules", ",").alias("failed_rules"))


def q_order_lines_outer(spark, sf_dir):
    """G1 with keep_empty: orders without items stay, as one row with NULL item."""
    lines = silver.order_lines(adapter.order_events(spark, sf_dir), keep_empty=True)
    return lines.select("order_id", "item_id", "qty", "line_amount")


def q_gold_daily_store_sales_sql(spark, sf_dir):
    """The SQL variant of the gold view (K8 DataFrame-bound views + SQL text, J1, A4, A6)."""
    return gold.sql_view(spark, "gold_daily_store_sales", _silver(spark, sf_dir), adapter.stores(spark, sf_dir))


def q_store_league(spark, sf_dir):
    """V5 A8 A9 O-2: store league over the daily store view."""
    return verify.store_league(q_gold_daily_store_sales(spark, sf_dir))


def q_top_items_report(spark, sf_dir):
    """V6 O-3: top 15 items by revenue (a top-k report; ties broken by key)."""
    return verify.top_items(q_gold_top_items(spark, sf_dir), 15)


# ---------------------------------------------------------------- ingest scenarios
def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _land_by_day(df, path):
    """NDJSON in one folder per day (``day=YYYY-MM-DD``); no shuffle, so a hot day is still written in parallel."""
    day = F.to_date("ts")
    (df.withColumn("day", day).write.partitionBy("day")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))


_DAY_OF_PATH = r"day=([0-9]{4}-[0-9]{2}-[0-9]{2})"


def _bronze_events(spark, sf_dir):
    key = ("bronze_events", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "ingest-events")
        _land_by_day(_events(spark, sf_dir), f"{run}/landing")
        opts = IngestOptions(schema_hints=EVENT_HINTS)
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)  # re-run: no new files
        _RUNS[key] = (run, opts)
    run, opts = _RUNS[key]
    return read_bronze(spark, f"{run}/bronze", f"{run}/state", opts), run


def q_bronze_events(spark, sf_dir):
    """Inferred + hinted schema, every row exactly once after a re-run."""
    b, _ = _bronze_events(spark, sf_dir)
    return b.select("event_id", "ts", "user_id", "event_type", "value", "props", "_rescued_data")


def q_bronze_total_rows(spark, sf_dir):
    """V2: total bronze rows after ingesting twice (idempotent re-run)."""
    b, _ = _bronze_events(spark, sf_dir)
    return verify.total_rows(b)


def q_bronze_per_file(spark, sf_dir):
    """V1: rows per landed file, rolled up to the day folder each file landed in."""
    b, _ = _bronze_events(spark, sf_dir)
    per_file = verify.per_file(b)
    return (per_file.groupBy(F.regexp_extract("source_file", _DAY_OF_PATH, 1).cast("date").alias("day"))
            .agg(F.sum("rows").alias("rows")))


def q_landing_listing(spark, sf_dir):
    """Landing-zone listing (contents not read): day folders holding JSON files."""
    _, run = _bronze_events(spark, sf_dir)
    listing = files.list_files(spark, f"{run}/landing", "*.json")
    return listing.agg(F.count_distinct(F.regexp_extract("path", _DAY_OF_PATH, 1)).alias("day_folders"))


def q_bronze_rescue(spark, sf_dir):
    """Fixed schema in rescue mode; mismatched types and unknown keys land in _rescued_data."""
    return _ingest_fixed(spark, sf_dir, "rescue").select("event_id", "user_id", "event_type", "_rescued_data")


def _bronze_evolution(spark, sf_dir):
    key = ("bronze_evolution", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "ingest-evolve")
        ev = _events(spark, sf_dir)
        early = F.col("ts") < F.lit(EVOLVE_AT).cast("timestamp_ntz")
        opts = IngestOptions(schema_hints=EVENT_HINTS)
        _land_by_day(ev.filter(early).drop("props"), f"{run}/landing/stage1")
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)
        late = ev.filter(~early).withColumn("props", F.from_json("props", "map<string,bigint>"))
        _land_by_day(late, f"{run}/landing/stage2")
        # addNewColumns: the first attempt records schema v1 and fails; the retry lands the rows.
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts, retries=1)
        _RUNS[key] = (run, opts)
    run, opts = _RUNS[key]
    return read_bronze(spark, f"{run}/bronze", f"{run}/state", opts), run


def q_bronze_evolution(spark, sf_dir):
    """A new nested column arrives; fail once, widen, retry; old rows read NULL."""
    b, _ = _bronze_evolution(spark, sf_dir)
    return b.select("event_id", "event_type", F.col("props.k").alias("props_k"))


def q_new_column_population(spark, sf_dir):
    """V3: rows and non-null count of the new column per day."""
    b, _ = _bronze_evolution(spark, sf_dir)
    return verify.column_population(b.withColumn("day", F.to_date("ts")), ("props",), by="day")


def q_table_changes(spark, sf_dir):
    """Rows inserted by bronze batches after the first one (pruned by batch_id)."""
    _, run = _bronze_evolution(spark, sf_dir)
    return table_changes(spark, f"{run}/bronze", 1).select("event_id", "_change_type")


# ---------------------------------------------------------------- pipeline scenario
def _pipeline(spark, sf_dir):
    key = ("pipeline", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "pipeline")
        last_day = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").agg(
            F.max(F.to_date("o_orderdate"))).first()[0]
        early = adapter.order_date_expr() < F.lit(last_day)  # order-level: filters before the joins
        p = _order_pipeline(spark, sf_dir, run)
        adapter.land_orders(spark, sf_dir, f"{run}/landing/stage1", early)
        p.run_update()
        adapter.land_orders(spark, sf_dir, f"{run}/landing/stage2", ~early)
        p.run_update()  # second update: gold views refresh only the dates that changed
        _RUNS[key] = run
    return _order_pipeline(spark, sf_dir, _RUNS[key])


def _order_pipeline(spark, sf_dir, run):
    return order_pipeline(spark, f"{run}/pipe", f"{run}/landing", adapter.stores(spark, sf_dir),
                          adapter.menu_items(spark, sf_dir), as_of=AS_OF, quarantine=True)


def q_pipeline_gold_daily_store_sales(spark, sf_dir):
    """R1 K6 K7 S16 E1–E5 end to end: files → bronze → silver stream → incrementally refreshed gold."""
    return _pipeline(spark, sf_dir).table("gold_daily_store_sales")


def q_pipeline_gold_top_items(spark, sf_dir):
    """The pipeline's gold_top_items (same run as above)."""
    return _pipeline(spark, sf_dir).table("gold_top_items")


def q_pipeline_gold_channel_mix(spark, sf_dir):
    """The pipeline's gold_channel_mix, incl. UNKNOWN channel and year-2099 rows."""
    return _pipeline(spark, sf_dir).table("gold_channel_mix")


def q_pipeline_quarantine(spark, sf_dir):
    """E8 in the stream: the silver flow's quarantine side table (lines failing a drop rule)."""
    q = _pipeline(spark, sf_dir).table("silver_quarantine")
    return q.select("order_id", "item_id", "qty", "store_id", F.array_join("failed_rules", ",").alias("failed_rules"))


def q_pipeline_row_counts(spark, sf_dir):
    """Row counts of the five pipeline tables."""
    p = _pipeline(spark, sf_dir)
    return verify.row_counts({n: p.table(n) for n in p.order() if n != "silver_quarantine"})


def q_event_log_expectations(spark, sf_dir):
    """O1 O3 E5: per-rule passed/failed summed over the silver flow's events."""
    p = _pipeline(spark, sf_dir)
    return (p.log.expectation_results().filter(F.col("status") == "COMPLETED")
            .groupBy("expectation").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed")))


# ---------------------------------------------------------------- live stream
def q_live_channel_sales(spark, sf_dir):
    """Watermarked 1-day windows per event type, complete mode, shared-storage sink."""
    key = ("live", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "live")
        src = _events(spark, sf_dir)
        stream = (spark.readStream.schema(src.schema).option("pathGlobFilter", "events.parquet")
                  .parquet(sf_dir))
        agg = live.daily_window_agg(stream, ts_col="ts", keys=("event_type",), amount_col="value")
        q = live.start(agg, name=f"live_{run.rsplit('-', 1)[-1]}", checkpoint=f"{run}/checkpoint",
                       sink="parquet", path=f"{run}/live", trigger={"availableNow": True})
        q.awaitTermination()
        _RUNS[key] = run
    return live.read_result(spark, f"{_RUNS[key]}/live", "complete", ["order_date", "event_type"]) \
        .withColumnRenamed("event_type", "channel")


def q_live_channel_sales_append(spark, sf_dir):
    """Append mode — the watermark finalizes and evicts windows; future rows are filtered first."""
    key = ("live_append", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "live-append")
        src = _events(spark, sf_dir)
        stream = (spark.readStream.schema(src.schema).option("pathGlobFilter", "events.parquet")
                  .parquet(sf_dir))
        agg = live.daily_window_agg(stream, ts_col="ts", keys=("event_type",), amount_col="value",
                                    drop_future=True, as_of=AS_OF)
        q = live.start(agg, name=f"live_append_{run.rsplit('-', 1)[-1]}", checkpoint=f"{run}/checkpoint",
                       sink="parquet", path=f"{run}/live", output_mode="append", trigger={"availableNow": True})
        q.awaitTermination()
        _RUNS[key] = run
    return live.read_result(spark, f"{_RUNS[key]}/live", "append", ["order_date", "event_type"]) \
        .withColumnRenamed("event_type", "channel")


def q_dimension_csv(spark, sf_dir):
    """A dimension written as header CSV and read back with inferred types."""
    run = new_run_dir(spark, "dims")
    adapter.stores(spark, sf_dir).write.option("header", True).csv(f"{run}/stores")
    return files.read_csv_dimension(spark, f"{run}/stores")


def _rescue_landing(spark, sf_dir):
    """Events as JSON text with two defects: ``user_id`` as a string on error events, an extra key on signups."""
    key = ("rescue_landing", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "landing-rescue")
        ev = _events(spark, sf_dir)
        fields = ["event_id", "ts", "user_id", "event_type", "value"]
        plain = F.to_json(F.struct(*fields))
        bad_type = F.to_json(F.struct("event_id", "ts", F.concat(F.lit("u"), F.col("user_id").cast("string"))
                                      .alias("user_id"), "event_type", "value"))
        extra = F.to_json(F.struct(*fields, F.lit(1).alias("extra")))
        line = (F.when(F.col("event_type") == "error", bad_type)
                .when(F.col("event_type") == "signup", extra).otherwise(plain))
        ev.select(line.alias("value")).write.text(f"{run}/landing")
        _RUNS[key] = f"{run}/landing"
    return _RUNS[key]


def _ingest_fixed(spark, sf_dir, mode):
    key = ("ingest_fixed", mode, sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, f"ingest-{mode.lower()}")
        opts = IngestOptions(schema=RESCUE_SCHEMA, evolution_mode=mode)
        ingest(spark, _rescue_landing(spark, sf_dir), f"{run}/bronze", f"{run}/state", opts)
        _RUNS[key] = (run, opts)
    run, opts = _RUNS[key]
    return read_bronze(spark, f"{run}/bronze", f"{run}/state", opts)


def q_bronze_none_mode(spark, sf_dir):
    """Evolution mode none — unknown keys are ignored (not rescued); type mismatches still are."""
    return _ingest_fixed(spark, sf_dir, "none").select("event_id", "user_id", "event_type", "_rescued_data")


def q_bronze_fail_on_new_columns(spark, sf_dir):
    """failOnNewColumns — the run with a new field fails and lands nothing; no schema version is added."""
    key = ("fail_on_new", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "ingest-failonnew")
        ev = _events(spark, sf_dir)
        early = F.col("ts") < F.lit(EVOLVE_AT).cast("timestamp_ntz")
        opts = IngestOptions(schema_hints=EVENT_HINTS, evolution_mode="failOnNewColumns")
        _land_by_day(ev.filter(early).drop("props"), f"{run}/landing/stage1")
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)
        _land_by_day(ev.filter(~early), f"{run}/landing/stage2")
        try:
            ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts, retries=3)  # not retried
            raise AssertionError("failOnNewColumns accepted a new column")
        except StreamingQueryException as e:
            if UnknownFieldError.MARKER not in str(e):
                raise
        _RUNS[key] = (run, opts)
    run, opts = _RUNS[key]
    return read_bronze(spark, f"{run}/bronze", f"{run}/state", opts).select("event_id", "event_type")


def q_event_log_sql(spark, sf_dir):
    """The reference's event-log query (LATERAL VIEW EXPLODE, JSON paths on VARIANT details)."""
    p = _pipeline(spark, sf_dir)
    p.log.as_view("pipeline_events", variant_details=True)
    return (spark.sql(EXPECTATIONS_PATH_SQL).filter(F.col("status") == "COMPLETED")
            .groupBy("expectation").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed")))


def q_catalog_gold_channel_mix(spark, sf_dir):
    """Pipeline tables registered in a database, read back by name."""
    p = _pipeline(spark, sf_dir)
    db = "strata_" + _RUNS[("pipeline", sf_dir)].rsplit("-", 1)[-1]
    p.register(db)
    return spark.table(f"{db}.gold_channel_mix").select(*gold.CHANNEL_MIX)


def q_dimension_table(spark, sf_dir):
    """A dimension CSV loaded and saved as a table (overwrite), read back by name."""
    run = new_run_dir(spark, "dimtable")
    adapter.stores(spark, sf_dir).write.option("header", True).csv(f"{run}/reference/stores")
    db = "strata_" + run.rsplit("-", 1)[-1]
    files.load_dimensions(spark, f"{run}/reference", database=db, names=("stores",), warehouse_dir=f"{run}/wh")
    return spark.table(f"{db}.stores")


def _in_utc(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Day buckets and date casts assume a UTC session (H7); enforce it for each query."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def _training_data():
    """The training-data operators and pipeline, or nothing where ``strata/llm`` has been taken out."""
    for name in ("strata.llm", "corpus_pipeline"):
        spec = importlib.util.find_spec(name)
        if spec is None or spec.origin is None:  # absent, or an empty leftover folder
            return {}, {}
    module = importlib.import_module("strata.llm.queries")
    pipeline = importlib.import_module("corpus_pipeline")
    sql = dict(module.oracle_sql())
    if pipeline.ORACLE_SQL:
        sql["pipeline"] = pipeline.ORACLE_SQL
    return {**module.queries(), "pipeline": pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {k: _in_utc(v) for k, v in _QUERIES.items()}
    return {**own, **_training_data()[0]}


def q_silver_order_lines_sql(spark, sf_dir):
    """G1 P1–P5 in SQL: the SQL form of the flatten, then the same rules."""
    lines = silver.order_lines_sql(spark, adapter.order_events(spark, sf_dir))
    return quality.apply_expectations(lines, DEFAULT_RULES, "silver_order_lines", AS_OF)[0]


def q_gold_subcent(spark, sf_dir):
    """Amounts below a cent are summed before the one rounding."""
    line = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return gold.channel_mix(line.select(
        F.col("l_shipdate").cast("date").alias("order_date"), F.col("l_returnflag").alias("channel"),
        F.col("l_linestatus").alias("payment_method"), F.col("l_orderkey").alias("order_id"),
        (F.col("l_quantity").cast("double") * F.lit(0.004)).alias("line_amount")))


def q_gold_exact_sums(spark, sf_dir):
    """Amounts from 4e-7 to 1e31 with mixed signs add up exactly, whatever the order of rows."""
    line = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    # each huge amount meets its negative in its group, so that only the small ones are left of the sum
    huge = F.array(*[F.lit(x) for x in (1e31, -1e31, 2.0 ** 80, -(2.0 ** 80))])
    parts = line.select(F.col("l_shipdate").cast("date").alias("order_date"), F.col("l_returnflag").alias("channel"),
                        F.col("l_linestatus").alias("payment_method"), F.col("l_orderkey").alias("order_id"),
                        F.explode(F.concat(huge, F.array(F.col("l_quantity").cast("double") / 4, F.lit(2.0 ** -21))))
                        .alias("line_amount"))
    return gold.channel_mix(parts)


def _text_events(spark, sf_dir):
    """Events whose fields are all text, some of which say more than their type can hold."""
    key = ("text_events", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "text-events")
        opts = IngestOptions(schema="event_id BIGINT, b BOOLEAN, d DATE, n TIMESTAMP_NTZ, m DECIMAL(12,2), f DOUBLE",
                             evolution_mode="rescue")
        kind, user = F.col("event_type"), F.col("user_id").cast("string")
        day, time = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
        _events(spark, sf_dir).select(
            "event_id", F.when(kind == "error", "y").when(kind == "click", "true").otherwise("false").alias("b"),
            F.when(kind == "signup", F.concat(day, F.lit("T10:11:12"))).otherwise(day).alias("d"),
            F.when(kind == "view", F.concat(time, F.lit("+05:30"))).otherwise(time).alias("n"),
            F.concat(user, F.when(kind == "error", ".239").otherwise(".250")).alias("m"),
            F.concat(user, F.when(kind == "purchase", "x").otherwise(".50")).alias("f")).write.json(f"{run}/landing")
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)
        _RUNS[key] = read_bronze(spark, f"{run}/bronze", f"{run}/state", opts)
    return _RUNS[key]


def q_bronze_lossless_text(spark, sf_dir):
    """Text under BOOLEAN, DATE, TIMESTAMP_NTZ, DECIMAL and DOUBLE is typed where nothing is lost, else rescued."""
    kept = F.from_json("_rescued_data", "b string, d string, n string, m string, f string")
    return _text_events(spark, sf_dir).select(
        "event_id", "b", "d", "n", F.col("m").cast("double").alias("m"), "f",
        *[kept[c].alias(f"{c}_rescued") for c in ("b", "d", "n", "m", "f")])


def q_expectations_after_reset(spark, sf_dir):
    """Two updates, a reset and one more update; the counts are those of the present silver."""
    key = ("reset", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "reset")
        p = _order_pipeline(spark, sf_dir, run)
        even = F.pmod(F.expr(adapter.ORDER_EXPRS["order_id"]).cast("bigint"), F.lit(2)) == 0
        adapter.land_orders(spark, sf_dir, f"{run}/landing/stage1", even)
        p.run_update(only=["bronze_orders", "silver_order_lines"])
        adapter.land_orders(spark, sf_dir, f"{run}/landing/stage2", ~even)
        p.run_update(only=["bronze_orders", "silver_order_lines"])
        p.reset()
        p.run_update(only=["bronze_orders", "silver_order_lines"])
        _RUNS[key] = run
    p = _order_pipeline(spark, sf_dir, _RUNS[key])
    return (p.log.expectation_results().filter(F.col("status") == "COMPLETED")
            .groupBy("expectation").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed")))


def _renamed_stores(stores: DataFrame) -> DataFrame:
    """Stores of Asia under another name and region, those of Africa closed."""
    asia = F.col("region") == "ASIA"
    return stores.filter(F.coalesce(F.col("region") != "AFRICA", F.lit(True))).select(
        "store_id", F.when(asia, F.concat(F.lit("New "), "store_name")).otherwise(F.col("store_name")).alias("store_name"),
        "city", F.when(asia, F.lit("EAST")).otherwise(F.col("region")).alias("region"))


def q_view_follows_dimension(spark, sf_dir):
    """The daily view after a new batch and, later, a dimension that changed without any new line."""
    key = ("dimension", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "dimension")
        silver_dir, view = f"{run}/silver", "gold_daily_store_sales"
        stores = adapter.stores(spark, sf_dir)
        lines = _silver(spark, sf_dir)
        late = F.coalesce(F.dayofmonth("order_date") > 15, F.lit(True))

        def refresh(dim):
            refresh_view(spark, view, lambda x: gold.daily_store_sales(x, dim), spark.read.parquet(silver_dir),
                         f"{run}/{view}", f"{run}/state",
                         dimension=Dimension(dim, "store_id", ("store_name", "city", "region")))

        lines.filter(~late).write.parquet(f"{silver_dir}/batch_id=0")
        refresh(stores)
        lines.filter(late).write.parquet(f"{silver_dir}/batch_id=1")
        refresh(stores)
        refresh(_renamed_stores(stores))
        _RUNS[key] = f"{run}/{view}"
    return read_view(spark, _RUNS[key], gold.DAILY_STORE_SALES)


def _lossless(spark, sf_dir):
    """Events landed under types that not every value fits: a fraction under BIGINT, a number under BOOLEAN, a nested key
    that the schema does not know."""
    key = ("lossless", sf_dir)
    if key not in _RUNS:
        run = new_run_dir(spark, "lossless")
        opts = IngestOptions(schema="event_id BIGINT, value BIGINT, flag BOOLEAN, tag STRUCT<k: BIGINT>",
                             evolution_mode="rescue")
        _events(spark, sf_dir).select(
            "event_id", "value", F.col("user_id").alias("flag"),
            F.struct(F.lit(1).alias("k"), F.when(F.col("event_type") == "error", F.col("event_type")).alias("note"))
            .alias("tag")).write.json(f"{run}/landing")
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)
        _RUNS[key] = read_bronze(spark, f"{run}/bronze", f"{run}/state", opts)
    return _RUNS[key]


def q_bronze_lossless(spark, sf_dir):
    """What does not fit its type is NULL there and whole in the rescue column."""
    rescued = F.col("_rescued_data")
    return _lossless(spark, sf_dir).select(
        "event_id", F.col("value").alias("value_typed"), F.col("flag").alias("flag_typed"),
        F.col("tag.k").alias("tag_k"),
        F.get_json_object(rescued, "$.value").cast("double").alias("value_rescued"),
        F.get_json_object(rescued, "$.flag").cast("bigint").alias("flag_rescued"),
        F.get_json_object(rescued, "$.tag.note").alias("note_rescued"))


def q_bronze_nested_evolution(spark, sf_dir):
    """Fields arrive inside an object and inside the elements of its array; fail once, widen, retry."""
    key = ("nested_evolution", sf_dir)
    if key not in _RUNS:
        run, opts = new_run_dir(spark, "ingest-nested"), IngestOptions(evolve_nested=True)
        ev = _events(spark, sf_dir)
        early = F.col("ts") < F.lit(EVOLVE_AT).cast("timestamp_ntz")
        user, kind = F.col("user_id"), F.col("event_type")
        ev.filter(early).select("event_id", F.struct(
            user.alias("k"), F.array(F.struct(user.alias("p"))).alias("parts")).alias("tag")) \
            .write.json(f"{run}/landing/stage1")
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)
        ev.filter(~early).select("event_id", F.struct(
            user.alias("k"), kind.alias("note"), F.struct((user + 1).alias("z")).alias("more"),
            F.array(F.struct(user.alias("p"), F.lit(None).cast("string").alias("q")),
                    F.struct(user.alias("p"), kind.alias("q"))).alias("parts")).alias("tag")) \
            .write.json(f"{run}/landing/stage2")
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts, retries=1)
        _RUNS[key] = (run, opts)
    run, opts = _RUNS[key]
    return read_bronze(spark, f"{run}/bronze", f"{run}/state", opts).select(
        "event_id", F.col("tag.k").alias("tag_k"), F.col("tag.note").alias("tag_note"),
        F.col("tag.more.z").alias("more_z"), F.size("tag.parts").cast("long").alias("n_parts"),
        F.get(F.col("tag.parts"), F.lit(0))["p"].alias("first_p"), F.get(F.col("tag.parts"), F.lit(1))["q"].alias("second_q"),
        "_rescued_data")


def q_bronze_replay(spark, sf_dir):
    """The last batch replayed, its commit forgotten: rows per event type, each once."""
    key = ("replay", sf_dir)
    if key not in _RUNS:
        run, opts = new_run_dir(spark, "replay"), IngestOptions(schema_hints=EVENT_HINTS)
        _land_by_day(_events(spark, sf_dir), f"{run}/landing")
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)
        commits = f"{run}/state/checkpoint/commits"
        last = max(int(n) for n in storage.children(spark, commits) if n.isdigit())
        storage.delete(spark, f"{commits}/{last}")
        ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/state", opts)
        _RUNS[key] = read_bronze(spark, f"{run}/bronze", f"{run}/state", opts)
    return _RUNS[key].groupBy("event_type").agg(F.count("*").alias("rows"),
                                                F.count_distinct("event_id").alias("events"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "silver_order_lines": q_silver_order_lines,
        "gold_daily_store_sales": q_gold_daily_store_sales,
        "gold_top_items": q_gold_top_items,
        "gold_channel_mix": q_gold_channel_mix,
        "expectation_counts": q_expectation_counts,
        "quarantine": q_quarantine,
        "order_lines_outer": q_order_lines_outer,
        "gold_daily_store_sales_sql": q_gold_daily_store_sales_sql,
        "store_league": q_store_league,
        "top_items_report": q_top_items_report,
        "bronze_events": q_bronze_events,
        "bronze_total_rows": q_bronze_total_rows,
        "bronze_per_file": q_bronze_per_file,
        "landing_listing": q_landing_listing,
        "bronze_rescue": q_bronze_rescue,
        "bronze_evolution": q_bronze_evolution,
        "new_column_population": q_new_column_population,
        "table_changes": q_table_changes,
        "pipeline_gold_daily_store_sales": q_pipeline_gold_daily_store_sales,
        "pipeline_gold_top_items": q_pipeline_gold_top_items,
        "pipeline_gold_channel_mix": q_pipeline_gold_channel_mix,
        "pipeline_row_counts": q_pipeline_row_counts,
        "event_log_expectations": q_event_log_expectations,
        "live_channel_sales": q_live_channel_sales,
        "dimension_csv": q_dimension_csv,
        "bronze_none_mode": q_bronze_none_mode,
        "bronze_fail_on_new_columns": q_bronze_fail_on_new_columns,
        "event_log_sql": q_event_log_sql,
        "catalog_gold_channel_mix": q_catalog_gold_channel_mix,
        "dimension_table": q_dimension_table,
        "live_channel_sales_append": q_live_channel_sales_append,
        "pipeline_quarantine": q_pipeline_quarantine,
        "silver_order_lines_sql": q_silver_order_lines_sql,
        "gold_subcent": q_gold_subcent,
        "gold_exact_sums": q_gold_exact_sums,
        "bronze_lossless_text": q_bronze_lossless_text,
        "expectations_after_reset": q_expectations_after_reset,
        "view_follows_dimension": q_view_follows_dimension,
        "bronze_lossless": q_bronze_lossless,
        "bronze_replay": q_bronze_replay,
        "bronze_nested_evolution": q_bronze_nested_evolution,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: gold_daily_store_sales over the sf0.001 tables."""
    return queries()["gold_daily_store_sales"](spark, SMOKE_DIR)


# ---------------------------------------------------------------- oracle SQL (DuckDB)
_CTE = adapter.oracle_lines_cte()
_SILVER = f"""WITH {_CTE},
silver AS (SELECT * FROM lines
           WHERE order_id IS NOT NULL AND store_id IS NOT NULL AND COALESCE(qty > 0, false)
             AND CASE WHEN currency = 'INR' THEN true ELSE error('currency_is_inr') END)"""
_CENTS = "SUM(CAST(ROUND(line_amount * 100) AS BIGINT))"


def _ratio(c: str, n: str) -> str:
    return (f"CAST(CASE WHEN {n} > 0 THEN CAST(sign({c}) AS BIGINT) * ((2 * abs({c}) + {n}) // (2 * {n})) END "
            f"AS DOUBLE) / 100.0")


_STORES = ("SELECT CAST(n_nationkey AS VARCHAR) AS store_id, n_name AS store_name, n_name AS city, r_name AS region "
           "FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
_MENU = ("SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_name, p_type AS category, "
         "p_retailprice AS base_price FROM part")

_RULE_SQL = [  # (name, action, predicate) — DEFAULT_RULES with now = AS_OF
    ("valid_order_id", "drop", "order_id IS NOT NULL"),
    ("valid_store", "drop", "store_id IS NOT NULL"),
    ("positive_qty", "drop", "qty > 0"),
    ("non_negative_amount", "warn", "line_amount >= 0"),
    ("known_channel", "warn", "channel IN ('DINE_IN','TAKEAWAY','DELIVERY','DRIVE_THRU','KIOSK')"),
    ("plausible_timestamp", "warn", f"order_ts <= TIMESTAMP '{AS_OF}'"),
    ("currency_is_inr", "fail", "currency = 'INR'"),
]


def _gold_sql(view: str) -> str:
    """Oracle body of one gold view over the CTE ``silver`` (appended after ``_SILVER``)."""
    return {
        "gold_daily_store_sales": f""",
            agg AS (SELECT order_date, store_id, COUNT(DISTINCT order_id) AS orders, {_CENTS} AS c,
                           CAST(SUM(qty) AS BIGINT) AS units_sold FROM silver GROUP BY order_date, store_id),
            gold AS (SELECT order_date, agg.store_id, s.store_name, s.city, s.region, orders,
                   CAST(c AS DOUBLE) / 100.0 AS revenue, units_sold, {_ratio('c', 'orders')} AS avg_basket_value
            FROM agg LEFT JOIN ({_STORES}) s ON agg.store_id = s.store_id)""",
        "gold_top_items": f""",
            agg AS (SELECT order_date, item_id, CAST(SUM(qty) AS BIGINT) AS units_sold, {_CENTS} AS c,
                           COUNT(DISTINCT order_id) AS orders_containing_item FROM silver GROUP BY order_date, item_id),
            gold AS (SELECT order_date, agg.item_id, m.item_name, m.category, units_sold,
                   CAST(c AS DOUBLE) / 100.0 AS revenue, orders_containing_item
            FROM agg LEFT JOIN ({_MENU}) m ON agg.item_id = m.item_id)""",
        "gold_channel_mix": f""",
            gold AS (SELECT order_date, channel, payment_method, COUNT(DISTINCT order_id) AS orders,
                   CAST({_CENTS} AS DOUBLE) / 100.0 AS revenue
            FROM silver GROUP BY order_date, channel, payment_method)""",
    }[view]


def oracle_sql() -> dict[str, str]:
    report = " UNION ALL ".join(
        f"SELECT '{n}' AS name, '{a}' AS action, "
        f"CAST(count(*) - count(*) FILTER (WHERE NOT COALESCE({p}, false)) AS BIGINT) AS passed_records, "
        f"CAST(count(*) FILTER (WHERE NOT COALESCE({p}, false)) AS BIGINT) AS failed_records FROM lines"
        for n, a, p in _RULE_SQL)
    keep = " AND ".join(f"COALESCE({p}, false)" for n, a, p in _RULE_SQL if a == "drop")
    fails = ", ".join(f"CASE WHEN NOT COALESCE({p}, false) THEN '{n}' END" for n, a, p in _RULE_SQL if a == "drop")
    gold_sql = {v: f"{_SILVER}{_gold_sql(v)} SELECT * FROM gold"
                for v in ("gold_daily_store_sales", "gold_top_items", "gold_channel_mix")}
    cents2 = "CAST(SUM(CAST(ROUND({x} * 100) AS BIGINT)) AS DOUBLE) / 100.0"
    per_rule = " UNION ALL ".join(
        f"SELECT '{n}' AS expectation, "
        f"CAST(count(*) - count(*) FILTER (WHERE NOT COALESCE({p}, false)) AS BIGINT) AS passed, "
        f"CAST(count(*) FILTER (WHERE NOT COALESCE({p}, false)) AS BIGINT) AS failed FROM lines"
        for n, a, p in _RULE_SQL)
    evolve = f"TIMESTAMP '{EVOLVE_AT}'"
    return _training_data()[1] | {
        "silver_order_lines": f"{_SILVER} SELECT * FROM silver",
        **gold_sql,
        "expectation_counts": f"WITH {_CTE} {report}",
        "quarantine": f"""WITH {_CTE}
            SELECT order_id, item_id, qty, store_id, concat_ws(',', {fails}) AS failed_rules
            FROM lines WHERE NOT ({keep})""",
        "order_lines_outer": f"""WITH {adapter.oracle_lines_cte('LEFT JOIN')}
            SELECT order_id, item_id, qty, line_amount FROM lines""",
        "gold_daily_store_sales_sql": gold_sql["gold_daily_store_sales"],
        "store_league": f"""{_SILVER}{_gold_sql('gold_daily_store_sales')}
            SELECT region, city, store_name, CAST(SUM(orders) AS BIGINT) AS orders,
                   {cents2.format(x='revenue')} AS revenue,
                   {_ratio('SUM(CAST(ROUND(avg_basket_value * 100) AS BIGINT))', 'COUNT(avg_basket_value)')}
                     AS avg_basket
            FROM gold GROUP BY region, city, store_name""",
        "top_items_report": f"""{_SILVER}{_gold_sql('gold_top_items')}
            SELECT category, item_name, CAST(SUM(units_sold) AS BIGINT) AS units,
                   {cents2.format(x='revenue')} AS revenue
            FROM gold GROUP BY category, item_name
            ORDER BY revenue DESC, category, item_name LIMIT 15""",
        "bronze_events": "SELECT event_id, ts, user_id, event_type, value, props, "
                         "CAST(NULL AS VARCHAR) AS _rescued_data FROM events",
        "bronze_total_rows": "SELECT count(*) AS total_rows FROM events",
        "bronze_per_file": "SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY CAST(ts AS DATE)",
        "landing_listing": "SELECT count(DISTINCT CAST(ts AS DATE)) AS day_folders FROM events",
        "bronze_rescue": """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
                   event_type,
                   CASE WHEN event_type = 'error' THEN '{"user_id":"u' || CAST(user_id AS VARCHAR) || '"}'
                        WHEN event_type = 'signup' THEN '{"extra":1}' END AS _rescued_data
            FROM events""",
        "bronze_evolution": f"""SELECT event_id, event_type,
                   CASE WHEN ts < {evolve} THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS props_k
            FROM events""",
        "new_column_population": f"""SELECT CAST(ts AS DATE) AS day, count(*) AS rows,
                   count(*) FILTER (WHERE ts >= {evolve}) AS with_props
            FROM events GROUP BY CAST(ts AS DATE)""",
        "table_changes": f"SELECT event_id, 'insert' AS _change_type FROM events WHERE ts >= {evolve}",
        "pipeline_gold_daily_store_sales": gold_sql["gold_daily_store_sales"],
        "pipeline_gold_top_items": gold_sql["gold_top_items"],
        "pipeline_gold_channel_mix": gold_sql["gold_channel_mix"],
        "pipeline_row_counts": f"""{_SILVER}
            SELECT 'bronze_orders' AS tbl, count(*) AS rows
              FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
            UNION ALL SELECT 'silver_order_lines', count(*) FROM silver
            UNION ALL SELECT 'gold_daily_store_sales', count(*) FROM (SELECT DISTINCT order_date, store_id FROM silver)
            UNION ALL SELECT 'gold_top_items', count(*) FROM (SELECT DISTINCT order_date, item_id FROM silver)
            UNION ALL SELECT 'gold_channel_mix', count(*)
              FROM (SELECT DISTINCT order_date, channel, payment_method FROM silver)""",
        "event_log_expectations": f"WITH {_CTE} {per_rule}",
        "live_channel_sales": f"""SELECT CAST(ts AS DATE) AS order_date, event_type AS channel, count(*) AS orders,
                   {cents2.format(x='value')} AS revenue
            FROM events GROUP BY CAST(ts AS DATE), event_type""",
        "dimension_csv": "SELECT n_nationkey AS store_id, n_name AS store_name, n_name AS city, r_name AS region "
                         "FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
        "bronze_none_mode": """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
                   event_type,
                   CASE WHEN event_type = 'error' THEN '{"user_id":"u' || CAST(user_id AS VARCHAR) || '"}' END
                     AS _rescued_data
            FROM events""",
        "bronze_fail_on_new_columns": f"SELECT event_id, event_type FROM events WHERE ts < {evolve}",
        "event_log_sql": f"WITH {_CTE} {per_rule}",
        "view_follows_dimension": f"""{_SILVER}{_gold_sql("gold_daily_store_sales")}
            SELECT order_date, store_id, orders, revenue, units_sold, avg_basket_value,
                   CASE WHEN region = 'ASIA' THEN 'New ' || store_name
                        WHEN region IS DISTINCT FROM 'AFRICA' THEN store_name END AS store_name,
                   CASE WHEN region IS DISTINCT FROM 'AFRICA' THEN city END AS city,
                   CASE WHEN region = 'ASIA' THEN 'EAST' WHEN region <> 'AFRICA' THEN region END AS region
            FROM gold""",
        "expectations_after_reset": f"WITH {_CTE} {per_rule}",
        "catalog_gold_channel_mix": gold_sql["gold_channel_mix"],
        "dimension_table": "SELECT n_nationkey AS store_id, n_name AS store_name, n_name AS city, r_name AS region "
                           "FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
        "pipeline_quarantine": f"""WITH {_CTE}
            SELECT order_id, item_id, qty, store_id, concat_ws(',', {fails}) AS failed_rules
            FROM lines WHERE NOT ({keep})""",
        "silver_order_lines_sql": f"{_SILVER} SELECT * FROM silver",
        "gold_subcent": """SELECT CAST(l_shipdate AS DATE) AS order_date, l_returnflag AS channel,
                   l_linestatus AS payment_method, count(DISTINCT l_orderkey) AS orders,
                   round(sum(l_quantity * 0.004), 2) AS revenue
            FROM lineitem GROUP BY ALL""",
        "gold_exact_sums": """SELECT CAST(l_shipdate AS DATE) AS order_date, l_returnflag AS channel,
                   l_linestatus AS payment_method, count(DISTINCT l_orderkey) AS orders,
                   round(sum(l_quantity / 4) + count(*) * pow(2.0, -21), 2) AS revenue
            FROM lineitem GROUP BY ALL""",
        "bronze_lossless_text": """SELECT event_id,
                   CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN true ELSE false END AS b,
                   CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS d,
                   CASE WHEN event_type <> 'view' THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS n,
                   CASE WHEN event_type <> 'error' THEN user_id + 0.25::DOUBLE END AS m,
                   CASE WHEN event_type <> 'purchase' THEN user_id + 0.5::DOUBLE END AS f,
                   CASE WHEN event_type = 'error' THEN 'y' END AS b_rescued,
                   CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d') || 'T10:11:12' END AS d_rescued,
                   CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' END AS n_rescued,
                   CASE WHEN event_type = 'error' THEN user_id || '.239' END AS m_rescued,
                   CASE WHEN event_type = 'purchase' THEN user_id || 'x' END AS f_rescued
            FROM events""",
        "bronze_lossless": """SELECT event_id, CASE WHEN value = floor(value) THEN CAST(value AS BIGINT) END AS value_typed,
                   CAST(NULL AS BOOLEAN) AS flag_typed, CAST(1 AS BIGINT) AS tag_k,
                   CASE WHEN value <> floor(value) THEN CAST(value AS DOUBLE) END AS value_rescued,
                   user_id AS flag_rescued, CASE WHEN event_type = 'error' THEN event_type END AS note_rescued
            FROM events""",
        "bronze_nested_evolution": f"""SELECT event_id, user_id AS tag_k,
                   CASE WHEN ts >= {evolve} THEN event_type END AS tag_note,
                   CASE WHEN ts >= {evolve} THEN user_id + 1 END AS more_z,
                   CASE WHEN ts >= {evolve} THEN 2::BIGINT ELSE 1::BIGINT END AS n_parts, user_id AS first_p,
                   CASE WHEN ts >= {evolve} THEN event_type END AS second_q, CAST(NULL AS VARCHAR) AS _rescued_data
            FROM events""",
        "bronze_replay": "SELECT event_type, count(*) AS rows, count(DISTINCT event_id) AS events FROM events GROUP BY 1",
        # append mode emits a day once the watermark (max event time - 1 day) has passed its end
        "live_channel_sales_append": f"""SELECT CAST(ts AS DATE) AS order_date, event_type AS channel,
                   count(*) AS orders, {cents2.format(x='value')} AS revenue
            FROM events
            WHERE ts <= TIMESTAMP '{AS_OF}'
            GROUP BY CAST(ts AS DATE), event_type
            HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY
                   <= (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{AS_OF}') - INTERVAL 1 DAY""",
    }
