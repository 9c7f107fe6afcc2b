"""Continuous daily aggregation with a watermark.

``daily_window_agg`` declares: cast the event time, optionally drop
implausible (future) timestamps, ``withWatermark``, 1-day tumbling
``window`` + key, ``count`` and exact revenue.  ``start`` runs it with
any trigger and output mode into

* ``memory`` — a queryable in-driver table, as in the reference (results are
  #days x #keys, tiny); or
* ``parquet`` — ``foreachBatch`` publishing ``batch_id=<id>`` folders on shared
  storage; ``read_result`` gives the table: the newest batch in complete mode,
  all of them in append mode, the newest row of each window in update mode.

Output modes (D4, H4): ``complete`` re-emits everything and never evicts
state — the watermark then bounds nothing; ``update``/``append`` let the
watermark evict state and drop late rows.  One far-future row (the 2099
defect) pushes the watermark decades ahead and every later real row becomes
"late"; ``drop_future=True`` filters such rows *before* ``withWatermark``
(T8).  Buckets are UTC days (the session zone is UTC).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.money import amount_total
from strata.sources import storage


def daily_window_agg(stream: DataFrame, *, ts_col: str = "order_ts", keys: Sequence[str] = ("channel",),
                     amount_col: str = "order_total", window: str = "1 day", watermark: str | None = "1 day",
                     drop_future: bool = False, as_of: str | None = None, date_col: str = "order_date",
                     count_col: str = "orders", amount_out: str = "revenue") -> DataFrame:
    df = stream.withColumn(ts_col, F.col(ts_col).try_cast("timestamp"))
    if drop_future:
        now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
        df = df.filter(F.col(ts_col) <= now)
    if watermark:
        df = df.withWatermark(ts_col, watermark)
    agg = (df.groupBy(F.window(ts_col, window), *keys)
           .agg(F.count(F.lit(1)).alias(count_col), amount_total(amount_col).alias(amount_out)))
    return agg.select(F.col("window.start").cast("date").alias(date_col), *keys, count_col, amount_out)


def start(agg: DataFrame, *, name: str, checkpoint: str, sink: str = "memory", path: str | None = None,
          output_mode: str = "complete", trigger: dict | None = None) -> StreamingQuery:
    """Start the aggregation; default trigger ``processingTime='10 seconds'`` (continuous)."""
    w = (agg.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"processingTime": "10 seconds"})))
    if sink == "memory":
        return w.format("memory").start()
    if sink != "parquet" or not path:
        raise ValueError("sink must be 'memory' or 'parquet' with a path")
    if output_mode not in ("complete", "append", "update"):
        raise ValueError("output_mode must be complete, append or update")
    storage.check_same_stream(agg.sparkSession, path, checkpoint)

    def write(batch, batch_id):
        # keyed by batch: a replay adds nothing, and readers never lose the table
        if storage.published(batch.sparkSession, path, batch_id):
            batch.write.format("noop").mode("overwrite").save()  # the aggregation's state still has to be committed
        else:
            storage.publish(batch, path, batch_id)

    return w.foreachBatch(write).start()


def read_result(spark: SparkSession, path: str, output_mode: str, keys: Sequence[str]) -> DataFrame:
    """The result table of a parquet sink: the newest batch (complete), all batches (append) or the newest row of each
    of ``keys`` (update)."""
    rows = spark.read.parquet(path)
    if output_mode == "complete":
        newest = max(int(n.split("=")[1]) for n in storage.children(spark, path) if n.startswith("batch_id="))
        return rows.filter(F.col("batch_id") == newest).drop("batch_id")
    if output_mode == "update":
        last = rows.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))
        rows = rows.join(last, [*keys, "batch_id"], "left_semi")
    return rows.drop("batch_id")


def live_channel_sales(spark: SparkSession, bronze_dir: str, bronze_state: str, checkpoint: str, *,
                       name: str = "live_channel_sales", trigger: dict | None = None, output_mode: str = "complete",
                       drop_future: bool = False, as_of: str | None = None) -> StreamingQuery:
    """The reference's continuous read-out: bronze stream, one file per micro-batch, 1-day windows per
    channel, complete mode, 10-second trigger, queryable as the in-memory table ``name``."""
    from strata.sources.ingest import stream_bronze  # local import: streaming does not need ingest otherwise

    stream = stream_bronze(spark, bronze_dir, bronze_state, max_files_per_trigger=1)
    agg = daily_window_agg(stream, drop_future=drop_future, as_of=as_of)
    return start(agg, name=name, checkpoint=checkpoint, output_mode=output_mode, trigger=trigger)


def stop_all(spark: SparkSession) -> list[str]:
    """Stop every active stream of the session; returns their names."""
    names = []
    for q in spark.streams.active:
        names.append(q.name or q.id)
        q.stop()
    return names


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent progress as rows (batch, input rows, input/processing rates, batch duration)."""
    rows = [(p.get("batchId"), p.get("numInputRows"), p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond"),
             (p.get("durationMs") or {}).get("triggerExecution"), p.get("timestamp"))
            for p in (query.recentProgress or [])]
    return spark.createDataFrame(rows, "batch_id bigint, num_input_rows bigint, input_rows_per_second double, "
                                       "processed_rows_per_second double, batch_duration_ms bigint, timestamp string")
