"""Incremental, exactly-once JSON file ingestion.

The stream reads the landing folder with Spark's *text* file source.  Its
schema (one ``value`` line plus file metadata) never changes, so the
checkpoint stays valid however the JSON evolves; all schema work happens per
micro-batch in ``foreachBatch``:

1. read every line under the schema that the batch is likely to have (a sample's
   for the first batch, else the stored one): a line that its typed fields write
   back byte for byte is done.  Any other is parsed with ``try_parse_json`` →
   VARIANT (NULL for invalid JSON); if there are none, steps 2–3 have nothing to
   find and are left out.  A batch is at most ``maxFilesPerTrigger`` (1000) files,
   which are read anew for each pass and never held in memory;
2. first batch: infer the schema of all lines with the distributed
   ``schema_of_variant_agg`` aggregate, apply hints, store it as version 0;
3. later batches, in ``addNewColumns`` / ``failOnNewColumns`` mode: one
   distributed pass collects the *names* of unseen top-level keys (metadata
   only, never rows); ``addNewColumns`` infers their types, stores version
   n+1 and raises :class:`UnknownFieldError`, so the batch commits nothing and
   is replayed — with the wider schema — on the next run; ``evolve_nested`` treats
   new keys inside stored objects, array elements and map values the same way
   (without it they are rescued);
4. project with ``try_variant_get`` and build ``_rescued_data``: what would not
   convert without loss, at any depth, is NULL in its column and rescued whole;
5. publish ``<table>/batch_id=<id>`` in one move: readers see a batch whole or
   not at all, and a replayed batch that is there already is left alone, so a
   retry after any failure leaves no duplicates, here or downstream.

Discovery, exactly-once bookkeeping and rate limiting are the file source's
own checkpoint log; ``maxFileAge`` is lifted so old late files are not
silently skipped (H8).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.variant import (fit_flags, read_whole, rescued_column, says_all, typed_columns,
                                      whole_columns)
from strata.sources import evolution, storage
from strata.sources.schema_store import (SchemaStore, all_strings, apply_hints, check_types_kept,
                                         schema_from_variant_type)

EVOLUTION_MODES = ("addNewColumns", "rescue", "failOnNewColumns", "none")
META_COLUMNS = ("source_file", "file_modified_at", "ingested_at")
# Internal column names while a batch is parsed (JSON fields may be called anything).
LINE, VAR, FITS, SRC, MTIME = ("__strata_line", "__strata_v", "__strata_fits", "__strata_src", "__strata_mtime")
WHOLE, PLAIN = "__strata_whole", "__strata_plain"
SAMPLE_LINES = 10_000  # of the first batch; what they show is checked against every line


class UnknownFieldError(RuntimeError):
    """New fields were seen; in addNewColumns mode the schema has been widened — re-run."""

    MARKER = "STRATA_UNKNOWN_FIELDS"

    def __init__(self, fields, version=None):
        self.fields = sorted(fields)
        where = f"; schema version {version} recorded, re-run to continue" if version is not None else ""
        super().__init__(f"{self.MARKER}: new fields {self.fields}{where}")


@dataclass
class IngestOptions:
    """Options of the incremental file source."""

    infer_column_types: bool = True
    schema_hints: str | None = None
    evolution_mode: str = "addNewColumns"
    # New keys inside stored objects count as new columns too; columns with a hint keep the hint's type.
    evolve_nested: bool = False
    rescued_data_column: str | None = "_rescued_data"
    # Bounds every micro-batch — and so first-batch inference — on a large backfill.
    max_files_per_trigger: int | None = 1000
    path_glob: str | None = None
    recursive: bool = True
    max_file_age: str = "36500d"
    schema: T.StructType | str | None = None  # fixed schema: skip inference
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.evolution_mode not in EVOLUTION_MODES:
            raise ValueError(f"evolution_mode must be one of {EVOLUTION_MODES}")


def file_stream(spark: SparkSession, source_dir: str, opts: IngestOptions) -> DataFrame:
    """Streaming DataFrame of raw lines + file metadata (lazy: nothing is read until started)."""
    r = spark.readStream.format("text").option("maxFileAge", opts.max_file_age)
    if opts.max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", opts.max_files_per_trigger)
    if opts.path_glob:
        r = r.option("pathGlobFilter", opts.path_glob)
    if opts.recursive:
        r = r.option("recursiveFileLookup", "true")
    for k, v in opts.extra.items():
        r = r.option(k, v)
    return r.load(source_dir).select(
        F.col("value").alias(LINE),
        F.col("_metadata.file_path").alias(SRC),
        F.col("_metadata.file_modification_time").alias(MTIME),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add the parsed line (VARIANT, NULL when it is not valid JSON); blank lines are skipped."""
    return lines.filter(F.trim(LINE) != "").select("*", F.try_parse_json(LINE).alias(VAR))


def _objects(parsed: DataFrame) -> DataFrame:
    """Lines that are JSON objects (valid JSON starting with ``{``)."""
    return parsed.filter(F.col(VAR).isNotNull() & F.ltrim(LINE).startswith("{"))


def infer_schema(spark: SparkSession, parsed: DataFrame, opts: IngestOptions, only=None) -> T.StructType:
    """Distributed inference over JSON objects (optionally only the keys in ``only``)."""
    objs = _objects(parsed)
    if only is not None:
        keep = F.array(*[F.lit(k) for k in only])
        m = F.try_variant_get(VAR, "$", "map<string,variant>")
        objs = objs.select(F.to_variant_object(F.map_filter(m, lambda k, _: F.array_contains(keep, k))).alias(VAR))
    t = objs.agg(F.schema_of_variant_agg(VAR)).first()[0]
    schema = schema_from_variant_type(spark, t)
    if not opts.infer_column_types:
        schema = all_strings(schema)
    return schema


def new_top_level_keys(parsed: DataFrame, schema: T.StructType) -> list[str]:
    """Distinct keys not in ``schema`` (case-insensitive); only names reach the driver, as the schema itself does."""
    known = F.array(*[F.lit(f.name.lower()) for f in schema.fields]) if schema.fields else F.array().cast(
        "array<string>")
    fields = F.try_variant_get(VAR, "$", "map<string,variant>")
    keys = (_objects(parsed).select(F.explode(F.map_keys(fields)).alias("k"))
            .filter(~F.array_contains(known, F.lower("k"))).distinct())
    return [r["k"] for r in keys.collect()]


def project(lines: DataFrame, schema: T.StructType, opts: IngestOptions, order: Sequence[str] = (),
            seen: Observation | None = None) -> DataFrame:
    """Typed columns, rescue column and metadata (bronze row shape) of raw lines.

    A line that its typed fields write back byte for byte (``says_all``; ``order`` is the likely order of its fields)
    is done.  Any other is parsed as VARIANT: first whether each field fits its type, then the typed values and the
    rescue column, which read that.  ``seen`` counts these others as ``parsed``.
    """
    lines = lines.filter(F.trim(LINE) != "")
    whole = read_whole(schema, LINE, order)
    read = lines.select(LINE, SRC, MTIME, *([] if whole is None else [whole.alias(WHOLE)]))
    read = read.select("*", (F.lit(False) if whole is None else says_all(schema, LINE, WHOLE)).alias(PLAIN))
    if seen is not None:
        read = read.observe(seen, F.count_if(~F.col(PLAIN)).alias("parsed"))
    read = read.select("*", F.when(~F.col(PLAIN), F.try_parse_json(LINE)).alias(VAR))
    typed = read.select("*", F.when(~F.col(PLAIN), fit_flags(schema, VAR)).alias(FITS))
    cols = typed_columns(schema, VAR, FITS)
    if whole is not None:
        cols = [F.when(F.col(PLAIN), w).otherwise(c).alias(f.name)
                for f, w, c in zip(schema.fields, whole_columns(schema, WHOLE), cols)]
    if opts.rescued_data_column:
        unknown = opts.evolution_mode != "none"
        rescued = rescued_column(schema, LINE, VAR, FITS, rescue_unknown=unknown)
        cols.append(F.when(~F.col(PLAIN), rescued).alias(opts.rescued_data_column))
    cols += [F.col(SRC).alias("source_file"), F.col(MTIME).alias("file_modified_at"),
             F.current_timestamp().alias("ingested_at")]
    return typed.select(*cols)


def key_order(lines: DataFrame) -> list[str]:
    """Keys of one object of the batch as its text has them."""
    row = parse_lines(lines).filter(F.col(VAR).isNotNull()).select(F.json_object_keys(LINE).alias("k")).first()
    return (row["k"] or []) if row else []


class BronzeWriter:
    """The ``foreachBatch`` body: evolve schema, project, write ``batch_id=<id>``."""

    def __init__(self, spark: SparkSession, table_dir: str, state_dir: str, opts: IngestOptions):
        self.spark, self.table_dir, self.opts = spark, table_dir.rstrip("/"), opts
        self.store = SchemaStore(spark, state_dir)
        self._latest = None  # read once per run: the running stream is the store's only writer

    def _write_version(self, version: int, schema: T.StructType) -> None:
        self.store.write(version, schema)
        self._latest = (version, schema)

    def latest(self):
        if self._latest is None:
            self._latest = self.store.latest()
        return self._latest

    def current_schema(self, parsed: DataFrame, latest) -> T.StructType:
        if latest is not None:
            version, schema = latest
            hinted = apply_hints(self.spark, schema, self.opts.schema_hints)
            check_types_kept(schema, hinted)
            if hinted != schema:  # hinted columns or nested fields that no batch has had yet
                self._write_version(version + 1, hinted)
                version, schema = version + 1, hinted
        elif self.opts.schema is not None:
            schema = self.opts.schema if isinstance(self.opts.schema, T.StructType) else \
                self.spark.createDataFrame([], self.opts.schema).schema
            schema = apply_hints(self.spark, schema, self.opts.schema_hints)
            self._write_version(0, schema)
            return schema
        else:
            schema = apply_hints(self.spark, infer_schema(self.spark, parsed, self.opts), self.opts.schema_hints)
            self._write_version(0, schema)
            return schema
        mode = self.opts.evolution_mode
        if mode in ("addNewColumns", "failOnNewColumns") and self.opts.evolve_nested:
            objects = _objects(parsed)
            fixed = evolution.hinted_columns(self.spark, self.opts.schema_hints)
            fresh = evolution.new_keys(objects, VAR, schema, skip=fixed)
            names = [evolution.path_text(at, k) for at, keys in fresh.items() for k in keys]
            if fresh:
                if mode == "failOnNewColumns":
                    raise UnknownFieldError(names)
                added = evolution.new_fields(self.spark, objects, VAR, fresh)
                if not self.opts.infer_column_types and () in added:
                    added[()] = all_strings(added[()])
                if not added:
                    return schema
                wider = apply_hints(self.spark, evolution.widened(schema, added), self.opts.schema_hints)
                self._write_version(version + 1, wider)
                raise UnknownFieldError(names, version + 1)
        elif mode in ("addNewColumns", "failOnNewColumns"):
            fresh = new_top_level_keys(parsed, schema)
            if fresh:
                if mode == "failOnNewColumns":
                    raise UnknownFieldError(fresh)
                added = infer_schema(self.spark, parsed, self.opts, only=fresh)
                if not added.fields:  # only keys without a type yet: rescued until data shows it
                    return schema
                hinted = apply_hints(self.spark, T.StructType(schema.fields + added.fields), self.opts.schema_hints)
                self._write_version(version + 1, hinted)
                raise UnknownFieldError(fresh, version + 1)
        return schema

    def needs_prepass(self, latest) -> bool:
        """Inference (first batch, no fixed schema) or new-field detection reads the batch before the write."""
        first = latest is None and self.opts.schema is None
        return first or self.opts.evolution_mode in ("addNewColumns", "failOnNewColumns")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if storage.published(self.spark, self.table_dir, batch_id):
            return  # a replay of a batch whose rows are in the table already
        latest = self.latest()
        fixed = latest is None and self.opts.schema is not None
        if self.needs_prepass(latest) and not fixed:
            self._checked(batch, batch_id, latest)
        else:
            schema = self.current_schema(parse_lines(batch), latest)
            storage.publish(project(batch, schema, self.opts, key_order(batch)), self.table_dir, batch_id)

    def _checked(self, batch: DataFrame, batch_id: int, latest) -> None:
        """Writes the batch under the schema that it is likely to have and counts the lines that do not show by
        themselves that they fit it.  Where there are any, all lines are read for inference or new keys, and the batch is
        written again if that gives another schema.  The files are read anew each time, so no batch is held in memory.
        """
        parsed = parse_lines(batch)
        if latest is None:
            sample = parsed.limit(SAMPLE_LINES)
            likely = apply_hints(self.spark, infer_schema(self.spark, sample, self.opts), self.opts.schema_hints)
        else:
            likely = apply_hints(self.spark, latest[1], self.opts.schema_hints)
            check_types_kept(latest[1], likely)
        order = key_order(batch)
        seen = Observation(f"ingest_{batch_id}_{uuid.uuid4().hex[:8]}")
        staged = f"{self.table_dir}/_staged/batch_id={batch_id}"
        project(batch, likely, self.opts, order, seen).write.mode("overwrite").option(
            "compression", storage.CODEC).parquet(staged)
        if int(seen.get.get("parsed") or 0):
            try:
                schema = self.current_schema(parsed, latest)
            except UnknownFieldError:
                storage.delete(self.spark, staged)  # the replay writes the batch under the wider schema
                raise
            if schema != likely:
                project(batch, schema, self.opts, order).write.mode("overwrite").option(
                    "compression", storage.CODEC).parquet(staged)
        elif latest is None or likely != latest[1]:
            self._write_version(0 if latest is None else latest[0] + 1, likely)
        storage.rename(self.spark, staged, f"{self.table_dir}/batch_id={batch_id}")


def _is_unknown_field(exc: BaseException) -> bool:
    return UnknownFieldError.MARKER in str(exc)


def ingest(spark: SparkSession, source_dir: str, table_dir: str, state_dir: str,
           opts: IngestOptions | None = None, *, trigger: dict | None = None, retries: int = 0,
           query_name: str | None = None, wait: bool = True):
    """Run the bronze stream (default ``availableNow``) and return the StreamingQuery.

    ``retries`` re-runs the stream after :class:`UnknownFieldError` in
    ``addNewColumns`` mode only (its "fail once, succeed on retry" contract);
    any other error propagates.  With ``wait=False`` the started query is returned.
    """
    opts = opts or IngestOptions()
    trigger = trigger or {"availableNow": True}
    attempt = 0
    storage.check_same_stream(spark, table_dir, f"{state_dir.rstrip('/')}/checkpoint")
    while True:
        writer = BronzeWriter(spark, table_dir, state_dir, opts)
        w = (file_stream(spark, source_dir, opts).writeStream
             .foreachBatch(writer)
             .option("checkpointLocation", f"{state_dir.rstrip('/')}/checkpoint")
             .trigger(**trigger))
        if query_name:
            w = w.queryName(query_name)
        q = w.start()
        if not wait:
            return q
        try:
            q.awaitTermination()
            return q
        except StreamingQueryException as e:
            if attempt < retries and opts.evolution_mode == "addNewColumns" and _is_unknown_field(e):
                attempt += 1
                time.sleep(0.1)
                continue
            raise


def bronze_schema(spark: SparkSession, state_dir: str, opts: IngestOptions | None = None) -> T.StructType:
    """Full bronze schema (latest data schema + rescue + metadata + batch_id)."""
    opts = opts or IngestOptions()
    latest = SchemaStore(spark, state_dir).latest()
    data = latest[1] if latest else T.StructType([])
    extra = []
    if opts.rescued_data_column:
        extra.append(T.StructField(opts.rescued_data_column, T.StringType(), True))
    extra += [T.StructField("source_file", T.StringType(), True),
              T.StructField("file_modified_at", T.TimestampType(), True),
              T.StructField("ingested_at", T.TimestampType(), True),
              T.StructField("batch_id", T.LongType(), True)]
    return T.StructType(data.fields + extra)


def read_bronze(spark: SparkSession, table_dir: str, state_dir: str, opts: IngestOptions | None = None) -> DataFrame:
    """Batch read of the bronze table under the latest schema (older batches: new columns NULL)."""
    schema = bronze_schema(spark, state_dir, opts)
    return spark.read.schema(schema).option("mergeSchema", "true").parquet(table_dir)


def stream_bronze(spark: SparkSession, table_dir: str, state_dir: str, opts: IngestOptions | None = None,
                  max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Streaming read of the bronze table (S16); restarts with a wider schema keep the checkpoint."""
    # Old batches that this reader has not seen yet count as well, however late.
    r = spark.readStream.schema(bronze_schema(spark, state_dir, opts)).option("maxFileAge", "36500d")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(table_dir)
