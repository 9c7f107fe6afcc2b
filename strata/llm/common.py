"""Small helpers the operators share: table access, intermediate tables, Arrow batches."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import new_run_dir

_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Prepares Python workers: hands them this package, once per context, so that they need no path of their own to
    it; and lowers Spark's default of 10,000 rows per Arrow batch, which whole texts make too large."""
    context = spark.sparkContext
    if spark.conf.get(_ROWS, "10000") == "10000":
        spark.conf.set(_ROWS, "2000")
    if getattr(context, "_strata_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = f"{tempfile.mkdtemp(prefix='strata-code-')}/strata.zip"  # Spark copies it to every executor
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = f"{folder}/{name}"
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    context._strata_shipped = True


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` whose function may use this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage at a table every executor can read, so a lost executor costs the re-read of a file
    and never another run of what came before; ids that depend on the partitioning are fixed by it.
    """
    spark = df.sparkSession
    path = path or f"{new_run_dir(spark, label)}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def null_last(name: str):
    """Sort key by which a NULL id comes after every other one."""
    return F.struct(F.col(name).isNull().alias("none"), F.col(name).alias("id"))


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


@functools.lru_cache(maxsize=8)
def vocabulary_path(name: str) -> str:
    """Where the public vocabulary file ``name`` lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
