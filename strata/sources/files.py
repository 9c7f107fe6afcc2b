"""Batch file scans: dimension CSVs, landing-zone listing, table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Header + inferred types (dates come out as DATE)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def load_dimensions(spark: SparkSession, reference_dir: str, database: str | None = None,
                    names=("stores", "menu_items"), warehouse_dir: str | None = None) -> dict[str, DataFrame]:
    """Read each ``<reference_dir>/<name>.csv`` (a file, or a folder of part files named ``<name>``);
    with ``database``, overwrite it as a Parquet table (K5)."""
    out = {}
    for name in names:
        df = read_csv_dimension(spark, f"{reference_dir.rstrip('/')}/{{{name},{name}.csv}}")
        if database:
            where = f" LOCATION '{warehouse_dir.rstrip('/')}/{database}.db'" if warehouse_dir else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
            w = df.write.mode("overwrite").format("parquet")
            if warehouse_dir:
                w = w.option("path", f"{warehouse_dir.rstrip('/')}/{name}")
            w.saveAsTable(f"{database}.{name}")
            df = spark.table(f"{database}.{name}")
        out[name] = df
    return out


def list_files(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """``path, name, size, modification_time`` of the files below ``directory`` (contents not read)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return (r.load(directory)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"),
                    F.col("modificationTime").alias("modification_time")))
