"""Account-table sources and sinks: CSV/parquet scan, target checks, CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def prepare_accounts(df: DataFrame, target: str = "y") -> DataFrame:
    """Drop index-like columns ("Unnamed..."), require the target, cast it to int."""
    df = df.drop(*[c for c in df.columns if "Unnamed" in c])
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    return df.withColumn(target, F.col(target).cast("int"))


def load_accounts(spark: SparkSession, path: str, target: str = "y", fmt: str | None = None,
                  schema: str | None = None) -> DataFrame:
    """Scan an account table (CSV with header / parquet) and prepare it.

    CSV schema inference reads the data twice; pass ``schema`` for large inputs."""
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
        df = reader.csv(path)
    else:
        df = reader.parquet(path) if schema is None else reader.schema(schema).parquet(path)
    return prepare_accounts(df, target)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Sink: parquet by default, CSV with a header on request (one file per task)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
