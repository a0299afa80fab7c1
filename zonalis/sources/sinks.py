"""Writes: reports, training set, zones, analytics versions, segments, records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.operators.features import training_rows


def write_csv_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("header", True).csv(path)


def write_training_set(df: DataFrame, path: str) -> dict[str, int]:
    """Rows with a closing price, partitioned by transaction type; returns rows per type."""
    training_rows(df).write.mode("overwrite").partitionBy("tipo_transaccion").parquet(path)
    written = df.sparkSession.read.parquet(path)
    return {r["tipo_transaccion"]: r["n"] for r in
            written.groupBy("tipo_transaccion").agg(F.count("*").alias("n")).collect()}


def write_zones(zones: DataFrame, path: str) -> None:
    """Replace the zones of the cities in ``zones`` and leave other cities alone."""
    (zones.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ciudad").parquet(path))


def write_version(df: DataFrame, root: str, version: str) -> str:
    """A new, never overwritten version of a table; readers switch once it is complete."""
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A table bucketed by its key, so that the next upsert does not shuffle it."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def write_segments(segments: DataFrame, path: str) -> None:
    segments.write.mode("overwrite").parquet(path)


def write_json_records(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").json(path)
