"""Content kept in versions: files first, then the manifest that makes them visible.

``path/data/<version>`` holds files, ``path/manifest/version=<version>`` one row per part of the content with the folder it
lies in. Readers follow the newest manifest. A manifest is one file, which Spark puts in place by a rename when it is
complete, so a job that ends half-way leaves the version before.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.sources.session import constant_frame, shared_folder

MANIFEST = "part int, folder string, format string, parts int"


def new_version() -> str:
    """Versions sort by the time they were begun."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, its path object) of a path of any scheme."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it does not exist."""
    fs, place = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, place = file_system(spark, path)
    fs.delete(place, True)


def complete_versions(spark: SparkSession, path: str) -> list[str]:
    """Versions with a whole manifest, oldest first."""
    return [name.removeprefix("version=") for name in listed(spark, f"{path}/manifest") if name.startswith("version=")
            and any(f.endswith(".parquet") for f in listed(spark, f"{path}/manifest/{name}"))]


def manifest(spark: SparkSession, path: str) -> tuple[str, dict[int, str], str, int] | None:
    """(version, folder by part, schema, number of parts) of the newest version; None before the first."""
    found = complete_versions(spark, path)
    if not found:
        return None
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/version={found[-1]}").collect()
    return found[-1], {r["part"]: r["folder"] for r in rows if r["folder"]}, rows[0]["format"], rows[0]["parts"]


def publish(spark: SparkSession, path: str, version: str, folders: dict[int, str], schema: str, parts: int) -> None:
    """Make a version visible. Parts without a folder are empty."""
    rows = [(p, f, schema, parts) for p, f in sorted(folders.items())] or [(0, None, schema, parts)]
    constant_frame(spark, rows, MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/version={version}")


def write(df: DataFrame, path: str) -> str:
    """A whole frame as the next version."""
    version = new_version()
    df.write.parquet(f"{path}/data/{version}")
    publish(df.sparkSession, path, version, {0: f"data/{version}"}, schema_text(df), 1)
    return version


def read(spark: SparkSession, path: str, parts: Iterable[int] | None = None) -> DataFrame:
    """The newest version, or only some of its parts."""
    found = manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no complete version in {path}")
    _, folders, schema, _ = found
    chosen = sorted(folders) if parts is None else [p for p in sorted(set(parts)) if p in folders]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folders[p]}" for p in chosen])


def schema_text(df: DataFrame, without: Sequence[str] = ()) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in without)


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` versions and the files none of these uses; returns the versions that left.

    Manifests go before files. Files of versions begun after the newest complete one stay: a job may be writing them.
    """
    found = complete_versions(spark, path)
    kept, gone = found[-keep:], found[:-keep]
    used = set()
    for v in kept:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/version={v}").select("folder").distinct().collect()
        used |= {r["folder"].split("/")[1] for r in rows if r["folder"]}
    for v in gone:
        remove(spark, f"{path}/manifest/version={v}")
    for v in listed(spark, f"{path}/data"):
        if kept and v <= kept[-1] and v not in used:
            remove(spark, f"{path}/data/{v}")
    return gone


def remove_stages(spark: SparkSession, older_than: dt.timedelta = dt.timedelta(days=2)) -> list[str]:
    """Remove intermediate results of this library from the shared folder that were begun before ``older_than``.

    Choose a time longer than any job takes; returns the names that left.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/stage"
    fs, place = file_system(spark, folder)
    if not fs.exists(place):
        return []
    limit = (time.time() - older_than.total_seconds()) * 1000
    old = [s.getPath() for s in fs.listStatus(place) if s.getModificationTime() < limit]
    for path in old:
        fs.delete(path, True)
    return sorted(path.getName() for path in old)


# --- tables in key buckets --------------------------------------------------

def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _write_buckets(rows: DataFrame, path: str, version: str, touched: Sequence[int], columns: Sequence[str]) -> dict[int, str]:
    """Write rows by ``_bucket``; the folder of every touched bucket that has rows."""
    spark = rows.sparkSession
    (rows.select("_bucket", *columns).repartition(max(1, len(touched)), "_bucket")
     .write.partitionBy("_bucket").parquet(f"{path}/data/{version}"))
    there = {int(n.split("=")[1]) for n in listed(spark, f"{path}/data/{version}") if n.startswith("_bucket=")}
    return {b: f"data/{version}/_bucket={b}" for b in sorted(there)}


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> str:
    """A whole table in buckets of its key as the next version."""
    version = new_version()
    rows = df.withColumn("_bucket", bucket_of(key, buckets))
    folders = _write_buckets(rows, path, version, range(buckets), df.columns)
    publish(df.sparkSession, path, version, folders, schema_text(df), buckets)
    return version


def replace_buckets(spark: SparkSession, path: str, rows: DataFrame, touched: Iterable[int], key: str) -> str:
    """The next version: ``rows`` in place of the touched buckets, the others as they lie."""
    before, folders, schema, buckets = manifest(spark, path)
    touched, version = sorted(set(touched)), new_version()
    if not touched:
        return before
    new = _write_buckets(rows.withColumn("_bucket", bucket_of(key, buckets)), path, version, touched, rows.columns)
    publish(spark, path, version, {b: f for b, f in folders.items() if b not in touched} | new, schema, buckets)
    return version


def buckets_of(df: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that hold the keys of ``df``: at most ``buckets`` numbers."""
    return sorted(r["b"] for r in df.select(bucket_of(key, buckets).alias("b")).distinct().collect())
