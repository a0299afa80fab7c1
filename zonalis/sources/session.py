"""Session helpers: small constant frames, the shared checkpoint folder, staging."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def constant_frame(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A frame of configuration rows, planned as a local relation (no Python worker, no job)."""
    struct = T.StructType.fromDDL(schema)
    rows = list(rows)
    arrow = to_arrow_schema(struct)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=struct)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches, as named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="zonalis-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def shuffle_parts(spark: SparkSession) -> int:
    """The number of shuffle tasks of the session, for spreading hot groups."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Read by Spark when a query begins: its shuffle files go when it ends, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in here leave no shuffle files; nothing reads those of a written frame again."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and later passes read only the
    columns they need. The shuffle files of the writing are removed. With ``by`` they also read only the values of that
    column they ask for.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stage/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small frame (statistics, centroids)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
