"""Reports on a run: reject detail and summary, counts per step and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DETAIL_KEYS = ("id_propiedad", "mlsid", "subtipo_original", "tipo_propiedad", "tipo_transaccion")


def reject_detail(rejects: DataFrame, keys: Sequence[str] = DETAIL_KEYS,
                  drop_null_keys: bool = True) -> DataFrame:
    """One row per property with its distinct reasons, sorted and joined.

    The set of reasons per group is small: reasons are a fixed list of texts.
    """
    rows = rejects.dropna(subset=list(keys)) if drop_null_keys else rejects
    return rows.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set("motivo")), ", ").alias("motivos"))


def reject_summary(rejects: DataFrame) -> DataFrame:
    """Distinct properties per reason, most frequent first."""
    return (rejects.select("id_propiedad", "motivo").distinct()
            .groupBy("motivo").agg(F.count("*").alias("total"))
            .orderBy(F.desc("total"), "motivo"))


def value_counts(df: DataFrame, column: str, total: str = "total") -> DataFrame:
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count("*").alias(total)).orderBy(F.desc(total), column))


def group_counts(df: DataFrame, keys: Sequence[str], cities: str | None = None) -> DataFrame:
    """Rows per group, and distinct cities when a city column is named."""
    counts = [F.count("*").alias("filas")]
    if cities:
        counts.append(F.count_distinct(cities).alias("ciudades"))
    return df.groupBy(*keys).agg(*counts)
