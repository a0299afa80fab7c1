"""Keyed upsert, replacement by city, referential checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis import config
from zonalis.functions.dates import instant
from zonalis.operators.lookups import lookup_join

ACTION = "accion"


def merge(target: DataFrame, incoming: DataFrame, key: str = config.ANALYTICS_KEY,
          update: Sequence[str] = config.UPSERT_COLUMNS,
          as_of: str | dt.date | None = None) -> DataFrame:
    """Target after the upsert, with the action per row: insertado, actualizado, sin_cambio.

    A known key takes the ``update`` columns from ``incoming``, nulls included,
    and keeps all others. With ``as_of`` the load and update times are kept as
    well. Keys are unique on both sides (see ``load_violations``), so the one
    full outer join cannot be skewed; a target bucketed by key is not shuffled.
    """
    extra = ["fecha_carga", "fecha_actualizacion"] if as_of else []
    columns = [c for c in target.columns if c not in extra]
    old = target.select(F.col(key).alias("_key"), F.lit(True).alias("_known"),
                        *[F.col(c).alias(f"t_{c}") for c in target.columns])
    new = incoming.select(F.col(key).alias("_key"), F.lit(True).alias("_arrives"),
                          *[F.col(c).alias(f"i_{c}") for c in columns])
    both = old.join(new, "_key", "full_outer")

    known, arrives = F.col("_known").isNotNull(), F.col("_arrives").isNotNull()
    action = (F.when(known & arrives, F.lit("actualizado"))
              .when(arrives, F.lit("insertado")).otherwise(F.lit("sin_cambio")))
    values = []
    for c in columns:
        from_incoming = arrives if c in update else ~known
        values.append(F.when(from_incoming, F.col(f"i_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
    if as_of:
        now = instant(as_of)
        values.append(F.when(known, F.col("t_fecha_carga")).otherwise(now).alias("fecha_carga"))
        values.append(F.when(arrives, now).otherwise(F.col("t_fecha_actualizacion"))
                      .alias("fecha_actualizacion"))
    return both.select(*values, action.alias(ACTION))


def upsert(target: DataFrame, incoming: DataFrame, **options) -> DataFrame:
    return merge(target, incoming, **options).drop(ACTION)


def action_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy(ACTION).agg(F.count("*").alias("filas"))


def replace_by(existing: DataFrame, new: DataFrame, key: str = "ciudad") -> DataFrame:
    """All rows of ``new``, and those of ``existing`` whose key value is not in ``new``."""
    kept = existing.join(new.select(key).distinct(), key, "left_anti")
    return kept.select(*existing.columns).unionByName(new.select(*existing.columns))


def _has_parent(child: DataFrame, parent: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    parents = parent.select(*[F.col(p).alias(c) for c, p in keys]).distinct().withColumn(
        "_parent", F.lit(True))
    return lookup_join(child, parents, [c for c, _ in keys])


ZONE_REFERENCE = (("cluster_zona", "cluster_id"), ("ciudad", "ciudad"))


def reference_violations(child: DataFrame, parent: DataFrame,
                         keys: Sequence[tuple[str, str]] = ZONE_REFERENCE) -> DataFrame:
    """Child rows whose reference has no parent; a reference with a null passes."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c, _ in keys])
    checked = child.filter(complete)
    parents = parent.select(*[F.col(p).alias(c) for c, p in keys]).distinct()
    return lookup_join(checked, parents, [c for c, _ in keys], "left_anti").select(*child.columns)


def set_null_without_parent(child: DataFrame, parent: DataFrame, column: str = "cluster_zona",
                            keys: Sequence[tuple[str, str]] = ZONE_REFERENCE) -> DataFrame:
    """The child with ``column`` null where its parent does not exist (any more)."""
    checked = _has_parent(child, parent, keys)
    return checked.withColumn(column, F.when(F.col("_parent"), F.col(column))).select(*child.columns)


def zone_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(ciudad, cluster_id, cambio) of the zones of ``old`` that are gone from ``new`` or lie elsewhere there."""
    at = ("centroide_lat", "centroide_lng")
    after = new.select("ciudad", "cluster_id", *[F.col(c).alias(f"_{c}") for c in at], F.lit(True).alias("_there"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in at])
    return (lookup_join(old.select("ciudad", "cluster_id", *at), after, ["ciudad", "cluster_id"])
            .filter(F.col("_there").isNull() | ~same)
            .select("ciudad", "cluster_id",
                    F.when(F.col("_there"), F.lit("movida")).otherwise(F.lit("eliminada")).alias("cambio")))


def referring(child: DataFrame, changes: DataFrame, keys: Sequence[tuple[str, str]] = ZONE_REFERENCE) -> DataFrame:
    """Child rows that refer to a changed parent."""
    gone = changes.select(*[F.col(p).alias(c) for c, p in keys]).distinct()
    return lookup_join(child, gone, [c for c, _ in keys], "left_semi").select(*child.columns)


def set_null_where_changed(child: DataFrame, changes: DataFrame, column: str = "cluster_zona",
                           keys: Sequence[tuple[str, str]] = ZONE_REFERENCE) -> DataFrame:
    """The child with ``column`` null where its parent has changed."""
    gone = changes.select(*[F.col(p).alias(c) for c, p in keys]).distinct().withColumn("_gone", F.lit(True))
    return lookup_join(child, gone, [c for c, _ in keys]).withColumn(
        column, F.when(F.col("_gone").isNull(), F.col(column))).select(*child.columns)
