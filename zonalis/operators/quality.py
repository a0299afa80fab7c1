"""Data quality: duplicates, required fields, outliers, price floors, load constraints.

An operator here adds a flag or an array of reasons to the frame it gets, so
that accepted and rejected rows are two filters on one frame and no input is
read twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis import config
from zonalis.operators.lookups import lookup_join
from zonalis.sources.session import constant_frame, shuffle_parts, small_checkpoint, staged

LITERAL_GROUPS = 200  # limits of so many groups are written into the expression
HOT_ROWS = 100_000  # a key with no more rows is ranked in one task
REJECT_COLUMNS = ("id_propiedad", "mlsid", "subtipo_original", "tipo_propiedad",
                  "segmento", "tipo_transaccion")


def no_reasons() -> Column:
    return F.array().cast("array<string>")


def reasons_if(*checks: tuple[Column, str]) -> Column:
    """The texts of all failed checks; a check that is null has not failed."""
    parts = [F.when(failed, F.array(F.lit(text))).otherwise(no_reasons()) for failed, text in checks]
    return F.concat(*parts) if parts else no_reasons()


# --- duplicates -------------------------------------------------------------

def _latest_first(df: DataFrame, key: str, latest_by: Sequence[str]) -> list[Column]:
    ties = [c for c in df.columns if c != key and c not in latest_by]
    return [F.col(c).desc_nulls_last() for c in (*latest_by, *ties)]


def flag_last(df: DataFrame, key: str, latest_by: Sequence[str], flag: str = "es_ultimo",
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mark the latest row of every key; rows without a key count as one key.

    Latest is decided by ``latest_by`` (nulls first), then by all other columns,
    so the choice does not depend on the order of the input; of identical rows
    one is marked. The rows are written once and shuffled once, by key. Keys
    with more than ``hot_rows`` rows and more than a task's share are fewer than
    the shuffle tasks: every task names its best row of these, and their rows
    are marked where they stand.
    """
    order = _latest_first(df, key, latest_by)
    rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    limit = max(hot_rows, rows.count() // shuffle_parts(df.sparkSession))
    hot = F.broadcast(small_checkpoint(rows.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n"))
                                       .filter(F.col("_n") > limit).select("_hot")))
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))

    def ranked(part: DataFrame) -> DataFrame:
        first = F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1
        return part.withColumn(flag, first).select(*df.columns, flag)

    if hot.isEmpty():
        return ranked(rows)
    heavy = rows.join(hot, is_hot, "left_semi")
    best = F.broadcast(small_checkpoint(keep_last(heavy, key, latest_by).select(
        F.col(key).alias("_hot"), F.col("_row").alias("_best"))))
    marked = heavy.join(best, is_hot).withColumn(flag, F.col("_row") == F.col("_best"))
    return ranked(rows.join(hot, is_hot, "left_anti")).unionByName(marked.select(*df.columns, flag))


def keep_last(df: DataFrame, key: str, latest_by: Sequence[str]) -> DataFrame:
    """Only the latest row of every key (see ``flag_last``).

    With the others not needed, every task keeps just its best row per key
    before the shuffle, so hot keys need no splitting.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*_latest_first(df, key, latest_by)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


# --- categories, areas, required fields -------------------------------------

def map_category(df: DataFrame, source: str, target: str, mapping: Mapping[str, str],
                 default: str) -> DataFrame:
    """Look a value up in a fixed table; anything unknown or null gets the default."""
    table = constant_frame(df.sparkSession, sorted(mapping.items()),
                           f"{source} string, _mapped string")
    return (lookup_join(df, table, source, at_most=len(mapping))
            .withColumn(target, F.coalesce("_mapped", F.lit(default))).drop("_mapped")
            .select(*df.columns, target))


def with_type_areas(df: DataFrame) -> DataFrame:
    """Built and land area as they count for each property type."""
    kind = F.col("tipo_propiedad")
    house, department, land = (kind == v for v in (config.HOUSE, config.DEPARTMENT, config.LAND))
    return df.withColumns({
        "m2_construidos": F.when(house | department, F.col("construction_area_m").cast("double"))
                           .when(land, F.lit(0.0)),
        "m2_terreno": F.when(house, F.col("land_m2").cast("double"))
                       .when(department & (F.col("land_m2") > 0), F.col("land_m2").cast("double"))
                       .when(land, F.col("total_area").cast("double")),
    })


def invalid_area() -> Column:
    """Area zero or negative where the type needs one. A null area is not caught here."""
    kind = F.col("tipo_propiedad")
    bad = (kind.isin(config.HOUSE, config.DEPARTMENT) & (F.col("m2_construidos") <= 0)) | (
        (kind == config.LAND) & (F.col("m2_terreno") <= 0))
    return F.coalesce(bad, F.lit(False))


def missing_field_reasons(required: Mapping[str, Sequence[str]] = config.REQUIRED_FIELDS,
                          texts: Mapping[str, str] = config.FIELD_REASONS) -> Column:
    """One reason per field that the property type requires and that is null or 0."""
    fields = list(dict.fromkeys(f for names in required.values() for f in names))
    checks = []
    for name in fields:
        kinds = [kind for kind, names in required.items() if name in names]
        empty = F.coalesce(F.col(name) == 0, F.lit(True))
        checks.append((F.col("tipo_propiedad").isin(kinds) & empty,
                       texts.get(name, f"{name} inválido")))
    return reasons_if(*checks)


# --- outliers ---------------------------------------------------------------

def group_spread(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Count, mean and sample standard deviation per group."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("media"),
        F.stddev_samp(value).alias("desv"))


def flag_outliers(df: DataFrame, value: str, keys: Sequence[str], flag: str = "es_atipico", *,
                  among: Column | None = None, at_most: int | None = None,
                  sigmas: float = config.OUTLIER_SIGMAS,
                  min_values: int = config.OUTLIER_MIN_VALUES, written: bool = False) -> DataFrame:
    """Mark values further than ``sigmas`` standard deviations from the group mean.

    Groups with too few values or without spread mark nothing, nor does a null
    value. Only rows where ``among`` holds count for the statistics. The
    statistics are one partial aggregation and a small join: with few, large
    groups a window would put all rows into a few tasks. With ``written`` they are computed at once, and the
    limits of few groups (``at_most``) are part of the expression: nothing is joined.
    """
    counted = df if among is None else df.filter(among)
    spread = (group_spread(counted, value, keys)
              .filter((F.col("n") >= min_values) & (F.col("desv") > 0))
              .select(*keys,
                      (F.col("media") - sigmas * F.col("desv")).alias("_low"),
                      (F.col("media") + sigmas * F.col("desv")).alias("_high")))
    if written and at_most is not None and at_most <= LITERAL_GROUPS:
        limits = [reduce(lambda a, b: a & b, [F.col(k) == r[k] for k in keys])
                  & ~F.col(value).between(F.lit(r["_low"]), F.lit(r["_high"]))
                  for r in spread.collect() if None not in [r[k] for k in keys]]
        return df.withColumn(flag, F.coalesce(*[F.when(hit, F.lit(True)) for hit in limits], F.lit(False))
                             ).select(*df.columns, flag)
    spread = small_checkpoint(spread) if written else spread
    outside = ~F.col(value).between(F.col("_low"), F.col("_high"))
    return (lookup_join(df, spread, keys, at_most=at_most)
            .withColumn(flag, F.coalesce(outside, F.lit(False)))
            .select(*df.columns, flag))


# --- price floors -----------------------------------------------------------

def flag_below_floor(df: DataFrame, floors: Mapping[str, Mapping[str, float]],
                     price: str = "precio_publicacion", flag: str = "bajo_minimo") -> DataFrame:
    """Mark prices below the floor of their (transaction, type); no floor or no price passes."""
    floors_of = [F.when((F.col("tipo_transaccion") == deal) & (F.col("tipo_propiedad") == kind), F.lit(float(v)))
                 for deal, kinds in floors.items() for kind, v in kinds.items()]
    floor = F.coalesce(*floors_of, F.lit(None).cast("double"))
    return df.withColumn(flag, F.coalesce(F.col(price) < floor, F.lit(False))).select(*df.columns, flag)


def floor_reason() -> Column:
    texts = [F.when(F.col("tipo_transaccion") == deal, F.lit(text))
             for deal, text in config.REASON_FLOOR.items()]
    return F.coalesce(*texts)


# --- rejects and load constraints -------------------------------------------

def reject_rows(df: DataFrame, reasons: str) -> DataFrame:
    """One row per rejected property and reason; columns the input lacks are null."""
    columns = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
               for c in REJECT_COLUMNS]
    return df.filter(F.size(reasons) > 0).select(*columns, F.explode(reasons).alias("motivo"))


def load_violations(df: DataFrame, not_null: Iterable[str] = config.ANALYTICS_NOT_NULL,
                    unique: str | None = config.ANALYTICS_KEY, reasons: str = "violaciones") -> DataFrame:
    """Reasons why a row cannot be loaded: a null where none may be, a key already taken.

    Of the complete rows sharing a key one is accepted. ``unique=None`` leaves
    the key unchecked, for rows that are known to have one each: no shuffle.
    """
    not_null = tuple(not_null)
    checks = [(F.col(c).isNull(), f"{c} nulo") for c in not_null]
    if unique is None:
        return df.withColumn(reasons, reasons_if(*checks))
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in not_null])
    # Incomplete rows take no key: they are ranked behind all complete ones.
    ranked = flag_last(df.withColumn("_complete", complete), unique, ["_complete"], "_first")
    checks.append((F.col(unique).isNotNull() & complete & ~F.col("_first"), f"{unique} repetido"))
    return ranked.withColumn(reasons, reasons_if(*checks)).select(*df.columns, reasons)
