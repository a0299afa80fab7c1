"""Missing values, safe numbers and small arithmetic expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value.
MISSING_TEXTS = ("nan", "NaT", "None", "inf", "-inf")


def finite(c: Column) -> Column:
    """A floating-point column with NaN and infinities as null."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def present_text(c: Column) -> Column:
    """A string column with the texts for "missing" as null."""
    return F.when(~c.isin(*MISSING_TEXTS), c)


def missing_to_null(df: DataFrame) -> DataFrame:
    """Every kind of "missing" in a frame becomes null, so that no NaN reaches a comparison."""

    def clean(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return finite(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType):
            return present_text(F.col(f.name)).alias(f.name)
        return F.col(f.name)

    return df.select(*[clean(f) for f in df.schema.fields])


def to_number(c: Column) -> Column:
    """Double, or null for anything that is not a finite number."""
    return finite(c.try_cast("double"))


def bounded_int(c: Column, low: int, high: int) -> Column:
    """Truncated towards zero, null outside ``low..high`` or when not a number."""
    whole = to_number(c).try_cast("bigint")
    return F.when(whole.between(low, high), whole).cast("int")


def with_bounded_ints(df: DataFrame, limits: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Limit several columns; those that are whole numbers already need no conversion."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

    def limited(name: str, low: int, high: int) -> Column:
        c = F.col(name)
        if isinstance(df.schema[name].dataType, whole):
            return F.when(c.between(low, high), c).cast("int")
        return bounded_int(c, low, high)

    return df.withColumns({n: limited(n, *span) for n, span in limits.items() if n in df.columns})


def null_if_zero(c: Column) -> Column:
    return F.when(c != 0, c)


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, null when ``b`` is zero."""
    return a / null_if_zero(b)


def clamp(c: Column, low: float, high: float) -> Column:
    """``c`` limited to ``low..high``; null stays null (least and greatest skip nulls)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def at_least_zero(c: Column) -> Column:
    return F.when(c < 0, F.lit(0)).otherwise(c)


def has_any(*columns: str) -> Column:
    """True when at least one of the columns is not null."""
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull()
