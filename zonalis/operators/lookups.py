"""Joins with a side that is expected to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.sources.session import small_checkpoint

# A side is broadcast up to this many rows; beyond it the join is a shuffle join.
BROADCAST_ROWS = 200_000


def row_count_up_to(df: DataFrame, bound: int) -> int:
    """The row count, counted no further than ``bound + 1``."""
    return df.limit(bound + 1).count()


def broadcast_if_small(small: DataFrame, *, at_most: int | None = None,
                       bound: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` with a broadcast hint when its row count is within ``bound``.

    ``at_most`` is a bound the caller can prove (say, the length of a
    configuration table); without one the rows are computed once, checkpointed
    and counted. Beyond the bound there is no hint: Spark plans a shuffle join,
    and adaptive execution splits skewed partitions.
    """
    if at_most is None:
        small = small_checkpoint(small)
        at_most = row_count_up_to(small, bound)
    return F.broadcast(small) if at_most <= bound else small


def lookup_join(df: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "left", *,
                at_most: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    return df.join(broadcast_if_small(small, at_most=at_most, bound=bound),
                   [on] if isinstance(on, str) else list(on), how)
