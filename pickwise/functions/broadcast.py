"""Broadcast only behind a size bound.

A join of a large per-user table with a small per-category table (a top-k list, a pool,
a stage) must not shuffle on ``category`` alone: a category holding a third of the
users would land in one task. When the small side's row count is bounded -- rows per
category times a counted number of categories -- it is broadcast; beyond the bound the
join is left to Spark (sort-merge with adaptive skew splitting).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.session import cut_lineage

Broadcaster = Callable[[DataFrame], DataFrame]

# Same default as Config.broadcast_rows.
MAX_ROWS = 2_000_000


def keep(df: DataFrame) -> DataFrame:
    return df


def bounded(n_groups: int, rows_per_group: int, max_rows: int) -> Broadcaster:
    """``F.broadcast`` when ``n_groups * rows_per_group <= max_rows``, else identity."""
    return F.broadcast if n_groups * max(rows_per_group, 1) <= max_rows else keep


def checked(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Materialise a small per-group table once (reliable checkpoint), count it, and mark
    it for broadcast when it has at most ``max_rows`` rows."""
    m = cut_lineage(df)
    return F.broadcast(m) if m.count() <= max_rows else m
