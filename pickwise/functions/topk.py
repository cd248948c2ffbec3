"""Top-k per group.

``row_number() <= k`` over a window is planned by Spark as a partial WindowGroupLimit
before the shuffle and a final one after it, so a group never sends more than k rows per
map task across the network, however large (or skewed) the group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int | None,
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the first ``k`` rows of every group in ``order`` (None: number all of them);
    ``rank_col`` is 1-based."""
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        ranked = ranked.where(F.col(rank_col) <= k)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("long"))
