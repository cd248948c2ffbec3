"""The ``name:name:...`` list format of the recommendation history (F1, F2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = ":"


def ordered_join(slot: str, item: str, sep: str = SEPARATOR) -> Column:
    """Aggregate: items of a group joined by ``sep`` in ``slot`` order (F1).

    Only used on recommendation lists, which hold at most ``n_recs`` rows per group.
    """
    sorted_items = F.array_sort(F.collect_list(F.struct(F.col(slot), F.col(item))))
    return F.array_join(F.transform(sorted_items, lambda s: s[item]), sep)


def explode_list(df: DataFrame, list_col: str, slot: str = "slot", item: str = "product_name",
                 sep: str = SEPARATOR) -> DataFrame:
    """One row per list item with its 0-based slot (F2)."""
    others = [c for c in df.columns if c != list_col]
    return df.select(
        *others, F.posexplode(F.split(F.col(list_col), sep)).alias(slot, item)
    ).withColumn(slot, F.col(slot).cast("long"))
