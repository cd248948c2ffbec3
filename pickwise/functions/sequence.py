"""Dense 0-based positions within groups, without sending a group to one task.

``row_number() over (partition by g order by o)`` streams a whole group through a single
task. When one group can hold a third of the data that task is the job. Instead:

1. range-partition on (g, o) and sort within partitions: one distributed sort, and a hot
   group is spread over many contiguous ranges;
2. tag each row with ``monotonically_increasing_id`` (partition index << 33 | row) and cut
   lineage with a reliable checkpoint, so every reader sees the same tags;
3. a small aggregate per (partition, g): first row tag and row count; a window over that
   small table gives each (partition, g) the number of g-rows in earlier partitions; it is
   written once and broadcast within the usual bound, so the tagged rows are not shuffled again;
4. position = offset + (row tag - first row tag of its (partition, g)).

Rows are assumed distinct on (g, o); ties get an arbitrary but fixed order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.functions.broadcast import checked
from pickwise.session import cut_lineage

_ROW_BITS = 33


def dense_positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    out: str = "pos",
    partitions: int | None = None,
) -> DataFrame:
    keys = [*group, *order]
    # without a number adaptive execution merges small neighbouring ranges: a small table is one task
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
    tagged = cut_lineage(ranged.withColumn("_tag", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_part", F.shiftright("_tag", _ROW_BITS))

    stats = tagged.groupBy("_part", *group).agg(
        F.min("_tag").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    stats = checked(stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))

    return (
        tagged.join(stats, on=["_part", *group])
        .withColumn(out, (F.col("_off") + F.col("_tag") - F.col("_first")).cast("long"))
        .drop("_tag", "_part", "_first", "_off")
    )


def group_sizes(df: DataFrame, group: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(out))
