"""Deterministic hash order used for samples, picks and the train/validate split.

H(x) = the first 8 hex digits of md5(x) read as a BIGINT. It depends only on the row's
own values, so results do not change when the data is repartitioned or a task is rerun.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def h32(*parts: Column | str) -> Column:
    """H('p1|p2|...') over string forms of the parts."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    key = F.concat_ws("|", *cols)
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def seeded(seed: int, *parts: Column | str) -> Column:
    return h32(F.lit(str(seed)), *parts)
