"""Temporal URL list filters: every capture is judged by the list entries active when it was fetched.

Dated list events (add or remove) become validity intervals with ``lead`` over each entry's own
events. A capture is matched on its host and on every parent domain, as of its fetch time.
The as-of join is an equi-join on (pattern, time bucket): an interval is dealt to the
buckets it touches within the captures' own time range, and a capture looks into one bucket
only, so a pattern with a long history does not meet all captures of its host. A host may
hold a third of the captures: captures are first reduced to distinct (host, fetch time) with
the count of hosts' captures kept apart, matched, and the verdicts are joined back; the
entries that match are few a key, and Spark splits the skewed side of the last join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; null if there is none."""
    h = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(h != "", h)


def validity_intervals(events: DataFrame) -> DataFrame:
    """``(list, pattern, valid_from, valid_to)`` from events ``(list, pattern, action, at)``.

    An entry is valid from an ``add`` to its next event (``valid_to`` excluded; null: still
    valid). Of events at one instant the removal counts last. Repeated adds cut an interval in
    two that touch; repeated removals change nothing. Events with a null in any of the four
    columns are ignored."""
    w = Window.partitionBy("list", "pattern").orderBy("at", F.col("action") == "remove")
    e = events.select("list", F.lower("pattern").alias("pattern"), F.lower("action").alias("action"), "at").dropna()
    e = e.distinct().withColumn("valid_to", F.lead("at").over(w))
    return e.where((F.col("action") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at")))).select(
        "list", "pattern", F.col("at").alias("valid_from"), "valid_to"
    )


def judge_captures(
    captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at",
    bucket_seconds: int = 30 * 86400,
) -> DataFrame:
    """``(id, host, fetched_at, n_entries, lists, blocked)`` for every capture.

    An entry's pattern is a host; it covers that host and all its subdomains. ``lists`` are the
    distinct lists with an entry active at fetch time, sorted; ``n_entries`` counts the
    active (list, pattern) pairs; ``blocked`` says that there is one. A capture without a
    host or time matches nothing; repeated rows are judged each; other columns are ignored;
    without events nothing is blocked."""
    c = captures.select(F.col(id_col).cast("long").alias("id"), host_of(F.col(url_col)).alias("host"), F.col(time_col).cast("timestamp").alias("at"))
    bucket = lambda x: F.floor(F.unix_timestamp(x) / bucket_seconds)
    asked = c.where("host is not null and at is not null").select("host", "at").distinct()
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = asked.select("host", "at", bucket(F.col("at")).alias("b"), F.explode(F.array_distinct(parents)).alias("pattern"))
    lo, hi = (F.lit(x) for x in asked.agg(F.min("at"), F.max("at")).first())
    iv = validity_intervals(events).where((F.col("valid_from") <= hi) & (F.col("valid_to").isNull() | (F.col("valid_to") > lo)))
    first, last = bucket(F.greatest("valid_from", lo)), bucket(F.least(F.coalesce("valid_to", hi), hi))
    iv = iv.select("list", "pattern", "valid_from", "valid_to", F.explode(F.sequence(first, last)).alias("b"))
    hit = keys.join(iv, ["pattern", "b"]).where("at >= valid_from and (valid_to is null or at < valid_to)")
    verdict = hit.groupBy("host", "at").agg(
        F.countDistinct("list", "pattern").alias("n_entries"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists")
    )
    return c.join(verdict, ["host", "at"], "left").select(
        F.col("id").alias(id_col), "host", F.col("at").alias(time_col), F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce("lists", F.lit("")).alias("lists"), F.col("n_entries").isNotNull().alias("blocked"),
    )
