"""The engine's tables and the store they live in.

Layout under a root folder (any Hadoop-compatible path shared by the cluster)::

    <root>/<table>/segment=<id>/category=<c>/part-*.parquet
    <root>/_commits/part-*.parquet            (seq, commit_id, table, segment, replaces)

A commit is one small append to ``_commits`` that names the segments it adds to any number of
tables, and whether they replace what the table held. Segments have fresh names and are
written before their commit, so readers never see half of a batch or of a promotion, a
writer that died leaves nothing behind that counts, and a plan never overwrites the files it
reads. A commit id given by the caller (a batch) is accepted once. One writer at a time
(as in the original).

Every segment of a rating table comes with two derived segments of the same name, in the same commit:
the sum and count of its ratings per product, and its raters. A snapshot reads its rating summary
from them, so no reader of means, counts or raters scans the ratings themselves.

A commit that touches the new products replaces their hash order (``operators.newproducts.hash_order``,
under the default seed) too: onboarding and promotion sort them, a recommendation batch looks positions up.

A commit that touches the recommendation history brings the latest list of its users along. The latest lists are
written anew when those added since hold as many rows as the last such writing, so they hold two rows a user at
most on average, and a row is rewritten a bounded number of times however long the history grows.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from pickwise import schemas
from pickwise.config import DEFAULT
from pickwise.operators.feedback import latest_lists
from pickwise.operators.newproducts import hash_order
from pickwise.session import cut_lineage


@dataclass(frozen=True)
class Tables:
    """A consistent snapshot of every table (any may be None when not needed)."""

    users: DataFrame | None = None
    products: DataFrame | None = None
    new_products: DataFrame | None = None
    ratings: DataFrame | None = None
    new_product_ratings: DataFrame | None = None
    shown: DataFrame | None = None
    category_recs: DataFrame | None = None
    user_recs: DataFrame | None = None
    history: DataFrame | None = None
    # maintained summaries of the two rating tables; None: derive them from the rows
    stats: DataFrame | None = None      # as ``operators.ratings.product_stats``
    raters: DataFrame | None = None     # category, user_id of everyone with a rating
    new_order: DataFrame | None = None  # the stored hash order of new products; None: derive it
    latest: DataFrame | None = None     # history rows that hold every user's latest list; None: read the history

    def with_(self, **kw) -> "Tables":
        return replace(self, **kw)


# Tables attribute -> stored table name
STORED = {
    "users": "users",
    "products": "products",
    "new_products": "new_products",
    "ratings": "ratings",
    "new_product_ratings": "new_product_ratings",
    "shown": "new_product_shown_list",
    "category_recs": "category_recommendation_data",
    "user_recs": "user_recommendation_data",
    "history": "previous_user_recommendations",
}


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


# rating table -> its derived tables
STATE_OF = {t: f"{t}_state" for t in ("ratings", "new_product_ratings")}
RATERS_OF = {t: f"{t}_raters" for t in STATE_OF}
ORDERED, ORDER = "new_products", "new_product_order"
HISTORY, LATEST = "previous_user_recommendations", "previous_user_recommendations_latest"


def write_partitioned(df: DataFrame, path: str, mode: str, rebalance: bool = True) -> None:
    """Partitioned Parquet write (S3 append / S4 overwrite, S5 file count).

    Rows are rebalanced on the partition column: adaptive execution gives a category as many writers as its
    bytes need (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each) and a small one a single file.
    Overwrite is dynamic: only categories present in ``df`` are replaced.
    """
    if rebalance:
        df = df.hint("rebalance", F.col("category"))
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("category")
        .parquet(path)
    )


def merged_stats(ratings_state: DataFrame, new_ratings_state: DataFrame) -> DataFrame:
    """The summary ``operators.ratings.product_stats`` from the states of any number of segments."""
    both = ratings_state.withColumn("_new", F.lit(False)).unionByName(new_ratings_state.withColumn("_new", F.lit(True)))
    return both.groupBy("category", "product_id").agg(
        F.sum("sum").alias("sum_all"), F.sum("n").alias("n_all"),
        F.sum(F.when(F.col("_new"), F.col("sum"))).alias("sum_new"), F.coalesce(F.sum(F.when(F.col("_new"), F.col("n"))), F.lit(0)).alias("n_new"),
    )


_COMMITS = "seq long, commit_id string, table string, segment string, replaces boolean"


class TableStore:
    def __init__(self, spark: SparkSession, root: str, rebalance: bool = True):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rebalance = rebalance

    # -- commits ------------------------------------------------------------------------
    def _commits(self) -> DataFrame:
        """The commit log; empty only if nothing was ever committed. Other errors surface."""
        try:
            return self.spark.read.schema(_COMMITS).parquet(f"{self.root}/_commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, _COMMITS)

    def segments(self) -> dict[str, list[str]]:
        """Segments of every table as of now (one small read of the log)."""
        out: dict[str, list[str]] = {}
        for r in self._commits().orderBy("seq").toLocalIterator():
            if r["replaces"] or r["table"] not in out:
                out[r["table"]] = []
            if r["segment"]:
                out[r["table"]].append(r["segment"])
        return out

    def committed(self, commit_id: str) -> bool:
        """Whether a commit with this id exists (a batch that came back)."""
        return not self._commits().where(F.col("commit_id") == commit_id).isEmpty()

    def commit(self, appends: dict[str, DataFrame], replaces: dict[str, DataFrame] | None = None, commit_id: str | None = None) -> bool:
        """Append to and replace any number of tables at once (S3, S6). False, and nothing
        done, if ``commit_id`` was committed before."""
        if commit_id and self.committed(commit_id):
            return False
        seq = (self._commits().agg(F.max("seq")).first()[0] or 0) + 1
        name = commit_id or uuid.uuid4().hex
        now = self.segments() if ORDERED in appends or HISTORY in appends else {}
        before = now.get(ORDERED, [])

        def write(t, df, segment):
            write_partitioned(df.select(*schemas.TABLES[t].fieldNames()), f"{self.root}/{t}/segment={segment}", "error", self.rebalance)

        def add(task):
            t, df, replacing = task
            segment = f"{seq:08d}-{uuid.uuid4().hex}"
            write(t, df, segment)
            written = [t]
            if t == ORDERED:
                held = self.read(t, {t: [segment] if replacing else [*before, segment]})
                write(ORDER, hash_order(held, DEFAULT.sample_seed), segment)
            if t in STATE_OF:
                held = self.read(t, {t: [segment]})
                write(STATE_OF[t], held.groupBy("category", "product_id").agg(F.sum("rating").alias("sum"), F.count(F.lit(1)).alias("n")), segment)
                write(RATERS_OF[t], held.select("category", "user_id").distinct(), segment)
                written += [STATE_OF[t], RATERS_OF[t]]
            rows = [(seq, name, x, segment, replacing) for x in written]
            if t == HISTORY:
                lists, anew = self._latest_after({} if replacing else now, segment)
                write(LATEST, lists, segment)
                rows.append((seq, name, LATEST, segment, anew))
            return rows + [(seq, name, ORDER, segment, True)] if t == ORDERED else rows

        # the tables' writes do not depend on each other: they share the cluster
        tasks = [(t, df, replacing) for dfs, replacing in ((appends, False), (replaces or {}, True)) for t, df in dfs.items()]
        with ThreadPoolExecutor(max_workers=8) as pool:
            rows = [r for part in pool.map(add, tasks) for r in part]
        self.spark.createDataFrame(rows, _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")
        return True

    def _latest_after(self, now: dict[str, list[str]], segment: str) -> tuple[DataFrame, bool]:
        """Latest lists to store with a new ``segment`` of the history, and whether they replace those stored."""
        added = latest_lists(self.read(HISTORY, {HISTORY: [segment]}))
        past, kept = now.get(HISTORY, []), now.get(LATEST, [])
        if past[-1:] != kept[-1:]:  # written before latest lists were kept
            return latest_lists(self.read(HISTORY, {HISTORY: [*past, segment]})), True
        if not kept:
            return added, True
        base, since = (self.read(LATEST, {LATEST: x}) for x in (kept[:1], kept[1:]))
        if since.count() + added.count() < base.count():
            return added, False
        return latest_lists(base.unionByName(since).unionByName(added)), True

    # -- read (S1) ---------------------------------------------------------------------
    def read(self, table: str, segments: dict[str, list[str]] | None = None) -> DataFrame:
        schema = schemas.TABLES[table]
        paths = [f"{self.root}/{table}/segment={x}" for x in (self.segments() if segments is None else segments).get(table, [])]
        if not paths:
            return empty(self.spark, schema)
        read = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return read.parquet(*paths).select(*schema.fieldNames())

    def scan_category(self, table: str, category: str) -> DataFrame:
        """One category of a table; the filter on the partition column prunes folders."""
        return self.read(table).where(F.col("category") == F.lit(category))

    def load(self) -> Tables:
        """Every table, all as of the same commit, with the rating summaries if every rating segment has its own, and
        the order of new products and the latest lists if they are of the last segment (segments written before these
        were kept have none)."""
        now = self.segments()
        tables = Tables(**{attr: self.read(name, now) for attr, name in STORED.items()})
        if now.get(ORDERED) and now[ORDERED][-1:] == now.get(ORDER):
            tables = tables.with_(new_order=self.read(ORDER, now))
        if now.get(HISTORY) and now[HISTORY][-1:] == now.get(LATEST, [])[-1:]:
            tables = tables.with_(latest=self.read(LATEST, now))
        if any(now.get(t, []) != now.get(of[t], []) for of in (STATE_OF, RATERS_OF) for t in STATE_OF):
            return tables
        old, new = (self.read(STATE_OF[t], now) for t in STATE_OF)
        raters = [self.read(RATERS_OF[t], now) for t in RATERS_OF]
        return tables.with_(stats=merged_stats(old, new), raters=raters[0].unionByName(raters[1]).distinct())

    # -- write (S3, S4, S6) -------------------------------------------------------------
    def append(self, table: str, df: DataFrame) -> None:
        self.commit({table: df})

    def overwrite_categories(self, table: str, df: DataFrame) -> None:
        """Replace the categories present in ``df``; others stay."""
        df = cut_lineage(df.select(*schemas.TABLES[table].fieldNames()))
        there = F.broadcast(df.select("category").distinct())  # one row per category
        self.publish({table: self.read(table).join(there, "category", "left_anti").unionByName(df)})

    def publish(self, tables: dict[str, DataFrame]) -> None:
        """Replace several tables at once (S6); the plans may read what they replace."""
        self.commit({}, tables)
