"""Engine parameters.

One frozen ``Config`` is passed to every operator. The first block holds values that
must equal the original recommender's for equal results; everything after it is ours.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Config:
    # --- Fixed values (must match the original job's constants) -----------------------
    # ALS grid: ranks 5, 10, 15, 20; regularisation .001, .003, .009, .01, .03, .09, .1
    ranks: tuple[int, ...] = (5, 10, 15, 20)
    reg_params: tuple[float, ...] = (0.001, 0.003, 0.009, 0.01, 0.03, 0.09, 0.1)
    # train / validate split 0.7 / 0.3 with seed 0
    train_fraction: float = 0.7
    split_seed: int = 0
    # ALS iterations
    max_iter: int = 20
    # length of a recommendation list
    n_recs: int = 5
    # a new product is promoted when it has more than 2 ratings (strict)
    promote_over: int = 2
    # new products placed in a mid-stage list
    n_new: int = 2
    # stage thresholds 1 and 2
    stage1: int = 1
    stage2: int = 2
    # pool sizes come from integer division: 2 * (5 // 2) = 4 unrated, 2 * (3 // 2) = 2 rated
    unrated_pool: int = 4
    rated_pool: int = 2
    # --- Our own choices ----------------------------------------------------------------
    # seed mixed into every hash-ordered sample and pick
    sample_seed: int = 42
    # hash buckets used by the deterministic split (train if bucket < fraction * buckets)
    split_buckets: int = 1000
    # ALS solver layout
    als_seed: int = 7
    als_blocks: int = 0  # 0: from the number of ratings and the default parallelism
    als_block_ratings: int = 1_000_000  # ratings per block when blocks are derived
    als_checkpoint_interval: int = 10  # at most; fewer iterations where their shuffles pass als_shuffle_bytes
    als_shuffle_bytes: int = 1 << 30  # shuffled factors that the fits running at once keep on disk
    fit_task_bytes: int = 512 << 20  # a category of the grid that holds no more is fitted in one task a point
    fit_ratings: int = 2_000_000_000  # ratings of one fit of several categories (below 2^31, the ids of ALS)
    # grid points fitted at once (threads submitting Spark jobs), as in pyspark.ml.tuning;
    # 1 when a single fit fills the cluster
    grid_parallelism: int = 1
    # rows per factor block in top-k scoring (user side and item side)
    score_block_rows: int = 4096
    # largest per-category table (rows) broadcast to a per-user join
    broadcast_rows: int = 2_000_000
    # largest item-factor payload (bytes) broadcast to the scoring tasks
    score_broadcast_bytes: int = 64 << 20

    @property
    def n_established(self) -> int:
        """Established products in a mid-stage list, and ALS rows kept per user."""
        return self.n_recs - self.n_new

    @property
    def picks_per_pool(self) -> int:
        return self.n_new // 2

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


DEFAULT = Config()
