import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickwise import schemas
from pickwise.config import Config
from pickwise.operators import category_fit
from pickwise.operators import factorization as MF
from pickwise.sources import models

CFG = Config(ranks=(3, 5), reg_params=(0.01, 0.1), max_iter=10, als_blocks=2, score_block_rows=32)


@pytest.fixture(scope="module")
def planted(spark):
    """3 categories x 80 users x 60 products, rank 3, 30 ratings per user."""
    rng = np.random.default_rng(11)
    rows = []
    for c in ("X", "Y", "Z"):
        U = rng.normal(size=(80, 3))
        V = rng.normal(size=(60, 3))
        for u in range(80):
            for p in rng.choice(60, size=30, replace=False):
                rows.append((c, u + 1, int(p) + 1, float(U[u] @ V[p] + 3.0)))
    return spark.createDataFrame(rows, "category string, user_id long, product_id long, rating double")


def test_split_is_disjoint_complete_and_stable(planted):
    s = MF.split_train_validate(planted, CFG)
    n = planted.count()
    assert s.count() == n
    a = {tuple(r) for r in s.collect()}
    b = {tuple(r) for r in MF.split_train_validate(planted.repartition(13), CFG).collect()}
    assert a == b
    train = sum(1 for r in a if r[-1] == "train")
    assert 0.6 < train / n < 0.8


def test_grid_recovers_planted_matrix_and_winner_is_min(planted):
    res = MF.grid_search(planted, CFG)
    g = res.grid.collect()
    assert len(g) == 3 * 4
    for c in ("X", "Y", "Z"):
        mine = [r for r in g if r["category"] == c]
        best = [r for r in mine if r["is_best"]]
        assert len(best) == 1
        assert best[0]["rmse"] == min(r["rmse"] for r in mine)
        assert res.winners[c] == best[0]["grid_index"]
    # mean predictor for comparison
    v = MF.split_train_validate(planted, CFG)
    means = v.where("split = 'train'").groupBy("category", "product_id").agg(F.avg("rating").alias("prediction"))
    base = {r["category"]: r["rmse"] for r in MF.rmse(v.where("split = 'validate'").join(means, ["category", "product_id"])).collect()}
    for r in g:
        if r["is_best"]:
            assert r["rmse"] < 0.5 * base[r["category"]]


def test_block_top_k_equals_brute_force(planted):
    res = MF.grid_search(planted, CFG)
    uf, itf = MF.winning_factors(res)
    got = MF.recommend_top_k(uf, itf, 3, CFG).collect()
    U = {}
    for r in uf.collect():
        U[(r["category"], r["user_id"])] = np.asarray(r["features"], dtype=np.float64)
    items = {}
    for r in itf.collect():
        items.setdefault(r["category"], []).append((r["product_id"], np.asarray(r["features"], dtype=np.float64)))
    want = {}
    for (c, u), x in U.items():
        scored = sorted(((-float(x @ v), p) for p, v in items[c]))[:3]
        want[(c, u)] = [p for _, p in scored]
    mine = {}
    for r in sorted(got, key=lambda r: (r["category"], r["user_id"], r["rank"])):
        mine.setdefault((r["category"], r["user_id"]), []).append(r["product_id"])
    assert mine == want


def test_save_load_gives_equal_predictions(planted, spark):
    ix = MF.index_ratings(planted, CFG)
    train = ix.data.where("split = 'train'")
    valid = ix.data.where("split = 'validate'")
    m = MF.fit(train, 3, 0.01, CFG)
    path = tempfile.mkdtemp(prefix="pickwise-als-")
    models.save_als(m, path)
    a = {(r["u"], r["i"]): r["prediction"] for r in MF.predict(m, valid).collect()}
    b = {(r["u"], r["i"]): r["prediction"] for r in MF.predict(models.load_als(path), valid).collect()}
    assert a == b and len(a) > 0


def test_replicated_block_path_equals_broadcast_path(planted):
    res = MF.grid_search(planted, CFG)
    uf, itf = MF.winning_factors(res)
    a = {tuple(r) for r in MF.recommend_top_k(uf, itf, 3, CFG).collect()}
    b = {tuple(r) for r in MF.recommend_top_k(uf, itf, 3, CFG.with_(score_broadcast_bytes=0, score_block_rows=7)).collect()}
    assert a == b  # scores included, to the last bit
    assert len(a) == 3 * uf.count()


def test_index_is_injective_for_any_ids(spark):
    keys = spark.createDataFrame([("A", 5), ("A", -1), ("B", 5), ("C", 2**40), ("B", 9), ("B", 9)],
                                 "category string, user_id long")
    got = {(r["category"], r["user_id"]): r["u"] for r in MF.dense_index(keys, MF.USER, "u").collect()}
    assert len(got) == 5 and sorted(got.values()) == list(range(5))


def test_blocks_follow_ratings_and_cores():
    cfg = CFG.with_(als_blocks=0, als_block_ratings=100)
    assert MF.blocks_for(10, 4, cfg) == 4
    assert MF.blocks_for(5001, 4, cfg) == 51
    assert MF.blocks_for(5001, 4, cfg.with_(als_blocks=3)) == 3


def test_winner_is_chosen_on_unrounded_errors():
    """Errors that differ by less than 1e-6; ties go to the first point, NaN and missing errors never win."""
    e = [("A", 0, 0.5), ("A", 1, 0.5 - 1e-8), ("B", 1, 0.25), ("B", 0, 0.25), ("C", 0, float("nan")), ("C", 1, 9.0), ("D", 0, None)]
    assert MF.pick_winners(e) == {"A": 1, "B": 0, "C": 1}


def test_errors_of_all_points_in_one_pass_equal_the_models(planted, spark):
    cfg = CFG.with_(ranks=(2, 3), reg_params=(0.01, 0.3), max_iter=4)
    res = MF.grid_search(planted, cfg)
    got = {(r["category"], r["grid_index"]): (r["rmse"], r["n_scored"]) for r in res.grid.collect()}
    ix = MF.index_ratings(planted, cfg)
    train, valid = ix.data.where("split = 'train'"), ix.data.where("split = 'validate'")
    for p, (rank, reg) in enumerate([(r, g) for r in cfg.ranks for g in cfg.reg_params]):
        for r in MF.rmse(MF.predict(MF.fit(train, rank, reg, cfg), valid)).collect():
            e, n = got[r["category"], p]
            assert abs(e - r["rmse"]) < 2e-5 and n == r["n_scored"]
    users = MF.stacked_factors(spark, res.run_path, 4, "users", "u")
    items = MF.stacked_factors(spark, res.run_path, 4, "items", "i")
    plan = MF.grid_errors(valid, users, items, [2, 2, 3, 3])._jdf.queryExecution().optimizedPlan().toString()
    below = plan[:plan.index("stack")] if "stack" in plan else plan
    assert len(users.first()["stack"]) == 10 and below.count("MapInArrow") == 1


def test_a_grid_that_died_fits_only_what_is_missing(planted, spark, monkeypatch):
    cfg, path = CFG.with_(max_iter=2), tempfile.mkdtemp(prefix="pickwise-run-") + "/run"
    real, fitted = MF.fit, []

    def dies(train, rank, reg, *a):
        if len(fitted) == 2:
            raise RuntimeError("driver lost")
        fitted.append((rank, reg))
        return real(train, rank, reg, *a)

    monkeypatch.setattr(MF, "fit", dies)
    with pytest.raises(RuntimeError):
        MF.grid_search(planted, cfg, path)
    again = []
    monkeypatch.setattr(MF, "fit", lambda train, rank, reg, *a: again.append((rank, reg)) or real(train, rank, reg, *a))
    res = MF.grid_search(planted, cfg, path)
    assert fitted + again == [(r, g) for r in cfg.ranks for g in cfg.reg_params]
    whole = MF.grid_search(planted, cfg)
    assert res.winners == whole.winners
    assert MF.winning_factors(res)[0].count() == MF.winning_factors(whole)[0].count()
    with pytest.raises(ValueError):
        MF.grid_search(planted.limit(100), cfg, path)


def _factors(spark, rng, n_users, n_items, decay, whole=False):
    draw = (lambda *s: rng.integers(-2, 3, s)) if whole else (lambda *s: rng.normal(size=s))
    u = [(c, i, [float(x) for x in draw(3)]) for c in "AB" for i in range(n_users)]
    v = [(c, int(p), [float(x) * (1.0 if whole else decay ** j) for x in draw(3)]) for c in "AB" for j, p in enumerate(rng.permutation(n_items) * 3)]
    shape = "features array<float>"
    return spark.createDataFrame(u, f"category string, user_id long, {shape}"), spark.createDataFrame(v, f"category string, product_id long, {shape}")


@pytest.mark.parametrize("whole", [False, True])
def test_pruned_top_k_equals_brute_force_with_ties(spark, whole):
    rng = np.random.default_rng(5)
    uf, itf = _factors(spark, rng, 70, 200, 0.97, whole)
    items = {c: [(r["product_id"], np.asarray(r["features"])) for r in itf.collect() if r["category"] == c] for c in "AB"}
    want = {}
    for r in uf.collect():
        x = np.asarray(r["features"])
        want[r["category"], r["user_id"]] = [p for _, p in sorted((-float(sum(x[f] * v[f] for f in range(3))), p) for p, v in items[r["category"]])[:4]]
    for cfg in (Config(), Config(score_broadcast_bytes=0, score_block_rows=16)):
        out = MF.recommend_top_k(uf, itf, 4, cfg, work=True).cache()
        got = {}
        for r in sorted(out.collect(), key=lambda r: r["rank"]):
            got.setdefault((r["category"], r["user_id"]), []).append(r["product_id"])
        assert got == want
        assert all(r["n_scored"] <= 70 * r["n_items"] for r in MF.scoring_work(out, itf).collect())


def test_the_block_join_meets_only_what_the_bounds_admit(spark, monkeypatch):
    """Norms that fall fast: most user blocks stop after the first item block."""
    rng = np.random.default_rng(6)
    uf, itf = _factors(spark, rng, 64, 640, 0.95)
    cfg, met = Config(score_broadcast_bytes=0, score_block_rows=32), []
    real = MF._meet
    monkeypatch.setattr(MF, "_meet", lambda u, i, k: met.append(u.select("category", "blk").count()) or real(u, i, k))
    out = MF.recommend_top_k(uf, itf, 3, cfg, work=True)
    work = {r["category"]: r for r in MF.scoring_work(out, itf).collect()}
    assert met[0] == 2 * 2 and met[1] < 0.5 * 2 * 2 * 19  # of 19 further item blocks a category
    assert all(w["n_users"] == 64 and w["n_items"] == 640 and w["share"] < 0.5 for w in work.values())
    near = MF.recommend_top_k(uf, itf, 3, Config(), work=True)
    assert {tuple(r)[:5] for r in out.collect()} == {tuple(r)[:5] for r in near.collect()}


def test_top_k_with_fewer_items_than_places(spark):
    rng = np.random.default_rng(7)
    uf, itf = _factors(spark, rng, 5, 2, 1.0)
    for cfg in (Config(), Config(score_broadcast_bytes=0, score_block_rows=1)):
        assert MF.recommend_top_k(uf, itf, 3, cfg).count() == 2 * 5 * 2


def test_top_k_kernel_memory_does_not_follow_the_items():
    import tracemalloc

    rng = np.random.default_rng(0)
    peaks = []
    for n in (20_000, 80_000):
        U, V = rng.standard_normal((600, 4)), rng.standard_normal((n, 4))
        items = MF._by_norm(np.arange(n), V)  # once per category, outside the kernel
        tracemalloc.start()
        MF._topk_pruned(np.arange(600), U, *items, 3)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0]


def test_parallel_grid_picks_the_same_winners(planted):
    a = MF.grid_search(planted, CFG)
    b = MF.grid_search(planted, CFG.with_(grid_parallelism=3))
    assert a.winners == b.winners
    key = lambda r: (r["category"], r["grid_index"])
    assert sorted(map(tuple, a.grid.collect()), key=str) == sorted(map(tuple, b.grid.collect()), key=str)


def test_categories_are_packed_under_the_budget(spark):
    sizes = {"A": 50, "B": 30, "C": 20, "D": 20, "E": 1}
    ratings = spark.createDataFrame([(c, u, 1, 3.0) for c, n in sizes.items() for u in range(n)] + [(None, 1, 1, 2.0)], schemas.RATINGS)
    groups = lambda n: MF.category_groups(ratings, Config(fit_ratings=n))
    assert groups(1000) == [["A", "B", "C", "D", "E"]]
    assert groups(50) == [["A"], ["B", "C"], ["D", "E"]]
    assert groups(1) == [["A"], ["B"], ["C"], ["D"], ["E"]]  # no category is lost or cut
    assert MF.category_groups(ratings.limit(0), Config()) == []


def test_a_group_gives_what_its_categories_alone_give(planted, tmp_path):
    """Groups of one category: grid, winners and factors of a search over that category's ratings."""
    path = str(tmp_path / "run")
    res = MF.grid_search(planted, CFG.with_(fit_ratings=1), path)
    cats = sorted(r["category"] for r in planted.select("category").distinct().collect())
    assert len(res.parts) == len(cats) > 1 and sorted(res.winners) == cats
    rows = lambda d: sorted(map(str, d.collect()))
    uf, itf = MF.winning_factors(res)
    for c in cats:
        alone = MF.grid_search(planted.where(F.col("category") == c), CFG)
        assert rows(alone.grid) == rows(res.grid.where(F.col("category") == c))
        u, i = MF.winning_factors(alone)
        assert u.count() == uf.where(F.col("category") == c).count() and i.count() == itf.where(F.col("category") == c).count()
    again = MF.grid_search(planted, CFG.with_(fit_ratings=1), path)  # a run that comes back fits nothing anew
    assert rows(again.grid) == rows(res.grid)


def test_block_pairs_hand_on_one_list_a_user(spark, monkeypatch):
    """However many item blocks a user block meets: neither its rows nor its lists are copied once a pair."""
    uf, itf = _factors(spark, np.random.default_rng(8), 40, 300, 1.0)
    real, seen = MF._meet, []

    def meet(u, i, k):
        got = real(u, i, k).cache()
        seen.append((u.count(), got.groupBy("category", "user_id").count().agg(F.max("count")).first()[0]))
        return got

    monkeypatch.setattr(MF, "_meet", meet)
    cfg = Config(score_broadcast_bytes=0, score_block_rows=10)
    got = {tuple(r) for r in MF.recommend_top_k(uf, itf, 3, cfg).collect()}
    assert seen[1][0] <= 2 * 4 and seen[1][1] <= 3
    monkeypatch.setattr(MF, "SLAB_ITEMS", 30)  # several slabs of item blocks a category
    assert got == {tuple(r) for r in MF.recommend_top_k(uf, itf, 3, cfg).collect()} and len(got) == 2 * 40 * 3


def test_checkpoints_follow_the_shuffled_bytes():
    cfg = Config(grid_parallelism=4)
    assert MF.checkpoint_every(100_000, 20, cfg) == 10 and MF.fits_at_once(100_000, cfg) == 4
    assert MF.checkpoint_every(9_000_000, 20, cfg) == 1 and MF.fits_at_once(9_000_000, cfg) == 1
    assert MF.checkpoint_every(0, 5, cfg) == 10


def test_a_released_model_leaves_no_checkpoint(planted, spark):
    ix = MF.index_ratings(planted, CFG)
    model = MF.fit(ix.data.where("split = 'train'"), 3, 0.1, CFG)
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    held = set(os.listdir(root))
    MF.release(model)
    assert len(held - set(os.listdir(root))) >= 1
    assert ix.data.count() == planted.count()  # its own checkpoints are still there


def _counted(df, seen):
    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return df.mapInPandas(run, df.schema)


def test_fit_runs_its_rows_once(spark):
    pairs = [(u, i, float(1 + (u + i) % 5)) for u in range(6) for i in range(5)]
    seen = spark.sparkContext.accumulator(0)
    MF.fit(_counted(spark.createDataFrame(pairs, "u int, i int, rating float"), seen), 2, 0.1, CFG.with_(max_iter=1))
    assert seen.value == len(pairs)


@pytest.mark.parametrize("name", ["als_recommend", "als_scoring_work"])
def test_scoring_queries_join_the_factors_once(spark, monkeypatch, name):
    from pickwise.plans import queries as Q

    rows = [(k, "X", n, [float(n), 1.0]) for k in ("user", "item") for n in range(1, 5)]
    seen = spark.sparkContext.accumulator(0)
    factors = spark.createDataFrame(rows, "kind string, category string, id long, features array<float>")
    monkeypatch.setattr(Q, "_trained", lambda *_: _counted(factors, seen))
    assert Q.REGISTRY[name](spark, "").count() > 0
    assert seen.value == len(rows)


def test_users_do_not_carry_the_bounds_of_all_blocks(spark, monkeypatch):
    """What a user's row holds, and what is shuffled with it, does not grow with the number of item blocks."""
    uf, itf = _factors(spark, np.random.default_rng(4), 30, 200, 0.5)
    real, kinds = MF.cut_lineage, []

    def cut(d):
        if "n_scored" in d.columns and "floor" in d.columns:
            leaves = d._jdf.queryExecution().optimizedPlan().collectLeaves()
            for k in range(leaves.size()):
                out = leaves.apply(k).output()
                kinds.extend(out.apply(j).dataType().simpleString() for j in range(out.size()))
        return real(d)

    monkeypatch.setattr(MF, "cut_lineage", cut)
    cfg = Config(score_broadcast_bytes=0, score_block_rows=10)
    got = MF.recommend_top_k(uf, itf, 3, cfg, work=True).collect()
    assert kinds and not any(t.startswith("array<struct") for t in kinds)
    scored = {(r["category"], r["user_id"]): r["n_scored"] for r in got}
    items = sorted((r["category"], -np.linalg.norm(r["features"]), r["product_id"], r["features"]) for r in itf.collect())
    for r in uf.collect():
        of = [x for x in items if x[0] == r["category"]]
        third = sorted(float(np.dot(r["features"], x[3])) for x in of[:10])[-3]
        reached = sum(-x[1] * np.linalg.norm(r["features"]) * (1 + 1e-9) >= third for x in of[10::10])
        assert scored[r["category"], r["user_id"]] == 10 * (1 + reached)


def test_categories_that_fit_a_task_get_the_factors_of_sparks_als(planted, spark, monkeypatch):
    """No iteration is run over the cluster for them; larger categories go through Spark's ALS, in the same search."""
    cfg = CFG.with_(ranks=(3,), reg_params=(0.01, 0.1), max_iter=4)
    ratings = planted.where("category <> 'X' or user_id <= 20").cache()
    real, iterations = MF.als, []
    monkeypatch.setattr(MF, "als", lambda rank, reg, c, blocks: iterations.append(c.max_iter) or real(rank, reg, c, blocks))
    values = lambda res: {(r["category"], r["grid_index"]): (r["rmse"], r["n_scored"], r["is_best"]) for r in res.grid.collect()}
    small = MF.grid_search(ratings, cfg)
    assert set(iterations) == {0}
    large = MF.grid_search(ratings, cfg.with_(fit_task_bytes=0))
    assert set(iterations) == {0, 4}
    a, b = values(small), values(large)
    assert len(a) == 6 and a.keys() == b.keys()
    assert all(abs(a[k][0] - b[k][0]) < 1e-5 and a[k][1:] == b[k][1:] for k in a)
    for side in ("users", "items"):
        f, g = ({r["id"]: r["features"] for r in MF.point_factors(spark, res.run_path, 1, side, "id").collect()} for res in (small, large))
        assert f.keys() == g.keys() and all(np.allclose(f[k], g[k], atol=1e-3) for k in f)
    mixed = MF.grid_search(ratings, cfg.with_(fit_task_bytes=category_fit.task_bytes(600, 20, 60, (3,))))
    assert [sorted(p.winners) for p in mixed.parts] == [["X"], ["Y", "Z"]]
    assert {k: v[1] for k, v in values(mixed).items()} == {k: v[1] for k, v in b.items()}
    assert MF.winning_factors(mixed)[0].count() == MF.winning_factors(large)[0].count()


@pytest.mark.parametrize("rank", [2, 6])
def test_half_an_iteration_solves_every_row(rank, monkeypatch):
    """Rows with fewer ratings than factors, with more, and with too many for one piece."""
    monkeypatch.setattr(category_fit, "WIDEST", 30)
    monkeypatch.setattr(category_fit, "CHUNK", 100)
    rng, reg = np.random.default_rng(2), 0.05
    count = np.array([*range(1, 29), 30, 31, 250] * 3)
    u = rng.permutation(np.repeat(np.arange(len(count)), count))
    i, r = rng.integers(0, 60, len(u)), rng.integers(1, 6, len(u)).astype(np.float32)
    X = rng.normal(size=(61, rank)).astype(np.float32)
    X[-1] = 0
    got = category_fit._half(X, category_fit._layout(u, i, r, len(count), 60, rank), len(count), reg)
    for k, n in enumerate(count):
        V = X[i[u == k]].astype(float)
        assert np.allclose(got[k], np.linalg.solve(V.T @ V + n * reg * np.eye(rank), V.T @ r[u == k]), rtol=1e-4, atol=1e-5)
    assert not got[-1].any()
