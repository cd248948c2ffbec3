"""The exact top-k kernel used by ALS scoring, against a brute-force sort (no Spark)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pickwise.operators.factorization import _topk_rows


@settings(max_examples=200, deadline=None)
@given(
    n_users=st.integers(1, 6), n_items=st.integers(1, 9), rank=st.integers(1, 3),
    k=st.integers(1, 5), seed=st.integers(0, 10_000),
)
def test_topk_rows_matches_sorting(n_users, n_items, rank, k, seed):
    rng = np.random.default_rng(seed)
    # small integers: many exact ties, which must go to the lower item id
    U = rng.integers(-2, 3, size=(n_users, rank)).astype(np.float64)
    V = rng.integers(-2, 3, size=(n_items, rank)).astype(np.float64)
    uids = np.arange(100, 100 + n_users, dtype=np.int64)
    iids = rng.permutation(np.arange(n_items, dtype=np.int64) * 7)
    u, i, v, r = _topk_rows(uids, U, iids, V, k)
    got = sorted(zip(u.tolist(), r.tolist(), i.tolist(), v.tolist()))
    want = []
    for row, uid in enumerate(uids):
        scored = sorted((-(U[row] @ V[c]), int(iids[c])) for c in range(n_items))[:k]
        want += [(int(uid), rank_ + 1, item, -neg) for rank_, (neg, item) in enumerate(scored)]
    assert got == sorted(want)
