from __future__ import annotations

import math

import numpy as np

from feedloom.llm import topk


def test_against_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)], 1, 2) for i in range(300)]
    rows += [(300 + i, rows[10][1], 1, 2) for i in range(8)]  # ties
    rows += [(400, None, 1, 2), (401, [1.0, None], 1, 2), (402, [math.nan] * 8, 1, 2), (403, [math.inf] * 8, 1, 2), (None, [1.0] * 8, 1, 2), (450, [0.5, 0.25], 1, 2), (350, [], 1, 2), (10, rows[10][1], 1, 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, rank int").repartition(4)
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in ok:
        if q % 50 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in ok if i != q))[:5]
            want += [(q, n, i, -x) for n, (x, i) in enumerate(scores, 1)]
    got = topk.top_k(table).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert topk.top_k(table.limit(0)).count() == 0


def test_bounds_prune():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 1)) * 500
    x = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 64)) * 5)
    q, c, s, exact = topk.search(x[:20], np.arange(20), x, np.arange(4000), 5)
    scores = x[:20] @ x.T
    scores[np.arange(20), np.arange(20)] = -np.inf
    assert np.array_equal(s.reshape(20, 5), -np.sort(-scores, axis=1)[:, :5].astype(np.int64)) and exact < 20 * 4000 * 0.8
