import math
import random

import numpy as np
from conftest import table
from stocklake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, dim string, block string, square int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", "d", "b", 2) for r in rows], SCHEMA)


def expected(rows, k=5, every=50):
    sound = []
    for vec, v in rows:
        if vec is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            sound.append((vec, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for q, a in {(q, tuple(v)) for q, v in sound if q % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in sound if c != q and len(a) == len(b))
        out.extend((q, i + 1, c, -s) for i, (s, c) in enumerate(scored[:k]))
    return sorted(out, key=repr)


def check(spark, rows, **options):
    got = table(topk.top_k(vectors_of(spark, rows), **options), "query_id", "rank", "vec_id", "score")
    assert got == expected(rows)


def random_rows(n, dim, seed, same=0):
    rng = random.Random(seed)
    common = [rng.gauss(0, 1) for _ in range(dim)]
    return [(i, common if i < same else [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]


def test_many_blocks_and_ties(spark):
    check(spark, random_rows(400, 8, 1, same=150), candidates=64, queries=3)


def test_one_block(spark):
    check(spark, random_rows(230, 16, 2))


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf"), 0.0])]
    rows += [(None, [1.0, 1.0]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, [0.0, 0.0]), (250, [1.0, 2.0, 3.0])]
    rows += [(300, []), (4, []), (350, [-1.0, 3.0]), (7, [9.0, 9.0]), (7, [9.0, 9.0]), (0, [1.0, 2.0])]
    check(spark, rows)


def test_empty(spark):
    assert topk.top_k(vectors_of(spark, [(1, [1.0])]).limit(0)).count() == 0
    assert topk.top_k(vectors_of(spark, [(1, [1.0])])).count() == 0


def test_stops_early():
    """Bounds leave most rows of separate clusters unevaluated, without changing the result."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 4000, (40, 16))
    rows = np.rint(centres[rng.integers(0, 40, 8000)] + rng.normal(0, 60, (8000, 16)))
    top = float((rows**2).sum(axis=1).max())
    lift = np.sqrt(top - (rows**2).sum(axis=1))
    pivots = topk.choose_pivots(rows[:500], 32)
    query, ids = rows[:1], np.arange(8000)
    args = query, ids[:1], topk.pivot_distances(query, np.zeros(1), pivots)
    found = list(topk.search_block(*args, rows, ids, topk.pivot_distances(rows, lift, pivots), top, 5))[0]
    best = sorted(range(1, 8000), key=lambda i: (-int(rows[i] @ query[0]), i))[:5]
    assert found[1].tolist() == best
