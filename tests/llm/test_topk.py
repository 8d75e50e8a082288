import numpy as np
import pytest
from pyspark.sql import functions as F

from objsync.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors, queries, k):
    """vectors, queries: (id, list of ints)."""
    out = []
    for q, v in queries:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(make, rows, k=5, every=2, clash=False):
    df = make(rows, SCHEMA, clash).withColumn("vector", topk.scaled(F.col("embedding")))
    got = topk.top_k(df, df.filter(f"vec_id % {every} = 0"), k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_matches_brute_force_with_ties(make):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.integers(-3, 4, 6) / 8]) for i in range(300)]
    rows += [(i, [0.25] * 6) for i in range(300, 400)]
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows]
    assert run(make, rows) == brute(whole, [r for r in whole if r[0] % 2 == 0], 5)


def test_rows_that_take_no_part(make):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [1.0, None]), (None, [1.0, 1.0]), (6, [0.5, -0.5])]
    assert run(make, rows, clash=True) == [(0, 1, 6, 64 * 32 - 128 * 32), (6, 1, 0, 64 * 32 - 128 * 32)]


def test_empty_short_and_repeated(make):
    assert run(make, []) == []
    assert run(make, [(0, [1.0])]) == []
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0]), (1, [1.0])]
    assert run(make, rows) == [(0, 1, 1, 4096), (0, 2, 1, 4096)]


def test_components_beyond_exact_doubles(make):
    rows = [(i, [v]) for i, v in enumerate([2.0**40 + 2.0**20, 2.0**40, 2.0**41, -(2.0**41)])]
    whole = [(i, [int(64 * v[0])]) for i, v in rows]
    cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    want = []
    for q, v in whole[::2]:
        scores = sorted((-cut(v[0] * w[0]), i) for i, w in whole if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert run(make, rows) == sorted(want)


@pytest.mark.parametrize("seed", range(4))
def test_block_stops_only_when_nothing_can_follow(seed):
    draw = np.random.default_rng(seed)
    grid = np.floor(draw.normal(size=(500, 4)) ** 3 * 64)
    block = topk._Block(np.arange(500), grid)
    asking = np.arange(0, 500, 25)
    found = block.best(asking, grid[asking], 3)
    got = sorted(zip(*found))
    want = sorted((q, i, s) for q, _, i, s in brute([(i, v) for i, v in enumerate(grid.astype(int).tolist())],
                                                  [(q, grid[q].astype(int).tolist()) for q in asking.tolist()], 3))
    assert got == want
