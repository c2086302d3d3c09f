import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanstats.llm import topk
from urbanstats.llm.topk import BallTree, Cells, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, v string, shard int, block int, kth int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", 2, 3, 4) for i, v in rows], SCHEMA)


def plain(rows, k=5, every=50):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        usable.setdefault(i, set()).add(whole)
    out = []
    for q in usable:
        if q % every:
            continue
        asked = min(usable[q])
        scored = [
            (-sum(a * b for a, b in zip(asked, v)), i) for i, some in usable.items() if i != q for v in some
        ]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("shards", [7, 100_000])
def test_random_vectors(spark, shards):
    """A third of the rows are one vector; many ties."""
    rnd = random.Random(1)
    same = [0.5] * 6
    rows = [
        (i, same if i % 3 == 0 else [rnd.choice([-1.0, -0.25, 0.1, 0.5, 2.0]) for _ in range(6)])
        for i in range(400)
    ]
    got = top_k(vectors_of(spark, rows), F.col("vec_id") % 50 == 0, shard_vectors=shards, block_queries=3)
    assert found(got) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]),
        (0, [1.0, 2.0]),
        (0, [0.5, 0.5]),
        (1, None),
        (2, []),
        (3, [1.0, None]),
        (4, [float("nan"), 1.0]),
        (5, [float("inf")]),
        (None, [1.0, 1.0]),
        (6, [1.0, 2.0, 3.0]),
        (50, [0.0, 0.0]),
        (7, [-0.001]),
    ]
    assert found(top_k(vectors_of(spark, rows), F.col("vec_id") % 50 == 0)) == plain(rows)


def test_empty_table_and_no_queries(spark):
    assert found(top_k(vectors_of(spark, []), F.col("vec_id") % 50 == 0)) == []
    assert found(top_k(vectors_of(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0)) == []
    assert found(top_k(vectors_of(spark, [(50, [1.0])]), F.col("vec_id") % 50 == 0)) == []


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 3, (300, 8)) for c in (-100, 0, 100)]).astype(np.int64)
    ids = np.full((900, 6), (1 << 63) - 1)
    ids[:, 0] = rng.permutation(900)
    tree = BallTree.from_bytes(BallTree.build(points, ids).to_bytes())
    queries = rng.normal(50, 30, (20, 8)).astype(np.int64)
    none = np.full(20, -(1 << 63))
    scores, names = tree.search(np.full(20, -1), queries, none, 5)
    every = queries @ points.T
    for q in range(20):
        best = np.lexsort((ids[:, 0], -every[q]))[:5]
        assert scores[q].tolist() == every[q, best].tolist()
        assert names[q].tolist() == ids[best, 0].tolist()


def test_cells_hold_their_points():
    """Bounds hold for all points, also for those of other widths than the sample's."""
    rng = np.random.default_rng(8)
    sample = np.concatenate([rng.normal(c, 5, (40, 6)) for c in (-90, 0, 70)]).astype(np.int64)
    cells = Cells(sample, 7)
    assert len(cells.centres) == 7
    for width in (4, 6, 9):
        points = rng.integers(-150, 150, (300, width))
        cell, far = cells.of(points)
        radius = np.full(7, -np.inf)
        np.maximum.at(radius, cell, far)
        wide = max(width, 6)
        queries = rng.integers(-150, 150, (20, wide))
        scores = queries @ np.pad(points, ((0, 0), (0, wide - width))).T
        bounds = cells.bounds(queries, radius, 150.0)
        assert (bounds[:, cell] >= scores).all()
    assert len(Cells(np.ones((50, 3)), 8).centres) == 1 and len(Cells(np.zeros((0, 1)), 4).centres) == 1


def test_clustered_vectors_meet_few_cells(spark, monkeypatch):
    """Far clusters are skipped before any vector moves to them."""
    monkeypatch.setattr(topk, "SAMPLE_PER_CELL", 2)
    pairs = []
    plain_stored = topk.stored
    monkeypatch.setattr(
        topk, "stored", lambda df, name: (pairs.append(plain_stored(df, name)), pairs[-1])[1]
        if name.endswith("_pairs")
        else plain_stored(df, name)
    )
    rng = random.Random(6)
    middle = [[rng.gauss(0, 4) for _ in range(8)] for _ in range(20)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in middle[i % 20]]) for i in range(1200)]
    rows = [(i * 10 + i % 20, v) for i, v in rows]
    got = top_k(vectors_of(spark, rows), F.col("vec_id") % 50 == 0, shard_vectors=60)
    assert found(got) == plain(rows)
    asked = sum(i % 50 == 0 for i, _ in rows)
    met = sum(p.count() for p in pairs)
    assert met < 0.4 * asked * 20


def test_large_numbers_are_exact(spark):
    rows = [(0, [3000.0, 1.0]), (1, [3000.0, 2.0]), (2, [-3000.0, 5.0]), (3, [2999.996, 2.0])]
    assert found(top_k(vectors_of(spark, rows), F.col("vec_id") % 50 == 0)) == plain(rows)
