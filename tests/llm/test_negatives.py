import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanstats.llm.negatives import best_of_rows, exact_product, mine_hard_negatives, moduli, score_window

SCHEMA = "vec_id long, embedding array<float>, label int, v string, block int, asked int, score int, found int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "v", 2, 3, 4, 5) for i, v, label in rows], SCHEMA)


def plain(rows, every=50):
    usable = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        usable.setdefault(i, set()).add((whole, label))
    out = []
    for a in usable:
        if a % every:
            continue
        asked, own = min(usable[a])
        scored = sorted(
            (-sum(x * y for x, y in zip(asked, v)), i, label)
            for i, some in usable.items()
            if i != a
            for v, label in some
        )
        for s, i, _ in [x for x in scored if x[2] == own][:5]:
            hard = [x for x in scored if x[2] != own and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, i, r + 1, n, -s, -m) for r, (m, n, _) in enumerate(hard)]
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def mine(df, **sizes):
    return mine_hard_negatives(df, F.col("vec_id") % 50 == 0, **sizes)


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 50, "block_anchors": 3}])
def test_random_vectors(spark, sizes):
    """A third of the rows are one vector; many ties."""
    rnd = random.Random(13)
    same = [0.5] * 6
    rows = [
        (i, same if i % 3 == 0 else [rnd.choice([-1.0, -0.25, 0.1, 0.5, 2.0]) for _ in range(6)], rnd.randrange(4))
        for i in range(400)
    ]
    want = plain(rows)
    assert len(want) > 50
    assert found(mine(vectors_of(spark, rows), **sizes)) == want


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1),
        (0, [1.0, 2.0], 1),
        (0, [0.5, 0.5], 2),
        (1, None, 1),
        (2, [], 1),
        (3, [1.0, None], 1),
        (4, [float("nan"), 1.0], 1),
        (5, [float("inf")], 2),
        (None, [1.0, 1.0], 1),
        (6, [1.0, 2.0, 3.0], 2),
        (7, [1.0, 1.0], None),
        (8, [0.5, 0.6], 1),
        (8, [0.5, 0.5], 1),
        (9, [0.4, 0.3], 3),
        (9, [0.4, 0.3], 3),
        (10, [0.4, 0.3], 3),
        (11, [0.4, 0.3], 2),
        (12, [0.3, 0.3], 5),
        (50, [0.0, 0.0], 1),
        (100, [-1.0, 0.0], 3),
    ]
    want = plain(rows)
    assert len(want) > 5
    assert found(mine(vectors_of(spark, rows))) == want


def test_empty_table_and_no_anchors(spark):
    assert found(mine(vectors_of(spark, []))) == []
    assert found(mine(vectors_of(spark, [(1, [1.0], 1), (2, [1.0], 2)]))) == []
    assert found(mine(vectors_of(spark, [(50, [1.0], 1)]))) == []


@pytest.mark.parametrize(("most", "width"), [(1, 1), (160, 64), (30_000, 1500), (2**28, 40)])
def test_residues_give_the_exact_product(most, width):
    rnd = random.Random(most)
    left, right = ([[rnd.randint(-most, most) for _ in range(width)] for _ in range(9)] for _ in "ab")
    left[0] = right[0] = [most] * width
    right[1] = [-most] * width
    got = exact_product(np.array(left, np.int64), np.array(right, np.int64), moduli(width * most * most))
    assert got.tolist() == [[sum(x * y for x, y in zip(a, b)) for b in right] for a in left]


def test_moduli_cover_the_range():
    assert math.prod(moduli(1_638_400)) > 2 * 1_638_400 and len(moduli(1_638_400)) == 3
    assert math.prod(moduli(1 << 62)) > 1 << 63


def test_score_window():
    scores = np.array([0, 1, 2, 99, 100, 101, -1, -100, 7, (1 << 62) + 1])
    low, high = score_window(scores, 50, 95)
    for s, a, b in zip(scores.tolist(), low.tolist(), high.tolist()):
        assert (a, b) == (-(-50 * s // 100), 95 * s // 100)


def test_best_of_rows_keeps_ties_in_order():
    scores = np.array([[5, 5, 5, 1], [1, 2, 3, 4]])
    row, column, rank = best_of_rows(scores, np.array([[1, 1, 1, 1], [1, 0, 0, 1]], bool), 2)
    assert list(zip(row, column, rank)) == [(0, 0, 0), (0, 1, 1), (1, 3, 0), (1, 0, 1)]
