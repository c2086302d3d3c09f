"""Hard-negative mining: exact integer scores by a residue-number-system product.

Vectors of whole numbers are multiplied modulo several small primes, each in float32,
where every sum is a whole number below 2**24 and therefore exact. The residues are put
together by Chinese remaindering, which gives the exact signed score; positives and
negatives are then selected by windows over the scores.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanstats.llm.common import stored
from urbanstats.llm.topk import integer_vectors

# Rows and anchors per block, about, and anchors that a task scores at a time.
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 4096
STEP_ANCHORS = 256
# Components summed in float32 before the sum is reduced; residues of primes up to
# 2 * 256 + 1 have at most 256 in absolute value, so that a sum stays within 2**24.
PANEL = 256

_NONE = np.int64(-(1 << 63))
# A score must fit in 64 bits with its sign.
_MOST = 1 << 63


def primes_below(n):
    """Primes below ``n``, largest first."""
    sieve = np.ones(n, bool)
    sieve[:2] = False
    for i in range(2, int(n**0.5) + 1):
        if sieve[i]:
            sieve[i * i :: i] = False
    return np.flatnonzero(sieve)[::-1].tolist()


def moduli(largest):
    """The fewest primes whose product tells all scores from -largest to largest apart."""
    chosen, product = [], 1
    for p in primes_below(2 * PANEL + 1):
        if product > 2 * min(largest, _MOST):
            break
        chosen.append(p)
        product *= p
    return chosen


def _centred(x, p):
    """``x`` modulo an odd ``p``, between -(p - 1) / 2 and (p - 1) / 2."""
    half = p // 2
    return (x + half) % p - half


def residue_product(left, right, p):
    """left @ right.T modulo ``p``, centred; panel by panel in float32."""
    total = np.zeros((len(left), len(right)), np.int64)
    for a in range(0, left.shape[1], PANEL):
        x = _centred(left[:, a : a + PANEL], p).astype(np.float32)
        y = _centred(right[:, a : a + PANEL], p).astype(np.float32)
        total += (x @ y.T).astype(np.int64)
    return _centred(total, p)


def exact_product(left, right, primes):
    """left @ right.T in whole numbers, from its residues, as centred mixed-radix digits.

    Exact where every score is below half the product of the primes in absolute value,
    and fits in 64 bits.
    """
    value, base = np.zeros((len(left), len(right)), np.int64), 1
    for p in primes:
        digit = residue_product(left, right, p)
        if base > 1:
            digit = _centred((digit - value % p) * pow(base, -1, p), p)
        # The last digits may be out of range on their own; modulo 2**64 the sum is right.
        value += digit * np.uint64(base % (1 << 64)).astype(np.int64)
        base *= p
    return value


def best_of_rows(scores, allowed, k):
    """(row, column, rank) of the k highest allowed scores in each row, ties in column order."""
    masked = np.where(allowed, scores, _NONE)
    if masked.shape[1] > k:
        floor = np.partition(masked, -k, axis=1)[:, -k]
        allowed = allowed & (masked >= floor[:, None])
    row, column = np.nonzero(allowed)
    # A stable sort by -score, written so that the smallest long has no overflow.
    order = np.lexsort((column, ~masked[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    return row[rank < k], column[rank < k], rank[rank < k]


def _matrix(rows, width):
    """Lists of up to ``width`` numbers as a matrix, zeros at the end of short ones."""
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


_PACKED = "ids binary, labels binary, vectors binary"


def _packed(rows, width):
    """The columns of a block, in order of id; vectors in the smallest type that holds them."""
    rows = rows.sort_values("vec_id", kind="stable")
    vectors = _matrix(rows["v"].tolist(), width)
    most = max(int(vectors.max(initial=0)), -1 - int(vectors.min(initial=0)))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
    labels = rows["label"].to_numpy(np.int64)
    return rows, (rows["vec_id"].to_numpy(np.int64).tobytes(), labels.tobytes(), vectors.astype(kind).tobytes())


def _unpacked(row, width):
    ids = np.frombuffer(row["ids"], np.int64)
    size = len(row["vectors"]) // max(1, len(ids) * width)
    vectors = np.frombuffer(row["vectors"], f"i{max(1, size)}").reshape(len(ids), width)
    return ids, np.frombuffer(row["labels"], np.int64), vectors.astype(np.int64)


def _row_blocks(points, blocks, width):
    """Rows (block, ids, labels, vectors): all rows, dealt by a hash of the whole row."""

    def pack(rows):
        return pd.DataFrame([(rows["block"].iloc[0], *_packed(rows, width)[1])], columns=["block", *_names(_PACKED)])

    dealt = points.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(pack, f"block long, {_PACKED}")


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _anchor_blocks(anchors, width):
    """Rows (asked, ids, labels, vectors, positives): anchors and what they found so far.

    ``positives`` holds four numbers for each: place of the anchor in the block, and the
    positive's rank, vec_id and score.
    """

    def pack(rows):
        rows, columns = _packed(rows, width)
        found = [(i, p["rank"], p["vec_id"], p["score"]) for i, some in enumerate(rows["found"]) for p in some]
        positives = np.array(found, np.int64).reshape(-1, 4).tobytes()
        return pd.DataFrame(
            [(rows["asked"].iloc[0], *columns, positives)], columns=["asked", *_names(_PACKED), "positives"]
        )

    return anchors.groupBy("asked").applyInPandas(pack, f"asked long, {_PACKED}, positives binary")


def _meet(anchors, blocks, n_asked, n_blocks, work, schema):
    """Apply ``work`` to each block of anchors with each block of rows, one pair at a time."""

    def numbers(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = anchors.withColumn("block", numbers(n_blocks)).groupBy("asked", "block")
    right = blocks.withColumn("asked", numbers(n_asked)).groupBy("asked", "block")

    def one(a, b):
        if not len(a) or not len(b):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in _names(schema)})
        return work(a.iloc[0], b.iloc[0])

    return left.cogroup(right).applyInPandas(one, schema)


_POSITIVE = "anchor_id long, vec_id long, score long"


def _find_positives(primes, width, k):
    """The k best rows of a block with the anchor's label, for each anchor of another."""

    def work(asked, block):
        anchor, label, vectors = _unpacked(asked, width)
        ids, labels, rows = _unpacked(block, width)
        out = []
        for a in range(0, len(anchor), STEP_ANCHORS):
            some = slice(a, a + STEP_ANCHORS)
            scores = exact_product(vectors[some], rows, primes)
            allowed = (label[some, None] == labels) & (anchor[some, None] != ids)
            row, column, _ = best_of_rows(scores, allowed, k)
            out.append((anchor[some][row], ids[column], scores[row, column]))
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(_names(_POSITIVE), zip(*out))})

    return work


def score_window(scores, low, high):
    """Lowest and highest whole number from ``low`` to ``high`` per cent of each score.

    Hundreds and the rest are taken apart, so that no product overflows.
    """
    hundreds, rest = scores // 100, scores % 100
    return low * hundreds - (-low * rest) // 100, high * hundreds + high * rest // 100


_NEGATIVE = "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"


def _find_negatives(primes, width, k, window):
    """The k best rows of a block in each positive's window, with other labels."""

    def work(asked, block):
        anchor, label, vectors = _unpacked(asked, width)
        positives = np.frombuffer(asked["positives"], np.int64).reshape(-1, 4)
        ids, labels, rows = _unpacked(block, width)
        out = [(np.zeros(0, np.int64),) * 6]
        for a in range(0, len(anchor), STEP_ANCHORS):
            some = slice(a, a + STEP_ANCHORS)
            scores = exact_product(vectors[some], rows, primes)
            other = (label[some, None] != labels) & (anchor[some, None] != ids)
            mine = positives[(positives[:, 0] >= a) & (positives[:, 0] < a + STEP_ANCHORS)]
            # One positive of each anchor at a time.
            turn = np.arange(len(mine)) - np.searchsorted(mine[:, 0], mine[:, 0])
            for t in range(int(turn.max(initial=-1)) + 1):
                at, place, positive, reached = mine[turn == t].T
                low, high = score_window(reached, *window)
                theirs = scores[at - a]
                allowed = other[at - a] & (theirs >= low[:, None]) & (theirs <= high[:, None])
                row, column, _ = best_of_rows(theirs, allowed, k)
                mine_t = (anchor[at], place, positive, reached)
                out.append((*[x[row] for x in mine_t], ids[column], theirs[row, column]))
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(_names(_NEGATIVE), zip(*out))})

    return work


def _ranked(rows, keys, score, name, k):
    best = Window.partitionBy(*keys).orderBy(F.desc(score), name)
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine_hard_negatives(
    vectors,
    is_anchor,
    label=None,
    positives=5,
    negatives=3,
    window=(50, 95),
    scale=256,
    block_rows=BLOCK_ROWS,
    block_anchors=BLOCK_ANCHORS,
):
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has the columns vec_id, embedding and label; ``label`` may be an
    expression instead of the column. Each component x becomes floor(scale * x), and a
    score is the exact inner product with the anchor; more than 63 bits are not meant.
    An anchor is a row that meets ``is_anchor``, a condition on vec_id. Its positives are
    the ``positives`` rows of highest score with its label; a positive's negatives are the
    ``negatives`` rows of highest score with other labels and a score between
    ``window[0]`` and ``window[1]`` per cent of the positive's. Higher scores come first,
    ties by smaller vec_id; fewer rows all come out. A positive score below zero has an
    empty window.

    Rows with a NULL id, label or vector, or a component that is NULL or not finite, take
    no part. Equal rows count once. Rows with the anchor's own id are no candidates; where
    an id has several vectors or labels each is a candidate, and the one that sorts first
    is the anchor. Vectors of different lengths compare as if the shorter one ended in
    zeros. No rows or no anchors give an empty result. Other columns are ignored.

    All rows and all anchors go into blocks of bounded size, and each block of anchors
    meets each block of rows in a task of its own, twice: for the positives, and for the
    negatives in their windows. No key of the data decides where a row goes.
    """
    labels = F.col("label") if label is None else label
    usable = vectors.select("vec_id", "embedding", labels.cast("long").alias("label")).filter("label IS NOT NULL")
    points = stored(integer_vectors(usable, scale, also=("label",)), "negatives_points")
    sizes = points.select(
        F.size("v").alias("n"), F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))).alias("most")
    ).agg(F.count(F.lit(1)), F.max("n"), F.max("most")).first()
    rows, width, most = sizes[0], max(1, sizes[1] or 0), int(sizes[2] or 0)
    primes = moduli(width * most * most)
    asked = points.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("one"))
    n_blocks = max(1, -(-rows // block_rows))
    n_asked = max(1, -(-asked.count() // block_anchors))
    anchors = asked.select(
        "vec_id", "one.label", "one.v", F.pmod(F.xxhash64("vec_id"), F.lit(n_asked)).alias("asked")
    )
    blocks = stored(_row_blocks(points, n_blocks, width), "negatives_blocks")
    nothing = F.array().cast("array<struct<rank:int,vec_id:bigint,score:bigint>>")
    first = _anchor_blocks(anchors.withColumn("found", nothing), width)
    best = _meet(first, blocks, n_asked, n_blocks, _find_positives(primes, width, positives), _POSITIVE)
    found = stored(
        _ranked(best, ["anchor_id"], "score", "vec_id", positives), "negatives_positives"
    )
    theirs = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("rank", found["vec_id"], "score")).alias("found")
    )
    second = _anchor_blocks(anchors.join(theirs, "vec_id"), width)
    hard = _meet(second, blocks, n_asked, n_blocks, _find_negatives(primes, width, negatives, window), _NEGATIVE)
    return _ranked(hard, ["anchor_id", "place"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
