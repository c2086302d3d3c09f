"""MinHash near-duplicates by min-max hashing: both ends of each permutation are kept.

A permutation of a document's shingles gives two signature values, the smallest and the
largest number, so that half of the hash evaluations do. Bands of values are the keys of
lists; documents that share a list are candidates, and links are confirmed on the full
sets of shingles.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from urbanstats.llm.common import stored, text_table
from urbanstats.llm.components import connected_components
from urbanstats.llm.windows import WordHashes, spread, windows_of

# 64 bands of six values, two each of 192 permutations. Two sets of similarity 0.8 miss
# all bands with a chance of (1 - 0.8 ** 6) ** 64, about 4 in a billion.
BANDS = 64
VALUES = 6
# Lists of more sets than this are compared block by block; a block has about so many
# shingles (0.8 MB), and so many columns of it are multiplied at a time.
LIST_LENGTH = 16
BLOCK_SHINGLES = 100_000
COLUMNS = 2048
# Characters that a task signs at a time, and shingles that are permuted at a time.
CHUNK_CHARS = 2_000_000
STEP = 4096
# Texts that are needed again are chosen by broadcast keys up to this many (32 MB or so).
MAX_BROADCAST_KEYS = 1_000_000

_SEED = 4


def shingle_sets(known, texts, length):
    """Of each text, the sorted 64-bit hashes of its distinct shingles.

    Words are lower-cased in A-Z. With fewer words than ``length`` all of them are one
    shingle; without words there is none.
    """
    words = [text.encode("utf-8").lower().split() for text in texts]
    hashes, counts = windows_of(known, words, length)
    ends = np.cumsum(counts).tolist()
    sets = []
    for some, a, b in zip(words, [0, *ends], ends):
        if 0 < len(some) < length:
            sets.append(np.array([xxhash.xxh64_intdigest(b" ".join(some), _SEED)], np.uint64))
        else:
            sets.append(np.unique(hashes[a:b]))
    return sets


def permutations(n):
    """Multipliers (odd) and offsets of ``n`` permutations of 32-bit numbers, from a rule."""
    numbers = [xxhash.xxh64_intdigest(b"%d" % i, _SEED) for i in range(n)]
    factors = np.array([x >> 32 | 1 for x in numbers], np.uint32)
    return factors[:, None], np.array([x & 0xFFFFFFFF for x in numbers], np.uint32)[:, None]


def signature(hashes, permuted):
    """Smallest and largest number of a set under each permutation, as a flat array."""
    factors, offsets = permuted
    numbers = (hashes >> np.uint64(32)).astype(np.uint32)
    ends = np.empty((len(factors), 2), np.uint32)
    ends[:, 0], ends[:, 1] = 0xFFFFFFFF, 0
    for a in range(0, len(numbers), STEP):
        moved = numbers[a : a + STEP] * factors + offsets
        np.minimum(ends[:, 0], moved.min(1), out=ends[:, 0])
        np.maximum(ends[:, 1], moved.max(1), out=ends[:, 1])
    return ends.ravel()


def band_keys(signatures, bands):
    """A 64-bit key for each band of each signature."""
    parts = signatures.reshape(len(signatures), bands, -1).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for i in range(parts.shape[2]):
        keys = spread((keys ^ parts[:, :, i]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 1))
    return keys.view(np.int64)


def _chunks(batches, most):
    """(rows, texts) of about ``most`` characters; a text is never cut."""
    rows, texts, size = [], [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            rows.append(row)
            texts.append(row.text)
            size += len(row.text)
            if size >= most:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


_SIGNED = "doc_id long, text_key long, n long, set_key binary, keys array<long>"


def _sign(length, bands, values, most):
    """Function for mapInPandas: size and key of each set, and the keys of its bands.

    Of equal sets in a chunk only the first one carries bands.
    """

    def sign(batches):
        known, permuted = WordHashes(), permutations(bands * values // 2)
        for rows, texts in _chunks(batches, most):
            sets = shingle_sets(known, texts, length)
            names = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            first = {name: i for i, name in reversed(list(enumerate(names))) if len(sets[i])}
            chosen = sorted(first.values())
            keys = [None] * len(sets)
            if chosen:
                made = band_keys(np.array([signature(sets[i], permuted) for i in chosen]), bands)
                for i, own in zip(chosen, made):
                    keys[i] = own
            yield pd.DataFrame(
                {
                    "doc_id": [r.doc_id for r in rows],
                    "text_key": [r.text_key for r in rows],
                    "n": [len(s) for s in sets],
                    "set_key": names,
                    "keys": keys,
                }
            )

    return sign


def _hash_sets(length, most):
    """Function for mapInPandas: the shingles of each text."""

    def hash_sets(batches):
        known = WordHashes()
        for rows, texts in _chunks(batches, most):
            sets = shingle_sets(known, texts, length)
            yield pd.DataFrame({"node": [r.node for r in rows], "hashes": [s.view(np.int64) for s in sets]})

    return hash_sets


def _sized(percent):
    """Whether the sizes of two sets allow the similarity."""
    return F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * percent


def _texts_with_keys(docs):
    return text_table(docs).filter("doc_id IS NOT NULL").withColumn("text_key", F.xxhash64("text"))


class _Sets:
    """Distinct sets of shingles as the nodes of a graph, and their texts."""

    def __init__(self, texts, nodes, length, chunk_chars, percent):
        self.texts, self.nodes, self.percent = texts, nodes, percent
        self.hashing = _hash_sets(length, chunk_chars)

    def hashes(self, wanted):
        """Rows (node, hashes) of the wanted nodes: the full sets."""
        keys = self.nodes.join(wanted, "node").select("node", "doc_id", "text_key")
        texts, few = self.texts, wanted.count() <= MAX_BROADCAST_KEYS
        found = texts.join(F.broadcast(keys) if few else keys, ["doc_id", "text_key"])
        # Rows that repeat an id and its text give the set once.
        once = found.groupBy("node").agg(F.min("text").alias("text"))
        return stored(once.mapInPandas(self.hashing, "node long, hashes array<long>"), "minhash_sets")

    def links(self, pairs):
        """Those pairs (u, v) whose full sets are similar enough."""
        ends = [pairs.select(F.col(c).alias("node")) for c in "uv"]
        wanted = ends[0].unionByName(ends[1]).distinct()
        sets = self.hashes(stored(wanted, "minhash_wanted"))
        both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u").join(
            sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v"
        )
        shared = F.size(F.array_intersect("a", "b"))
        union = F.size("a") + F.size("b") - shared
        return stored(both.filter(shared * 100 >= union * self.percent).select("u", "v"), "minhash_links")


def _labelled(lists, links):
    """``lists`` with the component of each node so far, in lists that hold several.

    Nodes of one component need no comparing; only lists that join different ones stay.
    """
    labels = stored(connected_components(links, "minhash_parts"), "minhash_labels")
    known = stored(
        lists.join(labels, "node", "left").select(*lists.columns, F.coalesce("label", "node").alias("label")),
        "minhash_labelled",
    )
    several = known.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return known.join(stored(several.filter("low < high").select("key"), "minhash_open"), "key")


def _pairs_of_short(lists, percent):
    """Pairs of nodes of different components that share a short list."""
    u, v = (lists.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "label")]) for s in "uv")
    return (
        u.join(v, "key")
        .filter((F.col("node_u") < F.col("node_v")) & (F.col("label_u") != F.col("label_v")) & _sized(percent))
        .select(F.col("node_u").alias("u"), F.col("node_v").alias("v"))
        .distinct()
    )


def shared_counts(first, second):
    """How many elements each set of one list shares with each set of another.

    Only elements of several sets count; they are the columns of two matrices of zeros
    and ones, whose product is exact in float32 below 2**24.
    """
    sets = [*first, *second]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times > 1
    owner, column = owner[several[column]], (np.cumsum(several) - 1)[column[several[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(first), len(second)), np.float32)
    for a in range(0, int(several.sum()), COLUMNS):
        x, y = np.searchsorted(column, (a, a + COLUMNS))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[x:y], column[x:y] - a] = 1
        total += held[: len(first)] @ held[len(first) :].T
    return total.astype(np.int64)


def joined_labels(alike, left, right):
    """The smallest label that each label is connected with.

    ``alike`` says which rows (with the labels ``left``) go with which columns (``right``).
    """
    names, codes = np.unique(np.concatenate((left, right)), return_inverse=True)
    best = np.arange(len(names))
    a, b = codes[: len(left)], codes[len(left) :]
    while True:
        now = best.copy()
        np.minimum.at(now, a, np.where(alike, best[b], len(names)).min(1, initial=len(names)))
        np.minimum.at(now, b, np.where(alike, best[a][:, None], len(names)).min(0, initial=len(names)))
        now = np.minimum(now, now[now])
        if (now == best).all():
            return names, names[best]
        best = now


def _compare(percent):
    """Function for applyInPandas: which components two blocks of a list join, and by which nodes.

    All pairs of the blocks are compared on their full sets at once; a row comes out for
    each component that is joined with another, not for each pair.
    """

    def compare(rows):
        one, other = rows[rows["block"] == rows["i"]], rows[rows["block"] == rows["j"]]
        if not len(one) or not len(other):
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        first, second = one["hashes"].tolist(), other["hashes"].tolist()
        n, m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (first, second))
        shared = shared_counts(first, second)
        alike = 100 * shared >= percent * (n[:, None] + m - shared)
        left, right = one["label"].to_numpy(np.int64), other["label"].to_numpy(np.int64)
        names, joined = joined_labels(alike, left, right)
        node_of = dict(zip([*left, *right], [*one["node"], *other["node"]]))
        out = [(node_of[x], node_of[y]) for x, y in zip(names.tolist(), joined.tolist()) if x != y]
        return pd.DataFrame(out, columns=["u", "v"])

    return compare


def _links_of_long(lists, sets, percent, block_shingles):
    """Links that join components within long lists, block by block."""
    weights = lists.groupBy("key").agg(F.ceil(F.sum("n") / block_shingles).alias("blocks"))
    placed = lists.join(stored(weights, "minhash_blocks"), "key").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks"))
    )
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = placed.withColumn("other", others).select(
        "key", "node", "label", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    wanted = stored(lists.select("node").distinct(), "minhash_wanted")
    return (
        met.join(sets.hashes(wanted), "node")
        .groupBy("key", "i", "j")
        .applyInPandas(_compare(percent), "u long, v long")
    )


def near_duplicates(
    docs,
    shingle_words=4,
    percent=80,
    bands=BANDS,
    values=VALUES,
    list_length=LIST_LENGTH,
    block_shingles=BLOCK_SHINGLES,
    chunk_chars=CHUNK_CHARS,
):
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    A document's set has its distinct shingles of ``shingle_words`` words, lower-cased in
    A-Z; of fewer words the whole sequence is one shingle. Documents whose sets share
    ``percent`` per cent of their union or more are linked, equal sets too. ``component_id``
    is the smallest doc_id reachable, and ``kept`` says that it is the row's own.

    Texts without words, empty and NULL texts have an empty set and are linked with
    nothing. Rows with a NULL id cannot be named and are left out; rows that repeat an id
    give a row each, linked by their own sets. Texts of any length are taken whole. Other
    columns are ignored. An empty table gives an empty result.

    Equal sets are one node. Sets that share a band share a list. First each set is
    compared with one other, that with which it shares most lists among their first
    members; what that links needs no more comparing. In lists that still hold sets of
    several components, all pairs of different components are compared: pair by pair in
    lists of up to ``list_length`` sets, block by block in longer ones. All comparisons
    are of full sets (64-bit hashes of the shingles). None is left out, so a link can
    only be missed if two sets share no band at all; see BANDS for the chance.
    """
    texts = _texts_with_keys(docs)
    signed = stored(texts.mapInPandas(_sign(shingle_words, bands, values, chunk_chars), _SIGNED), "minhash_signed")
    nodes = stored(
        signed.filter("n > 0")
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("one"), F.max("n").alias("n"), F.max("keys").alias("keys"))
        .select(F.monotonically_increasing_id().alias("node"), "one.*", "n", "set_key", "keys"),
        "minhash_nodes",
    )
    postings = nodes.select("node", "n", F.explode("keys").alias("key"))
    heads = postings.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n")).alias("head")
    )
    lists = stored(
        postings.join(stored(heads.filter("size > 1"), "minhash_heads"), "key"), "minhash_lists"
    )
    stars = (
        lists.select(F.col("head.node").alias("u"), F.col("head.n").alias("n_u"), F.col("node").alias("v"), F.col("n").alias("n_v"))
        .filter("u < v")
        .filter(_sized(percent))
        .groupBy("u", "v")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    first = stored(
        stars.groupBy("v").agg(F.max_by("u", F.struct("shared", -F.col("u"))).alias("u")), "minhash_first"
    )
    sets = _Sets(texts, nodes, shingle_words, chunk_chars, percent)
    links = sets.links(first.select("u", "v"))
    left = stored(
        _labelled(lists.select("key", "node", "n", "size"), links), "minhash_left"
    )
    short, long_ = left.filter(F.col("size") <= list_length), left.filter(F.col("size") > list_length)
    pairs = _pairs_of_short(short, percent).join(first, ["u", "v"], "left_anti")
    links = links.unionByName(sets.links(stored(pairs, "minhash_pairs")))
    if not long_.isEmpty():
        links = links.unionByName(_links_of_long(long_, sets, percent, block_shingles))
    labels = connected_components(links, "minhash_components")
    labelled = stored(
        nodes.select("node", "doc_id", "set_key")
        .join(labels, "node", "left")
        .select("set_key", "doc_id", F.coalesce("label", "node").alias("label")),
        "minhash_groups",
    )
    smallest = stored(labelled.groupBy("label").agg(F.min("doc_id").alias("component_id")), "minhash_smallest")
    groups = stored(labelled.join(smallest, "label").select("set_key", "component_id"), "minhash_found")
    own = F.coalesce("component_id", "doc_id")
    return (
        signed.select("doc_id", "n", "set_key")
        .join(groups, "set_key", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), (F.col("doc_id") == own).alias("kept"))
    )
