"""Substring dedup: passages of many words that a document with a smaller id holds too.

The Rabin-Karp hash of every window of words is counted. Tasks pack the hashes by
bucket, eight bytes each, so that no row is made per window; Spark brings each bucket
together. The few windows whose hash comes twice are counted again with a second one, from
other hashes of the words: they are equal only if both are. The answers go back to the
documents that asked.
"""

from collections import defaultdict
from hashlib import sha256
from itertools import count, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from urbanstats.llm.common import stored, text_table

WINDOW = 50
# Characters that a task hashes at a time, and words that it remembers.
CHUNK_CHARS = 2_000_000
KNOWN_WORDS = 250_000
# Windows that a task holds before it packs them, 24 bytes each.
HELD_WINDOWS = 500_000
# Bytes of text whose windows share a bucket, about (some 2.5 million windows). There is a
# task for each, so tasks grow in number and not in size, up to what a driver can track.
BUCKET_BYTES = 16_000_000
MOST_TASKS = 200_000
# Ids of documents with removals are broadcast up to this many (32 MB or so), so that
# only those documents' texts move; beyond, all texts are joined by key.
MAX_BROADCAST_IDS = 2_000_000

# Base of the rolling hash and its inverse modulo 2**64, and the seeds of the words' hashes.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEED, _SECOND_SEED = 50, 51

# A window's two hashes.
PAIR = np.dtype([("first", np.uint64), ("second", np.uint64)])


class WordHashes:
    """64-bit hashes of words, one per seed; words met before are looked up.

    To be asked for many words at a time, as each call walks over the known ones.
    """

    def __init__(self, seeds=(_SEED,)):
        self.seeds = seeds
        self.index, self.hashes = defaultdict(count().__next__), np.zeros((len(seeds), 0), np.uint64)

    def of(self, words):
        """An array of the words' hashes for each seed."""
        if self.hashes.shape[1] > KNOWN_WORDS:
            self.__init__(self.seeds)
        codes = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        new = list(islice(self.index, self.hashes.shape[1], None))
        made = [[xxhash.xxh64_intdigest(w, seed) for w in new] for seed in self.seeds]
        self.hashes = np.concatenate((self.hashes, np.array(made, np.uint64)), axis=1)
        return self.hashes[:, codes]


def _places(texts, length):
    """Where the windows of many texts start in all their words, and how many each has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(sizes - length + 1, 0)
    ends = np.cumsum(counts)
    place = np.arange(ends[-1] if len(ends) else 0)
    # Windows over the end of a text are left out.
    place += np.repeat(np.cumsum(sizes) - sizes - (ends - counts), counts)
    return place, counts


def windows_of(known, texts, length):
    """Of many texts, each a list of words: the hashes of all windows, and their numbers."""
    place, counts = _places(texts, length)
    (words,) = known.of([w for words in texts for w in words])
    return window_hashes(words, length)[place], counts


def pairs_of(known, texts, length):
    """The same with two hashes of each window; ``known`` has two seeds."""
    place, counts = _places(texts, length)
    first, second = known.of([w for words in texts for w in words])
    pairs = np.empty(len(place), PAIR)
    pairs["first"] = window_hashes(first, length)[place]
    pairs["second"] = window_hashes(second, length)[place]
    return pairs, counts


def runs_of(pairs, *more):
    """An order that puts equal pairs together, then by ``more``, and where each run starts."""
    order = np.lexsort((*more, pairs["second"], pairs["first"]))
    first, second = pairs["first"][order], pairs["second"][order]
    new = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return order, np.flatnonzero(np.r_[len(pairs) > 0, new])


def among(pairs, others):
    """Which of ``pairs`` are in ``others``."""
    order, starts = runs_of(np.concatenate((pairs, others)))
    run = np.zeros(len(order), np.int64)
    run[starts[1:]] = 1
    run = np.cumsum(run)
    found = np.zeros(len(starts), bool)
    found[run[order >= len(pairs)]] = True
    out = np.empty(len(order), bool)
    out[order] = found[run]
    return out[: len(pairs)]


def words_of_bytes(text):
    """The words of a text as bytes: all between space, and tab to carriage return."""
    return text.encode("utf-8").split()


def _powers(base, n):
    out = np.empty(n, np.uint64)
    out[0:1] = 1
    made = 1
    while made < n:
        step = np.uint64(pow(base, made, 1 << 64))
        more = min(made, n - made)
        out[made : made + more] = out[:more] * step
        made += more
    return out


def window_hashes(hashes, length):
    """Rabin-Karp hash of each run of ``length`` items; none if there are fewer.

    A running sum of hash times a power of the base gives each window as a difference,
    shifted back to power zero; all modulo 2**64.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASE, len(hashes)), out=sums[1:])
    return spread((sums[length:] - sums[:n]) * _powers(_INVERSE, n))


def spread(hashes):
    """Mix 64-bit numbers so that all bits count, as buckets are cut by the upper ones."""
    hashes = hashes ^ (hashes >> np.uint64(31))
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def covered(starts, length, n):
    """Which of ``n`` places lie in a window of ``length`` that starts at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    change[starts] += 1
    change[starts + length] -= 1
    return np.cumsum(change[:n]) > 0


def _chunks(batches, most):
    """(ids, texts) of about ``most`` characters, in order of id; a text is never cut."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= most:
                yield _in_order(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield _in_order(ids, texts)


def _in_order(ids, texts):
    order = sorted(range(len(ids)), key=ids.__getitem__)
    return np.array([ids[i] for i in order], np.int64), [texts[i] for i in order]


# Kinds of packed rows: windows to count, windows whose first hash comes twice, windows
# that repeat, and whole documents. The second and third are for their documents.
_ASK, _SUSPECT, _REPEATED, _WHOLE = 0, 1, 2, 3
_PACKED = "bucket int, kind int, ids binary, counts binary, hashes binary, doc_id long, n_words long, digest string"


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _packed(kind, buckets, docs, hashes):
    """A row per bucket: its documents, how many windows each has, and their hashes.

    ``buckets`` says where each window goes. The order of the windows stays.
    """
    order = np.argsort(buckets, kind="stable")
    docs, hashes, buckets = docs[order], hashes[order], buckets[order]
    cuts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1], True]) if len(docs) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        some = docs[a:b]
        first = np.flatnonzero(np.r_[True, some[1:] != some[:-1]])
        counts = np.diff(np.r_[first, len(some)]).astype(np.int32)
        yield (
            int(buckets[a]),
            kind,
            some[first].tobytes(),
            counts.tobytes(),
            hashes[a:b].tobytes(),
            None,
            None,
            None,
        )


def _unpacked(rows, dtype=PAIR):
    """The document and the hashes of each window in packed rows."""
    docs = [
        np.repeat(np.frombuffer(i, np.int64), np.frombuffer(c, np.int32))
        for i, c in zip(rows["ids"], rows["counts"])
    ]
    hashes = [np.frombuffer(h, dtype) for h in rows["hashes"]]
    return np.concatenate([np.zeros(0, np.int64), *docs]), np.concatenate([np.zeros(0, dtype), *hashes])


def _by_document(kind, docs, hashes, buckets):
    """Packed rows of windows for the buckets of their documents."""
    order = np.argsort(docs, kind="stable")
    docs, hashes = docs[order], hashes[order]
    return _packed(kind, docs % buckets, docs, hashes)


def _bucket(first, buckets):
    return ((first >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _frame(rows):
    return pd.DataFrame(rows, columns=_names(_PACKED), dtype=object)


def _pack(length, buckets, most):
    """Function for mapInPandas: from documents to rows for the buckets."""

    def pack(batches):
        known = WordHashes((_SEED, _SECOND_SEED))
        for ids, texts in _chunks(batches, most):
            words = [words_of_bytes(text) for text in texts]
            rows = [
                (i % buckets, _WHOLE, None, None, None, i, len(w), sha256(b" ".join(w)).hexdigest())
                for i, w in zip(ids.tolist(), words)
            ]
            hashes, counts = pairs_of(known, words, length)
            if len(hashes):
                owner = np.repeat(np.arange(len(ids)), counts)
                # Of windows that repeat in this chunk only the first one asks: the
                # others know already. A passage that everyone has asks once a chunk.
                order, first = runs_of(hashes)
                leader = np.repeat(ids[owner[order[first]]], np.diff(np.r_[first, len(order)]))
                later = order[ids[owner[order]] > leader]
                rows += _by_document(_REPEATED, ids[owner[later]], hashes[later], buckets)
                ask = np.sort(order[first])
                asked = hashes["first"][ask]
                rows += _packed(_ASK, _bucket(asked, buckets), ids[owner[ask]], asked)
            yield pd.DataFrame(rows, columns=_names(_PACKED))

    return pack


def _suspect(buckets):
    """Function for applyInPandas: of a bucket's windows, those whose hash comes twice.

    They are packed again, by the buckets of their documents. Other rows pass.
    """

    def suspect(rows):
        docs, hashes = _unpacked(rows[rows["kind"] == _ASK], np.uint64)
        order = np.argsort(hashes, kind="stable")
        docs, hashes = docs[order], hashes[order]
        same = hashes[1:] == hashes[:-1]
        twice = np.r_[False, same] | np.r_[same, False] if len(docs) else np.zeros(0, bool)
        found = _frame(_by_document(_SUSPECT, docs[twice], hashes[twice], buckets))
        return pd.concat([rows[rows["kind"] != _ASK].astype(object), found], ignore_index=True)

    return suspect


def _ask_again(length, buckets, most):
    """Function for mapInPandas: the suspects of documents with both their hashes.

    Many documents are packed together, up to ``HELD_WINDOWS`` suspects.
    """

    def pack(held):
        docs = np.concatenate([np.full(len(mine), doc_id, np.int64) for doc_id, mine in held])
        pairs = np.concatenate([mine for _, mine in held])
        return _frame(_packed(_ASK, _bucket(pairs["first"], buckets), docs, pairs))

    def ask(batches):
        known, held, n = WordHashes((_SEED, _SECOND_SEED)), [], 0
        for batch in batches:
            for doc_id, own, suspects in _own_windows(known, batch, length, most):
                mine = own[np.isin(own["first"], np.frombuffer(suspects, np.uint64))]
                order, first = runs_of(mine)
                held.append((doc_id, mine[order[first]]))
                n += len(first)
                if n >= HELD_WINDOWS:
                    yield pack(held)
                    held, n = [], 0
        if held:
            yield pack(held)

    return ask


def _count(buckets):
    """Function for applyInPandas: of a bucket's windows, those that a smaller id holds too.

    They are packed again, by the buckets of their documents.
    """

    def count_(rows):
        docs, hashes = _unpacked(rows)
        order, first = runs_of(hashes, docs)
        docs, hashes = docs[order], hashes[order]
        later = docs > np.repeat(docs[first], np.diff(np.r_[first, len(docs)]))
        return _frame(_by_document(_REPEATED, docs[later], hashes[later], buckets))

    return count_


def _gather(dtype):
    """Function for applyInPandas: one row per document with all its windows."""

    def gather(rows):
        docs, hashes = _unpacked(rows, dtype)
        order = np.argsort(docs, kind="stable")
        docs, hashes = docs[order], hashes[order]
        cuts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1], True]) if len(docs) else [0]
        found = [(docs[a], hashes[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
        return pd.DataFrame(found, columns=["doc_id", "windows"])

    return gather


def _own_windows(known, batch, length, most):
    """Of each row: the id, the hashes of its own windows, and the windows that came with it."""
    ends = batch["text"].str.len().cumsum() // most
    for _, some in batch.groupby(ends.to_numpy(), sort=False):
        hashes, counts = pairs_of(known, [words_of_bytes(text) for text in some["text"]], length)
        yield from zip(some["doc_id"], np.split(hashes, np.cumsum(counts)[:-1]), some["windows"])


def _remove(length, with_text, most):
    """Function for mapInPandas: what is left of the documents with repeated windows."""

    def one(doc_id, words, own, repeated):
        bad = among(own, np.frombuffer(repeated, PAIR))
        gone = covered(np.flatnonzero(bad), length, len(words))
        kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
        bounds = np.flatnonzero(np.diff(np.r_[False, gone, False]))
        left = kept.decode() if with_text and gone.any() else None
        return doc_id, len(words), int(gone.sum()), sha256(kept).hexdigest(), bounds, left

    def remove(batches):
        known = WordHashes((_SEED, _SECOND_SEED))
        for batch in batches:
            ends = batch["text"].str.len().cumsum() // most
            for _, some in batch.groupby(ends.to_numpy(), sort=False):
                words = [words_of_bytes(text) for text in some["text"]]
                hashes, counts = pairs_of(known, words, length)
                own = np.split(hashes, np.cumsum(counts)[:-1])
                yield pd.DataFrame(
                    [one(*r) for r in zip(some["doc_id"], words, own, some["windows"])],
                    columns=["doc_id", "n_words", "n_removed", "kept_sha256", "bounds", "kept"],
                )

    return remove


def remove_repeated_passages(docs, length=WINDOW, with_text=True, chunk_chars=CHUNK_CHARS):
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, intervals, kept.

    A word is removed if a window of ``length`` words that covers it also starts in a
    document with a smaller id. ``intervals`` has the maximal removed runs as arrays
    (first word, word after the last), ``kept`` the kept words joined by single spaces
    (left out with ``with_text=False``; NULL where nothing is removed, as the text itself
    is then kept) and ``kept_sha256`` the hash of that text.

    Windows lie within one document and are judged on the input. Rows with one id are one
    document: they do not remove each other's words, and each gives a row. Rows with a
    NULL id cannot be ordered and are left out. NULL, empty and short texts have no
    window. Windows are equal if two hashes of them are, 128 bits in all. Texts of any length
    are taken whole. An empty table gives an empty result.
    """
    texts = text_table(docs.filter(F.col("doc_id").isNotNull()))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = docs.sparkSession
    least = spark.sparkContext.defaultParallelism
    buckets = min(max(1, least, -(-size // BUCKET_BYTES)), 1 << 30)
    tasks = min(buckets, MOST_TASKS)

    def by_bucket(rows, each, schema=_PACKED):
        return rows.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(each, schema)

    def touched(documents):
        """Texts of these documents alone; texts of others do not move."""
        ids = documents.select("doc_id")
        ids = ids if ids.count() > MAX_BROADCAST_IDS else F.broadcast(ids)
        return texts.join(ids, "doc_id", "left_semi").join(documents, "doc_id")

    packed = texts.mapInPandas(_pack(length, buckets, chunk_chars), _PACKED)
    answers = stored(by_bucket(packed, _suspect(buckets)), "window_answers")
    of_document = "doc_id long, windows binary"
    suspects = by_bucket(answers.filter(F.col("kind") == _SUSPECT), _gather(np.uint64), of_document)
    again = touched(stored(suspects, "window_suspects")).mapInPandas(
        _ask_again(length, buckets, chunk_chars), _PACKED
    )
    found = by_bucket(again, _count(buckets)).unionByName(answers.filter(F.col("kind") == _REPEATED))
    repeated = stored(by_bucket(found, _gather(PAIR), of_document), "window_repeats")
    whole = answers.filter(F.col("kind") == _WHOLE).select("doc_id", "n_words", "digest")
    none = F.array().cast("array<array<bigint>>")
    pairs = F.transform(
        F.sequence(F.lit(0), (F.size("bounds") / 2 - 1).cast("int")),
        lambda i: F.array(F.get("bounds", 2 * i), F.get("bounds", 2 * i + 1)),
    )
    cut = (
        touched(repeated)
        .mapInPandas(
            _remove(length, with_text, chunk_chars),
            "doc_id long, n_words long, n_removed long, kept_sha256 string, bounds array<long>, kept string",
        )
        .select(
            "doc_id",
            "n_words",
            "n_removed",
            "kept_sha256",
            F.when(F.size("bounds") > 0, pairs).otherwise(none).alias("intervals"),
            "kept",
        )
    )
    same = whole.join(repeated.select("doc_id"), "doc_id", "left_anti").select(
        "doc_id",
        "n_words",
        F.lit(0).cast("long").alias("n_removed"),
        F.col("digest").alias("kept_sha256"),
        none.alias("intervals"),
        F.lit(None).cast("string").alias("kept"),
    )
    result = cut.unionByName(same)
    return result if with_text else result.drop("kept")
