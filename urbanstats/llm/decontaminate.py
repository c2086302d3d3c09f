"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by size, as the number of shingles that a contained item may lack
depends on it. A partition whose items have at most ``u`` shingles keeps, of each item,
its ``floor((1 - t) * u) + 1`` smallest MinHash values. A document that holds a share
``t`` of an item's shingles lacks fewer than that, so it holds one of the kept ones:
looking those up in the documents finds every pair. Exact containment decides.
"""

from pyspark.sql import functions as F

from urbanstats.llm.common import stored, text_table
from urbanstats.operators.names import unused

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# MinHash values and candidate pairs are broadcast up to this many (24 MB or so), and
# joined by key beyond.
MAX_BROADCAST_PROBES = 1_000_000


def plain_words(text):
    """Lower-case words of letters and digits; what stands between is ignored."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _runs(items, length, make):
    """One value per run of ``length`` array items; none where there are fewer."""
    n = F.size(items)
    return F.when(
        n >= length,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - length, F.lit(0))),
            lambda i: make([F.get(items, i + k) for k in range(length)]),
        ),
    ).otherwise(F.array())


def _hash(word):
    return F.xxhash64(word)


_RUNS = "array<struct<length:int,h:bigint>>"


def _hashed_runs(words, length):
    """A struct of length and hash per run of ``length`` words."""
    return _runs(
        words, length, lambda w: F.struct(F.lit(length).alias("length"), F.xxhash64(F.array(*w)).alias("h"))
    ).cast(_RUNS)


def _shingle_text(words):
    return F.concat_ws(" ", *words)


def _item_sets(items, shingle_words):
    """Rows (item_id, length, shingles): the distinct shingles of each item.

    An item of fewer words than a shingle is one shingle of its own length.
    """
    words = text_table(items, "item_id").select(
        F.col("doc_id").alias("item_id"), plain_words(F.col("text")).alias("words")
    )
    words = words.filter(F.col("item_id").isNotNull() & (F.size("words") > 0))
    whole = F.array(F.concat_ws(" ", "words"))
    return words.select(
        "item_id",
        F.least(F.size("words"), F.lit(shingle_words)).alias("length"),
        F.when(F.size("words") < shingle_words, whole)
        .otherwise(F.array_distinct(_runs(F.col("words"), shingle_words, _shingle_text)))
        .alias("shingles"),
    ).distinct()


def _min_hashes(sets, containment):
    """Rows (length, h, item_id): the smallest MinHash values of each item.

    The size partition of an item is the power of two that its shingles fit in.
    """
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles"))))
    keep = F.floor(F.lit(1 - containment) * upper + 1e-9).cast("int") + 1
    hashes = F.transform("shingles", lambda s: F.xxhash64(F.transform(F.split(s, " "), _hash)))
    return sets.select(
        "item_id", "length", F.explode(F.slice(F.array_sort(hashes), F.lit(1), keep)).alias("h")
    ).distinct()


def find_contained(docs, items, shingle_words=SHINGLE_WORDS, containment=CONTAINMENT):
    """Pairs of a document and an item whose shingles it holds to ``containment`` or more.

    Columns: doc_id, item_id, n_shingles (distinct ones of the item), n_shared,
    containment, text_key (hash of the document's text).

    Words are lower-cased runs of letters and digits. Items of fewer than
    ``shingle_words`` words must appear whole. Items that are NULL, empty or without an
    id match nothing; NULL and empty documents hold nothing. Documents with a NULL id are
    judged row by row and come out with a NULL id. Repeated rows give each pair once.
    ``items`` has the columns item_id and text; other columns of both are ignored.
    """
    sets = _item_sets(items, shingle_words)
    probes = _min_hashes(sets, containment)
    lengths = sorted(r["length"] for r in sets.select("length").distinct().collect())
    if probes.count() <= MAX_BROADCAST_PROBES:
        probes = F.broadcast(probes)
    texts = text_table(docs).withColumn("text_key", F.xxhash64("text"))
    # Hashes of words first: a shingle's hash then needs no text of its own.
    word_hashes = texts.select(
        "doc_id", "text_key", F.transform(plain_words(F.col("text")), _hash).alias("words")
    )
    # The runs of all lengths in one pass: a text is read and split once.
    shingles = word_hashes.select(
        "doc_id",
        "text_key",
        F.explode(F.concat(F.array().cast(_RUNS), *[_hashed_runs(F.col("words"), n) for n in lengths])).alias("run"),
    ).select("doc_id", "text_key", "run.length", "run.h")
    hits = shingles.join(probes, ["length", "h"]).select("doc_id", "text_key", "item_id")
    pairs = hits.distinct().select(
        F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), "item_id"
    )
    pairs = stored(pairs, "contained_pairs")
    if pairs.count() <= MAX_BROADCAST_PROBES:  # then texts without a candidate do not move
        pairs = F.broadcast(pairs)
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    both = texts.join(pairs, same).join(sets, "item_id")
    # Exploded from arrays of one: the filter below would otherwise move down and split
    # the text again for every shingle.
    words = both.select(
        "doc_id",
        "text_key",
        "item_id",
        "length",
        "shingles",
        F.explode(F.array(plain_words(F.col("text")))).alias("words"),
    )
    own = F.lit(None).cast("array<string>")
    for n in lengths:
        own = F.when(F.col("length") == n, _runs(F.col("words"), n, _shingle_text)).otherwise(own)
    counted = words.select(
        "doc_id",
        "item_id",
        F.size("shingles").cast("long").alias("n_shingles"),
        "text_key",
        F.explode(F.array(F.size(F.array_intersect("shingles", own)).cast("long"))).alias("n_shared"),
    ).withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    return (
        counted.filter(F.col("containment") >= containment)
        .select("doc_id", "item_id", "n_shingles", "n_shared", "containment", "text_key")
        .distinct()
    )


def drop_contained(docs, items, shingle_words=SHINGLE_WORDS, containment=CONTAINMENT):
    """The rows of ``docs`` that hold no item; same columns, whatever their names.

    Rows are judged by id and text: all rows that repeat one fare alike, also with a NULL
    id. NULL and empty texts hold nothing and stay. Texts of any length are taken whole.
    Without items every row stays; an empty table gives an empty one.
    """
    bad_id, bad_key = (unused(name, docs) for name in ("_bad_id", "_bad_key"))
    bad = (
        find_contained(docs, items, shingle_words, containment)
        .select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key))
        .distinct()
    )
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(bad_id)) & (key == F.col(bad_key))
    return docs.join(bad, same, "left_anti")
