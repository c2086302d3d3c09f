"""SimHash near-duplicates by a byte-position inverted index with count filtering."""

from itertools import combinations

from pyspark.sql import functions as F

from urbanstats.llm.common import stored, text_table, words_of
from urbanstats.llm.components import connected_components
from urbanstats.operators.names import unused

# The letters that are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Two counters of 32 bits in one sum.
_LANES = 0x0000000100000001


def _bit(k):
    """A long with bit k set; bit 63 is the sign."""
    return F.lit((1 << k) - (1 << 64) if k == 63 else 1 << k).cast("long")


def shingles(words, length):
    """All runs of ``length`` words, repeats included; all words where there are fewer."""
    n = F.size(words)
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(n - length, F.lit(0))),
        lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(length)]),
    )
    return F.when(n > 0, runs)


def fingerprints(docs, shingle_words=3, with_key=False):
    """One row per row of ``docs``: doc_id, fp (the 64 bits as a long).

    ``with_key`` adds text_key, the hash of the text. A bit is set if it is set in over
    half of the shingles' XXH64 (seed 42). A text without words, an empty or a NULL one has
    fingerprint 0.

    The bits are counted while the shingles stream by, two counters to a long, so a
    text of any length needs 32 longs.
    """
    names = ["doc_id", *(["text_key"] if with_key else [])]
    texts = text_table(docs).withColumn("text_key", F.xxhash64("text")).select(
        F.monotonically_increasing_id().alias("row"),
        *names,
        words_of(F.translate("text", UPPER, LOWER)).alias("words"),
    )
    hashes = texts.select(
        "row", *names, F.explode_outer(shingles(F.col("words"), shingle_words)).alias("s")
    ).select("row", *names, F.when(F.col("s").isNotNull(), F.xxhash64("s")).alias("h"))
    counts = hashes.groupBy("row", *names).agg(
        F.count("h").alias("n"),
        *[
            F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(_LANES))).alias(f"c{k}")
            for k in range(32)
        ],
    )
    bits = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"c{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"c{k}", 32)
        for bit, count in ((k, low), (k + 32, high)):
            bits = bits.bitwiseOR(F.when(count * 2 > F.col("n"), _bit(bit)).otherwise(F.lit(0)))
    return counts.select(*names, F.coalesce(bits, F.lit(0).cast("long")).alias("fp"))


def _mask(parts, width):
    """Long with all bits of the given parts set; a part has ``width`` bits."""
    bits = sum((1 << width) - 1 << (width * p) for p in parts)
    return bits - (1 << 64) if bits >> 63 else bits


# Two fingerprints within three bits share at least five of their eight positional
# bytes. Of any five, three lie in the same half, so that eight lists per fingerprint
# (three bytes of a half) hold every such pair.
MIN_SHARED = 5
_TRIPLES = [
    frozenset(c) for half in (range(4), range(4, 8)) for c in combinations(half, 3)
]
# A pair in a list also shares two more bytes: a full list is dealt out again by all
# five that it may share, and a list that is still full by three of the six half bytes
# that are left, which leaves 4,096 fingerprints per list at most.
_FIVES = [frozenset(c) for c in combinations(range(8), MIN_SHARED)]


def _half_bytes(five):
    left = [h for h in range(16) if h // 2 not in five]
    whole = [h for h in range(16) if h // 2 in five]
    return [whole + list(c) for c in combinations(left, 3)]


_FIRST = {0: [_mask(t, 8) for t in _TRIPLES]}
_SECOND = {_mask(t, 8): [_mask(f, 8) for f in _FIVES if t <= f] for t in _TRIPLES}
_THIRD = {_mask(f, 8): [_mask(h, 4) for h in _half_bytes(f)] for f in _FIVES}

# Lists longer than this are dealt out again.
LIST_LENGTH = 64


def _postings(rows, finer):
    """Rows (mask, value, fp): each fingerprint in the lists that refine its own."""
    masks = F.lit(None)
    for mask, into in finer.items():
        longs = F.array(*[F.lit(m).cast("long") for m in into])
        masks = F.when(F.col("mask") == F.lit(mask), longs).otherwise(masks)
    return rows.select("fp", F.explode(masks).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp"
    ).distinct()


def shared_bytes(a, b):
    """How many positional bytes two fingerprints share."""
    differ = a.bitwiseXOR(b)
    return sum(
        (F.shiftrightunsigned(differ, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int")
        for i in range(8)
    )


def _pairs(postings):
    """Linked pairs of the fingerprints that share a list: tallied, then verified."""
    left, right = postings.alias("l"), postings.alias("r")
    a, b = F.col("l.fp"), F.col("r.fp")
    on = (F.col("l.mask") == F.col("r.mask")) & (F.col("l.value") == F.col("r.value")) & (a < b)
    return left.join(right, on).select(a.alias("u"), b.alias("v"))


def similar_pairs(prints, max_bits=3, list_length=LIST_LENGTH):
    """Pairs (u, v), u < v, of distinct fingerprints that differ in ``max_bits`` or fewer.

    ``prints`` has the column ``fp``. A pair is a candidate if it shares a list of the
    index, stays if at least five positional bytes are equal, and is verified by its bit
    distance. Lists longer than ``list_length`` are refined, never cut.
    ``max_bits`` may be 0 to 3, as the number of shared bytes follows from it.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("five shared bytes are guaranteed for up to three differing bits only")
    rows = prints.select("fp").distinct().withColumn("mask", F.lit(0).cast("long"))
    found = None
    for name, finer in (("first", _FIRST), ("second", _SECOND), ("third", _THIRD)):
        postings = _postings(rows, finer)
        sizes = postings.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        last = name == "third"
        postings = stored(
            postings.join(sizes, ["mask", "value"]).select(
                "mask", "value", "fp", (F.lit(not last) & (F.col("n") > list_length)).alias("full")
            ),
            f"simhash_{name}",
        )
        pairs = _pairs(postings.filter("not full"))
        found = pairs if found is None else found.unionByName(pairs)
        rows = postings.filter("full").select("fp", "mask")
        if last or rows.isEmpty():
            break
    return (
        found.filter(shared_bytes(F.col("u"), F.col("v")) >= MIN_SHARED)
        .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
        .distinct()
    )


def _components(docs, shingle_words, max_bits, with_key=False):
    """Fingerprints of the rows with an id, and (fp, label, component_id) of each of them."""
    prints = stored(
        fingerprints(docs.filter(F.col("doc_id").isNotNull()), shingle_words, with_key), "fingerprints"
    )
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    labels = connected_components(similar_pairs(nodes, max_bits), "simhash_components")
    labelled = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    firsts = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return prints, labelled.join(firsts, "label").select("fp", "label", "component_id")


def near_duplicates(docs, shingle_words=3, max_bits=3):
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints that differ in ``max_bits`` bits or fewer are linked, equal ones too.
    ``component_id`` is the smallest doc_id reachable over links. Rows with a NULL id
    cannot be named and are left out; repeated ids give a row each. Empty, blank and
    NULL texts have fingerprint 0 and are linked like any other. Other columns are
    ignored. An empty table gives an empty result.
    """
    prints, by_print = _components(docs, shingle_words, max_bits)
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_firsts(docs, shingle_words=3, max_bits=3):
    """The rows of ``docs`` less near-duplicates: of each component, its smallest id.

    Of several rows of a component with that id one stays, the one whose text sorts
    first; rows with one id in several components are judged in each. Rows with a NULL
    id stay. The columns are those of ``docs``, whatever their names. NULL and empty texts
    are near-duplicates of each other; texts of any length are taken whole. An empty table
    gives an empty one.
    """
    names = {c: unused(f"_simhash_{c}", docs) for c in ("doc_id", "text_key", "label")}
    prints, by_print = _components(docs, shingle_words, max_bits, with_key=True)
    firsts = (
        prints.join(by_print, "fp")
        .filter(F.col("doc_id") == F.col("component_id"))
        .select(*[F.col(c).alias(name) for c, name in names.items()])
        .distinct()
    )
    text = F.coalesce(docs["text"], F.lit(""))
    same = (docs["doc_id"].cast("long") == F.col(names["doc_id"])) & (
        F.xxhash64(text) == F.col(names["text_key"])
    )
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    one = docs.join(firsts, same).groupBy(names["label"]).agg(F.min_by(row, text).alias("one"))
    return one.select("one.*").unionByName(docs.filter(F.col("doc_id").isNull()))
