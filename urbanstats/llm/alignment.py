"""Cross-tokenizer alignment by an inverted index: per id pair, bitmaps of documents.

Two tokenizers cut the same bytes. Where a token of one overlaps a token of the other,
the two ids are linked. An index holds, for each pair of ids, a compressed bitmap of the
documents that link it, and bit planes of how often each does beyond once. The bitmaps of
all parts of the corpus are merged; counting their bits gives a pair's documents and
links; walking its postings brings the pair's score back to every document.
"""

import re
from collections import defaultdict
from functools import cache
from hashlib import sha256
from itertools import count, islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from urbanstats.llm.common import stored, text_table

# Characters that a task aligns at a time (a text is never cut), documents per block at
# most (16 bits number them), and units that a task remembers.
CHUNK_CHARS = 1_000_000
BLOCK_DOCUMENTS = 1 << 16
KNOWN_UNITS = 200_000
# Units that are encoded as one text.
TOGETHER = 2048
# Pairs are dealt to so many buckets, and blocks to ranges of about so many bytes of text:
# a task merges one bucket of one range, so that a pair that is everywhere has a row per
# range and no task ever holds all of its documents.
BUCKETS = 16
RANGE_BYTES = 64_000_000
# Ids of either tokenizer stay below this, so that a pair and a document fit in a long.
_ID_BITS = 20

# A text is cut into units before a space that follows on anything but white space: no
# token of either tokenizer crosses such a place.
_UNIT = re.compile(r"(?<=\S)(?= )")


def read_tokenizers(byte_bpe, piece_model):
    """The contents of both vocabulary files, to be sent to tasks: (JSON text, model bytes)."""
    with open(byte_bpe, encoding="utf-8") as a, open(piece_model, "rb") as b:
        return a.read(), b.read()


def byte_alphabet():
    """Which byte each character of a byte-level entry stands for.

    Printable bytes of Latin-1 stand for themselves, the others for 256 and up in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, files):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files[0])
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.b = SentencePieceProcessor(model_proto=files[1])
        alphabet = byte_alphabet()
        n = self.a.get_vocab_size()
        self.bytes_a = [
            bytes(alphabet.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(n)
        ]
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)])
            if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode("utf-8")
            for i in range(self.b.get_piece_size())
        ]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _ID_BITS:
            raise ValueError(f"vocabularies of up to {1 << _ID_BITS} entries")
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id("▁")

    def encode(self, units):
        """(ids of a, ids of b, how many of a each unit has, how many of b, which are whole).

        All units begin with a space. Units that end in something else than white space
        are encoded as one text, many at a time, and cut apart by their bytes. A unit that
        either tokenizer does not give back byte by byte is not whole and has no ids.
        """
        parts = []
        for i in range(0, len(units), TOGETHER):
            some = units[i : i + TOGETHER]
            parts.append(self._together(some) or self._one_by_one(some))
        return [np.concatenate(x) for x in zip(*parts)]

    def _together(self, units):
        """As ``encode``; None where the units have to be looked at one by one."""
        if any(u[-1].isspace() for u in units):
            return None
        text = "".join(units)
        raw, ends = text.encode("utf-8"), np.cumsum([len(u.encode("utf-8")) for u in units])
        found = []
        for ids, table, sizes in (
            (self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.bytes_a, self.sizes_a),
            (self.b.encode(text[1:]), self.bytes_b, self.sizes_b),
        ):
            if b"".join([table[x] for x in ids]) != raw:
                return None
            ids = np.array(ids, np.int64)
            token_ends = np.cumsum(sizes[ids])
            last = np.searchsorted(token_ends, ends)
            if (token_ends[last] != ends).any():
                return None
            found.append((ids, np.diff(last, prepend=-1)))
        (a, n_a), (b, n_b) = found
        return a, b, n_a, n_b, np.ones(len(units), bool)

    def _one_by_one(self, units):
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = self.b.encode([u[1:] for u in units], num_threads=1)
        whole = []
        for i, unit in enumerate(units):
            raw = unit.encode("utf-8")
            b[i] = [self.space] if unit == " " else b[i]
            parts = ([self.bytes_a[x] for x in a[i]], [self.bytes_b[x] for x in b[i]])
            whole.append(all(b"".join(x) == raw for x in parts))
            if not whole[-1]:
                a[i], b[i] = [], []
        flat = [np.array([x for some in ids for x in some], np.int64) for ids in (a, b)]
        return *flat, *(np.array(list(map(len, ids)), np.int64) for ids in (a, b)), np.array(whole, bool)


@cache
def _tokenizers(files):
    """One pair of tokenizers for all tasks of a Python worker."""
    return Tokenizers(files)


def _places(sizes):
    """Where each of consecutive stretches begins."""
    return np.cumsum(sizes) - sizes


def ragged(starts, sizes):
    """Indices of the elements of many stretches, one stretch after the other."""
    sizes = np.asarray(sizes, np.int64)
    return np.arange(int(sizes.sum())) + np.repeat(np.asarray(starts, np.int64) - _places(sizes), sizes)


def align(a_ids, b_ids, a_sizes, b_sizes, n_a, n_b):
    """Links and groups of units that both tokenizers cover in full.

    ``a_ids`` and ``a_sizes`` have the tokens of all units in a row and how many bytes
    each has, ``n_a`` how many each unit has. Gives the links of all units in order, as
    numbers a << 20 | b, how many each unit has, how many groups, and their text.
    """
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    ends = np.union1d(a_end, b_end)
    # Every stretch between two neighbouring ends lies in one token of each, and two
    # tokens that overlap do so in one such stretch.
    in_a, in_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
    links = a_ids[in_a] << _ID_BITS | b_ids[in_b]
    both = (a_end[in_a] == ends) & (b_end[in_b] == ends)
    unit_end = a_end[np.cumsum(n_a) - 1]
    n_links = np.diff(np.searchsorted(ends, unit_end, side="right"), prepend=0)
    common = ends[both]
    n_groups = np.diff(np.searchsorted(common, unit_end, side="right"), prepend=0)
    # The text lists the tokens of a group, first those of one tokenizer.
    a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
    a_at = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group)
    b_at = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, side="right")
    ids, after = np.empty(len(a_ids) + len(b_ids), np.int64), np.empty(len(a_ids) + len(b_ids), np.uint8)
    ids[a_at], ids[b_at] = a_ids, b_ids
    comma, bar, semicolon = b",|;"
    after[a_at] = np.where(common[a_group] == a_end, bar, comma)
    after[b_at] = np.where(common[b_group] == b_end, semicolon, comma)
    digits = len(str(int(ids.max(initial=0))))
    tens = 10 ** np.arange(digits - 1, -1, -1)
    cells = np.empty((len(ids), digits + 1), np.uint8)
    cells[:, :digits] = ids[:, None] // tens % 10 + ord("0")
    cells[:, digits] = after
    shown = np.ones(cells.shape, bool)
    shown[:, : digits - 1] = ids[:, None] >= tens[:-1]
    text = cells[shown].tobytes()
    stop = np.cumsum(shown.sum(1))[np.cumsum(n_a) + np.cumsum(n_b) - 1].tolist()
    return links, n_links, n_groups, [text[x : y - 1] for x, y in zip([0, *stop], stop)]


class Units:
    """Aligned units of text; those met before are looked up."""

    def __init__(self, tokenizers):
        self.tokenizers = tokenizers
        self.forget()

    def forget(self):
        self.index = defaultdict(count().__next__)
        self.texts = []
        none = np.zeros(0, np.int64)
        # Of each unit: whether it is whole, tokens of both, groups, links, where these begin.
        self.whole, self.n_a, self.n_b, self.n_groups, self.n_links, self.first = (none,) * 6
        self.links = none

    def codes(self, units):
        """The number of each unit; what is known of them holds until the next call."""
        if len(self.index) > KNOWN_UNITS:
            self.forget()
        codes = np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
        self._learn(list(islice(self.index, len(self.whole), None)))
        return codes

    def _learn(self, new):
        if not new:
            return
        t = self.tokenizers
        a, b, n_a, n_b, whole = t.encode(new)
        some = np.flatnonzero(whole)
        numbers = np.zeros((4, len(new)), np.int64)
        texts = [b""] * len(new)
        links = np.zeros(0, np.int64)
        if len(some):
            n_a, n_b = n_a[some], n_b[some]
            links, n_links, n_groups, found = align(a, b, t.sizes_a[a], t.sizes_b[b], n_a, n_b)
            numbers[:, some] = n_a, n_b, n_groups, n_links
            for i, text in zip(some.tolist(), found):
                texts[i] = text
        first = len(self.links) + _places(numbers[3])
        for name, more in zip(
            ("whole", "n_a", "n_b", "n_groups", "n_links", "first", "links"), (whole, *numbers, first, links)
        ):
            setattr(self, name, np.concatenate((getattr(self, name), more)))
        self.texts += texts


def compress(n_docs, owner, docs):
    """Bitmaps of documents: how many documents each has, and the bytes of all.

    ``owner`` and ``docs`` are in order; a bitmap is a list of 16-bit numbers where that
    is shorter, else one bit for each of ``n_docs``.
    """
    counts = np.bincount(owner).astype(np.int64)
    width = -(-n_docs // 8)
    dense = 2 * counts > width
    first = _places(np.where(dense, width, 2 * counts))
    body = np.zeros(int(np.where(dense, width, 2 * counts).sum()), np.uint8)
    rank = np.arange(len(owner)) - np.repeat(_places(counts), counts)
    listed = ~dense[owner]
    at = first[owner[listed]] + 2 * rank[listed]
    body[at], body[at + 1] = docs[listed] & 255, docs[listed] >> 8
    bits = dense[owner]
    np.bitwise_or.at(
        body, first[owner[bits]] + (docs[bits] >> 3), (1 << (docs[bits] & 7)).astype(np.uint8)
    )
    return counts, body


def sizes_of(widths, counts):
    """Bytes of each bitmap, from the bytes that all bits take and the documents it has."""
    return np.where(2 * counts > widths, widths, 2 * counts)


def expand(widths, counts, body):
    """(bitmap, document) of all set bits; the inverse of ``compress``."""
    sizes = sizes_of(widths, counts)
    first, dense = _places(sizes), 2 * counts > widths
    listed = np.flatnonzero(~dense)
    at = ragged(first[listed], sizes[listed])
    numbers = body[at].view("<u2").astype(np.int64)
    owner = np.repeat(listed, counts[listed])
    whole = np.flatnonzero(dense)
    at = ragged(first[whole], sizes[whole])
    bits = np.flatnonzero(np.unpackbits(body[at], bitorder="little"))
    byte_owner = np.repeat(whole, sizes[whole])
    byte_place = np.arange(len(at)) - np.repeat(_places(sizes[whole]), sizes[whole])
    return (
        np.concatenate((owner, byte_owner[bits >> 3])),
        np.concatenate((numbers, byte_place[bits >> 3] * 8 + (bits & 7))),
    )


# A bitmap of a pair: its block, bytes of all the block's bits, plane, set bits. Plane 0
# has the documents, plane k + 1 those where bit k of (links - 1) is set.
_HEAD = np.dtype([("block", "<i8"), ("width", "<u2"), ("plane", "u1"), ("count", "<u4")])

_ROWS = (
    "block long, doc int, doc_id long, n_bytes long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, bucket int, pairs binary, heads binary, body binary"
)


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _chunks(batches, most):
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= most or len(ids) == BLOCK_DOCUMENTS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _postings(links, docs, n_docs, block, buckets):
    """Rows of the index for one block: per bucket, its pairs' bitmaps."""
    # Pair and document in one number: sorting brings the links of both together.
    keys = np.sort(links << 16 | docs)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    more = np.diff(np.r_[first, len(keys)]) - 1
    pairs, docs = keys[first] >> 16, keys[first] & 0xFFFF
    planes = [(0, np.arange(len(pairs)))]
    planes += [(k + 1, np.flatnonzero(more >> k & 1)) for k in range(int(more.max(initial=0)).bit_length())]
    plane = np.concatenate([np.full(len(at), k) for k, at in planes])
    at = np.concatenate([at for _, at in planes])
    bucket = bucket_of(pairs[at], buckets)
    order = np.lexsort((docs[at], plane, pairs[at], bucket))
    bucket, plane, at = bucket[order], plane[order], at[order]
    pairs, docs = pairs[at], docs[at]
    new = np.r_[True, (pairs[1:] != pairs[:-1]) | (plane[1:] != plane[:-1])][: len(pairs)]
    counts, body = compress(n_docs, np.cumsum(new) - 1, docs)
    heads = np.zeros(len(counts), _HEAD)
    heads["block"], heads["width"], heads["plane"] = block, -(-n_docs // 8), plane[new]
    heads["count"] = counts
    pairs, bucket = pairs[new], bucket[new]
    ends = np.cumsum(sizes_of(heads["width"].astype(np.int64), counts))
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        some = body[ends[a - 1] if a else 0 : ends[b - 1]]
        yield int(bucket[a]), pairs[a:b].tobytes(), heads[a:b].tobytes(), some.tobytes()


def bucket_of(pairs, buckets):
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _index(files, buckets, most):
    """Function for mapInPandas: a row per document, and the index of each block."""

    def index(batches):
        known, block = Units(_tokenizers(files)), None
        for ids, texts in _chunks(batches, most):
            # Blocks are numbered within the task's partition, so a task that runs again
            # gives the same numbers.
            block = TaskContext.get().partitionId() << 32 if block is None else block + 1
            units = [_UNIT.split(" " + text) if text else [] for text in texts]
            codes = known.codes([u for some in units for u in some])
            doc = np.repeat(np.arange(len(texts)), list(map(len, units)))
            whole = np.bincount(doc[known.whole[codes] == 0], minlength=len(texts)) == 0
            codes, doc = codes[whole[doc]], doc[whole[doc]]
            total = [np.zeros(len(texts), np.int64) for _ in range(4)]
            for sums, part in zip(total, (known.n_a, known.n_b, known.n_groups, known.n_links)):
                np.add.at(sums, doc, part[codes])
            ends = np.searchsorted(doc, np.arange(len(texts)), side="right").tolist()
            listed = codes.tolist()
            digests = [
                sha256(b";".join([known.texts[c] for c in listed[a:b]])).hexdigest() if b > a else ""
                for a, b in zip([0, *ends], ends)
            ]
            n_links = known.n_links[codes]
            links = known.links[ragged(known.first[codes], n_links)]
            rows = [
                (block, i, doc_id, len(text.encode("utf-8")), *map(int, numbers), digest, *[None] * 4)
                for i, (doc_id, text, digest, *numbers) in enumerate(zip(ids, texts, digests, *total))
            ]
            rows += [
                (block, *[None] * 8, *packed)
                for packed in _postings(links, np.repeat(doc, n_links), len(texts), block, buckets)
            ]
            frame = pd.DataFrame(rows, columns=_names(_ROWS))
            yield frame.astype({c: object for c in _names(_ROWS)}).where(frame.notna(), None)

    return index


_MERGED = "bucket int, part int, a int, b int, n_docs long, n_links long, heads binary, body binary"


def _merge(rows):
    """For applyInPandas: the bitmaps of each pair over a range of blocks, and their bits.

    Documents of different blocks are different, so bitmaps of a plane are merged by
    putting their blocks side by side.
    """
    pairs = np.frombuffer(b"".join(rows["pairs"]), np.int64)
    heads = np.frombuffer(b"".join(rows["heads"]), _HEAD)
    body = np.frombuffer(b"".join(rows["body"]), np.uint8)
    sizes = sizes_of(heads["width"].astype(np.int64), heads["count"].astype(np.int64))
    first = _places(sizes)
    order = np.lexsort((heads["block"], heads["plane"], pairs))
    pairs, heads, sizes = pairs[order], heads[order], sizes[order]
    body = body[ragged(first[order], sizes)]
    new = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    plane = heads["plane"].astype(np.int64)
    bits = heads["count"].astype(np.int64)
    # Each document counts once in plane 0, and by the value of its other planes.
    n_docs = np.add.reduceat(np.where(plane == 0, bits, 0), new)
    n_links = np.add.reduceat(bits << np.maximum(plane - 1, 0), new)
    head_bytes, body_bytes = heads.tobytes(), body.tobytes()
    head_end = np.r_[new[1:], len(pairs)]
    body_end = np.cumsum(sizes)[head_end - 1].tolist()
    size = _HEAD.itemsize
    return pd.DataFrame(
        {
            "bucket": rows["bucket"].iloc[0],
            "part": rows["part"].iloc[0],
            "a": (pairs[new] >> _ID_BITS).astype(np.int32),
            "b": (pairs[new] & ((1 << _ID_BITS) - 1)).astype(np.int32),
            "n_docs": n_docs,
            "n_links": n_links,
            "heads": [head_bytes[x * size : y * size] for x, y in zip(new.tolist(), head_end.tolist())],
            "body": [body_bytes[x:y] for x, y in zip([0, *body_end], body_end)],
        }
    )


_SCORES = "block long, doc int, n_best long, count_sum long"


def _bring_back(rows):
    """For applyInPandas: what the postings of some pairs add to each document."""
    heads = np.frombuffer(b"".join(rows["heads"]), _HEAD)
    of_row = np.repeat(np.arange(len(rows)), rows["heads"].map(len).to_numpy() // _HEAD.itemsize)
    body = np.frombuffer(b"".join(rows["body"]), np.uint8)
    owner, docs = expand(heads["width"].astype(np.int64), heads["count"].astype(np.int64), body)
    blocks, place = np.unique(heads["block"], return_inverse=True)
    slots = 8 * int(heads["width"].max())
    times = np.int64(1) << np.maximum(heads["plane"].astype(np.int64) - 1, 0)
    at = place[owner] * slots + docs
    out = []
    for scores in (rows["best"].to_numpy(np.int64), rows["total"].to_numpy(np.int64)):
        sums = np.zeros(len(blocks) * slots, np.int64)
        np.add.at(sums, at, (times * scores[of_row])[owner])
        out.append(sums)
    some = np.flatnonzero(out[1])
    return pd.DataFrame(
        {
            "block": blocks[some // slots],
            "doc": (some % slots).astype(np.int32),
            "n_best": out[0][some],
            "count_sum": out[1][some],
        }
    )


def link_index(docs, files, buckets=BUCKETS, range_bytes=RANGE_BYTES, chunk_chars=CHUNK_CHARS):
    """(documents, index): what each document has, and the merged postings of all pairs.

    documents: block, doc, doc_id, n_bytes, n_a, n_b, n_groups, n_links, groups_sha256.
    index: a row per pair (a, b) and range of blocks, with its documents and links there.
    """
    found = stored(
        text_table(docs).mapInPandas(_index(files, buckets, chunk_chars), _ROWS), "alignment_blocks"
    )
    documents = found.filter("doc IS NOT NULL").select(*_names(_ROWS)[:9])
    size = documents.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, -(-size // range_bytes))
    blocks = found.filter("doc IS NULL").select(
        "bucket", F.pmod(F.xxhash64("block"), F.lit(ranges)).cast("int").alias("part"), "pairs", "heads", "body"
    )
    merged = blocks.groupBy("bucket", "part").applyInPandas(_merge, _MERGED)
    return documents, stored(merged, "alignment_index")


def pair_table(index):
    """Rows (a, b, n_docs, n_links, best): documents and links of each pair in the corpus.

    ``best`` says that no other pair with the same b has more links.
    """
    pairs = stored(
        index.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")),
        "alignment_pairs",
    )
    # One row per id of the second vocabulary, which has 2**20 entries at most.
    most = pairs.groupBy("b").agg(F.max("n_links").alias("most"))
    return pairs.join(F.broadcast(most), "b").select(
        "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best")
    )


def align_tokenizers(docs, files, buckets=BUCKETS, range_bytes=RANGE_BYTES, chunk_chars=CHUNK_CHARS):
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``files`` has a byte-level BPE vocabulary and a sentencepiece model with byte
    fallback, see ``read_tokenizers``. Both encode a space and the text, without special
    tokens. Byte offsets at which tokens of both end cut them into groups; tokens that
    overlap are linked. ``n_best`` counts the links whose pair has the most links in the
    corpus among all pairs with their second id, ties included; ``count_sum`` adds up the
    corpus counts of all links. ``groups_sha256`` is the hash of the groups' ids.

    NULL and empty texts have no tokens, nor have texts that the tokens of either do not
    give back byte by byte: zeros, and an empty string for the hash. Each row is a
    document of its own, also where ids or whole rows repeat, and NULL ids come out as
    they are. A text is aligned whole, with some 100 bytes of memory per character of the
    longest. Other columns are ignored. An empty table gives an empty result.

    Scores go from pairs to documents by the pairs' postings, a bounded part of the
    corpus at a time, and are summed by document.
    """
    documents, index = link_index(docs, files, buckets, range_bytes, chunk_chars)
    scores = pair_table(index).select("a", "b", F.col("n_links").alias("total"), F.col("best").cast("long"))
    postings = index.select("bucket", "part", "a", "b", "heads", "body").join(scores, ["a", "b"])
    sums = (
        postings.groupBy("bucket", "part")
        .applyInPandas(_bring_back, _SCORES)
        .groupBy("block", "doc")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    nothing = F.lit(0).cast("long")
    return documents.join(sums, ["block", "doc"], "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", nothing).alias("n_best"),
        F.coalesce("count_sum", nothing).alias("count_sum"),
        "groups_sha256",
    )
