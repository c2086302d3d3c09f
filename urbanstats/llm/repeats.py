"""Suffix-array dedup: bytes covered by a long string that also starts anywhere else.

Two equal strings of ``length`` bytes have the same smallest hash among their grams of
half that length, at the same place. Each window is therefore led by that gram, its
anchor, and the windows that share an anchor form a stretch of text. Only stretches with
equal anchors can hold equal windows: those go to one task, as suffixes of one suffix
array, where equal windows stand side by side.
"""

from hashlib import sha256

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from urbanstats.llm.common import FREQUENT_ROWS, join_counted, stored, text_table
from urbanstats.llm.suffixes import suffix_array
from urbanstats.llm.windows import _INVERSE, _powers, covered, spread, window_hashes

LENGTH = 400
# Bytes that a task works on at a time, and bytes of stretches per suffix array, about.
CHUNK_BYTES = 1_000_000
ARRAY_BYTES = 1_000_000
# An anchor with more different stretches than this is split by more of their text.
STRETCHES = 256
# Texts that are needed again are chosen by broadcast keys up to this many (32 MB or so).
MAX_BROADCAST_KEYS = 1_000_000

# Hashes of single bytes, from a rule.
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([b]), 400) for b in range(256)], np.uint64)
# Bytes that no UTF-8 text has, even one higher; a shared core, a line's end.
_CORE = b"\xff"
_SHIFT = bytes(range(1, 256)) + b"\xfe"

_KEY = ["text_key", "text_check"]


def _texts(docs):
    """doc_id, text, and a key of the text in two longs: equal texts fare alike."""
    check = F.shiftleft(F.octet_length("text").cast("long"), 32) + F.crc32(F.col("text").cast("binary"))
    return text_table(docs).select(
        "doc_id", "text", F.xxhash64("text").alias("text_key"), check.alias("text_check")
    )


class Hashes:
    """Rabin-Karp hashes of any stretches of a text, modulo 2**64."""

    def __init__(self, raw):
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * _powers(0x9E3779B97F4A7C15, len(raw)), out=self.sums[1:])
        self.back = _powers(_INVERSE, len(raw) + 1)

    def of(self, starts, ends, also=0):
        """One number per stretch; ``also`` goes into it."""
        rolled = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        salt = np.asarray(ends - starts, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return spread(rolled + salt + np.asarray(also, np.uint64) * np.uint64(0x165667B19E3779F9))


def _smallest(values, width):
    """The smallest of each run of ``width`` values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def find_stretches(raw, starts, stops, length):
    """Stretches of windows with one anchor: (first window, windows, anchor place, anchor).

    Windows are the runs of ``length`` bytes that lie within one of the given parts of
    ``raw``. The anchor is the leftmost gram with the smallest hash.
    """
    gram = length // 2
    width = length - gram + 1
    none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
    if len(raw) < length:
        return none
    grams = window_hashes(_BYTES[raw], gram)
    lead = _smallest(grams, width)
    counts = np.maximum(stops - starts - length + 1, 0)
    starts, counts = starts[counts > 0], counts[counts > 0]
    if not len(starts):
        return none
    begins = np.zeros(len(lead) + 1, bool)
    begins[1:-1] = lead[1:] != lead[:-1]
    begins[starts] = True
    inside = np.zeros(len(lead) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + counts, -1)
    inside = np.cumsum(inside) > 0
    # A place outside ends the stretch before it.
    ends = np.flatnonzero(begins | ~inside)
    first = np.flatnonzero(begins & inside)
    last = ends[np.searchsorted(ends, first, side="right")]
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    place = np.empty(len(first), np.int64)
    for a in range(0, len(first), 4096):
        some = first[a : a + 4096]
        place[a : a + 4096] = some + (views[some] == lead[some][:, None]).argmax(1)
    anchor = lead[first]
    # A gram that repeats within its stretch hands over to its next occurrence.
    over = np.flatnonzero(last - 1 > place)
    if len(over):
        parts = [(np.delete(first, over), np.delete(last, over), np.delete(place, over))]
        for a, b in zip(first[over].tolist(), last[over].tolist()):
            found = np.flatnonzero(grams[a : b + width - 1] == lead[a]) + a
            cut = np.unique(np.r_[a, found[found < b - 1] + 1])
            parts.append((cut, np.r_[cut[1:], b], found[np.searchsorted(found, cut)]))
        first, last, place = (np.concatenate(x) for x in zip(*parts))
        anchor = lead[first]
    return first, last - first, place, anchor


def _pieces(batches, most):
    """Lists of (row number, offset, bytes) of about ``most`` bytes; rows of the batch.

    A text that is longer is dealt with in pieces whose windows follow on each other.
    """
    for batch in batches:
        chunk, size = [], 0
        for i, text in enumerate(batch["text"]):
            raw = text.encode("utf-8")
            for offset in range(0, max(1, len(raw)), most):
                chunk.append((i, offset, raw))
                size += min(most, len(raw))
                if size >= most:
                    yield batch, chunk
                    chunk, size = [], 0
        if chunk:
            yield batch, chunk


_ANCHORED = (
    "doc_id long, text_key long, text_check long, n_bytes long, digest string, "
    "start long, n int, place int, h long, sh long"
)


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _anchor(length, most):
    """Function for mapInPandas: a row per document, and one per stretch of windows."""

    def anchor(batches):
        for batch, chunk in _pieces(batches, most):
            keys = batch[["doc_id", *_KEY]].to_numpy(object)
            whole = [
                (*keys[i], len(raw), sha256(raw).hexdigest(), None, None, None, None, None)
                for i, offset, raw in chunk
                if offset == 0
            ]
            parts = [raw[o : o + most + length - 1] for _, o, raw in chunk]
            raw = np.frombuffer(b"".join(parts), np.uint8)
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            starts = np.cumsum(sizes) - sizes
            first, n, place, lead = find_stretches(raw, starts, starts + sizes, length)
            rows = pd.DataFrame(whole, columns=_names(_ANCHORED))
            if len(first):
                hashes = Hashes(raw)
                same = hashes.of(first, first + n - 1 + length, also=place - first)
                owner = np.searchsorted(starts, first, side="right") - 1
                row = np.array([c[0] for c in chunk])[owner]
                more = pd.DataFrame(
                    {
                        "text_key": batch["text_key"].to_numpy()[row],
                        "text_check": batch["text_check"].to_numpy()[row],
                        "start": first - starts[owner] + np.array([c[1] for c in chunk])[owner],
                        "n": n.astype(np.int32),
                        "place": (place - first).astype(np.int32),
                        "h": lead.view(np.int64),
                        "sh": same.view(np.int64),
                    }
                )
                rows = pd.concat([rows.astype(object), more.astype(object)])[_names(_ANCHORED)]
                rows = rows.where(rows.notna(), None)
            yield rows

    return anchor


_SLICE = "h long, sh long, copies long, n int, place int, core int, core_end int, raw binary"


def _cut(length):
    """Function for mapInPandas: the bytes of the wanted stretches of each text."""
    gram = length // 2

    def cut(batches):
        seen = set()
        for batch in batches:
            rows = []
            columns = (batch[c] for c in (*_KEY, "text", "wanted"))
            for key, check, text, wanted in zip(*columns):
                if (key, check) in seen:  # another copy of the text
                    continue
                seen.add((key, check))
                raw = text.encode("utf-8")
                for w in wanted:
                    a, n, place = w["start"], w["n"], w["place"]
                    part = raw[a : a + n - 1 + length]
                    rows.append((w["h"], w["sh"], w["copies"], n, place, place, place + gram, part))
                if len(rows) >= 2000:
                    yield pd.DataFrame(rows, columns=_names(_SLICE))
                    rows = []
            yield pd.DataFrame(rows, columns=_names(_SLICE))

    return cut


_RUNS = "h long, sh long, runs array<int>"


def _runs(flags):
    """Start and length of each run of set flags, one after the other."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    edges[1::2] -= edges[::2]
    return edges.astype(np.int32)


def repeated_windows(raws, n, core, core_end, group, copies, length):
    """For each stretch, which of its windows another place holds too, in the same group.

    All suffixes of all stretches are put in order. What a group's stretches share, their
    core, stands as one character: every window has all of it.
    """
    texts = [
        r[:a].translate(_SHIFT) + _CORE + r[b:].translate(_SHIFT) for r, a, b in zip(raws, core, core_end)
    ]
    order, raw, starts = suffix_array(texts)
    place_of = np.full(len(raw), -1, np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    window = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    place_of[window] = np.arange(len(owner))
    in_order = place_of[order]
    in_order = in_order[in_order >= 0]
    size = length - (core_end - core) + 1
    # Windows of one size at a time, each in the order of the suffixes.
    in_order = in_order[np.argsort(size[owner[in_order]], kind="stable")]
    at, long_ = window[in_order], size[owner[in_order]]
    text = Hashes(raw).of(at, at + long_)
    alike = np.r_[False, (text[1:] == text[:-1]) & (long_[1:] == long_[:-1])]
    same = np.cumsum(~alike) * (int(group.max(initial=0)) + 1) + group[owner[in_order]]
    _, which = np.unique(same, return_inverse=True)
    total = np.bincount(which, weights=copies[owner[in_order]])
    found = np.zeros(len(owner), bool)
    found[in_order] = total[which] > 1
    return np.split(found, np.cumsum(n)[:-1])


def _sort_out(length):
    """Function for applyInPandas: the repeated windows of a bucket of stretches."""

    def sort_out(rows):
        rows = rows.drop_duplicates(["h", "sh"])
        n, core, end = (rows[c].to_numpy(np.int64) for c in ("n", "core", "core_end"))
        group = np.unique(rows["h"].to_numpy(np.int64), return_inverse=True)[1]
        flags = repeated_windows(
            rows["raw"].tolist(), n, core, end, group, rows["copies"].to_numpy(np.float64), length
        )
        out = [(h, sh, _runs(f)) for h, sh, f in zip(rows["h"], rows["sh"], flags) if f.any()]
        return pd.DataFrame(out, columns=["h", "sh", "runs"])

    return sort_out


_SPLIT = "parent_h long, parent_sh long, offset int, " + _SLICE


def _split(length, width):
    """Function for mapInPandas: stretches cut to windows of nearby places to their anchor.

    Such windows share more text than the anchor, all of which goes into their key.
    """

    def split(batches):
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                # Window i starts place - i bytes before the anchor, which picks its bin.
                for b in range((r.place - r.n + 1) // width, r.place // width + 1):
                    a, z = max(0, r.place - b * width - width + 1), min(r.n - 1, r.place - b * width)
                    if a > z:
                        continue
                    raw = r.raw[a : z + length]
                    place = r.place - a
                    core, end = place - b * width, place - b * width - width + 1 + length
                    key = xxhash.xxh64_intdigest(
                        b"%d %d %d " % (r.h, b, core - place) + raw[core:end], end - place & 0xFFFFFFFF
                    )
                    own = xxhash.xxh64_intdigest(b"%d " % place + raw, 1)
                    rows.append(
                        (r.h, r.sh, a, _signed(key), _signed(own), r.copies, z - a + 1, place, core, end, raw)
                    )
            yield pd.DataFrame(rows, columns=_names(_SPLIT))

    return split


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _resolve(slices, length, widths, stretches):
    """Rows (h, sh, runs): the repeated windows of different stretches of each anchor.

    An anchor with more than ``stretches`` of them is split by place and further text, in
    bins of ``widths`` in turn. In a bin of one place a stretch is its own key, and
    counting is all that is left.
    """
    slices = stored(slices, "suffix_stretches")
    sizes = slices.groupBy("h").agg(F.count(F.lit(1)).alias("stretches"))
    full = sizes.filter(F.col("stretches") > stretches).select("h")
    hot = stored(full, "suffix_full") if widths else None
    some = slices if hot is None else slices.join(hot, "h", "left_anti")
    size = some.agg(F.sum(F.length("raw"))).first()[0] or 0
    buckets = max(int(slices.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // ARRAY_BYTES))
    result = (
        some.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(_sort_out(length), _RUNS)
    )
    if hot is None or hot.isEmpty():
        return result
    parts = stored(
        slices.join(hot, "h", "left_semi").mapInPandas(_split(length, widths[0]), _SPLIT), "suffix_parts"
    )
    finer = parts.groupBy("h", "sh").agg(
        F.sum("copies").alias("copies"),
        *[F.first(c).alias(c) for c in ("n", "place", "core", "core_end", "raw")],
    )
    finer = stored(finer, "suffix_finer")
    totals = finer.groupBy("h").agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("kinds"))
    totals = stored(totals.filter("total > 1"), "suffix_totals")
    known = stored(join_counted(finer, totals, "h", "kinds"), "suffix_known")
    alone = known.filter("kinds = 1").select("h", "sh", F.array(F.lit(0), "n").alias("runs"))
    several = known.filter("kinds > 1").select(*_names(_SLICE))
    found = stored(alone.unionByName(_resolve(several, length, widths[1:], stretches)), "suffix_parts_found")
    moved = F.transform("runs", lambda x, i: F.when(i % 2 == 0, x + F.col("offset")).otherwise(x))
    back = parts.select("parent_h", "parent_sh", "offset", "h", "sh").join(found, ["h", "sh"])
    lifted = back.select(F.col("parent_h").alias("h"), F.col("parent_sh").alias("sh"), moved.alias("runs"))
    return result.unionByName(
        lifted.groupBy("h", "sh").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    )


_LEFT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary"


def _remove(length, with_text):
    """Function for mapInPandas: what is left of the texts with repeated windows."""

    def remove(batches):
        for batch in batches:
            rows = []
            for doc_id, text, runs in zip(batch["doc_id"], batch["text"], batch["found"]):
                raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                starts = np.zeros(len(raw) + 1, np.int64)
                for run in runs:
                    a, n = run["start"] + run["runs"][::2], run["runs"][1::2]
                    np.add.at(starts, a, 1)
                    np.add.at(starts, a + n, -1)
                gone = covered(np.flatnonzero(np.cumsum(starts) > 0), length, len(raw))
                kept = raw[~gone].tobytes()
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                rows.append(
                    (
                        doc_id,
                        len(raw),
                        int(gone.sum()),
                        len(edges) // 2,
                        sha256(kept).hexdigest(),
                        edges,
                        kept if with_text else None,
                    )
                )
            frame = pd.DataFrame(rows, columns=_names(_LEFT))
            yield frame.astype({"doc_id": object})

    return remove


def _with_keys(texts, wanted):
    """``texts`` joined with rows by key; unwanted texts do not move where keys are few."""
    keys = wanted.select(*_KEY)
    if keys.count() <= MAX_BROADCAST_KEYS:
        texts = texts.join(F.broadcast(keys), _KEY, "left_semi")
    return texts.join(wanted, _KEY)


def remove_repeated_strings(
    docs,
    length=LENGTH,
    with_text=True,
    stretches=STRETCHES,
    chunk_bytes=CHUNK_BYTES,
    frequent_rows=FREQUENT_ROWS,
):
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept.

    A byte of a text in UTF-8 is removed if a string of ``length`` bytes that covers it
    also starts anywhere else, in the same row or another. ``spans`` has the maximal
    removed runs, first byte and byte after the last in turn; ``kept`` the bytes that stay
    (left out with ``with_text=False``; NULL where nothing is removed) and ``kept_sha256``
    their hash.

    Strings lie within one row and are judged on the input. Each row is a document of its
    own, also where ids or whole rows repeat. NULL and empty texts have no bytes; NULL ids
    come out as they are. Other columns are ignored. A text of any length is worked on in
    pieces, but whole. An empty table gives an empty result.
    """
    if length < 2:
        raise ValueError("strings of two bytes at least")
    texts = _texts(docs)
    anchored = stored(texts.mapInPandas(_anchor(length, chunk_bytes), _ANCHORED), "suffix_anchors")
    stretches_ = anchored.filter(F.col("h").isNotNull()).select(*_KEY, "start", "n", "place", "h", "sh")
    kinds = stored(
        stretches_.groupBy("h")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("sh").alias("low"), F.max("sh").alias("high"))
        .filter("rows > 1")
        .select("h", "rows", (F.col("low") == F.col("high")).alias("one")),
        "suffix_kinds",
    )
    # Dealt anew by place for the grouping, as a frequent anchor's rows lie together.
    found_again = join_counted(stretches_, kinds, "h", "rows", frequent_rows).repartition("text_key", "start")
    repeated = stored(
        found_again.groupBy(*stretches_.columns, "one").agg(F.count(F.lit(1)).alias("copies")),
        "suffix_repeated",
    )
    # Of equal stretches one is looked at, and counts as often as there are copies.
    where = F.struct(*_KEY, "start", "n", "place")
    chosen = (
        repeated.filter("not one")
        .groupBy("h", "sh")
        .agg(F.sum("copies").alias("copies"), F.min(where).alias("at"))
        .select("h", "sh", "copies", "at.*")
        .groupBy(*_KEY)
        .agg(F.collect_list(F.struct("h", "sh", "copies", "start", "n", "place")).alias("wanted"))
    )
    slices = _with_keys(texts.select("text", *_KEY), stored(chosen, "suffix_chosen")).mapInPandas(
        _cut(length), _SLICE
    )
    found = _resolve(slices, length, sorted({max(1, length // 16), 1}, reverse=True), stretches)
    runs = (
        repeated.filter("not one").select(*_KEY, "start", "h", "sh").join(found, ["h", "sh"])
        .select(*_KEY, "start", "runs")
        .unionByName(repeated.filter("one").select(*_KEY, "start", F.array(F.lit(0), "n").alias("runs")))
    )
    found = stored(
        runs.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "runs")).alias("found")), "suffix_runs"
    )
    cut = _with_keys(texts, found).mapInPandas(_remove(length, with_text), _LEFT)
    whole = anchored.filter(F.col("digest").isNotNull())
    same = whole.join(found.select(*_KEY), _KEY, "left_anti").select(
        "doc_id",
        "n_bytes",
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.col("digest").alias("kept_sha256"),
        F.array().cast("array<bigint>").alias("spans"),
        F.lit(None).cast("binary").alias("kept"),
    )
    result = cut.unionByName(same)
    return result if with_text else result.drop("kept")
