"""SentencePiece encoding with seeded merge-dropout, and decoding.

Each merge candidate is dropped with probability ``dropout``, decided by a keyed hash of
the document's id, the word's place in the text and the candidate's place in the word; the
rest is the usual agenda, best score first and leftmost on ties. A candidate is decided
once, so the result depends on nothing but text, id and seed. Decoding any of the segmentations gives the text back.
"""

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256
from itertools import count, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from urbanstats.llm.common import text_table

DROPOUT = 0.1

# Words up to this many characters are merged many at a time, longer ones by a heap.
SHORT_WORD = 48
# Characters per round of work in a task, and words that a task remembers.
ROUND_CHARS = 1_000_000
KNOWN_WORDS = 150_000

# The space symbol of the vocabulary, and the names of its byte pieces.
SPACE_SYMBOL = "▁"
_BYTE = re.compile("<0x([0-9A-F]{2})>")
# A word takes the spaces before it. No piece joins a line end or a space to what
# stands before it, which ``read_vocabulary`` checks.
_WORDS = re.compile(r" *[^ \n]+| +|\n")

_M = (1 << 64) - 1


def _mix(x):
    """A 64-bit mixing step; for numpy arrays and, masked, for plain integers."""
    if isinstance(x, np.ndarray):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _M
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _M
    return x ^ (x >> 31)


def _candidate(key, start, middle, end):
    """Hash of a merge candidate: characters start to middle and middle to end of a word."""
    if isinstance(key, np.ndarray):
        a, b, c = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
        return _mix(key + start * a + middle * b + end * c)
    at = start * 0x9E3779B97F4A7C15 + middle * 0xC2B2AE3D27D4EB4F + end * 0x165667B19E3779F9
    return _mix((key + at) & _M)


class Vocabulary:
    """Pieces, their scores and the merges between them; a space stands for itself."""

    def __init__(self, pieces, scores):
        self.pieces, self.scores = pieces, scores

    def __getstate__(self):
        return self.pieces, self.scores

    def __setstate__(self, state):
        self.pieces, self.scores = state

    @cached_property
    def ids(self):
        return {p: i for i, p in enumerate(self.pieces) if p is not None}

    @cached_property
    def byte_ids(self):
        found = {}
        for i, p in enumerate(self.pieces):
            if isinstance(p, bytes):
                found[p[0]] = i
        return np.array([found[b] for b in range(256)], np.int64)

    @cached_property
    def ranks(self):
        """0 for the best score; equal scores share a rank."""
        return np.unique(-np.asarray(self.scores), return_inverse=True)[1].astype(np.int64)

    @cached_property
    def merges(self):
        """Sorted keys ``left * size + right`` and the piece that each makes."""
        size, ids, found = len(self.pieces), self.ids, {}
        for piece, whole in ids.items():
            if isinstance(piece, str):
                for cut in range(1, len(piece)):
                    left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                    if left is not None and right is not None:
                        found[left * size + right] = whole
        keys = np.array(sorted(found), np.int64)
        return keys, np.array([found[k] for k in keys.tolist()], np.int64)

    @cached_property
    def merge_table(self):
        keys, made = self.merges
        return dict(zip(keys.tolist(), made.tolist()))

    @cached_property
    def of_character(self):
        table = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if isinstance(piece, str) and len(piece) == 1:
                table[ord(piece)] = i
        return table

    @cached_property
    def bytes_of(self):
        return [p.encode() if isinstance(p, str) else p or b"" for p in self.pieces]


def read_vocabulary(path):
    """The vocabulary of a SentencePiece BPE model with byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores = [], []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            piece = bytes([int(_BYTE.fullmatch(name)[1], 16)])
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            piece = None
        else:
            piece = name.replace(SPACE_SYMBOL, " ")
            if "\n" in piece or " " in piece.lstrip(" "):
                raise ValueError(f"piece {name!r} reaches over the end of a word")
        pieces.append(piece)
        scores.append(model.get_score(i))
    return Vocabulary(pieces, scores)


def agenda_encode(vocabulary, word, key, dropout):
    """Ids of one word: merges by an agenda, dropped ones skipped as they come up."""
    size, merges, ranks = len(vocabulary.pieces), vocabulary.merge_table, vocabulary.ranks
    limit = min(_M, int(dropout * 2.0**64))
    ids = vocabulary.of_character[[ord(c) for c in word]].tolist()
    n = len(ids)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    agenda = []

    def add(left, right):
        if left >= 0 and right < n and ids[left] >= 0 and ids[right] >= 0:
            made = merges.get(ids[left] * size + ids[right])
            if made is not None:
                heapq.heappush(agenda, (int(ranks[made]), left, right, end[right], made))

    for i in range(n - 1):
        add(i, i + 1)
    while agenda:
        _, left, right, stop, made = heapq.heappop(agenda)
        if not (alive[left] and right < n and alive[right] and end[left] == right and end[right] == stop):
            continue
        if _candidate(key, left, right, stop) < limit:
            continue
        ids[left], end[left], alive[right] = made, stop, False
        if stop < n:
            before[stop] = left
        add(before[left], left)
        add(left, stop)
    return _with_bytes(vocabulary, [(ids[i], word[i]) for i in range(n) if alive[i]])


def _with_bytes(vocabulary, symbols):
    out = []
    for i, text in symbols:
        out.extend([i] if i >= 0 else vocabulary.byte_ids[list(text.encode())].tolist())
    return out


def encode_words(vocabulary, words, keys, dropout, log=None):
    """What ``agenda_encode`` gives for each of many short words, merged side by side.

    Every round takes each word's best candidate that is not dropped; only the pairs
    beside a merge are looked up again. Returns the ids of all words one after the
    other, and how many each has. The merges go to the list ``log``, if given, as
    arrays (word, start, middle, end).
    """
    table, made = vocabulary.merges
    ranks, size = vocabulary.ranks, len(vocabulary.pieces)
    limit, none = np.uint64(min(_M, int(dropout * 2.0**64))), np.int64(1 << 62)
    text = "".join(words)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    final = vocabulary.of_character[codes].astype(np.int64)
    alive = np.ones(len(codes), bool)
    # What is still at work: symbols by their place, and each word's stretch of them.
    place, ids = np.arange(len(codes)), final.copy()
    starts, counts, keys = np.cumsum(lengths) - lengths, lengths, np.asarray(keys, np.uint64)
    number = np.arange(len(words))
    while len(starts):
        n = len(place)
        word = np.repeat(np.arange(len(starts)), counts)
        offset = place[starts][word]
        low, high = (place - offset).astype(np.uint64), np.empty(n, np.uint64)
        following = np.arange(1, n + 1)
        following[starts + counts - 1] = -1
        before = np.arange(-1, n - 1)
        before[starts] = -1
        high[:-1] = low[1:]
        # After a pause the last symbol of a word ends where the word does.
        high[starts + counts - 1] = lengths
        order, result = np.full(n, none), np.zeros(n, np.int64)

        def look_up(left):
            """Set the candidates that start at these symbols."""
            right = following[left]
            order[left] = none
            real = (right >= 0) & (ids[left] >= 0) & (ids[right] >= 0)
            left, right = left[real], right[real]
            pair = ids[left] * size + ids[right]
            at = np.minimum(np.searchsorted(table, pair), len(table) - 1)
            real = table[at] == pair
            left, right, at = left[real], right[real], at[real]
            stay = _candidate(keys[word[left]], low[left], high[left], high[right]) >= limit
            left, whole = left[stay], made[at[stay]]
            order[left] = ranks[whole] << 32 | left
            result[left] = whole

        look_up(np.arange(n))
        while True:
            best = np.minimum.reduceat(order, starts)
            best = best[best < none]
            if len(best) * 2 < len(starts):
                break
            left = best & np.int64((1 << 32) - 1)
            right = following[left]
            if log is not None:
                log.append((number[word[left]], low[left], high[left], high[right]))
            ids[left], high[left] = result[left], high[right]
            order[right] = none
            alive[place[right]] = False
            after = following[right]
            following[left] = after
            inner = after >= 0
            before[after[inner]] = left[inner]
            ahead = before[left]
            look_up(np.concatenate((left, ahead[ahead >= 0])))
        final[place] = ids
        # Go on with the words that have a candidate left, without their merged symbols.
        busy = np.minimum.reduceat(order, starts) < none
        stay = busy[word] & alive[place]
        place, ids = place[stay], ids[stay]
        counts = np.bincount(word[stay], minlength=len(starts))[busy]
        keys, lengths, number = keys[busy], lengths[busy], number[busy]
        starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    place = np.flatnonzero(alive)
    owner, ids = owner[place], final[place]
    lost = np.flatnonzero(ids < 0)
    if len(lost):
        # A character without a piece gives way to its bytes.
        spelled = [vocabulary.byte_ids[list(text[i].encode())] for i in place[lost].tolist()]
        each = np.ones(len(ids), np.int64)
        each[lost] = [len(s) for s in spelled]
        owner, ids = np.repeat(owner, each), np.repeat(ids, each)
        ids[ids < 0] = np.concatenate(spelled)
    return ids, np.bincount(owner, minlength=len(words))


def _gathered(firsts, counts):
    """The places of many stretches of a pool, one stretch after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(firsts - (ends - counts), counts)


class Encoder:
    """Encodes texts in one task.

    Of a short word met before, the plain ids and the merges that make them are looked
    up: an occurrence that drops none of these merges has the plain ids. Every other one
    is merged with its own key. What is remembered decides on nothing.
    """

    def __init__(self, vocabulary, seed, dropout, known_words=KNOWN_WORDS):
        self.vocabulary, self.seed, self.dropout = vocabulary, seed, dropout
        self.known_words = known_words
        self.forget()

    def forget(self):
        # A word that is looked up for the first time gets the next number.
        self.index, self.words = defaultdict(count().__next__), []
        self.long = np.zeros(0, bool)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.merge_first, self.merge_count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.merges, self.merges_used = np.zeros((3, 1 << 16), np.uint8), 0

    def learn(self):
        """The plain ids of the words that are new, and the merges of the short ones."""
        met = self.words[len(self.long) :]
        long = np.fromiter(map(len, met), np.int64, len(met)) > SHORT_WORD
        counts, merges = np.zeros((2, len(met)), np.int64)
        short, log, parts = np.flatnonzero(~long), [], []
        if len(short):
            ids, counts[short] = encode_words(
                self.vocabulary, [met[w] for w in short.tolist()], np.zeros(len(short)), 0.0, log
            )
            parts.append(ids)
        first = self.used + np.cumsum(counts) - counts
        if self.dropout <= 0:
            # With dropout hardly an occurrence of a long word is plain.
            at = self.used + sum(map(len, parts))
            for w in np.flatnonzero(long).tolist():
                part = agenda_encode(self.vocabulary, met[w], 0, 0.0)
                parts.append(np.array(part, np.int64))
                first[w], counts[w] = at, len(part)
                at += len(part)
        if log:
            word, *spans = (np.concatenate(x) for x in zip(*log))
            order = np.argsort(word, kind="stable")
            merges[short] = np.bincount(word, minlength=len(short))
            merged = self.merges_used + len(word)
            while merged > self.merges.shape[1]:
                self.merges = np.concatenate((self.merges, np.zeros_like(self.merges)), axis=1)
            for row, span in zip(self.merges, spans):
                row[self.merges_used : merged] = span[order]
        self.merge_first = np.r_[self.merge_first, self.merges_used + np.cumsum(merges) - merges]
        self.merge_count = np.r_[self.merge_count, merges]
        self.merges_used += int(merges.sum())
        self.long = np.r_[self.long, long]
        self.first, self.count = np.r_[self.first, first], np.r_[self.count, counts]
        more = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        while self.used + len(more) > len(self.pool):
            self.pool = np.r_[self.pool, np.zeros_like(self.pool)]
        self.pool[self.used : self.used + len(more)] = more
        self.used += len(more)

    def dropping(self, codes, keys):
        """Which occurrences (word numbers and keys) are not known to be plain."""
        merges = self.merge_count[codes]
        start, middle, end = self.merges[:, _gathered(self.merge_first[codes], merges)].astype(np.uint64)
        limit = np.uint64(min(_M, int(self.dropout * 2.0**64)))
        dropped = _candidate(np.repeat(keys, merges), start, middle, end) < limit
        found = self.long[codes]
        found[np.repeat(np.arange(len(codes)), merges)[dropped]] = True
        return np.flatnonzero(found)

    def encode(self, names, texts):
        """Ids of each text; the name (its id as text) decides on what is dropped."""
        if len(self.words) > self.known_words:
            self.forget()
        words, counts = [], []
        for text in texts:
            found = _WORDS.findall(" " + text) if text else []
            words += found
            counts.append(len(found))
        codes = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        self.words.extend(islice(self.index, len(self.words), None))
        counts = np.array(counts, np.int64)
        self.learn()
        first, each, pool = self.first[codes], self.count[codes], self.pool
        if self.dropout > 0:
            name = [xxhash.xxh64_intdigest(n, self.seed) for n in names]
            place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
            keys = _mix(np.repeat(np.array(name, np.uint64), counts) + place.astype(np.uint64))
            own = self.dropping(codes, keys)
            long = self.long[codes[own]]
            short, own = own[~long], own[long]
            ids, each[short] = encode_words(
                self.vocabulary, [words[w] for w in short.tolist()], keys[short], self.dropout
            )
            parts = [self.pool[: self.used], ids.astype(np.int32)]
            first[short] = self.used + np.cumsum(each[short]) - each[short]
            at = self.used + len(ids)
            for w, key in zip(own.tolist(), keys[own].tolist()):
                part = agenda_encode(self.vocabulary, words[w], key, self.dropout)
                parts.append(np.array(part, np.int32))
                first[w], each[w] = at, len(part)
                at += len(part)
            pool = np.concatenate(parts)
        ids = pool[_gathered(first, each)]
        bounds = np.r_[0, np.cumsum(each)][np.r_[0, np.cumsum(counts)]]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _rounds(batches):
    """Batches cut in rounds of about ROUND_CHARS characters; a text is never cut."""
    for batch in batches:
        ends = batch["text"].str.len().cumsum() // ROUND_CHARS
        for _, rows in batch.groupby(ends.to_numpy(), sort=False):
            yield rows, ["" if i is None else str(i) for i in rows["doc_id"]]


def decode_ids(vocabulary, ids):
    """The text of piece ids: pieces and bytes joined, less the space put in front."""
    raw = b"".join(map(vocabulary.bytes_of.__getitem__, ids))
    return raw.decode("utf-8", "replace")[1:]


def decode_column(vocabulary, ids):
    """Column: the text that piece ids stand for; empty for NULL or no ids."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(
                [decode_ids(vocabulary, r.tolist()) if r is not None else "" for r in rows], dtype=object
            )

    return decode(ids)


def _with_names(docs):
    """Ids as text, so that a NULL among them leaves the others as they are."""
    return text_table(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def encode_documents(docs, vocabulary, seed=42, dropout=DROPOUT):
    """One row per row of ``docs``: doc_id, ids (array of int).

    ``dropout`` is the probability that a merge candidate is skipped: 0 gives the plain
    encoding of the vocabulary, 1 single characters. Each occurrence of a word draws on
    its own, by a hash of the document's id, the word's place and ``seed``; rows that
    agree in id and text get the same ids. NULL and empty texts have no ids. NULL ids
    draw as one name. Characters without a piece, the vocabulary's own
    space symbol among them, are spelled in bytes. Other columns are ignored. Texts of any
    length are encoded whole. An empty table gives an empty result.
    """

    def encode(batches):
        encoder = Encoder(vocabulary, seed, dropout)
        for rows, names in _rounds(batches):
            ids = pd.Series(encoder.encode(names, rows["text"].tolist()), rows.index, dtype=object)
            yield pd.DataFrame({"doc_id": rows["doc_id"], "ids": ids})

    encoded = _with_names(docs).mapInPandas(encode, "doc_id string, ids array<int>")
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")


_ROUND_TRIP = (
    "doc_id string, n_pieces long, n_byte_pieces long, ids_sha256 string, decoded_sha256 string, lossless boolean"
)


def encode_round_trip(docs, vocabulary, seed=42, dropout=DROPOUT):
    """One row per row of ``docs``: its encoding in figures, and whether it decodes.

    Columns: doc_id, n_pieces, n_byte_pieces (of which bytes), ids_sha256 (of the ids as
    32-bit numbers, lowest byte first), decoded_sha256 (of the decoded text), lossless
    (the decoded text equals the text). The ids stay in the task that made them; else as
    ``encode_documents``. An empty table gives an empty result.
    """

    def go(batches):
        encoder = Encoder(vocabulary, seed, dropout)
        low, high = vocabulary.byte_ids.min(), vocabulary.byte_ids.max()
        for rows, names in _rounds(batches):
            out = []
            for doc_id, text, ids in zip(
                rows["doc_id"], rows["text"], encoder.encode(names, rows["text"].tolist())
            ):
                spelled = int(((ids >= low) & (ids <= high)).sum())
                decoded = decode_ids(vocabulary, ids.tolist())
                out.append(
                    (
                        doc_id,
                        len(ids),
                        spelled,
                        sha256(ids.astype("<i4").tobytes()).hexdigest(),
                        sha256(decoded.encode()).hexdigest(),
                        decoded == text,
                    )
                )
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _ROUND_TRIP.split(", ")])

    found = _with_names(docs).mapInPandas(go, _ROUND_TRIP)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
