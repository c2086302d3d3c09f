import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from urbanstats.llm import repeats
from urbanstats.llm.common import join_counted
from urbanstats.llm.queries import QUERIES
from urbanstats.llm.suffixes import suffix_array

SF = "/root/testdata/sf0.001"


def plain(texts, length):
    """Per text: bytes, removed bytes, spans, hash of the rest; every string is counted."""
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(np.diff(np.r_[0, gone.astype(int)]).clip(0).sum())
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((len(r), int(gone.sum()), spans, sha256(kept).hexdigest()))
    return out


def compare(docs_of, rows, length, **options):
    got = repeats.remove_repeated_strings(docs_of(rows), length, **options).collect()
    want = [(str(i), *p) for (i, _), p in zip(rows, plain([t for _, t in rows], length))]
    assert sorted(
        (str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got
    ) == sorted(want)
    for r in got:
        assert sum(r["spans"][1::2]) - sum(r["spans"][::2]) == r["n_removed"]
        if r["n_removed"]:
            assert sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        else:
            assert r["kept"] is None
    return got


def some_rows(seed, n=90):
    rnd = random.Random(seed)
    base = "".join(rnd.choice("abcdé ") for _ in range(2500))
    rows = []
    for i in range(n):
        a = rnd.randrange(2400)
        rows.append((i, base[a : a + rnd.randrange(1, 180)] + rnd.choice(["", "xyz", base[:60]])))
    return rows


def test_query_equals_plain_python(spark):
    got = QUERIES["op4_suffix_array_dedup"](spark, SF).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: p for (i, _), p in zip(rows, plain([t for _, t in rows], 400))}
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    assert any(p[1] for p in want.values())


@pytest.mark.parametrize("length", [2, 7, 20, 50])
def test_random_texts(docs_of, length):
    assert any(r["n_removed"] for r in compare(docs_of, some_rows(length), length))


def test_full_anchors_are_split(docs_of):
    """Anchors with more than two stretches go through both finer levels."""
    compare(docs_of, some_rows(3), 32, stretches=2)


def test_texts_in_pieces(docs_of):
    compare(docs_of, some_rows(4, 50), 20, chunk_bytes=64)


def test_keys_beyond_broadcast(docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "MAX_BROADCAST_KEYS", 0)
    compare(docs_of, some_rows(5, 50), 20)


@pytest.mark.parametrize("rows", [1, 5])
def test_frequent_anchors_are_not_shuffled(docs_of, rows):
    """Anchors with more rows than that meet their kinds by broadcast; results stay."""
    compare(docs_of, some_rows(6), 24, stretches=2, frequent_rows=rows)


def test_join_counted_splits_rows_by_key(spark):
    keys = spark.createDataFrame([(1, 900, "a"), (2, 3, "b"), (4, 7, "d")], "h int, n long, x string")
    rows = spark.createDataFrame([(1, i) for i in range(900)] + [(2, i) for i in range(3)] + [(3, 0)], "h int, i int")
    for least in (1, 5, 1000):
        got = join_counted(rows, keys, "h", "n", least)
        assert got.columns == ["h", "i", "n", "x"]
        assert got.groupBy("h", "x").count().orderBy("h").collect() == [(1, "a", 900), (2, "b", 3)]
    assert join_counted(rows, keys.limit(0), "h", "n").collect() == []


def test_periodic_texts(docs_of):
    rows = [(1, "a" * 700), (2, "ab" * 200), (3, "abc" * 90 + "x" + "abc" * 90), (4, "ba" * 30)]
    compare(docs_of, rows, 40)


def test_copies_and_odd_rows(docs_of, odd_rows):
    compare(docs_of, odd_rows + [(i, "the very same text of some length") for i in range(40)], 12)


def test_empty_table(docs_of):
    assert repeats.remove_repeated_strings(docs_of([]), 12).collect() == []


def test_suffix_array_is_in_order():
    rnd = random.Random(3)
    for trial in range(150):
        letters = rnd.choice([b"ab", b"abc", b"a", b"the rain\xff", bytes(range(1, 256))])
        texts = [bytes(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(rnd.randrange(1, 9))]
        if trial % 3 == 0:
            texts = [t * rnd.randrange(1, 5) for t in texts]
        order, raw, _ = suffix_array(texts)
        raw = raw.tobytes()
        suffixes = [raw[p : raw.index(b"\0", p)] for p in order.tolist()]
        assert suffixes == sorted(suffixes)
        assert sorted(suffixes) == sorted(t[i:] for t in texts for i in range(len(t)))


def test_stretches_hold_each_window_once():
    rnd = random.Random(5)
    for _ in range(100):
        parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(60))) for _ in range(5)]
        raw = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts])
        starts = np.cumsum(sizes) - sizes
        first, n, place, _ = repeats.find_stretches(raw, starts, starts + sizes, 20)
        windows = sorted(x for a, k in zip(first.tolist(), n.tolist()) for x in range(a, a + k))
        assert windows == [s + i for s, z in zip(starts, sizes) for i in range(max(0, z - 19))]
        assert ((first + n - 1 <= place) & (place <= first + 10)).all()
