import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from urbanstats.llm import alignment
from urbanstats.llm.alignment import (
    Tokenizers,
    align_tokenizers,
    byte_alphabet,
    compress,
    expand,
    link_index,
    pair_table,
    read_tokenizers,
)

PATHS = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def files():
    return read_tokenizers(*PATHS)


@pytest.fixture(scope="module")
def both(files):
    return Tokenizers(files)


def plain(rows, both):
    """Each whole text by both libraries, each pair of tokens by its byte range."""
    kept, counts, docs = [], Counter(), defaultdict(set)
    for row, (doc_id, text) in enumerate(rows):
        raw = (" " + (text or "")).encode()
        a = both.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        parts = [[both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]]
        if any(b"".join(p) != raw for p in parts):
            a, b, parts = [], [], [[], []]
        ends = [np.cumsum([0, *map(len, p)]).tolist() for p in parts]
        spans = [list(zip(e, e[1:])) for e in ends]
        links, j = [], 0
        for i, (x, y) in zip(a, spans[0]):
            while j and spans[1][j - 1][1] > x:
                j -= 1
            while j < len(b) and spans[1][j][0] < y:
                if spans[1][j][1] > x:
                    links.append((i, b[j]))
                j += 1
        cuts = sorted(set(ends[0][1:]) & set(ends[1][1:]))
        groups, at = [], [0, 0]
        for c in cuts:
            to = [e.index(c, k) for e, k in zip(ends, at)]
            groups.append("|".join(",".join(map(str, ids[x:y])) for ids, x, y in zip((a, b), at, to)))
            at = to
        digest = sha256(";".join(groups).encode()).hexdigest() if a else ""
        kept.append((doc_id, len(a), len(b), len(groups), links, digest))
        counts.update(links)
        for pair in links:
            docs[pair].add(row)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = [
        (i, na, nb, g, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), d)
        for i, na, nb, g, ls, d in kept
    ]
    pairs = sorted((*p, len(docs[p]), n, n == most[p[1]]) for p, n in counts.items())
    return sorted(rows, key=repr), pairs


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


ODD = [
    (20, "two  spaces   three \n new lines\n\n  and\ttabs \t end "),
    (21, " leading"),
    (22, "   "),
    (23, "a "),
    (24, "no-break space  em 　wide\x85next\x1cfield"),
    (25, "<|endoftext|> <s> </s> <unk> <0x0A> it's we'll IT'S"),
    (26, "中文 テキスト 😀😀 é ﬁ Å 𝒳 ​ zero"),
    (27, "x" * 3000 + " " + "ab" * 2000),
    (28, "123456 1,000.00 ((())) +++ === \\n"),
    (29, "\n"),
    (30, "﻿bom ­ soft"),
]


def test_odd_rows(spark, docs_of, odd_rows, files, both):
    rows = odd_rows + ODD
    want, pairs = plain(rows, both)
    assert found(align_tokenizers(docs_of(rows), files, chunk_chars=5000, range_bytes=50_000)) == want
    got = pair_table(link_index(docs_of(rows), files)[1])
    assert sorted(map(tuple, got.collect())) == pairs


def test_random_texts(spark, docs_of, files, both):
    """Every mixture of letters, marks and white space is cut as the whole text is."""
    rnd = random.Random(5)
    signs = [" ", " ", "  ", "\n", "\t", " ", "a", "the", "The", "é", "1", "22", ".", "'s", "_", "▁", "\x00", "語"]
    rows = [(i, "".join(rnd.choices(signs, k=rnd.randrange(40)))) for i in range(600)]
    assert found(align_tokenizers(docs_of(rows), files, chunk_chars=800, range_bytes=900)) == plain(rows, both)[0]


def test_units_are_forgotten(spark, docs_of, files, both, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_UNITS", 50)
    rows = [(i, " ".join(f"w{i * j % 97}" for j in range(60))) for i in range(40)]
    assert found(align_tokenizers(docs_of(rows), files, chunk_chars=300)) == plain(rows, both)[0]


def test_units_together_and_one_by_one(both):
    """Units cut out of one encoded text have the ids that each has on its own."""
    units = [" the", " The", " x\ny", " 1,000.00", " é語", " it's", " ▁", " a", " \x00", " ab" * 1]
    for some in (units, units[:6], ["  two", " end ", " "], units[:3] * 900):
        got = both.encode(some)
        one = [both.encode([u]) for u in some]
        for x, y in zip(got, zip(*one)):
            assert x.tolist() == np.concatenate(y).tolist()
    assert both.encode(units)[4].tolist() == [u != " ▁" for u in units]


def test_documents(spark, files, both):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = found(align_tokenizers(docs, files, range_bytes=100_000, chunk_chars=20_000))
    assert got == plain(rows, both)[0]


def test_empty_table(docs_of, files):
    assert found(align_tokenizers(docs_of([]), files)) == []
    assert found(align_tokenizers(docs_of([(1, None)]), files)) == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("n_docs", [1, 7, 8, 9, 1000, 1 << 16])
def test_bitmaps_come_back(n_docs):
    rng = np.random.default_rng(n_docs)
    sets = [np.sort(rng.choice(n_docs, max(1, int(n_docs * p)), replace=False)) for p in (0, 0.01, 0.2, 0.9, 1)]
    owner = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    counts, body = compress(n_docs, owner, np.concatenate(sets))
    widths = np.full(len(sets), -(-n_docs // 8))
    got, docs = expand(widths, counts, body)
    for i, want in enumerate(sets):
        assert np.sort(docs[got == i]).tolist() == want.tolist()
    assert len(body) <= len(sets) * -(-n_docs // 8)


def test_alphabet_is_a_bijection():
    assert sorted(byte_alphabet().values()) == list(range(256)) and len(byte_alphabet()) == 256
