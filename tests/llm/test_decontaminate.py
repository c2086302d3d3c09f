import random
import re

import pytest

from urbanstats.llm import decontaminate
from urbanstats.llm.decontaminate import drop_contained, find_contained


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def plain(docs, items, least=0.8):
    """Every item against every document."""
    out = set()
    for item_id, item in items:
        w = words(item)
        if item_id is None or not w:
            continue
        n = min(5, len(w))
        own = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for doc_id, text in docs:
            d = words(text)
            shared = len(own & {tuple(d[i : i + n]) for i in range(len(d) - n + 1)})
            if shared / len(own) >= least:
                out.add((str(doc_id), item_id, len(own), shared))
    return out


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, "h") for i, t in items], "item_id long, text string, h int, words string")


def found(df):
    rows = df.collect()
    return {(str(r["doc_id"]), r["item_id"], r["n_shingles"], r["n_shared"]) for r in rows}


def cases(seed):
    """Items whole, cut, changed in some words, said twice, and close to the threshold."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["ab", "cd", "Ef", "gh2", "ï", "jk"]) + rnd.choice("xyz")
    items = [(i, " ".join(word() for _ in range(rnd.randrange(1, 60)))) for i in range(40)]
    docs = []
    for i in range(150):
        text = [word() for _ in range(rnd.randrange(100))]
        for _ in range(rnd.randrange(3)):
            item = rnd.choice(items)[1].split()
            for _ in range(rnd.randrange(4)):
                item[rnd.randrange(len(item))] = word()
            if rnd.random() < 0.3:
                item = item[: rnd.randrange(len(item)) + 1]
            at = rnd.randrange(len(text) + 1)
            text[at:at] = item
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(text)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_every_pair_is_found(spark, docs_of, seed):
    docs, items = cases(seed)
    want = plain(docs, items)
    assert len(want) > 30
    assert found(find_contained(docs_of(docs), items_of(spark, items))) == want


@pytest.mark.parametrize("least", [0.5, 1.0])
def test_other_thresholds(spark, docs_of, least):
    docs, items = cases(3)
    got = find_contained(docs_of(docs), items_of(spark, items), containment=least)
    assert found(got) == plain(docs, items, least)


def test_beyond_broadcast(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_PROBES", 0)
    docs, items = cases(4)
    assert found(find_contained(docs_of(docs), items_of(spark, items))) == plain(docs, items)


def test_odd_rows(spark, docs_of, odd_rows):
    items = [(1, None), (2, ""), (3, "!?"), (None, "one two"), (4, "TWO"), (5, "same text"), (5, "same text")]
    items += [(6, "one two"), (7, "no id at all"), (8, "alpha beta gamma délta x not there at all")]
    got = found(find_contained(docs_of(odd_rows), items_of(spark, items)))
    assert got == plain(odd_rows, items)
    assert ("None", 7, 1, 1) in got
    kept = drop_contained(docs_of(odd_rows), items_of(spark, items))
    bad = {(d, t) for d, t in odd_rows for p in plain([(d, t)], items)}
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(
        str(r) for r in odd_rows if r not in bad
    )
    assert kept.columns == docs_of([]).columns


def test_empty_tables(spark, docs_of):
    assert found(find_contained(docs_of([]), items_of(spark, [(1, "a b c d e f")]))) == set()
    assert found(find_contained(docs_of([(1, "a b c")]), items_of(spark, []))) == set()
    assert drop_contained(docs_of([(1, "a b c")]), items_of(spark, [])).count() == 1


def test_no_python_in_the_plan(spark, docs_of, plan):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert not re.search("Python|Pandas|Arrow", plan(find_contained(docs, items)))


def test_texts_are_split_once_for_all_lengths(spark, docs_of, plan, monkeypatch):
    """Items of one to six words: the candidate search reads and splits the documents once."""
    plans = []
    whole = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: plans.append(plan(df, mode="simple")) or whole(df, name))
    items = items_of(spark, [(n, " ".join("abcdef"[:n])) for n in range(1, 7)])
    got = find_contained(docs_of([(1, "x a b c d e f y"), (2, "b a")]), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, n) for n in range(1, 7)} | {(2, 1)}
    assert "Union" not in plans[0] and plans[0].count("Generate explode") == 2
