import random

import numpy as np
import pytest
import xxhash

from urbanstats.llm import simhash
from urbanstats.llm.components import connected_components
from urbanstats.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, space):
    words = space.findall((text or "").translate(LOWER))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    """Smallest id reachable, by comparing all pairs."""
    n = len(ids)
    group = list(range(n))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group[find(i)] = find(j)
    least = {}
    for i in range(n):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least[find(i)] for i in range(n)]


def test_query_equals_plain_python(spark, space):
    got = QUERIES["op1_simhash_near_dedup"](spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_print(r["text"], space) for r in rows]
    labels = plain_components([r["doc_id"] for r in rows], prints)
    want = {(r["doc_id"], f"{p:016x}", c) for r, p, c in zip(rows, prints, labels)}
    assert {tuple(r)[:3] for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("list_length", [64, 8, 1])
def test_pairs_of_dense_clusters(spark, list_length):
    """Clusters of bits that flip, as in large groups of near copies; lists of all lengths."""
    rnd = random.Random(list_length)
    values = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        free = rnd.sample(range(64), 9)
        for _ in range(70):
            values.add(centre ^ sum(1 << b for b in free if rnd.random() < 0.4))
    values |= {0, (1 << 64) - 1, 1 << 63, 7}
    values = sorted(values)
    rows = [(int(np.array(v, np.uint64).view(np.int64)),) for v in values]
    got = simhash.similar_pairs(spark.createDataFrame(rows, "fp long"), 3, list_length).collect()
    signed = {v: r[0] for v, r in zip(values, rows)}
    want = {
        tuple(sorted((signed[a], signed[b])))
        for i, a in enumerate(values)
        for b in values[:i]
        if (a ^ b).bit_count() <= 3
    }
    assert len(want) > 1000
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_every_pair_shares_a_list():
    """Three differing bytes leave a whole triple in one half, whichever they are."""
    from itertools import combinations

    for gone in combinations(range(8), 3):
        left = set(range(8)) - set(gone)
        assert any(t <= left for t in simhash._TRIPLES)
        assert any(f <= left for f in simhash._FIVES)


def test_more_than_three_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.similar_pairs(spark.createDataFrame([(1,)], "fp long"), 4)


def test_odd_rows(docs_of, odd_rows, space):
    got = simhash.near_duplicates(docs_of(odd_rows)).collect()
    rows = [(i, t) for i, t in odd_rows if i is not None]
    prints = [plain_print(t, space) for _, t in rows]
    labels = plain_components([i for i, _ in rows], prints)
    want = sorted((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, labels))
    assert sorted(tuple(r) for r in got) == want
    # Texts without words have fingerprint 0 and are linked.
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {1}


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).collect() == []
    assert simhash.keep_firsts(docs_of([])).collect() == []


def test_one_of_each_group_stays(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = simhash.keep_firsts(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    # 1 to 3 have no words, 6 has a copy in itself and in 7, whose other text stays.
    assert ids == ["1", "4", "5", "6", "7", "8", "9", "None", "None"]


def test_rows_with_one_id_are_judged_in_each_group(docs_of):
    rows = [(6, "same text here"), (7, "same text here"), (7, "zz unique text"), (7, "a third one"), (7, "a third one")]
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.keep_firsts(docs_of(rows)).collect())
    assert kept == [(6, "same text here"), (7, "a third one"), (7, "zz unique text")]


def test_components_of_long_chains(spark):
    rnd = random.Random(2)
    order = list(range(300))
    rnd.shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(298)] + [(500, 400), (400, 500), (7, 7)]
    got = connected_components(spark.createDataFrame(links, "u long, v long")).collect()
    labels = dict(map(tuple, got))
    assert len(got) == len(labels)
    chain = set(order[:299])
    assert {labels[i] for i in chain} == {min(chain)}
    assert labels[500] == labels[400] == 400
