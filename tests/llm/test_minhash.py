import random
from hashlib import md5

import numpy as np
import pytest

from urbanstats.llm import minhash
from urbanstats.llm.minhash import (
    band_keys,
    joined_labels,
    near_duplicates,
    permutations,
    shared_counts,
    signature,
)

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def plain(rows, space, percent=80, length=4):
    """All pairs of sets of text shingles."""
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    found = []
    for doc_id, text in rows:
        if doc_id is not None:
            w = space.findall((text or "").translate(upper))
            n = min(length, len(w))
            found.append((doc_id, frozenset(" ".join(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()))
    root = {s: s for _, s in found}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    sets = list(root)
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(a)] = find(b)
    first = {}
    for doc_id, s in found:
        first[find(s)] = min(doc_id, first.get(find(s), doc_id))
    own = [(i, len(s), first[find(s)] if s else i) for i, s in found]
    return sorted((i, n, c, c == i) for i, n, c in own)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def near_copies(rnd, groups, size, words=60):
    """Groups of texts with a few words changed, some of which are just not linked."""
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rnd.randrange(500)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rnd.randrange(5)):
                text[rnd.randrange(words)] = f"new{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    rnd.shuffle(rows)
    return rows


def test_odd_rows(docs_of, odd_rows, space):
    rows = odd_rows + [(40, "One  two"), (41, "ONE\ttwo"), (42, "one two three four five"), (43, "É one two three")]
    assert found(near_duplicates(docs_of(rows), chunk_chars=500)) == plain(rows, space)


@pytest.mark.parametrize(
    "sizes",
    [
        {},
        {"list_length": 4},
        {"list_length": 4, "block_shingles": 300},
        {"bands": 24, "values": 2, "list_length": 8, "block_shingles": 500},
    ],
)
def test_groups_of_near_copies(docs_of, space, sizes):
    """Short lists, and long ones compared block by block, give all components."""
    rows = near_copies(random.Random(3), 6, 25)
    rows += [(1000 + i, rows[0][1]) for i in range(50)]
    want = plain(rows, space)
    assert 6 < len({c for _, _, c, _ in want}) < len(want) / 2
    assert found(near_duplicates(docs_of(rows), chunk_chars=4000, **sizes)) == want


def test_similar_texts_below_the_threshold(docs_of, space):
    """One long list of texts that share most words but are not linked, but for some pairs."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(70)]
    rows = [(i, " ".join(base + [f"own{i}x{j}" for j in range(12)])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + f" {rnd.random()}") for i in range(0, 60, 9)]
    want = plain(rows, space)
    assert len({c for _, _, c, _ in want}) == 60
    assert found(near_duplicates(docs_of(rows), list_length=10, block_shingles=1000)) == want


def test_threshold_is_exact(docs_of, space):
    """Four of five shingles shared is a link, one less is none."""
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "q a b c d e f"), (4, "a b c d e f")]
    assert found(near_duplicates(docs_of(rows))) == plain(rows, space)


def test_empty_table(docs_of):
    assert found(near_duplicates(docs_of([]))) == []
    assert found(near_duplicates(docs_of([(3, None), (None, "a")]))) == [(3, 0, 3, True)]


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50))) for _ in range(30)]
    got = shared_counts(sets[:12], sets[12:])
    assert got.tolist() == [[len(set(a) & set(b)) for b in sets[12:]] for a in sets[:12]]


def test_joined_labels():
    alike = np.array([[1, 0, 0], [1, 1, 0], [0, 0, 0], [0, 0, 1]], bool)
    names, joined = joined_labels(alike, np.array([9, 4, 5, 6]), np.array([7, 8, 5]))
    assert dict(zip(names.tolist(), joined.tolist())) == {4: 4, 5: 5, 6: 5, 7: 4, 8: 4, 9: 4}


def test_signatures_estimate_the_similarity():
    """Smallest and largest values together are unbiased, with half of the permutations."""
    rnd = random.Random(2)
    numbers = np.array([int(md5(b"%d" % i).hexdigest()[:16], 16) for i in range(3000)], np.uint64)
    permuted = permutations(192)
    for shared in (100, 500, 800):
        part = rnd.sample(range(3000), 2000 - shared)
        a, b = numbers[part[:1000]], numbers[part[1000 - shared :]]
        equal = (signature(a, permuted) == signature(b, permuted)).mean()
        assert abs(equal - shared / (2000 - shared)) < 0.08
    keys = band_keys(np.array([signature(a, permuted), signature(a, permuted)]), 64)
    assert (keys[0] == keys[1]).all() and len(set(keys[0].tolist())) == 64
