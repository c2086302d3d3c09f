import random
import re

import pytest

ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row int, h string, fp int, words string, kind string, start int, n int, bucket int, text_key int, "
    "bad_id long, _bad_id long, _bad_key string, _simhash_doc_id long, _simhash_label string, "
    "_secret_key long, _secret_id string, _secret_spans string, node long, label int, block int"
)
_MORE = (7, 8, "b", 9, "l", 10, "i", "s", 11, 12, 13)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents, with columns whose names the operators use themselves."""

    def make(rows, parts=3):
        full = [(i, t, "en", "s", len(t or ""), 1, "h", 2, "w", "k", 3, 4, 5, 6, *_MORE) for i, t in rows]
        return spark.createDataFrame(full, ODD_SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULL ids and texts, empty and blank texts, repeated rows and ids, a very long text."""
    rnd = random.Random(11)
    words = ["alpha", "beta", "Gamma", "délta", "x", "😀", "token=abc123XYZ"]
    long_text = " ".join(rnd.choice(words) for _ in range(30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "one two"),
        (6, "same text here"),
        (6, "same text here"),
        (7, "same text here"),
        (7, "another text"),
        (None, "no id at all"),
        (None, None),
        (8, long_text),
        (9, "nul \x00 byte ▁ sign"),
    ]


@pytest.fixture(scope="session")
def space():
    return re.compile("[^\x20\x09-\x0D]+")
