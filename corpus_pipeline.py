"""From raw documents to piece ids: five stages, each on all that the one before kept.

Every stage takes rows with NULL ids and texts, empty and very long texts, and rows that
repeat an id or a whole row, as the operator that it calls says; extra columns may have
any names and stay, up to the last stage. An empty table goes through all stages.
"""

from pyspark.sql import functions as F

from urbanstats.llm.common import stored
from urbanstats.llm.decontaminate import drop_contained
from urbanstats.llm.pieces import encode_documents, read_vocabulary
from urbanstats.llm.quality import fit_quality, keep_good
from urbanstats.llm.secrets import fit_markov, labelled_samples, redact_secrets
from urbanstats.llm.simhash import keep_firsts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def quality(spark, docs, sf_dir):
    """Documents that the classifier scores at 0.7 or more; NULL texts are scored as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit_quality(docs, labels), threshold=0.7)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near-duplicates the document with the smallest id.

    Empty and NULL texts are near-duplicates of each other; rows with a NULL id stay.
    """
    return keep_firsts(docs, shingle_words=3, max_bits=3)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no benchmark item; NULL and empty texts hold none."""
    return drop_contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark, docs, sf_dir):
    """All documents, with their secrets cut out; NULL texts stay NULL."""
    return redact_secrets(docs, fit_markov(labelled_samples(docs)))


def pieces(spark, docs, sf_dir):
    """The piece ids of each document: doc_id, n_pieces, ids; none for NULL and empty texts."""
    ids = encode_documents(docs, read_vocabulary(VOCABULARY))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("pieces", pieces),
]

# Learned models and piece merges are not SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in turn; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
