"""The queries with SQL against DuckDB, and the pipeline."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from urbanstats.llm.common import stored
from urbanstats.llm.queries import ORACLE, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_oracle(spark, name, sf):
    con = duckdb.connect()
    for path in glob.glob(f"/root/testdata/{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    df = QUERIES[name](spark, f"/root/testdata/{sf}")
    assert {c: TYPES[t] for c, t in df.dtypes} == {d[0]: str(d[1]) for d in want.description}
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(map(repr, want.fetchall()))
    assert got or sf == "sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


SF = "/root/testdata/sf0.01"


def test_pipeline(spark):
    """Each stage against its operator's own result, on all that the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), f"test_{name}")
        kept[name] = (before, docs)
        if name != "pieces":
            assert sorted(docs.dtypes) == sorted(before.dtypes)

    def ids(df):
        return {r["doc_id"] for r in df.select("doc_id").collect()}

    before, after = kept["quality"]
    gone = ids(before) - ids(after)
    judged = [labels[i] for i in gone if i in labels]
    assert judged.count(0) > 0.9 * len(judged) and len(judged) > 30
    before, after = kept["near_duplicates"]
    groups = components_of(before)
    assert ids(after) == set(groups.values())
    before, after = kept["decontamination"]
    bad = ids(entry_points.queries()["op10_benchmark_decontamination"](spark, SF))
    assert ids(after) == ids(before) - bad and bad & ids(before)
    before, after = kept["secrets"]
    assert ids(after) == ids(before)
    assert after.filter(F.col("text").rlike("[0-9a-f]{24}")).isEmpty()
    assert not after.filter(F.col("text").contains("[secret]")).isEmpty()
    assert after.filter(F.col("n_chars") != F.length("text")).isEmpty()
    before, after = kept["pieces"]
    assert ids(after) == ids(before) and after.filter("n_pieces <> size(ids)").isEmpty()


def components_of(docs):
    from urbanstats.llm.simhash import near_duplicates

    return {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}


def test_run_is_all_stages(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_pieces", "ids"] and got.count() > 100
