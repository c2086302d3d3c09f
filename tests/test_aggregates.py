from collections import Counter

import pytest
from pyspark.sql import functions as F

from urbanstats.operators import (
    count_by,
    count_by_month,
    grand_total,
    row_count,
    share_of_total,
    sum_by_key,
)


def as_dict(df):
    return {tuple(r)[:-1]: tuple(r)[-1] for r in df.collect()}


def test_count_by(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 1)], "k string, j int")
    assert as_dict(count_by(df, "k")) == {("a",): 2, ("b",): 1, (None,): 1}
    assert as_dict(count_by(df, "k", "j", name="n")) == {("a", 1): 2, ("b", 2): 1, (None, 1): 1}


def test_count_by_month_leaves_out_undated(spark):
    df = spark.sql(
        "select * from values (timestamp'2010-01-01 00:00:00'), (timestamp'2010-01-31 23:59:59'),"
        " (timestamp'2011-01-01 00:00:00'), (null) as t(t)"
    )
    counts = count_by_month(df, "t")
    assert as_dict(counts) == {(2010, 1): 2, (2011, 1): 1}
    assert counts.dtypes == [("year", "int"), ("month", "int"), ("total", "bigint")]
    assert count_by_month(df.filter("t is null"), "t").collect() == []


def test_sum_by_key(spark):
    rows = [("1", "10", 4), ("1", None, 3), (" 1 ", "x", 1), ("", "7", 2), (None, "9", 1), ("2", "0", 5)]
    df = spark.createDataFrame(rows, "k string, p string, h int")
    got = sum_by_key(df, "k", {"p": "people", "h": "homes"})
    assert {tuple(r) for r in got.collect()} == {("1", 10, 8), ("2", 0, 5)}
    assert got.dtypes == [("k", "string"), ("people", "bigint"), ("homes", "bigint")]


@pytest.mark.parametrize("few_groups", [False, True])
def test_share_of_total(spark, few_groups):
    """Counts and percentages of the published result."""
    golden = {
        "Night": (251094, 34.08),
        "Evening": (198292, 26.92),
        "Afternoon": (156432, 21.23),
        "Morning": (130866, 17.76),
    }
    counts = spark.createDataFrame([(k, n) for k, (n, _) in golden.items()], "k string, count bigint")
    got = share_of_total(counts, few_groups=few_groups)
    assert {r["k"]: (r["count"], r["percentage"]) for r in got.collect()} == golden


@pytest.mark.parametrize("few_groups", [False, True])
def test_share_of_nothing(spark, few_groups):
    empty = spark.createDataFrame([], "k string, count bigint")
    assert share_of_total(empty, few_groups=few_groups).collect() == []
    zeros = spark.createDataFrame([("a", 0)], "k string, count bigint")
    assert share_of_total(zeros, few_groups=few_groups).first()["percentage"] is None


def test_share_reads_the_source_once(spark, plan):
    """The total comes from the shuffle that the counts already wrote."""
    df = spark.range(0, 100_000, 1, 8).select((F.col("id") % 5000).cast("string").alias("k"))
    shares = share_of_total(count_by(df, "k"))
    rows = shares.collect()
    assert len(rows) == 5000 and {r["percentage"] for r in rows} == {0.02}
    assert "ReusedExchange" in plan(shares, run=True)
    assert "Window" not in plan(shares) and "Cartesian" not in plan(shares)


def test_share_of_two_measures_reads_the_source_once(spark, plan, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 10_000, 1, 8).select((F.col("id") % 500).alias("k"), "id").write.parquet(path)
    counts = spark.read.parquet(path).groupBy("k").agg(
        F.count(F.lit(1)).alias("count"), F.sum("id").alias("ids")
    )
    shares = share_of_total(counts)
    assert {r["percentage"] for r in shares.collect()} == {0.2}
    final = plan(shares, run=True)
    assert "ReusedExchange" in final and "SinglePartition" not in final.split("Subqueries")[0].split("Initial")[0]


def test_totals(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert grand_total(df, "x").collect() == [(3,)]
    assert grand_total(df.limit(0), "x").collect() == [(None,)]
    assert row_count(df).collect() == [(3,)]


def test_one_group_with_most_rows(spark):
    """A hot group reaches the shuffle as one row per map task."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    got = dict(tuple(r) for r in count_by(df, "k").collect())
    want = Counter("hot" if i % 10 < 9 else str(i) for i in range(200_000))
    assert got == want
