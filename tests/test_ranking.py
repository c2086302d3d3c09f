import random

import pytest
from pyspark.sql import functions as F

from urbanstats.operators import rank_months, top_n_per_group


def order():
    return [F.desc("v"), F.asc("id")]


def brute_force(rows, n):
    groups = {}
    for g, v, i in rows:
        groups.setdefault(g, []).append((-v, i))
    return {
        (g, i, rank)
        for g, members in groups.items()
        for rank, (_, i) in enumerate(sorted(members)[:n], 1)
    }


@pytest.mark.parametrize("parts", [1, 8, 200])
@pytest.mark.parametrize("n", [1, 3, 50])
def test_top_n(spark, n, parts):  # 200 partitions take two merges
    """One group holds a third of the rows; values have many ties."""
    rng = random.Random(5)
    rows = [
        ("hot" if i % 3 == 0 else f"g{rng.randrange(40)}", rng.randrange(20), i) for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(parts)
    got = top_n_per_group(df, ["g"], order(), n, in_parts=parts > 1)
    assert got.columns == ["g", "v", "id", "ranking"]
    assert {(r["g"], r["id"], r["ranking"]) for r in got.collect()} == brute_force(rows, n)


def test_top_n_with_null_group(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), ("a", 1, 3)], "g string, v int, id int")
    got = top_n_per_group(df, ["g"], order(), 1).collect()
    assert {(r["g"], r["id"]) for r in got} == {(None, 2), ("a", 3)}


def test_top_n_arguments(spark):
    df = spark.createDataFrame([("a", 1, 3)], "g string, v int, id int")
    with pytest.raises(ValueError):
        top_n_per_group(df, ["g"], order(), 0)


def test_groups_are_cut_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"), "id")
    text = plan(top_n_per_group(df, ["g"], order(), 3))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_large_n_ranks_in_parts(spark, plan, conf):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"), "id")
    conf(spark__sql__optimizer__windowGroupLimitThreshold="3")
    for n, parts in ((2, False), (3, True), (500, True)):
        top = top_n_per_group(df, ["g"], order(), n)
        assert ("_part#" in plan(top)) == parts
        rows = [(i % 7, i, i) for i in range(1000)]
        assert {(r["g"], r["id"], r["ranking"]) for r in top.collect()} == brute_force(rows, n)


def jobs_of(spark, work):
    """How many Spark jobs a function starts."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "")
    before = set(sc.statusTracker().getJobIdsForGroup("counted"))
    try:
        work()
        return len(set(sc.statusTracker().getJobIdsForGroup("counted")) - before)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_building_runs_no_job(spark):
    """Also over an aggregation, whose partitions are known only once it has run."""
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("g"), (F.col("id") % 100).alias("id")).count()
    made = []
    assert jobs_of(spark, df.collect) > 0
    assert jobs_of(spark, lambda: made.append(top_n_per_group(df, ["g"], ["id"], 2, in_parts=True))) == 0
    assert len(made[0].collect()) == 14


def test_parts_are_bounded(spark):
    """A group that holds everything is dealt evenly, also where its rows lie together."""
    df = spark.range(64_000).select(F.lit("hot").alias("g"), "id").coalesce(1)
    top = top_n_per_group(df, ["g"], [F.desc("id")], 100, in_parts=True, parts=64)
    assert [r["id"] for r in top.orderBy("ranking").collect()] == list(range(63_999, 63_899, -1))
    sizes = df.groupBy(F.pmod(F.xxhash64("g", "id"), F.lit(64))).count().agg(F.max("count")).first()[0]
    assert sizes < 1300
    tree = top._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(" in tree and "spark_partition_id" not in tree


def test_columns_without_a_hash(spark):
    rows = [("a", {"x": 1}, 1), ("a", {"y": 2}, 2), ("b", None, 3)]
    df = spark.createDataFrame(rows, "g string, m map<string,int>, id int")
    got = top_n_per_group(df, ["g"], [F.desc("id")], 1, in_parts=True, parts=3)
    assert sorted((r["g"], r["id"]) for r in got.collect()) == [("a", 2), ("b", 3)]


def test_rank_months_breaks_ties_by_month(spark):
    counts = spark.createDataFrame(
        [(2010, 3, 5), (2010, 1, 5), (2010, 2, 9), (2011, 7, 1)], "year int, month int, total bigint"
    )
    got = rank_months(counts).orderBy("year", "ranking").collect()
    assert [(r["year"], r["month"], r["ranking"]) for r in got] == [
        (2010, 2, 1),
        (2010, 1, 2),
        (2010, 3, 3),
        (2011, 7, 1),
    ]


def test_helper_columns_do_not_hit_the_callers(spark):
    rows = spark.createDataFrame([("a", 1, 5, 7), ("a", 2, 6, 8)], "g string, _part int, _rank int, id int")
    got = top_n_per_group(rows.repartition(3), ["g"], [F.desc("_part")], 1, in_parts=True)
    assert got.columns == ["g", "_part", "_rank", "id", "ranking"]
    assert [tuple(r) for r in got.collect()] == [("a", 2, 6, 8, 1)]
