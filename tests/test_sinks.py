import glob
from threading import Event, Thread

import pytest
from pyspark.sql import functions as F

from urbanstats.sources import csv_to_parquet, preview, read_csv, write_csv
from urbanstats.sources.sessions import session_with


def files(path):
    return sorted(glob.glob(f"{path}/part-*"))


@pytest.fixture
def result(spark):
    rows = [(i, f"n{i}", i / 8) for i in range(100)]
    return spark.createDataFrame(rows, "id int, name string, v double").repartition(6)


def test_small_result_in_one_sorted_file(spark, result, tmp_path):
    out = str(tmp_path / "r")
    for _ in range(2):  # the second replaces the first
        write_csv(result, out, single_file_rows=100, order=["id"])
    (only,) = files(out)
    lines = open(only).read().splitlines()
    assert lines[0] == "id,name,v"
    assert [int(line.split(",")[0]) for line in lines[1:]] == list(range(100))


def test_larger_result_is_whole_and_in_parallel(spark, result, tmp_path):
    out = str(tmp_path / "r")
    write_csv(result, out, single_file_rows=99)
    assert len(files(out)) == 6
    assert {r["id"] for r in read_csv(spark, out).collect()} == {str(i) for i in range(100)}


def test_order_holds_at_every_size(spark, tmp_path):
    out = str(tmp_path / "r")
    conf = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(1000, 0, -1, 8)
        write_csv(df, out, header=False, single_file_rows=100, order=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", conf)
    assert len(files(out)) > 1
    assert [int(line) for f in files(out) for line in open(f)] == list(range(1, 1001))


def test_the_callers_cache_stays(spark, result, tmp_path):
    result.persist()
    try:
        for rows in (1000, 10):
            write_csv(result, str(tmp_path / "r"), single_file_rows=rows)
            assert result.storageLevel.useMemory
    finally:
        result.unpersist()


@pytest.mark.parametrize("order", [(), ("id",)])
@pytest.mark.parametrize("single", [0, 10, 1000])
def test_the_source_is_computed_once(spark, tmp_path, single, order):
    """Each row of the source is seen once, for a small and a large result, sorted or not."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def watched(x):
        seen.add(1)
        return x

    df = spark.range(200, numPartitions=4).select(watched("id").alias("id"))
    out = str(tmp_path / "r")
    write_csv(df, out, single_file_rows=single, order=order)
    assert seen.value == 200
    assert sorted(int(r["id"]) for r in read_csv(spark, out).collect()) == list(range(200))


def test_single_file_keeps_the_order_of_the_rows(spark, tmp_path):
    out = str(tmp_path / "r")
    df = spark.range(500, numPartitions=8).select(F.col("id").alias("_row")).orderBy(F.desc("_row"))
    write_csv(df, out, header=False, single_file_rows=500)
    (only,) = files(out)
    assert [int(line) for line in open(only)] == list(range(499, -1, -1))


def test_parallel_by_default(spark, result, tmp_path):
    out = str(tmp_path / "r")
    write_csv(result, out)
    assert len(files(out)) == 6


def test_without_header_and_no_overwrite(spark, tmp_path):
    out = str(tmp_path / "r")
    df = spark.createDataFrame([("Night", 3, 34.08)], "p string, n int, share double")
    write_csv(df, out, header=False, mode="errorifexists")
    assert "".join(open(f).read() for f in files(out)) == "Night,3,34.08\n"
    with pytest.raises(Exception, match="already exists"):
        write_csv(df, out, header=False, mode="errorifexists")


@pytest.mark.parametrize("sep", [",", ";"])
def test_values_survive(spark, tmp_path, sep):
    """All but empty texts, which Spark's reader takes for NULL."""
    out = str(tmp_path / "r")
    rows = [(' a "b", c ', "x;y"), ("", None), (None, "\\"), ('""', "'"), ("k", 'q\\"')]
    write_csv(spark.createDataFrame(rows, "a string, b string"), out, sep=sep)
    got = [tuple(r) for r in read_csv(spark, out, sep=sep).collect()]
    want = [(a or None, b) for a, b in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_csv_to_parquet(spark, result, tmp_path, conf):
    source, out = str(tmp_path / "csv"), str(tmp_path / "parquet")
    write_csv(result.withColumnRenamed("name", "Premis Desc"), source)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert csv_to_parquet(spark, [source], out, required=["Premis Desc"]) == 100
    assert csv_to_parquet(spark, [source], out) == 100  # replaces
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    back = spark.read.parquet(out)
    assert back.dtypes == [("id", "string"), ("Premis Desc", "string"), ("v", "string")]
    assert back.agg(F.sum(F.col("v").cast("double"))).first()[0] == sum(i / 8 for i in range(100))


def test_csv_to_parquet_keeps_the_sessions_settings(spark, result, tmp_path, conf):
    conf(spark__sql__parquet__compression__codec="zstd")
    source, out = str(tmp_path / "csv"), str(tmp_path / "parquet")
    write_csv(result, source)
    csv_to_parquet(spark, source, out)
    assert files(out) and all(".zstd." in f for f in files(out))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with pytest.raises(Exception):
        csv_to_parquet(spark, source, out, required=["not there"])
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_csv_to_parquet_leaves_other_threads_alone(spark, result, tmp_path, conf):
    """While files are converted, another thread finds the session's own settings."""
    conf(spark__sql__files__maxPartitionBytes="7m")
    source, out = str(tmp_path / "csv"), str(tmp_path / "parquet")
    write_csv(result, source)
    found, over = set(), Event()

    def watch():
        while not over.is_set():
            found.add(spark.conf.get("spark.sql.files.maxPartitionBytes"))

    thread = Thread(target=watch)
    thread.start()
    try:
        for _ in range(3):
            assert csv_to_parquet(spark, source, out) == 100
    finally:
        over.set()
        thread.join()
    assert found == {"7m"}


def test_session_with_settings(spark, conf):
    conf(spark__sql__shuffle__partitions="13")
    other = session_with(spark, spark__sql__files__maxPartitionBytes="5m")
    assert other.conf.get("spark.sql.shuffle.partitions") == "13"
    assert other.conf.get("spark.sql.files.maxPartitionBytes") == "5m"
    assert other.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "5m"
    assert other.sparkContext is spark.sparkContext


def test_preview(spark, result, plan):
    got = preview(result, [F.desc("v")], 3)
    assert [r["id"] for r in got.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan(got)
