"""Time the headline queries and print one JSON line.

``queries`` are registered queries at BENCH_SF_DIR. ``full_scale`` are the jobs on
crime files of the size the published run times are for (about 3.1 million rows and
900 MB of CSV, derived from the events table), and on census blocks with geometry (about
500 MB of GeoJSON, derived from the customers). BENCH_FULL_ROWS=0 leaves them out.

Each time is the median of three runs after a warm-up. It covers reading, planning and
computing every row; the rows go to Spark's noop sink, not to the driver, except those of
csv_to_parquet, which are written.
"""

import json
import os
import sys
from functools import partial
from statistics import median
from time import perf_counter

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from urbanstats import schemas as S  # noqa: E402
from urbanstats.functions import day_part_udf  # noqa: E402
from urbanstats.operators.joins import STRATEGIES  # noqa: E402
from urbanstats.plans import day_part_share, income_per_key, top_months, top_months_sql  # noqa: E402
from urbanstats.sources import (  # noqa: E402
    csv_to_parquet,
    feature_properties,
    read_csv,
    read_features,
    scratch_path,
    write_csv,
)
from workload import derive  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

RUNS = 3
HEADLINES = [
    "day_part_share",
    "day_part_share_udf",
    "day_part_share_udf_on_distinct",
    "day_part_share_csv",
    "day_part_share_parquet",
    "share_of_total",
    "share_of_total_two_measures",
    "monthly_counts",
    "top_months",
    "top_months_sql",
    "top_months_of_texts",
    "top_months_of_repeated_texts",
    "top_n_per_group",
    "top_n_per_group_large",
    "income_per_key",
    "income_per_key_strict",
    "income_per_key_files",
    "join_default",
    "join_broadcast",
    "join_merge",
    "join_shuffle_hash",
    "join_replicate_nl",
    "join_split_hot_keys",
    "join_split_clustered_key",
    "join_split_both_sides",
    "csv_multi_file",
    "csv_without_rejected",
    "csv_rejected_lines",
    "csv_line_ends_roundtrip",
    "csv_single_file",
    "csv_to_parquet",
    "geojson_split",
    "geojson_free_order",
    "geojson_features",
]


def timed(job):
    start = perf_counter()
    job().write.format("noop").mode("overwrite").save()
    return round(perf_counter() - start, 3)


def median_times(jobs):
    for job in jobs.values():  # warm up
        timed(job)
    return {name: median(timed(job) for _ in range(RUNS)) for name, job in jobs.items()}


def crime_files(spark, sf_dir, rows):
    """Two sets of CSV files as wide as the published ones, from repeated events."""
    events = derive.incidents(spark, sf_dir)
    copies = -(-rows // events.count())
    note = F.rpad(F.sha2(S.CRIME_ID, 256), 55, "x")
    named = {3: F.col(S.CRIME_TIME), 15: F.col(S.CRIME_PREMISE), 2: F.col(S.CRIME_DATE)}
    names = {3: S.CRIME_TIME, 15: S.CRIME_PREMISE, 2: S.CRIME_DATE}
    columns = [F.col(S.CRIME_ID)]
    for i in range(1, 28):
        filler = note if i % 9 == 0 else F.lpad(S.CRIME_ID, 4, "0")
        columns.append(named.get(i, filler).alias(names.get(i, f"c{i}")))
    wide = events.select(
        *columns, F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy")
    )
    paths = []
    for name, part in (("old", F.col("_copy") * 3 <= copies * 2), ("new", F.col("_copy") * 3 > copies * 2)):
        path = scratch_path(spark, name)
        write_csv(wide.repartition(16, S.CRIME_ID).filter(part).drop("_copy"), path)
        paths.append(path)
    return paths


# Crime rows for each census block.
ROWS_PER_BLOCK = 26


def block_files(spark, sf_dir, rows):
    """Census blocks as GeoJSON features, one per line, with a polygon of 150 corners."""
    blocks = derive.census_blocks(spark, sf_dir)
    copies = -(-rows // ROWS_PER_BLOCK // blocks.count())
    corner = F.array(F.lit(-118.123456789), F.lit(34.123456789))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.array_repeat(corner, 150)).alias("coordinates")).alias(
            "geometry"
        ),
        F.struct(*blocks.columns).alias("properties"),
    )
    path = scratch_path(spark, "blocks")
    copied = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    copied.repartition(8, "_copy").select(feature.alias("f")).select("f.*").write.json(path)
    return path


def folder_size(spark, path):
    """Bytes of the files of a folder, wherever it is."""
    return spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]


def full_scale(spark, sf_dir, rows):
    paths = crime_files(spark, sf_dir, rows)
    out = scratch_path(spark, "crimes")
    seconds = {}
    runs = []
    for _ in range(1 + RUNS):
        start = perf_counter()
        written = csv_to_parquet(spark, paths, out, required=S.CRIME_COLUMNS)
        runs.append(round(perf_counter() - start, 3))
    seconds["csv_to_parquet"] = median(runs[1:])
    blocks = block_files(spark, sf_dir, rows)
    income = derive.income_files(spark, sf_dir)

    def q3(strategy, layout="split", **options):
        features = feature_properties(read_features(spark, blocks, layout=layout, **options))
        return income_per_key(features, read_csv(spark, income, ";", required=S.INCOME_COLUMNS), strategy)

    street = F.col(S.CRIME_PREMISE) == "error"
    jobs = {
        "q1_csv": lambda: day_part_share(read_csv(spark, paths), where=street),
        "q1_csv_udf": lambda: day_part_share(read_csv(spark, paths), where=street, rule=day_part_udf()),
        "q1_csv_udf_on_distinct": lambda: day_part_share(
            read_csv(spark, paths), where=street, rule=day_part_udf(), repeated_texts=True
        ),
        "q1_parquet": lambda: day_part_share(spark.read.parquet(out), where=street),
        "q2_csv": lambda: top_months(read_csv(spark, paths), S.CRIME_DATE, S.CRIME_DATE_PATTERN),
        "q2_csv_sql": lambda: top_months_sql(read_csv(spark, paths), S.CRIME_DATE, S.CRIME_DATE_PATTERN),
        "q2_parquet": lambda: top_months(spark.read.parquet(out), S.CRIME_DATE, S.CRIME_DATE_PATTERN),
        "q2_parquet_repeated_texts": lambda: top_months(
            spark.read.parquet(out), S.CRIME_DATE, S.CRIME_DATE_PATTERN, repeated_texts=True
        ),
    }
    jobs |= {f"q3_{name}": partial(q3, name) for name in STRATEGIES}
    jobs["q3_default_unchecked"] = partial(q3, "default", check=False)
    jobs["q3_default_feature_lines"] = partial(q3, "default", layout="feature_lines")
    seconds.update(median_times(jobs))
    return {
        "rows": written,
        "csv_mb": round(sum(folder_size(spark, p) for p in paths) / 1e6, 1),
        "parquet_mb": round(folder_size(spark, out) / 1e6, 1),
        "geojson_mb": round(folder_size(spark, blocks) / 1e6, 1),
        "seconds": seconds,
        "rows_per_second": {n: round(written / s) for n, s in seconds.items() if not n.startswith("q3")},
    }


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_FULL_ROWS", "3138128"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times = median_times({name: partial(QUERIES[name], spark, sf_dir) for name in HEADLINES})
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    if rows:
        result["full_scale"] = full_scale(spark, sf_dir, rows)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
