"""Every query of the library's own operators against its SQL in DuckDB, on whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


# Spark type to DuckDB type, as both sides must agree on the schema.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE[name])
    schema = {d[0]: str(d[1]) for d in want.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == schema
    got = [tuple(r) for r in df.collect()]
    assert got
    assert rows_by_name(df.columns, got) == rows_by_name(list(schema), want.fetchall())


@pytest.mark.parametrize(
    "name",
    ["day_part_case", "day_part_udf", "timestamp_parse", "currency_parse", "share_of_total"]
    + ["top_months_of_texts", "top_months_of_repeated_texts", "income_per_key", "geojson_split"],
)
def test_settings_do_not_matter(spark, duck, conf, name):
    conf(
        spark__sql__ansi__enabled="false",
        spark__sql__adaptive__enabled="false",
        spark__sql__session__timeZone="America/Los_Angeles",
    )
    test_query_equals_its_oracle(spark, duck, name)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert [r["count"] for r in rows] == sorted((r["count"] for r in rows), reverse=True)


def test_ordered_results(spark):
    """The oracle ignores order, so it is checked here."""
    q = QUERIES
    months = [tuple(r)[:1] + (-r["total"], r["ranking"]) for r in q["top_months"](spark, SF).collect()]
    assert months == sorted(months)
    zips = [r["zip_code"] for r in q["income_per_key"](spark, SF).collect()]
    assert zips == sorted(zips)
    prices = [r["o_totalprice"] for r in q["preview_top_n"](spark, SF).collect()]
    assert prices == sorted(prices, reverse=True)
