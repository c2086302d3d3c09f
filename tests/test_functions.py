import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urbanstats.functions import (
    day_part_of_hhmm,
    day_part_udf,
    hour_of_hhmm,
    int_or_zero,
    key_present,
    parse_currency,
    parse_timestamp,
    safe_ratio,
)
from urbanstats.schemas import CRIME_DATE_PATTERN


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def apply(spark, function, values):
    rows = texts(spark, values).select("x", function(F.col("x")).alias("y")).collect()
    return [r["y"] for r in rows]


DAY_PART_CASES = {
    "0000": "Night",
    "0459": "Night",
    "0500": "Morning",
    "1159": "Morning",
    "1200": "Afternoon",
    "1659": "Afternoon",
    "1700": "Evening",
    "2059": "Evening",
    "2100": "Night",
    "2400": "Night",
    "9999": "Night",
    "-0600": "Night",
    " 0130 ": "Night",
    " 1330\t": "Afternoon",
    "+1330": "Afternoon",
    "12.5": "Night",
    "1230.5": "Night",
    "1_300": "Night",
    "13 00": "Night",
    "\u00a01300": "Night",
    "99999999999999": "Night",
    "9" * 30: "Night",
    "-" + "9" * 30: "Night",
    "0" * 30 + "1300": "Afternoon",
    "abc": "Night",
    "": "Night",
    None: "Night",
}


@pytest.mark.parametrize("udf", [False, True])
def test_day_part(spark, udf):
    rule = day_part_udf() if udf else day_part_of_hhmm
    assert apply(spark, rule, list(DAY_PART_CASES)) == list(DAY_PART_CASES.values())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.integers(-3000, 30000).map(str),
            st.integers(-(10**14), 10**14).map(str),
            st.integers(0, 2400).map(lambda n: f"{n:030d}"),
            st.integers(0, 2400).map(lambda n: f" {n:04d}"),
            st.text(alphabet="0123456789 +-._eE\t\n\x7f\u00a0x", max_size=7),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_day_part_variants_agree(spark, values):
    assert apply(spark, day_part_udf(), values) == apply(spark, day_part_of_hhmm, values)


def test_hour(spark):
    assert apply(spark, hour_of_hhmm, ["0059", "0100", "2359", "x", None]) == [0, 1, 23, None, None]


def test_timestamp(spark):
    def parse(c):
        return F.date_format(parse_timestamp(c, CRIME_DATE_PATTERN), "yyyy-MM-dd HH:mm:ss")

    got = apply(
        spark,
        parse,
        ["2010 Jan 01 12:00:00 AM", "2010 Jan 31 11:59:59 PM", "2010 Feb 01 12:00:00 PM"]
        + ["01/01/2010", "2010 Feb 30 01:00:00 AM", "", None],
    )
    want = ["2010-01-01 00:00:00", "2010-01-31 23:59:59", "2010-02-01 12:00:00"]
    assert got == want + [None] * 4


def test_timestamp_type(spark):
    row = texts(spark, ["2010 Jan 01 01:00:00 AM"]).select(
        parse_timestamp("x", CRIME_DATE_PATTERN).alias("t")
    )
    assert row.dtypes == [("t", "timestamp")]
    assert row.first()["t"].replace(tzinfo=None).date() == datetime.date(2010, 1, 1)


def test_currency(spark):
    values = ["$52,806", " $1,234.56 ", "-$5", "7", "n/a", "$", "", None]
    assert apply(spark, parse_currency, values) == [52806.0, 1234.56, -5.0, 7.0] + [None] * 4


def test_int_or_zero(spark):
    values = ["10", "10.0", "12.9", "9007199254740993", "1e3", "x", "NaN", "1e30", "", None]
    assert apply(spark, int_or_zero, values) == [10, 10, 12, 9007199254740993, 1000, 0, 0, 0, 0, 0]
    numbers = spark.createDataFrame([(1.0,), (2.9,), (None,)], "x double")
    assert [r[0] for r in numbers.select(int_or_zero("x")).collect()] == [1, 2, 0]


def test_key_present(spark):
    kept = texts(spark, ["a", "", " ", None]).filter(key_present("x")).collect()
    assert [r["x"] for r in kept] == ["a", " "]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 3), (1.0, 0), (None, 1), (1.0, None)], "a double, b int")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [0.33, None, None, None]


def test_currency_is_a_plain_decimal(spark):
    texts = {"$1,234.50": 1234.5, " -5 ": -5.0, ".5": 0.5, "5.": 5.0, "+7": 7.0}
    texts |= dict.fromkeys(["5D", "1e3", "NaN", "Infinity", "-", ".", "", "1 2", None])
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", parse_currency("t").alias("n")).collect()
    assert {r["t"]: r["n"] for r in got} == texts
