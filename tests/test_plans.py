import json
from functools import partial

import pytest
from pyspark.sql import functions as F

from urbanstats import schemas as S
from urbanstats.functions import day_part_of_hhmm, day_part_udf
from urbanstats.operators import STRATEGIES, rank_months, top_n_per_group
from urbanstats.plans import day_part_share, income_per_key, top_months, top_months_sql
from urbanstats.sources import feature_properties, read_csv, read_features

# Small inputs with the edge cases, and what they must give.
CRIMES = [
    ("0459", "STREET", "2010 Jan 01 12:00:00 AM"),
    ("0500", "STREET", "2010 Jan 31 11:59:59 PM"),
    ("1159", "STREET", "2010 Feb 01 12:00:00 AM"),
    ("1200", "STREET", "2010 Feb 01 12:00:00 PM"),
    ("1659", "STREET", "2010 Mar 01 12:00:00 AM"),
    ("1700", "STREET", "2010 Mar 01 12:00:00 AM"),
    ("2059", "STREET", "2010 Apr 01 12:00:00 AM"),
    ("2100", "STREET", "2011 Jan 01 12:00:00 AM"),
    ("2400", "STREET", "2011 Jan 01 12:00:00 AM"),
    (None, "STREET", "01/01/2010"),
    ("abc", "STREET", None),
    ("12.5", "STREET", "2010"),
    (" 0130 ", "STREET", "2011 Feb 01 12:00:00 AM"),
    ("1300", "SIDEWALK", "2011 Feb 01 12:00:00 AM"),
    ("1300", "street", "2011 Feb 01 12:00:00 AM"),
]


@pytest.fixture
def crimes(spark):
    columns = [S.CRIME_TIME, S.CRIME_PREMISE, S.CRIME_DATE]
    return spark.createDataFrame(CRIMES, ", ".join(f"`{c}` string" for c in columns))


def street():
    return F.col(S.CRIME_PREMISE) == S.STREET


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("udf", [False, True])
def test_day_part_share(crimes, udf, repeated):
    rule = day_part_udf() if udf else day_part_of_hhmm
    got = day_part_share(crimes, where=street(), rule=rule, repeated_texts=repeated)
    assert got.dtypes == [("day_part", "string"), ("count", "bigint"), ("percentage", "double")]
    assert [tuple(r) for r in got.collect()] == [
        ("Night", 7, 53.85),
        ("Afternoon", 2, 15.38),
        ("Evening", 2, 15.38),
        ("Morning", 2, 15.38),
    ]


def test_day_part_share_of_nothing(crimes):
    for repeated in (False, True):
        nothing = F.col(S.CRIME_PREMISE) == "ROOF"
        assert day_part_share(crimes, where=nothing, repeated_texts=repeated).collect() == []


top_months_repeated = partial(top_months, repeated_texts=True)
top_months_repeated_sql = partial(top_months_sql, repeated_texts=True)


def test_day_part_share_of_all(crimes):
    got = {r["day_part"]: r["count"] for r in day_part_share(crimes).collect()}
    assert got == {"Night": 7, "Afternoon": 4, "Evening": 2, "Morning": 2}


@pytest.mark.parametrize(
    "find", [top_months, top_months_sql, top_months_repeated, top_months_repeated_sql]
)
def test_top_months(crimes, find):
    got = find(crimes, S.CRIME_DATE, S.CRIME_DATE_PATTERN)
    assert [tuple(r) for r in got.collect()] == [
        (2010, 1, 2, 1),
        (2010, 2, 2, 2),
        (2010, 3, 2, 3),
        (2011, 2, 3, 1),
        (2011, 1, 2, 2),
    ]
    assert got.columns == ["year", "month", "total", "ranking"]
    only = find(crimes, S.CRIME_DATE, S.CRIME_DATE_PATTERN, n=1)
    assert [tuple(r) for r in only.collect()] == [(2010, 1, 2, 1), (2011, 2, 3, 1)]


# Published result: the months of a year with most incidents, as (month, count).
TOP_MONTHS = {
    2010: [(1, 19524), (3, 18131), (7, 17857)],
    2015: [(8, 15044), (10, 14934), (7, 14852)],
    2020: [(1, 18576), (2, 17284), (5, 17230)],
    2025: [(2, 44), (1, 26), (3, 24)],
}


def test_ranking_of_published_months(spark):
    rows = [(y, m, n) for y, months in TOP_MONTHS.items() for m, n in reversed(months)]
    counts = spark.createDataFrame(rows, "year int, month int, total bigint")
    want = {(y, m, n, i) for y, ms in TOP_MONTHS.items() for i, (m, n) in enumerate(ms, 1)}
    assert {tuple(r) for r in rank_months(counts).collect()} == want
    order = [F.desc("total"), F.asc("month")]
    assert {tuple(r) for r in top_n_per_group(counts, ["year"], order, 3).collect()} == want


BLOCKS = [("90001", 10, 4), ("90001", None, 3), ("90002", 0, 5), ("", 7, 2), (None, 9, 1), ("90003", 8, 2)]
INCOMES = "Zip Code;Community;Estimated Median Income\n90001;a;$1,000\n90002;b;$2,000\n 90003 ;c;n/a\n90004;d;$3,000\n"
INCOME_PER_HEAD = [
    ("90001", 10, 7, 1000.0, 700.0),
    ("90002", 0, 5, 2000.0, None),
    ("90003", 8, 2, None, None),
]


@pytest.fixture
def blocks_and_income(spark, tmp_path):
    features = [
        {"type": "Feature", "properties": {"ZCTA20": z, "POP20": p, "HOUSING20": h}, "geometry": None}
        for z, p, h in BLOCKS
    ]
    path = tmp_path / "blocks.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    income = tmp_path / "income.csv"
    income.write_text(INCOMES)
    return (
        feature_properties(read_features(spark, str(path))),
        read_csv(spark, str(income), sep=";", required=S.INCOME_COLUMNS),
    )


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("strict", [False, True])
def test_income_per_key(blocks_and_income, strategy, strict):
    got = income_per_key(*blocks_and_income, strategy=strategy, strict=strict)
    assert [tuple(r) for r in got.collect()] == INCOME_PER_HEAD[: 1 if strict else 3]


# Published result: people, homes, median income and income per head, by area.
INCOME_GOLDEN = [
    ("90001", 55859, 13820, 52806.0, 13064.66),
    ("90002", 53150, 13036, 46159.0, 11321.33),
    ("90003", 72764, 18244, 47733.0, 11968.02),
    ("90004", 58585, 24944, 54947.0, 23395.03),
    ("90005", 37987, 18721, 44913.0, 22134.32),
    ("90006", 58229, 21425, 41068.0, 15110.72),
    ("90007", 40944, 14971, 33222.0, 12147.48),
    ("90008", 33041, 15112, 49379.0, 22584.53),
    ("90010", 5400, 3152, 76547.0, 44680.77),
    ("90011", 102308, 24348, 47126.0, 11215.39),
]


def test_income_per_key_of_published_rows(spark):
    blocks = spark.createDataFrame(
        [(z, p, h) for z, p, h, _, _ in INCOME_GOLDEN], "ZCTA20 string, POP20 int, HOUSING20 int"
    )
    income = spark.createDataFrame(
        [(z, f"${m:,.0f}") for z, _, _, m, _ in INCOME_GOLDEN],
        "`Zip Code` string, `Estimated Median Income` string",
    )
    got = income_per_key(blocks, income)
    assert [tuple(r) for r in got.collect()] == INCOME_GOLDEN


def test_a_key_with_several_incomes_gives_several_rows(spark):
    blocks = spark.createDataFrame([("1", 2, 4)], "ZCTA20 string, POP20 int, HOUSING20 int")
    income = spark.createDataFrame(
        [("1", "$10"), (" 1", "$20"), ("1", "$20")],
        "`Zip Code` string, `Estimated Median Income` string",
    )
    got = income_per_key(blocks, income).collect()
    assert sorted(r["avg_annual_per_capita_income"] for r in got) == [20.0, 40.0, 40.0]


def test_jobs_from_paths_to_saved_results(spark, tmp_path):
    from urbanstats.plans import save_day_part_share, save_income_per_key, save_top_months
    from urbanstats.sources import read_csv
    from workload import derive
    from workload.queries import QUERIES

    sf = "/root/testdata/sf0.001"

    def saved(name):
        return [tuple(r.asDict().values()) for r in read_csv(spark, str(tmp_path / name)).collect()]

    def texts(df):
        return [tuple(None if v is None else str(v) for v in r) for r in df.collect()]

    crimes = derive.incident_files(spark, sf)
    save_day_part_share(spark, crimes, str(tmp_path / "shares"), premise="error")
    assert saved("shares") == texts(QUERIES["day_part_share"](spark, sf))
    save_top_months(spark, crimes, str(tmp_path / "months"))
    assert len(saved("months")) >= 1
    df = derive.census_blocks(spark, sf)
    blocks = derive.save_feature_documents(df, df.columns, "blocks")
    save_income_per_key(spark, blocks, derive.income_files(spark, sf), str(tmp_path / "income"))
    assert sorted(map(repr, saved("income"))) == sorted(map(repr, texts(QUERIES["income_per_key"](spark, sf))))


def test_undated_incidents_are_in_a_file(spark):
    from urbanstats import schemas as S
    from urbanstats.sources import read_csv
    from workload import derive

    rows = [(str(i), None if i % 10 == 0 else "2010 Jan 01 12:00:00 AM", "0100", "x") for i in range(100)]
    columns = ", ".join(f"`{c}` string" for c in S.CRIME_COLUMNS)
    files = derive.incident_halves(spark.createDataFrame(rows, columns))
    assert read_csv(spark, files, required=S.CRIME_COLUMNS).count() == 100
