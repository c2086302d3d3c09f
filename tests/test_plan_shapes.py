"""The physical plans: what is read, what is shuffled, what leaves the JVM."""

import re

import pytest
from pyspark.sql import functions as F

from urbanstats import schemas as S
from urbanstats.functions import day_part_udf
from urbanstats.plans import day_part_share, income_per_key, top_months, top_months_sql
from urbanstats.sources import feature_properties, read_csv, read_features, write_csv
from workload import derive
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def incident_parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "incidents")
    derive.incidents(spark, SF).write.parquet(path)
    return path


def test_day_part_share_pushes_filter_and_prunes(spark, incident_parquet, plan):
    error = F.col(S.CRIME_PREMISE) == "error"
    text = plan(day_part_share(spark.read.parquet(incident_parquet), where=error))
    assert "EqualTo(`Premis Desc`,error)" in text
    assert "ReadSchema: struct<TIME OCC:string,Premis Desc:string>" in text
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and text.count("Batched: true") == 1
    assert "Python" not in text and "ArrowEval" not in text


def test_day_part_share_on_csv_reads_two_columns_once(spark, tmp_path, plan):
    path = str(tmp_path / "csv")
    write_csv(derive.incidents(spark, SF), path)
    error = F.col(S.CRIME_PREMISE) == "error"
    text = plan(day_part_share(read_csv(spark, path), where=error))
    assert "ReadSchema: struct<TIME OCC:string,Premis Desc:string>" in text
    assert text.count("Scan csv") == 2


def test_time_is_parsed_once_per_row(spark, incident_parquet, plan, conf):
    conf(spark__sql__adaptive__enabled="false")
    code = plan(day_part_share(spark.read.parquet(incident_parquet)), mode="codegen")
    assert code.count("toIntExact") == 1


def test_udf_sees_distinct_times(spark, incident_parquet, plan):
    """The Python step comes after the first aggregation, not in the scan's stage."""
    incidents = spark.read.parquet(incident_parquet)
    tree = plan(day_part_share(incidents, rule=day_part_udf(), repeated_texts=True)).split("\n\n")[0]
    names = re.findall(r"- (\w+)", tree)
    python = names.index("ArrowEvalPython")
    assert names[python + 1] == "HashAggregate" and names.count("HashAggregate") == 4


@pytest.mark.parametrize("find", [top_months, top_months_sql])
def test_dates_are_parsed_once_per_row(spark, incident_parquet, plan, conf, find):
    conf(spark__sql__adaptive__enabled="false")
    found = find(spark.read.parquet(incident_parquet), S.CRIME_DATE, S.CRIME_DATE_PATTERN)
    assert plan(found, mode="codegen").count(".parse(") == 1
    assert "ReadSchema: struct<DATE OCC:string>" in plan(found)
    assert "WindowGroupLimit" in plan(found)


def test_sql_and_dataframe_months_have_one_plan(spark, incident_parquet, plan):
    incidents = spark.read.parquet(incident_parquet)

    def operators(find):
        text = plan(find(incidents, S.CRIME_DATE, S.CRIME_DATE_PATTERN))
        names = re.findall(r"- (\w+)", text.split("\n\n")[0])
        return [name for name in names if name != "Project"]

    assert operators(top_months) == operators(top_months_sql)


def test_income_per_key_stays_in_the_jvm(spark, tmp_path, plan, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    blocks, incomes = derive.census_blocks(spark, SF), derive.incomes(spark, SF)
    text = plan(income_per_key(blocks, incomes))
    assert "Python" not in text and "ExistingRDD" not in text
    # The sums' partitioning serves the join: one shuffle per side, one for the order.
    assert text.count("Batched: ") == 2
    assert text.count("Arguments: hashpartitioning") == 2
    assert text.count("Arguments: rangepartitioning") == 1


def test_features_are_parsed_once(spark, plan):
    df, fields = derive.supplier_features(spark, SF)
    path = derive.save_feature_documents(df, fields, "features")
    wanted = "ZCTA20 is not null and POP20 <> ''"
    rows = feature_properties(read_features(spark, path, fields, check=False), fields)
    assert plan(rows.filter(wanted)).count("from_json") == 1
    # With the check they were parsed in its own pass, and filters reach the stored rows.
    checked = plan(feature_properties(read_features(spark, path, fields), fields).filter(wanted))
    assert "from_json" not in checked and "IsNotNull(feature.properties.ZCTA20)" in checked


def test_no_product_of_tables_unless_asked(spark, plan):
    for name, query in QUERIES.items():
        if name != "join_replicate_nl":
            text = plan(query(spark, SF))
            assert "Cartesian" not in text and "NestedLoop" not in text, name


def test_a_callers_rule_gets_no_single_task_window(spark, incident_parquet, plan):
    incidents = spark.read.parquet(incident_parquet)
    assert "Window" not in plan(day_part_share(incidents, rule=lambda time: time))
    for rule in (day_part_udf(), None):
        text = plan(day_part_share(incidents, **({"rule": rule} if rule else {})))
        assert "Window" in text
