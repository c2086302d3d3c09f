"""One query per operator of the library, over the driver's tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanstats import schemas as S
from urbanstats.functions import (
    day_part_of_hhmm,
    day_part_udf,
    key_present,
    parse_currency,
    parse_timestamp,
)
from urbanstats.operators import (
    count_by,
    count_by_month,
    grand_total,
    join_with_strategy,
    rank_months,
    row_count,
    share_of_total,
    top_n_per_group,
)
from urbanstats.plans import (
    day_part_counts,
    day_part_share,
    income_per_key,
    income_table,
    population_by_key,
    top_months,
    top_months_sql,
)
from urbanstats.plans.months import monthly_counts_sql, rank_months_sql
from urbanstats.sources import (
    csv_to_parquet,
    feature_properties,
    preview,
    read_csv,
    read_csv_by_name,
    read_features,
    rejected_lines,
    scratch_path,
    write_csv,
)
from workload import derive



def _errors():
    return F.col(S.CRIME_PREMISE) == "error"


def _event_counts(spark, sf_dir):
    return count_by(derive.table(spark, sf_dir, "events"), "event_type")


# Share of incidents per part of day, by every way in.


def day_part_share_native(spark, sf_dir):
    return day_part_share(derive.incidents(spark, sf_dir), where=_errors())


def day_part_share_udf(spark, sf_dir):
    return day_part_share(derive.incidents(spark, sf_dir), where=_errors(), rule=day_part_udf())


def day_part_share_udf_on_distinct(spark, sf_dir):
    incidents = derive.incidents(spark, sf_dir)
    return day_part_share(incidents, where=_errors(), rule=day_part_udf(), repeated_texts=True)


def day_part_share_csv(spark, sf_dir):
    files = derive.incident_files(spark, sf_dir)
    return day_part_share(read_csv(spark, files, required=S.CRIME_COLUMNS), where=_errors())


def day_part_share_parquet(spark, sf_dir):
    out = scratch_path(spark, "incidents")
    csv_to_parquet(spark, derive.incident_files(spark, sf_dir), out)
    return day_part_share(spark.read.parquet(out), where=_errors())


def day_part_counts_by_event(spark, sf_dir):
    return day_part_counts(derive.incidents(spark, sf_dir))


def _day_part_per_event(spark, sf_dir, rule):
    rows = derive.incidents_with_bad_texts(spark, sf_dir)
    return rows.select(
        F.col(S.CRIME_ID).cast("bigint").alias("event_id"),
        rule(F.col(S.CRIME_TIME)).alias("day_part"),
    )


def day_part_case(spark, sf_dir):
    return _day_part_per_event(spark, sf_dir, day_part_of_hhmm)


def day_part_by_udf(spark, sf_dir):
    return _day_part_per_event(spark, sf_dir, day_part_udf())


# Aggregates, filters and expressions.


def share_per_event_type(spark, sf_dir):
    return share_of_total(_event_counts(spark, sf_dir))


def share_of_total_two_measures(spark, sf_dir):
    events = derive.table(spark, sf_dir, "events")
    counts = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("count"), F.sum("user_id").alias("users")
    )
    return share_of_total(counts)


def event_total(spark, sf_dir):
    return grand_total(_event_counts(spark, sf_dir), "count")


def order_rows(spark, sf_dir):
    return row_count(derive.table(spark, sf_dir, "orders"))


def filter_equal(spark, sf_dir):
    events = derive.table(spark, sf_dir, "events")
    return events.filter(F.col("event_type") == "error").select("event_id", "user_id", "value")


def filter_key_present(spark, sf_dir):
    lang = F.when(F.col("lang") == "de", "").when(F.col("lang") != "fr", F.col("lang"))
    documents = derive.table(spark, sf_dir, "documents").select("doc_id", lang.alias("lang"))
    return documents.filter(key_present("lang"))


def timestamp_parse(spark, sf_dir):
    parsed = parse_timestamp(F.col(S.CRIME_DATE), S.CRIME_DATE_PATTERN)
    rows = derive.incidents_with_bad_texts(spark, sf_dir).select(S.CRIME_ID, parsed.alias("t"))
    return rows.select(
        F.col(S.CRIME_ID).cast("bigint").alias("event_id"),
        F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("occurred"),
        F.year("t").alias("year"),
        F.month("t").alias("month"),
    )


def currency_parse(spark, sf_dir):
    text = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "n/a").otherwise(
        F.concat(F.lit(" $"), F.format_number("c_acctbal", 2))
    )
    customers = derive.table(spark, sf_dir, "customer")
    return customers.select("c_custkey", parse_currency(text).alias("amount"))


# Months.


def monthly_counts(spark, sf_dir):
    return count_by_month(derive.table(spark, sf_dir, "orders"), "o_orderdate")


def monthly_counts_by_sql(spark, sf_dir):
    return monthly_counts_sql(derive.table(spark, sf_dir, "orders"), "o_orderdate")


def rank_all_months(spark, sf_dir):
    return rank_months(monthly_counts(spark, sf_dir))


def rank_all_months_by_sql(spark, sf_dir):
    return rank_months_sql(derive.table(spark, sf_dir, "orders"), "o_orderdate")


def top_order_months(spark, sf_dir):
    return top_months(derive.table(spark, sf_dir, "orders"), "o_orderdate")


def top_order_months_by_sql(spark, sf_dir):
    return top_months_sql(derive.table(spark, sf_dir, "orders"), "o_orderdate")


def _dated_orders(spark, sf_dir):
    """Orders whose date is a text; pending ones have it in a form that is not read."""
    date = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "MM/dd/yyyy"))
    date = date.otherwise(F.date_format("o_orderdate", S.CRIME_DATE_PATTERN))
    return derive.table(spark, sf_dir, "orders").select(date.alias(S.CRIME_DATE))


def top_months_of_texts(spark, sf_dir):
    return top_months(_dated_orders(spark, sf_dir), S.CRIME_DATE, S.CRIME_DATE_PATTERN)


def top_months_of_repeated_texts(spark, sf_dir):
    orders = _dated_orders(spark, sf_dir)
    return top_months(orders, S.CRIME_DATE, S.CRIME_DATE_PATTERN, repeated_texts=True)


def top_months_of_repeated_texts_by_sql(spark, sf_dir):
    orders = _dated_orders(spark, sf_dir)
    return top_months_sql(orders, S.CRIME_DATE, S.CRIME_DATE_PATTERN, repeated_texts=True)


def top_months_of_texts_by_sql(spark, sf_dir):
    return top_months_sql(_dated_orders(spark, sf_dir), S.CRIME_DATE, S.CRIME_DATE_PATTERN)


def top_orders_per_priority(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders")
    rows = orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return top_n_per_group(rows, ["o_orderpriority"], order, 3, in_parts=True)


def top_orders_per_priority_large(spark, sf_dir):
    """More rows per group than Spark cuts groups to before the shuffle."""
    orders = derive.table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderpriority").alias("_part"), F.col("o_orderkey").alias("_rank"))
    top = top_n_per_group(rows.repartition(100, "_rank"), ["_part"], [F.asc("_rank")], 1500)
    return top.withColumnsRenamed({"_part": "o_orderpriority", "_rank": "o_orderkey"})


def preview_top_orders(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return preview(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


# Income per head.


def population_per_nation(spark, sf_dir):
    return population_by_key(derive.census_blocks(spark, sf_dir))


def income_per_nation(spark, sf_dir):
    return income_per_key(derive.census_blocks(spark, sf_dir), derive.incomes(spark, sf_dir))


def income_per_nation_strict(spark, sf_dir):
    return income_per_key(
        derive.census_blocks(spark, sf_dir), derive.incomes(spark, sf_dir), strict=True
    )


def income_per_nation_from_files(spark, sf_dir):
    blocks = derive.save_feature_documents(
        derive.census_blocks(spark, sf_dir), S.BLOCK_COLUMNS, "blocks"
    )
    income = read_csv(spark, derive.income_files(spark, sf_dir), ";", required=S.INCOME_COLUMNS)
    return income_per_key(feature_properties(read_features(spark, blocks)), income)


def _join_by(strategy, **limits):
    def query(spark, sf_dir):
        population = population_by_key(derive.census_blocks(spark, sf_dir))
        incomes = income_table(derive.incomes(spark, sf_dir))
        return join_with_strategy(population, incomes, "zip_code", strategy, **limits)

    return query


def join_split_clustered_key(spark, sf_dir):
    """Hot keys are split also where the right side's rows lie together by key."""
    population = population_by_key(derive.census_blocks(spark, sf_dir))
    incomes = income_table(derive.incomes(spark, sf_dir)).repartition(4, "zip_code")
    return join_with_strategy(
        population, incomes, "zip_code", "merge", split_hot_keys=True, min_piece_rows=4
    )


def join_split_both_sides(spark, sf_dir):
    """Ranked customers with the suppliers of their nation: keys are frequent on the left."""
    ranked = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    customers = derive.table(spark, sf_dir, "customer").withColumn("place", ranked)
    left = customers.select(F.col("c_nationkey").alias("nation"), "c_custkey", "place")
    suppliers = derive.table(spark, sf_dir, "supplier")
    right = suppliers.select(F.col("s_nationkey").alias("nation"), "s_suppkey")
    return join_with_strategy(left, right, "nation", "merge", split_hot_keys="both", min_piece_rows=4)


# Files.


def csv_multi_file(spark, sf_dir):
    rows = read_csv(spark, derive.incident_files(spark, sf_dir), required=S.CRIME_COLUMNS)
    return _typed_incidents(rows)


def csv_by_name(spark, sf_dir):
    """The second set of files has its columns in another order."""
    first, second = derive.incident_files(spark, sf_dir)
    swapped = derive.save_csv(
        read_csv(spark, second).select(*reversed(S.CRIME_COLUMNS)), "swapped"
    )
    return _typed_incidents(read_csv_by_name(spark, [first, swapped], required=S.CRIME_COLUMNS))


def _typed_incidents(rows):
    return rows.select(
        F.col(S.CRIME_ID).try_cast("bigint").alias("event_id"),
        F.col(S.CRIME_DATE).alias("occurred"),
        F.col(S.CRIME_TIME).alias("time"),
        F.col(S.CRIME_PREMISE).alias("premise"),
    )


def csv_semicolon(spark, sf_dir):
    rows = read_csv(spark, derive.income_files(spark, sf_dir), sep=";", required=S.INCOME_COLUMNS)
    return rows.select(
        F.col(S.INCOME_ZIP).alias("zip_code"),
        F.col("Community").alias("community"),
        parse_currency(S.INCOME_AMOUNT).alias("income"),
    )


def csv_dirty_rows(spark, sf_dir):
    lines = derive.messy_lines(spark, sf_dir)
    rows = read_csv(spark, lines, columns=["event_id", "note", "user_id"])
    return rows.select(
        F.col("event_id").try_cast("bigint").alias("event_id"),
        "note",
        F.col("user_id").try_cast("bigint").alias("user_id"),
    )


def csv_rejected_lines(spark, sf_dir):
    path = derive.lines_of_any_length(spark, sf_dir)
    return rejected_lines(spark, path, columns=["event_id", "note"]).select("line", "fields")


def csv_without_rejected(spark, sf_dir):
    path = derive.lines_of_any_length(spark, sf_dir)
    rows = read_csv(spark, path, columns=["event_id", "note"], long_lines="drop")
    return rows.select(F.col("event_id").try_cast("bigint").alias("event_id"), "note")


def csv_sink_roundtrip(spark, sf_dir):
    return derive.typed_orders(derive.reread_csv(derive.order_texts(spark, sf_dir), "orders"))


def csv_line_ends_roundtrip(spark, sf_dir):
    """Documents, whose texts have line ends, quotes and commas, by way of CSV files."""
    documents = derive.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = derive.save_csv(documents, "documents")
    rows = read_csv(spark, path, line_ends_in_values=True)
    return rows.select(F.col("doc_id").try_cast("bigint").alias("doc_id"), "text", "lang")


def csv_sink_without_header(spark, sf_dir):
    rows = derive.reread_csv(derive.order_texts(spark, sf_dir), "orders", header=False)
    return derive.typed_orders(rows)


def csv_single_file(spark, sf_dir):
    """A small result saved as one file."""
    path = scratch_path(spark, "shares")
    write_csv(day_part_share_native(spark, sf_dir), path, single_file_rows=1000)
    return read_csv(spark, path).select(
        "day_part",
        F.col("count").cast("bigint").alias("count"),
        F.col("percentage").cast("double").alias("percentage"),
    )


def csv_to_parquet_orders(spark, sf_dir):
    source, out = scratch_path(spark, "orders_csv"), scratch_path(spark, "orders_parquet")
    write_csv(derive.order_texts(spark, sf_dir), source)
    csv_to_parquet(spark, source, out)
    return derive.typed_orders(spark.read.parquet(out))


def parquet_scan(spark, sf_dir):
    path = scratch_path(spark, "orders")
    derive.order_texts(spark, sf_dir).write.parquet(path)
    return derive.typed_orders(spark.read.parquet(path))


def _features_by(layout, any_order=False):
    def query(spark, sf_dir):
        df, fields = derive.supplier_features(spark, sf_dir)
        if layout == "feature_lines":
            path = derive.save_feature_lines(df, fields, "supplier_features")
        elif any_order:
            path = derive.save_feature_documents_any_order(df, fields, "supplier_any_order")
        else:
            path = derive.save_feature_documents(df, fields, "supplier_documents")
        rows = feature_properties(read_features(spark, path, fields, layout), fields)
        return rows.select(
            F.col(S.BLOCK_ZIP).alias("name"),
            F.col(S.BLOCK_POPULATION).try_cast("bigint").alias("suppkey"),
            F.col(S.BLOCK_HOUSING).try_cast("int").alias("nationkey"),
        )

    return query


QUERIES = {
    "day_part_share": day_part_share_native,
    "day_part_share_udf": day_part_share_udf,
    "day_part_share_udf_on_distinct": day_part_share_udf_on_distinct,
    "day_part_share_csv": day_part_share_csv,
    "day_part_share_parquet": day_part_share_parquet,
    "day_part_counts": day_part_counts_by_event,
    "day_part_case": day_part_case,
    "day_part_udf": day_part_by_udf,
    "share_of_total": share_per_event_type,
    "share_of_total_two_measures": share_of_total_two_measures,
    "grand_total": event_total,
    "row_count": order_rows,
    "filter_equal": filter_equal,
    "filter_key_present": filter_key_present,
    "timestamp_parse": timestamp_parse,
    "currency_parse": currency_parse,
    "monthly_counts": monthly_counts,
    "monthly_counts_sql": monthly_counts_by_sql,
    "rank_months": rank_all_months,
    "rank_months_sql": rank_all_months_by_sql,
    "top_months": top_order_months,
    "top_months_sql": top_order_months_by_sql,
    "top_months_of_texts": top_months_of_texts,
    "top_months_of_repeated_texts": top_months_of_repeated_texts,
    "top_months_of_repeated_texts_sql": top_months_of_repeated_texts_by_sql,
    "top_months_of_texts_sql": top_months_of_texts_by_sql,
    "top_n_per_group": top_orders_per_priority,
    "top_n_per_group_large": top_orders_per_priority_large,
    "preview_top_n": preview_top_orders,
    "sum_pair_by_key": population_per_nation,
    "income_per_key": income_per_nation,
    "income_per_key_strict": income_per_nation_strict,
    "income_per_key_files": income_per_nation_from_files,
    "join_default": _join_by("default"),
    "join_broadcast": _join_by("broadcast"),
    "join_merge": _join_by("merge"),
    "join_shuffle_hash": _join_by("shuffle_hash"),
    "join_replicate_nl": _join_by("shuffle_replicate_nl"),
    "join_split_hot_keys": _join_by("merge", split_hot_keys=True, min_piece_rows=4),
    "join_split_clustered_key": join_split_clustered_key,
    "join_split_both_sides": join_split_both_sides,
    "csv_multi_file": csv_multi_file,
    "csv_by_name": csv_by_name,
    "csv_semicolon": csv_semicolon,
    "csv_dirty_rows": csv_dirty_rows,
    "csv_rejected_lines": csv_rejected_lines,
    "csv_without_rejected": csv_without_rejected,
    "csv_sink_roundtrip": csv_sink_roundtrip,
    "csv_line_ends_roundtrip": csv_line_ends_roundtrip,
    "csv_single_file": csv_single_file,
    "csv_sink_without_header": csv_sink_without_header,
    "csv_to_parquet": csv_to_parquet_orders,
    "parquet_scan": parquet_scan,
    "geojson_features": _features_by("document"),
    "geojson_document_lines": _features_by("document_lines"),
    "geojson_feature_lines": _features_by("feature_lines"),
    "geojson_split": _features_by("split"),
    "geojson_free_order": _features_by("split", any_order=True),
}
