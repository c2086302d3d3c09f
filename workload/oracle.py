"""The same queries in SQL for DuckDB, on the driver's tables.

Each is written against the original table, not against a derived file, so a round
trip that loses a value shows up.
"""

DAY_PART = """CASE WHEN hour({ts}) BETWEEN 5 AND 11 THEN 'Morning'
     WHEN hour({ts}) BETWEEN 12 AND 16 THEN 'Afternoon'
     WHEN hour({ts}) BETWEEN 17 AND 20 THEN 'Evening'
     ELSE 'Night' END"""

# Exact half-up rounding of a percentage to two places, in whole numbers.
PERCENT = "((n * 20000 + total) // (2 * total)) / 100.0"

EVENT_DAY_PART = DAY_PART.format(ts="ts")

DAY_PART_SHARE = f"""
WITH counts AS (
  SELECT {EVENT_DAY_PART} AS day_part, count(*) AS n
  FROM events WHERE event_type = 'error' GROUP BY 1
), totals AS (SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total FROM counts)
SELECT day_part, n AS "count", CAST({PERCENT} AS DOUBLE) AS percentage FROM totals
"""

DAY_PART_PER_EVENT = f"""
SELECT event_id,
  CASE WHEN event_type IN ('signup', 'purchase') THEN 'Night' ELSE {EVENT_DAY_PART} END AS day_part
FROM events
"""

MONTHLY = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  count(*) AS total
FROM orders {where} GROUP BY 1, 2
"""

RANKED = """
SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY total DESC, month) AS INTEGER)
  AS ranking
FROM ({monthly})
"""

TOP = "SELECT * FROM ({ranked}) WHERE ranking <= 3"

MONTHLY_ALL = MONTHLY.format(where="")
RANKED_ALL = RANKED.format(monthly=MONTHLY_ALL)
TOP_ALL = TOP.format(ranked=RANKED_ALL)
TOP_OF_TEXTS = TOP.format(ranked=RANKED.format(monthly=MONTHLY.format(where="WHERE o_orderstatus <> 'P'")))

POPULATION = """
SELECT CAST(c_nationkey AS VARCHAR) AS zip_code,
  CAST(sum(CASE WHEN c_nationkey >= 3 AND c_acctbal >= 0 THEN floor(c_acctbal) ELSE 0 END) AS BIGINT)
    AS total_population,
  CAST(sum(length(c_mktsegment)) AS BIGINT) AS total_housing_units
FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'FURNITURE') GROUP BY 1
"""

JOINED = f"""
SELECT p.*, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS median_household_income
FROM ({POPULATION}) p JOIN supplier ON zip_code = CAST(s_nationkey AS VARCHAR)
"""

INCOME_PER_KEY = f"""
SELECT *, round(median_household_income * total_housing_units / NULLIF(total_population, 0), 2)
  AS avg_annual_per_capita_income
FROM ({JOINED})
"""

INCOME_PER_KEY_STRICT = f"""
{INCOME_PER_KEY} WHERE total_population > 0 AND median_household_income IS NOT NULL
"""

INCIDENTS = """
SELECT event_id, strftime(ts, '%Y %b %d %I:%M:%S %p') AS occurred, strftime(ts, '%H%M') AS time,
  event_type AS premise
FROM events
"""

ORDERS = """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice
FROM orders
"""

SUPPLIERS = "SELECT s_name AS name, s_suppkey AS suppkey, s_nationkey AS nationkey FROM supplier"

ORACLE = {
    "day_part_share": DAY_PART_SHARE,
    "day_part_share_udf": DAY_PART_SHARE,
    "day_part_share_udf_on_distinct": DAY_PART_SHARE,
    "day_part_share_csv": DAY_PART_SHARE,
    "day_part_share_parquet": DAY_PART_SHARE,
    "day_part_counts": f"""
        SELECT {EVENT_DAY_PART} AS day_part, count(*) AS "count" FROM events GROUP BY 1
    """,
    "day_part_case": DAY_PART_PER_EVENT,
    "day_part_udf": DAY_PART_PER_EVENT,
    "share_of_total": f"""
        WITH counts AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
        totals AS (SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total FROM counts)
        SELECT event_type, n AS "count", CAST({PERCENT} AS DOUBLE) AS percentage FROM totals
    """,
    "share_of_total_two_measures": f"""
        WITH counts AS (
          SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1),
        totals AS (SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total FROM counts)
        SELECT event_type, n AS "count", users, CAST({PERCENT} AS DOUBLE) AS percentage FROM totals
    """,
    "grand_total": "SELECT count(*) AS total FROM events",
    "row_count": "SELECT count(*) AS rows FROM orders",
    "filter_equal": "SELECT event_id, user_id, value FROM events WHERE event_type = 'error'",
    "filter_key_present": "SELECT doc_id, lang FROM documents WHERE lang NOT IN ('de', 'fr')",
    "timestamp_parse": """
        SELECT event_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS occurred,
          CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month
        FROM (SELECT event_id, CASE WHEN event_type IN ('error', 'click') THEN ts END AS t FROM events)
    """,
    "currency_parse": """
        SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal END AS amount
        FROM customer
    """,
    "monthly_counts": MONTHLY_ALL,
    "monthly_counts_sql": MONTHLY_ALL,
    "rank_months": RANKED_ALL,
    "rank_months_sql": RANKED_ALL,
    "top_months": TOP_ALL,
    "top_months_sql": TOP_ALL,
    "top_months_of_texts": TOP_OF_TEXTS,
    "top_months_of_repeated_texts": TOP_OF_TEXTS,
    "top_months_of_repeated_texts_sql": TOP_OF_TEXTS,
    "top_months_of_texts_sql": TOP_OF_TEXTS,
    "top_n_per_group": """
        SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(r AS INTEGER) AS ranking
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
                ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)
        WHERE r <= 3
    """,
    "top_n_per_group_large": """
        SELECT o_orderpriority, o_orderkey, CAST(r AS INTEGER) AS ranking
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r
              FROM orders)
        WHERE r <= 1500
    """,
    "preview_top_n": """
        SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """,
    "sum_pair_by_key": POPULATION,
    "income_per_key": INCOME_PER_KEY,
    "income_per_key_strict": INCOME_PER_KEY_STRICT,
    "income_per_key_files": INCOME_PER_KEY,
    "join_default": JOINED,
    "join_broadcast": JOINED,
    "join_merge": JOINED,
    "join_shuffle_hash": JOINED,
    "join_replicate_nl": JOINED,
    "join_split_hot_keys": JOINED,
    "join_split_clustered_key": JOINED,
    "join_split_both_sides": """
        SELECT c_nationkey AS nation, c_custkey, s_suppkey,
          CAST(row_number() OVER (PARTITION BY c_nationkey, s_suppkey ORDER BY c_custkey) AS INTEGER) AS place
        FROM customer JOIN supplier ON c_nationkey = s_nationkey
    """,
    "csv_multi_file": INCIDENTS,
    "csv_by_name": INCIDENTS,
    "csv_semicolon": """
        SELECT ' ' || s_nationkey || ' ' AS zip_code, s_name AS community,
          CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS income
        FROM supplier
    """,
    "csv_dirty_rows": """
        SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type || ', ' || props END AS note,
          CASE WHEN event_type <> 'view' THEN user_id END AS user_id
        FROM events
        UNION ALL SELECT NULL, 'real', user_id FROM events WHERE event_type = 'error'
    """,
    "csv_rejected_lines": """
        SELECT event_id || ',error,' || user_id AS line, CAST(3 AS INTEGER) AS fields
        FROM events WHERE event_type = 'error'
        UNION ALL
        SELECT event_id || ',"a, "' || '"b"' || '"",' || user_id || ',', 4 FROM events WHERE event_type = 'click'
    """,
    "csv_without_rejected": """
        SELECT event_id,
          CASE event_type WHEN 'view' THEN 'view, ' || user_id WHEN 'purchase' THEN NULL ELSE event_type END AS note
        FROM events WHERE event_type NOT IN ('error', 'click')
    """,
    "csv_sink_roundtrip": ORDERS,
    "csv_line_ends_roundtrip": "SELECT doc_id, nullif(text, '') AS text, lang FROM documents",
    "csv_single_file": DAY_PART_SHARE,
    "csv_sink_without_header": ORDERS,
    "csv_to_parquet": ORDERS,
    "parquet_scan": ORDERS,
    "geojson_features": SUPPLIERS,
    "geojson_document_lines": SUPPLIERS,
    "geojson_feature_lines": SUPPLIERS,
    "geojson_split": SUPPLIERS,
    "geojson_free_order": SUPPLIERS,
}
