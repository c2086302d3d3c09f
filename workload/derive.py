"""The library's kinds of input, derived in Spark from the driver's tables.

Each function covers its whole table. Where bad values are wanted, a category of
the table decides which rows get them, so that the oracle can say the same.
"""

from pyspark.sql import functions as F

from urbanstats import schemas as S
from urbanstats.sources import read_csv, scratch_path, write_csv

FEATURES_PER_DOCUMENT = 100_000


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def incidents(spark, sf_dir):
    """Events as crime records: texts only, event type as premise."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias(S.CRIME_ID),
        F.date_format(ts, S.CRIME_DATE_PATTERN).alias(S.CRIME_DATE),
        F.date_format(ts, "HHmm").alias(S.CRIME_TIME),
        F.col("event_type").alias(S.CRIME_PREMISE),
    )


def incidents_with_bad_texts(spark, sf_dir):
    """Incidents whose time and date are padded, decimal, missing or of another form."""
    kind = F.col(S.CRIME_PREMISE)
    time, date = F.col(S.CRIME_TIME), F.col(S.CRIME_DATE)
    bad_time = (
        F.when(kind == "view", F.concat(F.lit(" "), time, F.lit(" ")))
        .when(kind == "signup", F.concat(time, F.lit(".5")))
        .when(kind == "purchase", F.lit(None))
        .otherwise(time)
    )
    bad_date = (
        F.when(kind == "view", F.substring(date, 1, 11))
        .when(kind == "signup", F.lit("01/01/2010"))
        .when(kind == "purchase", F.lit(None))
        .otherwise(date)
    )
    return incidents(spark, sf_dir).withColumns({S.CRIME_TIME: bad_time, S.CRIME_DATE: bad_date})


def incident_files(spark, sf_dir):
    """Incidents saved as two sets of CSV files, first and second half of the month.

    Those without a date are in the second one.
    """
    return incident_halves(incidents(spark, sf_dir))


def incident_halves(rows):
    day = F.substring(S.CRIME_DATE, 10, 2).try_cast("int")
    first = F.coalesce(day <= 15, F.lit(False))
    return [save_csv(rows.filter(first), "first_half"), save_csv(rows.filter(~first), "second_half")]


def census_blocks(spark, sf_dir):
    """Customers as census blocks; some keys, populations and nations are unusable."""
    segment, nation, balance = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.when(segment == "MACHINERY", "")
        .when(segment != "FURNITURE", nation.cast("string"))
        .alias(S.BLOCK_ZIP),
        F.when(nation >= 3, F.when(balance < 0, "n/a").otherwise(F.floor(balance).cast("string")))
        .alias(S.BLOCK_POPULATION),
        F.length(segment).cast("string").alias(S.BLOCK_HOUSING),
    )


def incomes(spark, sf_dir):
    """Suppliers as an income table of texts, several rows per key."""
    balance = F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(" "), F.col("s_nationkey"), F.lit(" ")).alias(S.INCOME_ZIP),
        F.col("s_name").alias("Community"),
        F.when(balance < 0, "n/a")
        .otherwise(F.concat(F.lit("$"), F.format_number(balance, 2)))
        .alias(S.INCOME_AMOUNT),
    )


def income_files(spark, sf_dir):
    return save_csv(incomes(spark, sf_dir), "income", sep=";")


def save_csv(df, name, sep=","):
    path = scratch_path(df.sparkSession, name)
    write_csv(df, path, sep=sep)
    return path


def _feature(fields):
    return F.struct(F.lit("Feature").alias("type"), F.struct(*fields).alias("properties"))


def save_feature_lines(df, fields, name):
    """One feature per line."""
    path = scratch_path(df.sparkSession, name)
    df.select(_feature(fields).alias("f")).select("f.*").write.json(path)
    return path


def save_feature_documents(df, fields, name):
    """One GeoJSON document per file, each of at most 100,000 features.

    Row ids are unique whatever the table holds, so the bound holds too.
    """
    path = scratch_path(df.sparkSession, name)
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    document = F.call_function("div", F.col("_row"), F.lit(FEATURES_PER_DOCUMENT))
    (
        rows.groupBy(document.alias("document"))
        .agg(F.collect_list(_feature(fields)).alias("features"))
        .select("document", F.lit("FeatureCollection").alias("type"), "features")
        .write.partitionBy("document")
        .json(path)
    )
    return path


def save_feature_documents_any_order(df, fields, name):
    """One document per line and file part: the type after the properties, one of which is
    the text ``Feature``, and a reference system behind the features. A document has at most
    100,000 features."""
    path = scratch_path(df.sparkSession, name)
    kind = F.lit("Feature").alias("kind")
    feature = F.struct(F.struct(kind, *fields).alias("properties"), F.lit("Feature").alias("type"))
    system = F.struct(
        F.lit("name").alias("type"), F.struct(F.lit("urn:x").alias("name")).alias("properties")
    )
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    number = F.call_function("div", F.col("_row"), F.lit(FEATURES_PER_DOCUMENT))
    documents = rows.groupBy(number.alias("n")).agg(F.collect_list(feature).alias("features"))
    (
        documents.select("n", "features", F.lit("FeatureCollection").alias("type"), system.alias("crs"))
        .write.partitionBy("n")
        .json(path)
    )
    return path


def supplier_features(spark, sf_dir):
    """Suppliers as features of a map: a table and its property columns."""
    df = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias(S.BLOCK_ZIP),
        F.col("s_suppkey").alias(S.BLOCK_POPULATION),
        F.col("s_nationkey").alias(S.BLOCK_HOUSING),
    )
    return df, list(S.BLOCK_COLUMNS)


def messy_lines(spark, sf_dir):
    """Events as hand-made CSV lines, saved as text.

    Quoted fields hold commas and doubled quotes, views are cut to one field, every
    error is followed by a blank line, a stray header line, and a true row whose first
    field is the column's name.
    """
    doubled = F.replace(F.col("props"), F.lit('"'), F.lit('""'))
    full = F.concat(
        F.col("event_id").cast("string"),
        F.lit(',"'),
        F.concat(F.col("event_type"), F.lit(", "), doubled),
        F.lit('",'),
        F.col("user_id").cast("string"),
    )
    line = F.when(F.col("event_type") == "view", F.col("event_id").cast("string")).otherwise(full)
    lines = F.when(
        F.col("event_type") == "error",
        F.array(
            line,
            F.lit(""),
            F.lit("event_id,note,user_id"),
            F.concat(F.lit("event_id,real,"), F.col("user_id").cast("string")),
        ),
    ).otherwise(F.array(line))
    path = scratch_path(spark, "messy")
    table(spark, sf_dir, "events").select(F.explode(lines).alias("value")).write.text(path)
    return path


def lines_of_any_length(spark, sf_dir):
    """Events as hand-made CSV lines of two columns, saved as text.

    Errors have a third field, clicks a quoted comma and two more fields, views a quoted
    comma only, and purchases one field.
    """
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    user = F.col("user_id").cast("string")
    line = (
        F.when(kind == "error", F.concat(key, F.lit(",error,"), user))
        .when(kind == "click", F.concat(key, F.lit(',"a, ""b""",'), user, F.lit(",")))
        .when(kind == "view", F.concat(key, F.lit(',"view, '), user, F.lit('"')))
        .when(kind == "purchase", key)
        .otherwise(F.concat(key, F.lit(","), kind))
    )
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return path


def order_texts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order No"),
        F.col("o_orderstatus").alias("Order Status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order Date"),
        F.col("o_totalprice").alias("Total Price"),
    )


def typed_orders(df):
    """Order texts renamed and cast back."""
    return df.withColumnsRenamed(
        {
            "Order No": "o_orderkey",
            "Order Status": "o_orderstatus",
            "Order Date": "o_orderdate",
            "Total Price": "o_totalprice",
        }
    ).select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        "o_orderstatus",
        "o_orderdate",
        F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
    )


def reread_csv(df, name, sep=",", header=True):
    """Save as CSV and read back."""
    path = scratch_path(df.sparkSession, name)
    mode = "overwrite" if header else "errorifexists"
    write_csv(df, path, sep=sep, header=header, mode=mode)
    columns = None if header else df.columns
    return read_csv(df.sparkSession, path, sep=sep, columns=columns)
