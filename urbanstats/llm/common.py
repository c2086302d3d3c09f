"""Helpers that several of the operators share."""

from pyspark.sql import functions as F

from urbanstats.sources import scratch_path

# Fixed value: the white space that parts words (space, and tab to carriage return).
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def stored(df, name):
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage: a lost executor costs no more than the tasks that read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A key is frequent when it holds more than one in this many rows, and more than so many.
FREQUENT_SHARE = 100_000
FREQUENT_ROWS = 100_000


def join_counted(rows, keys, on, n, least=FREQUENT_ROWS):
    """``rows`` joined with ``keys``, which has one row per key and its number of rows ``n``.

    Both are to be stored tables, so that Spark can split a key's rows in the join where
    its partition grows large. Frequent keys are not shuffled at all: there are 100,000 of
    them at most, so their list is broadcast and their rows stay where they are.
    """
    most = keys.agg(F.greatest(F.ceil(F.sum(n) / FREQUENT_SHARE), F.lit(least).cast("bigint"))).first()[0]
    frequent = keys.filter(F.col(n) > (most or 0))
    if frequent.isEmpty():
        return rows.join(keys, on)
    few = F.broadcast(frequent)
    rest = rows.join(F.broadcast(frequent.select(on)), on, "left_anti").join(keys.filter(F.col(n) <= most), on)
    return rows.join(few, on).unionByName(rest)


def text_table(docs, id_column="doc_id", text_column="text"):
    """Id and text alone, under the names ``doc_id`` and ``text``; a NULL text is empty.

    Dropping all other columns here keeps them out of every shuffle, and no name of
    the caller's can clash with a helper column.
    """
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )


def words_of(text):
    """The words of a text, as an array; no empty ones."""
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")
