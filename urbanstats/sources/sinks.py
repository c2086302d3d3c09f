"""Saving results."""

from pyspark.sql import functions as F

from urbanstats.operators.aggregates import row_count
from urbanstats.operators.names import unused
from urbanstats.sources.csv_files import CSV_QUOTING, read_csv
from urbanstats.sources.scratch import scratch_path
from urbanstats.sources.sessions import session_with

# Blanks at the ends of a value are kept, unlike by default.
CSV_WRITE = {**CSV_QUOTING, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df, path, sep=",", header=True, mode="overwrite", single_file_rows=0, order=()):
    """Save as CSV, in parallel: one file per partition.

    With ``order`` the rows are sorted over all files, first file first.
    ``single_file_rows`` saves results of up to that many rows as one file, in ``order``
    or else in that of ``df``, and larger ones whole, in parallel.

    Either computes ``df`` once: it is staged as Parquet in the scratch folder, the rows
    are counted from the footers, and sorting samples the staged rows. Nothing is cached,
    and no rows go to the driver.
    """
    if not order and not single_file_rows:
        _save_csv(df, path, sep, header, mode)
        return
    spark, staged = df.sparkSession, scratch_path(df.sparkSession, "staged")
    row = unused("_row", df)
    df.withColumn(row, F.monotonically_increasing_id()).write.parquet(staged)
    rows = spark.read.parquet(staged)
    if rows.count() <= single_file_rows:
        rows = rows.coalesce(1).sortWithinPartitions(*(order or [row]))
    elif order:
        rows = rows.orderBy(*order)
    _save_csv(rows.drop(row), path, sep, header, mode)


def _save_csv(df, path, sep, header, mode):
    df.write.options(**CSV_WRITE).option("sep", sep).csv(path, header=header, mode=mode)


def csv_to_parquet(spark, paths, out, sep=",", required=(), split_bytes="1g"):
    """Convert header CSV files to Parquet and return the number of rows written.

    The count comes from the Parquet footers, not from a second CSV scan. One task
    reads up to ``split_bytes`` of a large input, so that the compressed files do
    not come out small; a small input is still spread over all cores. That setting is made
    in a session of its own, which has all others of ``spark``.
    """
    reading = session_with(spark, spark__sql__files__maxPartitionBytes=split_bytes)
    read_csv(reading, paths, sep=sep, required=required).write.mode("overwrite").parquet(out)
    return row_count(spark.read.parquet(out)).first()["rows"]


def preview(df, order, n=10):
    """The first ``n`` rows by ``order``; each task keeps only its own ``n`` best."""
    return df.orderBy(*order).limit(n)
