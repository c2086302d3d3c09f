"""Counts, sums and shares.

Every aggregate here is algebraic, so Spark combines rows before the shuffle and
one group holding most of the rows reaches the reducer as one row per map task.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanstats.functions.scalars import int_or_zero, key_present


def count_by(df, *keys, name="count"):
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def weighted(df, column, repeated_texts=False):
    """The values of a column and a ``weight``: 1 for each row, or with
    ``repeated_texts`` each distinct value once, with its number of rows.

    The latter is for columns that get an expensive expression and hold few distinct
    texts, such as HHMM times or dates without a time of day: only distinct ones are
    shuffled and computed. Texts that hardly repeat would all be shuffled.
    """
    if repeated_texts:
        return count_by(df, column, name="weight")
    return df.select(column, F.lit(1).alias("weight"))


def count_by_month(df, timestamp, name="total", weight=None):
    """Rows per calendar month, or the sum of ``weight``; undated rows are left out.

    They are left out by counting timestamps: a filter on one that is parsed from
    text would move below and parse every text twice.
    """
    dated = F.col(timestamp).isNotNull()
    total = F.count(timestamp) if weight is None else F.sum(F.when(dated, F.col(weight)))
    months = df.groupBy(F.year(timestamp).alias("year"), F.month(timestamp).alias("month"))
    return months.agg(total.alias(name)).filter(F.col(name) > 0)


def sum_by_key(df, key, sums):
    """Sum of several columns per non-empty text key, NULL and junk as zero.

    ``sums`` maps each source column to the name of its total. The key is trimmed.
    """
    trimmed = df.select(F.trim(F.col(key)).alias(key), *sums).filter(key_present(key))
    return trimmed.groupBy(key).agg(
        *[F.sum(int_or_zero(source)).alias(total) for source, total in sums.items()]
    )


def grand_total(df, value, name="total"):
    """One row: the sum of a column, NULL when there are no rows."""
    return df.agg(F.sum(value).alias(name))


def row_count(df, name="rows"):
    """One row: how many rows there are."""
    return df.agg(F.count(F.lit(1)).alias(name))


def share_of_total(counts, value="count", name="percentage", few_groups=False):
    """Add each group's percentage of the grand total to rows already aggregated.

    The total is a scalar subquery over ``counts``: it is summed in parallel, and
    Spark reuses the shuffle of the aggregation, so the source is read once however
    many groups and measures there are. ``few_groups`` is for callers whose group count
    is fixed and tiny: there one window over those rows saves a stage.
    """
    if few_groups:
        total = F.sum(value).over(Window.partitionBy())
    else:
        # All columns are used, else the subquery's aggregation would differ from the
        # outer one and Spark would compute both.
        others = [F.count(F.col(f"`{c}`")) for c in counts.columns if c != value]
        row = counts.agg(F.struct(F.sum(value).alias("total"), *others).alias("totals"))
        total = row.scalar().getField("total")
    return counts.withColumn(name, F.round(F.try_divide(F.col(value) * 100.0, total), 2))
