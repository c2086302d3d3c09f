"""Rank in group and top N per group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanstats.operators.names import unused

# How many parts of a group one task merges.
PARTS_PER_MERGE = 64


def _keep_first(df, group, order, n, name):
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def top_n_per_group(df, group, order, n, name="ranking", in_parts=None, parts=None):
    """The first ``n`` rows of each group by ``order``, with their rank.

    ``order`` should end in a tie-break, or equal rows come in any order.

    While ``n`` is below ``spark.sql.optimizer.windowGroupLimitThreshold``, Spark cuts
    each group to ``n`` rows before the shuffle. ``in_parts`` deals each group's rows to
    ``parts`` parts first, ranks each part, and merges the winners 64 parts at a time, so
    that no task sorts a whole group, wherever its rows lie; it is set for a larger
    ``n``. ``parts`` is the number of shuffle partitions unless given. A row's part
    follows a hash of all its columns: the same when a lost task runs again, and known
    without looking at the input. The result is exact either way.
    """
    if in_parts is None:
        limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
        in_parts = n >= limit
    if n < 1:
        raise ValueError("n must be at least 1")
    if in_parts:
        part, rank = unused("_part", df), unused("_rank", df)
        left = int(parts or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        own = F.pmod(_row_hash(df), F.lit(left).cast("bigint"))
        df = df.withColumn(part, own)
        while left > 1:
            df = _keep_first(df, [*group, part], order, n, rank).drop(rank)
            left = -(-left // PARTS_PER_MERGE)
            df = df.withColumn(part, F.floor(F.col(part) / PARTS_PER_MERGE))
        df = df.drop(part)
    return _keep_first(df, group, order, n, name)


def _row_hash(df):
    """Hash of all columns of a row; maps, which have no hash, as their entries in order."""
    columns = [
        F.array_sort(F.map_entries(f"`{c}`")) if kind.startswith("map") else F.col(f"`{c}`")
        for c, kind in df.dtypes
    ]
    return F.xxhash64(*columns)


def rank_months(counts, value="total", name="ranking"):
    """Rank the months of each year, most rows first, earlier month first on ties.

    Takes one row per month, so a group has at most twelve rows.
    """
    window = Window.partitionBy("year").orderBy(F.desc(value), F.asc("month"))
    return counts.withColumn(name, F.row_number().over(window))
