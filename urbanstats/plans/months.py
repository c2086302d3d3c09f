"""Months with most incidents, per year."""

from pyspark.sql import functions as F

from urbanstats.functions.scalars import parse_timestamp
from urbanstats.operators.aggregates import count_by_month, weighted
from urbanstats.operators.ranking import top_n_per_group

MONTHS_AND_RANKS = """
    WITH months AS (
      SELECT year(occurred) AS year, month(occurred) AS month,
        sum(weight) FILTER (WHERE occurred IS NOT NULL) AS total
      FROM {incidents}
      GROUP BY year(occurred), month(occurred)
      HAVING total > 0
    ), ranks AS (
      SELECT *, row_number() OVER (PARTITION BY year ORDER BY total DESC, month) AS ranking
      FROM months
    )
"""


def occurrences(incidents, when, pattern=None, repeated_texts=False):
    """Times of incidents with a weight; texts are parsed by ``pattern``.

    See :func:`weighted` for ``repeated_texts``.
    """
    occurred = F.col(when) if pattern is None else parse_timestamp(F.col(when), pattern)
    return weighted(incidents, when, repeated_texts).select(occurred.alias("occurred"), "weight")


def top_months(incidents, when, pattern=None, n=3, repeated_texts=False):
    """The ``n`` months with most incidents of each year; earlier month on ties.

    See :func:`occurrences` for the arguments.
    """
    rows = occurrences(incidents, when, pattern, repeated_texts)
    counts = count_by_month(rows, "occurred", weight="weight")
    order = [F.desc("total"), F.asc("month")]
    return top_n_per_group(counts, ["year"], order, n).orderBy("year", "ranking")


def _query_months(incidents, when, pattern, query, repeated_texts=False):
    """Run a query over ``months`` and ``ranks``; Spark names the view and drops it."""
    rows = occurrences(incidents, when, pattern, repeated_texts)
    return incidents.sparkSession.sql(MONTHS_AND_RANKS + query, incidents=rows)


def monthly_counts_sql(incidents, when, pattern=None):
    """Incidents per calendar month, in SQL."""
    return _query_months(incidents, when, pattern, "SELECT * FROM months")


def rank_months_sql(incidents, when, pattern=None):
    """All months ranked within their year, in SQL."""
    return _query_months(incidents, when, pattern, "SELECT * FROM ranks")


def top_months_sql(incidents, when, pattern=None, n=3, repeated_texts=False):
    """Same as :func:`top_months`, in SQL."""
    top = f"SELECT * FROM ranks WHERE ranking <= {int(n)} ORDER BY year, ranking"
    return _query_months(incidents, when, pattern, top, repeated_texts)
