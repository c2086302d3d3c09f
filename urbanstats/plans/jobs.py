"""The three jobs from input paths to a saved result."""

from pyspark.sql import functions as F

from urbanstats import schemas as S
from urbanstats.plans.day_parts import day_part_share
from urbanstats.plans.income import income_per_key
from urbanstats.plans.months import top_months
from urbanstats.sources import feature_properties, read_csv, read_features, write_csv

# Results up to this many rows are saved as one file.
SMALL_RESULT = 1000


def save_day_part_share(spark, crime_paths, out, premise=S.STREET):
    """Share of incidents at a premise per part of day, from CSV files to a CSV result."""
    crimes = read_csv(spark, crime_paths, required=S.CRIME_COLUMNS)
    shares = day_part_share(crimes, where=F.col(S.CRIME_PREMISE) == premise)
    write_csv(shares, out, single_file_rows=SMALL_RESULT, order=[F.desc("percentage"), "day_part"])


def save_top_months(spark, crime_paths, out, n=3):
    """The months with most incidents of each year, from CSV files to a CSV result."""
    crimes = read_csv(spark, crime_paths, required=S.CRIME_COLUMNS)
    months = top_months(crimes, S.CRIME_DATE, S.CRIME_DATE_PATTERN, n)
    write_csv(months, out, single_file_rows=SMALL_RESULT, order=["year", "ranking"])


def save_income_per_key(
    spark, block_paths, income_paths, out, strategy="default", strict=False, layout="split"
):
    """Income per head and area, from GeoJSON and CSV files to a CSV result."""
    blocks = feature_properties(read_features(spark, block_paths, layout=layout))
    income = read_csv(spark, income_paths, sep=";", required=S.INCOME_COLUMNS)
    rows = income_per_key(blocks, income, strategy, strict)
    write_csv(rows, out, single_file_rows=SMALL_RESULT, order=[S.AREA, S.AREA_INCOME])
