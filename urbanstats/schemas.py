"""Column names and schemas of the open-data inputs."""

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Column names and the date pattern as published in the open data.
CRIME_ID = "DR_NO"
CRIME_TIME = "TIME OCC"
CRIME_DATE = "DATE OCC"
CRIME_PREMISE = "Premis Desc"
CRIME_DATE_PATTERN = "yyyy MMM dd hh:mm:ss a"
STREET = "STREET"
INCOME_ZIP = "Zip Code"
INCOME_AMOUNT = "Estimated Median Income"
BLOCK_ZIP = "ZCTA20"
BLOCK_POPULATION = "POP20"
BLOCK_HOUSING = "HOUSING20"

# The header of the published result of the income job.
AREA = "zip_code"
AREA_POPULATION = "total_population"
AREA_HOUSING = "total_housing_units"
AREA_INCOME = "median_household_income"
INCOME_PER_HEAD = "avg_annual_per_capita_income"

CRIME_COLUMNS = (CRIME_ID, CRIME_DATE, CRIME_TIME, CRIME_PREMISE)
INCOME_COLUMNS = (INCOME_ZIP, INCOME_AMOUNT)
BLOCK_COLUMNS = (BLOCK_ZIP, BLOCK_POPULATION, BLOCK_HOUSING)


def text_columns(names):
    """Schema in which every named column is a nullable string."""
    return StructType([StructField(name, StringType()) for name in names])


def feature_schema(fields=BLOCK_COLUMNS):
    """One GeoJSON feature, pruned to the wanted properties.

    Properties are read as text so that a number, a quoted number and junk all
    arrive; the geometry is left out and is never built.
    """
    return StructType([StructField("properties", text_columns(fields))])


def feature_collection_schema(fields=BLOCK_COLUMNS):
    """A GeoJSON document: an array of features."""
    return StructType([StructField("features", ArrayType(feature_schema(fields)))])
