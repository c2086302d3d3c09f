"""Column expressions. All are built-in Spark functions and stay in generated code.

Bad input gives NULL (or the stated default), never an error, with ANSI mode on.
"""

from pyspark.sql import functions as F

# First and last hour of each part of the day; all else is Night.
DAY_PARTS = (
    ("Morning", 5, 11),
    ("Afternoon", 12, 16),
    ("Evening", 17, 20),
)
OTHER_DAY_PART = "Night"

PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def hour_of_hhmm(time):
    """Hour of a HHMM text such as '0130'. NULL where the text is no whole number."""
    return F.call_function("div", _col(time).try_cast("int"), F.lit(100)).cast("int")


def day_part(hour):
    """Part of the day of an hour number. NULL and out-of-range hours are Night."""
    hour = _col(hour)
    name, first, last = DAY_PARTS[0]
    case = F.when(hour.between(first, last), name)
    for name, first, last in DAY_PARTS[1:]:
        case = case.when(hour.between(first, last), name)
    return case.otherwise(OTHER_DAY_PART)


def day_part_of_hhmm(time):
    return day_part(hour_of_hhmm(time))


def parse_timestamp(text, pattern):
    """Timestamp of a text by pattern. NULL where it does not fit."""
    return F.try_to_timestamp(_col(text), F.lit(pattern))


def parse_currency(text):
    """Number in a text such as '$52,806'. NULL where no plain decimal is left.

    Exponents, type letters, NaN and Infinity, which a cast would take, are no amounts.
    """
    number = F.translate(F.trim(_col(text)), "$,", "")
    return F.when(number.rlike(PLAIN_NUMBER), number.try_cast("double"))


def int_or_zero(value):
    """Whole number of a number or text; NULL and junk count as 0.

    Texts such as '10.0' come from numbers stored as doubles, hence the second try.
    """
    value = _col(value)
    return F.coalesce(
        value.try_cast("bigint"),
        value.try_cast("double").try_cast("bigint"),
        F.lit(0).cast("bigint"),
    )


def key_present(key):
    """True where a text key is neither NULL nor empty."""
    key = _col(key)
    return key.isNotNull() & (key != "")


def safe_ratio(numerator, denominator, places=2):
    """Rounded quotient. NULL where the denominator is 0 or a side is NULL."""
    return F.round(F.try_divide(_col(numerator), _col(denominator)), places)
