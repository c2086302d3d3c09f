"""CSV files as tables of strings, split over tasks by Spark's reader."""

import re
from functools import reduce
from operator import and_

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from urbanstats.operators.names import unused
from urbanstats.schemas import text_columns
from urbanstats.sources.records import read_records

# Quotes inside a quoted field are doubled, as in RFC 4180.
CSV_QUOTING = {"quote": '"', "escape": '"'}

LONG_LINES = ("cut", "raise", "drop")


def read_csv(
    spark, paths, sep=",", columns=None, required=(), long_lines="cut", line_ends_in_values=False
):
    """Read one or many files as one table; short rows are filled with NULL.

    Without ``columns`` every file starts with the same header, and a file whose
    header differs in a column that is read raises. With ``columns`` the names are
    given, files need no header, and header lines are dropped wherever they stand
    (as in files glued together or cut in pieces). A line is one if all its fields are
    the columns' names; a short line, if all that it has are.

    A line with more fields than columns is ``cut`` to them without a word, makes the job
    that reads it ``raise``, or is left out (``drop``); see ``rejected_lines`` for those.
    With the latter two every field of every line is parsed, whatever columns are read.

    ``line_ends_in_values`` cuts at line ends outside quotes only, see ``read_records``;
    many tasks share a file all the same. Files are read at once then.
    """
    if long_lines not in LONG_LINES:
        raise ValueError(f"unknown choice {long_lines!r} for long lines, use one of {LONG_LINES}")
    if line_ends_in_values:
        df, names, line = _with_records(spark, paths, sep, columns)
    elif long_lines == "cut":
        df = _reader(spark, sep, columns).csv(paths)
        names = df.columns
    else:
        df, names, line = _with_lines(spark, paths, sep, columns)
    if long_lines == "cut":
        df = df.select(*_quoted(names))
    else:
        fields = _fields(line, sep)
        too_many = fields > len(names)
        if long_lines == "raise":
            told = F.concat(fields, F.lit(f" fields instead of {len(names)}: "), F.left(line, F.lit(200)))
            too_many = F.when(too_many, F.raise_error(told).cast("boolean")).otherwise(F.lit(False))
        df = df.filter(line.isNull() | ~too_many).select(*_quoted(names))
    if columns is not None:
        df = df.filter(~_is_header(columns))
    _require(names, required)
    return df


def rejected_lines(spark, paths, sep=",", columns=None):
    """The lines with more fields than columns: line, fields, file.

    ``line`` is the whole text of the line, ``fields`` how many it has and ``file`` where it
    stands; together with ``read_csv(..., long_lines="drop")`` that is all that files hold.
    Blank lines and header lines are neither.
    """
    df, names, line = _with_lines(spark, paths, sep, columns)
    return df.filter(line.isNotNull()).select(
        line.alias("line"), _fields(line, sep).alias("fields"), F.col("_metadata.file_path").alias("file")
    ).filter(F.col("fields") > len(names))


def _quoted(names):
    return [F.col(f"`{name}`") for name in names]


def _reader(spark, sep, columns):
    reader = spark.read.options(**CSV_QUOTING).option("sep", sep)
    if columns is None:
        return reader.option("header", True).option("enforceSchema", False)
    return reader.schema(text_columns(columns))


def _with_lines(spark, paths, sep, columns):
    """(table, column names, line): the reader keeps the text of lines that do not fit.

    Those are the lines with fewer or more fields than columns; others have a NULL line.
    """
    names = columns or _reader(spark, sep, None).csv(paths).columns
    line = unused("_line", text_columns(names))
    schema = StructType([*text_columns(names).fields, StructField(line, StringType())])
    # A reader that skips columns would not see how many fields a line has.
    options = {"columnNameOfCorruptRecord": line, "columnPruning": False}
    reader = _reader(spark, sep, columns).schema(schema).options(**options)
    # Nor does it parse a line where no column of the file is looked at.
    looked_at = F.coalesce(F.length(_quoted(names)[0]), F.lit(0)) >= 0
    return reader.csv(paths).filter(looked_at), list(names), F.col(f"`{line}`")


def _with_records(spark, paths, sep, columns):
    """As ``_with_lines``, with line ends in values; the text of every record is kept."""
    names = list(columns or _reader(spark, sep, None).option("multiLine", True).csv(paths).columns)
    records = read_records(spark, paths).filter("record <> ''")
    schema = ", ".join("`" + name.replace("`", "``") + "` STRING" for name in names)
    options = {**CSV_QUOTING, "sep": sep, "multiLine": True}
    # Exploded from an array of one, so that no record is parsed for each of its columns.
    row = F.explode(F.array(F.from_csv("record", schema, options))).alias("row")
    line = unused("_line", text_columns(names))
    if columns is None:
        other = F.concat(F.lit(f"CSV header does not conform to the schema {names}: "), F.col("record"))
        header = F.from_csv("record", schema, options)
        same = (_fields(F.col("record"), sep) == len(names)) & reduce(
            and_, [header.getField(n).eqNullSafe(F.lit(n)) for n in names]
        )
        is_row = F.when(~F.col("first"), True).when(same, False).otherwise(F.raise_error(other).cast("boolean"))
        records = records.filter(is_row)
    df = records.select(F.col("record").alias(line), row).select("row.*", f"`{line}`")
    return df, names, F.col(f"`{line}`")


def _fields(line, sep):
    """How many fields a line has: separators within quotes are none.

    Each field is matched with the separator before it, and one is put before the first.
    """
    mark = re.escape(sep)
    other = f"(?:(?!{mark}).)*+"
    field = mark + r'(?:[ \t]*+"(?:[^"]|"")*+"' + other + "|" + other + ")"
    return F.regexp_count(F.concat(F.lit(sep), line), F.lit("(?s)" + field))


def _is_header(columns):
    """Whether a row has every column's name, as far as it goes."""
    named = [F.col(f"`{c}`").eqNullSafe(F.lit(c)) for c in columns]
    rest = [F.col(f"`{c}`").isNull() | same for c, same in zip(columns[1:], named[1:])]
    return reduce(and_, [named[0], *rest])


def _require(names, required):
    missing = [name for name in required if name not in names]
    if missing:
        raise ValueError(f"missing columns {missing}, found {list(names)}")


def read_csv_by_name(spark, layouts, sep=",", required=()):
    """Read groups of files whose headers differ, matching columns by name.

    ``layouts`` holds one path or list of paths per header, not one per file.
    """
    tables = [read_csv(spark, paths, sep=sep, required=required) for paths in layouts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
