"""GeoJSON feature collections as rows, without their geometry."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from urbanstats.schemas import BLOCK_COLUMNS, feature_collection_schema, feature_schema
from urbanstats.sources.scratch import scratch_path
from urbanstats.sources.sessions import session_with

LAYOUTS = ("split", "document", "document_lines", "feature_lines")

# A document of up to this many bytes is parsed as one text, a larger one as a stream.
DOCUMENT_TEXT_BYTES = 128 * 1024 * 1024
# Most such documents that one task reads, where there are more of them than cores.
DOCUMENTS_PER_TASK = 8

# Fixed value: names of compressed files.
_COMPRESSED = r"(?i)\.(gz|gzip|bz2|deflate|snappy|lz4|lzo|zst|zstd|passthrough)$"
# Fixed value: the member that holds a feature's attributes (RFC 7946).
PROPERTIES_MARK = '"properties"'

_TEXT = r'"(?:[^"\\]|\\.)*+"'
_FLAT = r'[^{}\[\]"]*+(?:' + _TEXT + r'[^{}\[\]"]*+)*+'
# What follows the mark in a member of the document itself, such as a reference system:
# the object around it is followed by a member or the end, not by an element of an array.
_DOCUMENT_MEMBER = r'^\s*+:\s*+\{' + _FLAT + r'\}' + _FLAT + r'\}\s*+(?:,\s*+"|\}\s*+$)'
# Lines of a document that hold no feature.
_OTHER_LINE = r'^(?:[\[\]{},\s]*+$|"|\{.*"features"\s*+:\s*+\[\s*+$)'


def read_features(spark, paths, fields=BLOCK_COLUMNS, layout="split", check=True):
    """One row per feature, with one column ``feature`` holding its properties.

    ``split``           documents of any size and line layout, read in parallel:
                        the text is cut where a feature's properties begin
    ``document``        one document per file, each read whole by one task
    ``document_lines``  one document per line
    ``feature_lines``   one feature per line, bare or as the lines of a document

    All layouts give the same rows, and raise where a document or a line is malformed or
    cut short. ``split`` also raises where ``"properties"`` is a value, or a member of
    something inside a feature; the other layouts read such documents. To see that each
    file is complete it reads all files at once: the wanted properties go to the scratch
    folder in the same pass that counts brackets, and are read from there. ``check=False``
    reads lazily instead, for files known to be complete.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}, use one of {LAYOUTS}")
    if layout == "split":
        return _read_split(spark, paths, fields, check)
    if layout == "feature_lines":
        return _read_lines(spark, paths, fields)
    if layout == "document":
        documents = _read_documents(spark, paths, fields)
    else:
        documents = _json_reader(spark, fields).json(paths)
    return documents.select(F.explode("features").alias("feature"))


def _json_reader(spark, fields):
    return spark.read.schema(feature_collection_schema(fields)).option("mode", "FAILFAST")


def _read_documents(spark, paths, fields):
    """One row per document, each file read once.

    A number that is wanted as text is cut out of what was read. Of a stream nothing is
    kept, so Spark's reader opens the file again for every number, and reads some thousand
    bytes for each. Documents are therefore read as lines: each is one, as a zero byte
    ends a line and no JSON text has any. A document that is too large for that is read as
    a stream all the same; so is a compressed one, whose stream cannot be read again and
    whose numbers are written anew.

    A line could be cut to splits, each of which would look for its end. The settings
    keep every file whole; the stream, which comes first, keeps the caller's session.
    """
    whole = session_with(
        spark,
        spark__sql__files__openCostInBytes=str(DOCUMENT_TEXT_BYTES),
        spark__sql__files__maxPartitionBytes=str(DOCUMENTS_PER_TASK * DOCUMENT_TEXT_BYTES),
    )
    small = (F.col("_metadata.file_size") <= DOCUMENT_TEXT_BYTES) & ~F.col("_metadata.file_name").rlike(
        _COMPRESSED
    )
    lines = _json_reader(whole, fields).option("lineSep", "\0").json(paths).filter(small)
    streams = _json_reader(spark, fields).option("multiLine", True).json(paths).filter(~small)
    return streams.select("features").unionAll(lines.select("features"))


def _read_lines(spark, paths, fields):
    line = F.trim("value", F.lit(" \t\r\n"))
    feature = F.from_json(line, feature_schema(fields), {"mode": "FAILFAST"})
    bad = F.raise_error(F.concat(F.lit("neither a feature nor part of a document: "), F.left(line, F.lit(80))))
    one = F.when(line.startswith("{"), feature).otherwise(bad)
    lines = spark.read.text(paths).filter(~line.rlike(_OTHER_LINE))
    return lines.select(F.explode(F.array(one)).alias("feature"))


def _read_split(spark, paths, fields, check):
    """Cut the text at the mark, so that Spark can give a file to many tasks.

    A record is the value of a feature's properties, the members after it, and what
    follows up to the next mark. The parser stops at the end of the feature; a record
    that is cut short raises, as the mark stood somewhere else. Text before the first
    feature does not start with a colon.

    The feature is exploded from an array of one, because a filter on its fields
    would otherwise move below and parse each record again.
    """
    records = spark.read.option("lineSep", PROPERTIES_MARK).text(paths)
    member = F.ltrim("value", F.lit(" \t\r\n")).startswith(":")
    feature = F.from_json(
        F.concat(F.lit("{" + PROPERTIES_MARK), F.col("value")),
        feature_schema(fields),
        {"mode": "FAILFAST"},
    )
    blank = reduce(and_, [F.col(f"feature.properties.`{name}`").isNull() for name in fields])
    of_document = blank & F.col("value").rlike(_DOCUMENT_MEMBER)
    if not check:
        parsed = records.filter(member).select("value", F.explode(F.array(feature)).alias("feature"))
        return parsed.filter(~of_document).select("feature")
    found = F.struct(
        F.when(member, feature).alias("feature"), _balance(F.col("value")).alias("balance")
    )
    parsed = records.select(
        F.col("_metadata.file_path").alias("file"), "value", F.explode(F.array(found)).alias("found")
    ).select("file", "value", "found.*", member.alias("member"))
    path = scratch_path(spark, "features")
    parsed.select(
        "feature", "file", "balance.*", "member", (F.col("member") & ~of_document).alias("kept")
    ).write.parquet(path)
    staged = spark.read.parquet(path)
    _check_complete(staged)
    return staged.filter("kept").select("feature")


def _balance(text):
    """Opening less closing brackets outside texts: a struct of braces and brackets.

    Only a record that has a bracket within a text, or an escape, is searched for texts;
    all others are split at the brackets.
    """
    def simple(parts):
        within = F.array_join(F.filter(parts, lambda _, i: i % 2 == 1), "")
        return (F.size(parts) % 2 == 1) & ~within.rlike(r"[\[\]{}]")

    # Bound to a variable, so that the text is split once.
    plain = ~text.contains("\\") & F.transform(F.array(F.split(text, '"')), simple)[0]

    def both(t):
        def more(a, b):
            return F.size(F.split(t, a)) - F.size(F.split(t, b))

        return F.struct(more(r"\{", r"\}").alias("braces"), more(r"\[", r"\]").alias("brackets"))

    bare = F.transform(F.array(F.regexp_replace(text, _TEXT, "")), both)[0]
    return F.when(plain, both(text)).otherwise(bare)


def _check_complete(staged):
    """Raise unless every file's brackets close and its marks are members."""
    files = staged.groupBy("file").agg(
        F.sum("braces").alias("braces"),
        F.sum("brackets").alias("brackets"),
        F.count_if(~F.col("member")).alias("heads"),
    )
    bad = files.filter("braces <> 0 OR brackets <> 0 OR heads <> 1").first()
    if bad is not None:
        raise ValueError(
            f"{bad['file']} is cut short, or has 'properties' as a value (read it with layout 'document')"
        )


def feature_properties(features, fields=BLOCK_COLUMNS):
    """The wanted properties as columns; ``fields`` may map them to new names."""
    names = fields if isinstance(fields, dict) else {name: name for name in fields}
    return features.select(
        *[F.col(f"feature.properties.`{name}`").alias(alias) for name, alias in names.items()]
    )
