"""Records of CSV files whose values hold line ends, cut by many tasks per file.

Spark's text reader gives lines, and a line end within quotes is no end of a record.
Whether a line starts within quotes follows from the number of quotes before it in its
file. These are counted per split first; then every task knows for its own splits, and
only the records that lie across splits are put together from their parts.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanstats.sources.scratch import scratch_path

# Where splits begin is broadcast for up to this many splits (128 MB of file each, or so);
# beyond, lines are shuffled to it.
MAX_BROADCAST_SPLITS = 200_000

_PARTS = "file string, split long, place int, first boolean, open boolean, closed boolean, record string"


def _lines(spark, paths):
    """Lines with their file and split, in order within each split."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"),
        "value",
    )


def _starts(spark, lines):
    """Rows (file, split, inside): whether the split's first line starts within quotes."""
    quotes = F.sum(F.size(F.split("value", '"')) - 1)
    splits = lines.groupBy("file", "split").agg((quotes % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    path = scratch_path(spark, "splits")
    splits.select("file", "split", inside.alias("inside")).write.parquet(path)
    return spark.read.parquet(path)


def _join_lines(batches):
    """For mapInPandas: whole records, and the parts of those that reach over a split's end.

    The rows of a split come together and in order. ``open`` says that a record goes on
    in the next split, ``closed`` that a part ends here.
    """
    now, inside, place, held = None, False, 0, []

    def rest():
        # The split ends within quotes: what is held goes on in the next one.
        return [(*now, place, now[1] == 0 and place == 0, True, False, "\n".join(held))] if held else []

    for batch in batches:
        if not len(batch):
            continue
        out, own = [], [batch[c].to_numpy() for c in ("file", "split")]
        cuts = np.flatnonzero(np.r_[True, (own[0][1:] != own[0][:-1]) | (own[1][1:] != own[1][:-1]), True])
        values, starts = batch["value"].tolist(), batch["inside"].tolist()
        files, splits = batch["file"].tolist(), batch["split"].tolist()
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            key = (files[a], splits[a])
            if key != now:
                out += rest()
                now, inside, place, held, continued = key, starts[a], 0, [], starts[a]
            for value in values[a:b]:
                inside ^= value.count('"') & 1
                held.append(value)
                if inside:
                    continue
                text = "\n".join(held) if len(held) > 1 else value
                if text.endswith("\r"):
                    text = text[:-1]
                out.append((*now, place, now[1] == 0 and place == 0, False, continued, text))
                place, held, continued = place + 1, [], False
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _PARTS.split(", ")])
    if now is not None:
        yield pd.DataFrame(rest(), columns=[c.split()[0] for c in _PARTS.split(", ")])


def read_records(spark, paths):
    """Rows (record, first): the records of CSV files, cut at line ends outside quotes.

    ``first`` marks the first record of a file. A carriage return before a line end belongs
    to it, but not within quotes. Quotes may stand only around fields, or doubled in them;
    a file whose last quote is not closed raises. The files are read twice, the first time
    to count quotes.
    """
    lines = _lines(spark, paths)
    starts = _starts(spark, lines)
    key = ["file", "split"]
    if starts.count() <= MAX_BROADCAST_SPLITS:
        known = lines.join(F.broadcast(starts), key, "left")
    else:
        known = lines.join(starts, key, "left").repartition(*key).sortWithinPartitions(*key, "n")
    # Both passes have to cut the files alike.
    lost = F.raise_error("the splits of the files changed while they were read").cast("boolean")
    known = known.select(*key, "value", F.coalesce("inside", lost).alias("inside"))
    parts = known.mapInPandas(_join_lines, _PARTS)
    path = scratch_path(spark, "records")
    parts.write.parquet(path)
    parts = spark.read.parquet(path)
    across = parts.filter("open OR closed")
    # Each record that is open begins one, unless it goes on from the split before.
    order = Window.partitionBy("file").orderBy("split", "place")
    number = F.sum(F.col("begins").cast("int")).over(order)
    begins = F.col("open") & ~F.coalesce(F.lag("open").over(order), F.lit(False))
    joined = (
        across.withColumn("begins", begins)
        .withColumn("number", number)
        .groupBy("file", "number")
        .agg(
            F.array_sort(F.collect_list(F.struct("split", "place", "record"))).alias("parts"),
            F.max("first").alias("first"),
            F.max("closed").alias("closed"),
        )
    )
    unclosed = F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("file"))).cast("string")
    text = F.when(F.col("closed"), F.array_join("parts.record", "\n")).otherwise(unclosed)
    whole = parts.filter("NOT open AND NOT closed").select("record", "first")
    return whole.unionByName(joined.select(text.alias("record"), "first"))
