"""URL filters: captures against dated lists, as of the time of the fetch.

An entry of a list is added and removed over time. Its changes become intervals in which
it is active, and each capture meets the intervals that hold its fetch time.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanstats.llm.common import stored

# What an entry's value stands for: one host; a domain with all hosts below it; a host
# and the first segments of a path.
KINDS = ("host", "domain", "prefix")
# What a list does with what it matches. One that allows wins over those that block.
ACTIONS = ("block", "allow")


def host_of(url):
    """Lower-case host of a URL, without user, port and last dot; NULL if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:@]*)", 2)
    host = F.regexp_replace(F.lower(host), r"\.$", "")
    return F.when(host != "", host)


def path_of(url):
    """Path of a URL without the first slash, query and fragment; empty if there is none."""
    return F.coalesce(
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1), F.lit("")
    )


def active_intervals(entries):
    """Rows (list, action, kind, value, since, until): when each entry is active.

    ``entries`` has the columns list, action, kind, value, changed (a date or a time) and
    added (true for an addition, false for a removal). ``until`` is the first moment that
    no longer counts, NULL for ever. Changes that change nothing are ignored; of an
    addition and a removal at one moment the removal counts. Values are compared in lower
    case but for paths. Rows with a NULL in any of the columns are ignored.
    """
    columns = ["list", "action", "kind", "value", "changed", "added"]
    value = F.when(F.col("kind") == "prefix", F.col("value")).otherwise(F.lower("value"))
    changes = (
        entries.select(*columns)
        .dropna()
        .withColumn("value", value)
        .groupBy("list", "action", "kind", "value", "changed")
        .agg(F.min("added").alias("added"))
    )
    entry = Window.partitionBy("list", "action", "kind", "value").orderBy("changed")
    turns = changes.withColumn("was", F.coalesce(F.lag("added").over(entry), F.lit(False))).filter(
        F.col("added") != F.col("was")
    )
    return turns.withColumn("until", F.lead("changed").over(entry)).filter("added").select(
        "list", "action", "kind", "value", F.col("changed").alias("since"), "until"
    )


def _keys(host, path, labels, segments):
    """Array of (kind, value): all that a list could call a capture.

    Only domains and prefixes as long as the lists have any are formed.
    """
    parts = F.split(host, r"\.")
    first = F.greatest(F.size(parts) - labels + 1, F.lit(1))
    domains = F.transform(
        F.sequence(first, F.size(parts)),
        lambda i: F.struct(
            F.lit("domain").alias("kind"),
            F.array_join(F.slice(parts, i, F.size(parts) - i + 1), ".").alias("value"),
        ),
    )
    steps = F.slice(F.split(path, "/"), 1, max(1, segments))
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda i: F.struct(
            F.lit("prefix").alias("kind"),
            F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")).alias("value"),
        ),
    )
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))
    return F.concat(
        own, domains if labels else F.array().cast(_KEYS), prefixes if segments else F.array().cast(_KEYS)
    )


_KEYS = "array<struct<kind:string,value:string>>"


def judge_captures(captures, entries, id_column="page_id", url_column="url", time_column="fetched"):
    """One row per row of ``captures``: id, host, time, n_active, lists, verdict.

    ``n_active`` counts the entries that are active at the fetch time and match the URL,
    ``lists`` names their lists (sorted, with commas), ``verdict`` is ``allow`` if one of
    them allows, else ``block`` if one blocks, else ``none``. See ``active_intervals`` for
    ``entries``. A prefix ends at a slash or at the end of the path.

    A URL that is NULL or has no host, or a NULL time, matches nothing. NULL and repeated
    ids give a row each; other columns are ignored. Without entries all verdicts are
    ``none``. Without captures the result is empty. URLs of any length are taken whole.

    The join is on the key, with the interval as its condition: an entry has few
    intervals, so a host with most captures makes no more rows than captures, and Spark
    can split it or ship the lists.
    """
    intervals = stored(active_intervals(entries), "list_intervals")
    most = intervals.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("value", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("value", "/")) - 1)).alias("segments"),
    ).first()
    url = F.col(f"`{url_column}`")
    own = captures.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_column}`").alias("id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col(f"`{time_column}`").alias("time"),
    )
    keys = own.select(
        "row",
        "id",
        "host",
        "time",
        F.explode_outer(
            F.when(
                F.col("host").isNotNull(),
                _keys(F.col("host"), F.col("path"), most["labels"] or 0, most["segments"] or 0),
            )
        ).alias("key"),
    ).select("row", "id", "host", "time", "key.*")
    active = (
        (keys["kind"] == intervals["kind"])
        & (keys["value"] == intervals["value"])
        & (keys["time"] >= intervals["since"])
        & (intervals["until"].isNull() | (keys["time"] < intervals["until"]))
    )
    met = keys.join(intervals, active, "left")
    verdict = F.when(F.max(F.col("action") == "allow"), "allow").when(
        F.max(F.col("action") == "block"), "block"
    )
    return (
        met.groupBy("row", "id", "host", "time")
        .agg(
            F.count("list").alias("n_active"),
            F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"),
            F.coalesce(verdict, F.lit("none")).alias("verdict"),
        )
        .select(
            F.col("id").alias(id_column), "host", F.col("time").alias(time_column), "n_active", "lists", "verdict"
        )
    )
