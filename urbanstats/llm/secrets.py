"""Secret scans: known forms by pattern, other random strings by Markov models."""

import json
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanstats.llm.common import stored, text_table
from urbanstats.operators.names import unused

# The forms that are always secrets, each with the group that holds the
# value and the least length of that. A shorter match is consumed and dropped.
BASE_KINDS = {
    "assign": (
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# The same search where matches too short to count cannot hide a longer one.
_SEARCH = {
    "assign": BASE_KINDS["assign"][0],
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}

# The characters that the models know.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = r"[A-Za-z0-9+/_=-]"

# Stretches of at least this many characters are judged by the models,
MIN_LENGTH = 16
# and runs of at least this many are samples of ordinary identifiers.
MIN_SAMPLE = 10
# A stretch is a secret from this log-likelihood ratio on (natural logarithm).
MIN_RATIO = 15.0
# Every transition counts as seen this often beforehand: without samples both models are
# uniform, and a few known secrets do not make the random one expect their letters only.
RANDOM_PRIOR = 20.0
ORDINARY_PRIOR = 2.0


def labelled_samples(docs):
    """Rows (sample, label): values of known forms with 1, runs outside them with 0.

    Known forms are cut out before runs are taken, so no sample has both labels.
    """
    texts = text_table(docs).select("text")
    known, rest = [], F.col("text")
    for kind, (_, group, least) in BASE_KINDS.items():
        values = F.regexp_extract_all("text", F.lit(_SEARCH[kind]), F.lit(group))
        found = F.filter(values, lambda v: F.length(v) >= least)
        known.append(F.when(F.col("text").rlike(_SEARCH[kind]), found).otherwise(F.array()))
        rest = F.when(rest.rlike(_SEARCH[kind]), F.regexp_replace(rest, _SEARCH[kind], " ")).otherwise(rest)
    runs = F.regexp_extract_all(rest, F.lit(_RUN + "{%d,}" % MIN_SAMPLE), F.lit(0))
    labelled = F.concat(
        F.transform(F.flatten(F.array(*known)), lambda v: F.struct(v.alias("sample"), F.lit(1).alias("label"))),
        F.transform(runs, lambda v: F.struct(v.alias("sample"), F.lit(0).alias("label"))),
    )
    return texts.select(F.explode(labelled).alias("s")).select("s.sample", "s.label")


def _pairs(text):
    """The neighbouring characters of a text, two by two."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))), lambda i: F.substring(text, i, 2)
    )


def fit_markov(samples):
    """The log-likelihood ratio of each transition, as {two characters: ratio}.

    ``samples`` has the columns sample and label (1 random, 0 ordinary); rows with NULL
    in either and characters outside the alphabet take no part. All samples are
    counted; what comes to the driver is a count per label and transition, which the
    alphabet bounds. Both models are smoothed, so they exist without any sample.
    """
    counts = (
        samples.filter(F.col("sample").isNotNull() & F.col("label").isin(0, 1))
        .select(F.explode(_pairs(F.col("sample"))).alias("pair"), "label")
        .filter(F.col("pair").rlike(f"^{_RUN}{{2}}$"))
        .groupBy("pair", "label")
        .count()
        .collect()
    )
    size = len(ALPHABET)
    tables = {0: {}, 1: {}}
    for row in counts:
        tables[row["label"]][row["pair"]] = row["count"]
    logs = {}
    for label, prior in ((0, ORDINARY_PRIOR), (1, RANDOM_PRIOR)):
        for a in ALPHABET:
            row = [tables[label].get(a + b, 0) + prior for b in ALPHABET]
            total = math.log(sum(row))
            logs[label, a] = [math.log(n) - total for n in row]
    return {
        a + ALPHABET[j]: logs[1, a][j] - logs[0, a][j] for a in ALPHABET for j in range(size)
    }


def _with_steps(text, model, then):
    """Column: ``then`` of the log-likelihood ratios of a text's transitions, made once."""
    size = len(ALPHABET)
    values = [model[a + b] for a in ALPHABET for b in ALPHABET]
    table = F.from_json(F.lit(json.dumps(values)), "array<double>")
    at = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def steps(codes):
        return F.zip_with(
            F.slice(codes, F.lit(1), F.size(codes) - 1),
            F.slice(codes, F.lit(2), F.size(codes) - 1),
            lambda a, b: F.get(table, a * size + b),
        )

    # Through arrays of one, so that the codes and the steps are made once.
    made = F.transform(F.array(at), steps)
    return F.get(F.transform(made, then), F.lit(0))


def _total(steps):
    return F.aggregate(steps, F.lit(0.0), lambda total, step: total + step)


def log_ratio(text, model):
    """Column: how much likelier a text of alphabet characters is random than ordinary."""
    return _with_steps(text, model, _total)


_STRETCHES = "array<struct<start:int,end:int>>"
_STATE = (
    "struct<at:int,window:double,sum:double,start:int,peak:double,first:int,end:int,fresh:int,"
    f"found:{_STRETCHES}>"
)


def _stretches(steps, min_length, min_ratio):
    """Array of the stretches (start, end) of a run that the models call random.

    ``sum`` is that of the best stretch of ``min_length`` characters or more that ends
    here: the one that ended a step before and this step, or the shortest. A stretch ends
    at its peak, once the sum has fallen by ``min_ratio`` from there or the run is over;
    the next one lies behind it. So each stretch with the ratio meets one that is listed.
    """
    lag = max(min_length - 1, 1)
    behind = F.slice(
        F.concat(F.array_repeat(F.lit(0.0), lag), steps), F.lit(1), F.size(steps)
    )
    moves = F.zip_with(steps, behind, lambda new, old: F.struct(new.alias("new"), old.alias("old")))
    zero, none = F.lit(0), F.lit(None)
    begin = F.struct(
        *[c.alias(n) for c, n in (
            (zero, "at"), (F.lit(0.0), "window"), (none, "sum"), (zero, "start"), (none, "peak"),
            (zero, "first"), (zero, "end"), (zero, "fresh"), (F.array(), "found"),
        )]
    ).cast(_STATE)

    def with_peak(state):
        stretch = F.struct(state["first"].alias("start"), state["end"].alias("end"))
        return F.concat(state["found"], F.array(stretch))

    def summed(state, move):
        window = state["window"] + move["new"] - move["old"]
        grown = state["sum"] + move["new"]
        begun = state["at"] - (lag - 1)
        shortest = (begun >= state["fresh"]) & (grown.isNull() | (window > grown))
        return F.struct(
            (state["at"] + 1).alias("at"),
            window.alias("window"),
            F.when(shortest, window).otherwise(grown).alias("sum"),
            F.when(shortest, begun).otherwise(state["start"]).alias("start"),
            *[state[c].alias(c) for c in ("peak", "first", "end", "fresh", "found")],
        )

    def judged(state):
        peak, total = state["peak"], state["sum"]
        better = F.coalesce((total >= min_ratio) & (peak.isNull() | (total > peak)), F.lit(False))
        over = F.coalesce(total <= peak - min_ratio, F.lit(False))
        return F.struct(
            state["at"].alias("at"),
            state["window"].alias("window"),
            F.when(~over, total).alias("sum"),
            state["start"].alias("start"),
            F.when(better, total).when(~over, peak).alias("peak"),
            F.when(better & peak.isNull(), state["start"]).otherwise(state["first"]).alias("first"),
            F.when(better, state["at"] + 1).otherwise(state["end"]).alias("end"),
            F.when(over, state["end"]).otherwise(state["fresh"]).alias("fresh"),
            F.when(over, with_peak(state)).otherwise(state["found"]).alias("found"),
        ).cast(_STATE)

    return F.aggregate(
        moves,
        begin,
        lambda state, move: F.get(F.transform(F.array(summed(state, move)), judged), F.lit(0)),
        lambda state: F.when(state["peak"].isNotNull(), with_peak(state)).otherwise(state["found"]),
    )


def random_stretches(run, model, min_length=MIN_LENGTH, min_ratio=MIN_RATIO):
    """Column: the stretches (start, end) of a run of alphabet characters that are secrets.

    A run with the ratio is one as a whole. Of another one, each stretch with the ratio
    is, with the letters and digits that it is joined to.
    """

    def found(steps):
        rising = F.aggregate(steps, F.lit(0.0), lambda total, step: total + F.greatest(step, F.lit(0.0)))
        whole = F.array(F.struct(F.lit(0).alias("start"), F.length(run).alias("end"))).cast(_STRETCHES)
        return (
            F.when(_total(steps) >= min_ratio, whole)
            .when(rising >= min_ratio, _stretches(steps, min_length, min_ratio))
            .otherwise(F.array().cast(_STRETCHES))
        )

    def widened(stretches):
        starts = F.concat(stretches["start"], F.array(F.length(run)))
        ends = F.concat(F.array(F.lit(0)), stretches["end"])
        gaps = F.zip_with(ends, starts, lambda a, b: F.substring(run, a + 1, b - a))
        # What joins two stretches goes to the second, so that none overlap.
        inner = F.size(stretches)
        before = F.transform(
            gaps,
            lambda g, i: F.when(i < inner, F.length(F.regexp_extract(g, "[A-Za-z0-9]*$", 0))).otherwise(0),
        )
        after = F.zip_with(
            gaps,
            before,
            lambda g, n: F.length(F.regexp_extract(F.substring(g, F.lit(1), F.length(g) - n), "^[A-Za-z0-9]*", 0)),
        )
        return F.transform(
            stretches,
            lambda s, i: F.struct(
                (s["start"] - F.get(before, i)).alias("start"),
                (s["end"] + F.get(after, i + 1)).alias("end"),
            ),
        )

    made = _with_steps(run, model, found)
    wide = F.transform(F.array(made), lambda s: F.when(F.size(s) > 0, widened(s)).otherwise(s))
    return F.get(wide, F.lit(0))


# All kinds, in the order in which spans with one start are listed.
KINDS = [*BASE_KINDS, "random"]

_MATCHES = "array<struct<kind:string,i:int,before:bigint,length:bigint,good:boolean>>"


def _matches(kind, search, value_group, good):
    """Array of all matches: the text before each, its length, and whether it counts."""
    text = F.col("text")
    before = F.split(text, search, -1)
    whole = F.regexp_extract_all(text, F.lit(search), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(search), F.lit(value_group))
    rows = F.transform(
        F.arrays_zip(whole.alias("w"), value.alias("v"), F.slice(before, F.lit(1), F.size(whole)).alias("b")),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(m["b"]).cast("long").alias("before"),
            F.length(m["w"]).cast("long").alias("length"),
            good(m["v"]).alias("good"),
        ),
    )
    return F.when(text.rlike(search), rows).otherwise(F.array().cast(_MATCHES))


def _without(text, search, value_group, least):
    """The text with a blank for each character of the matches that count."""
    before = F.split(text, search, -1)
    whole = F.regexp_extract_all(text, F.lit(search), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(search), F.lit(value_group))
    blanks = F.zip_with(
        whole, value, lambda w, v: F.when(F.length(v) >= least, F.repeat(F.lit(" "), F.length(w))).otherwise(w)
    )
    kept = F.zip_with(before, blanks, lambda b, w: F.concat(b, F.coalesce(w, F.lit(""))))
    return F.when(text.rlike(search), F.concat_ws("", kept)).otherwise(text)


def _both(a, b, text):
    """Two versions of a text, with the blanks of both."""
    each = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(y == " ", y).otherwise(x))
    return F.when(a == text, b).when(b == text, a).otherwise(F.concat_ws("", each))


def _random_matches(text, model, min_length, min_ratio):
    """As ``_matches``, of the secret stretches of all runs; the end of each run follows them."""
    search = _RUN + "{%d,}" % min_length
    before = F.split(text, search, -1)
    runs = F.regexp_extract_all(text, F.lit(search), F.lit(0))

    def pieces(m):
        def placed(stretches):
            ends = F.concat(F.array(F.lit(0)), stretches["end"])
            size = F.length(m["w"])
            marks = F.concat(
                F.transform(stretches, lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"))),
                F.array(F.struct(size.alias("s"), size.alias("e"))),
            )
            return F.zip_with(
                ends,
                marks,
                lambda last, s: F.struct(
                    (s["s"] - last + F.when(last == 0, F.length(m["b"])).otherwise(0)).alias("before"),
                    (s["e"] - s["s"]).alias("length"),
                ),
            )

        stretches = random_stretches(m["w"], model, min_length, min_ratio)
        return F.get(F.transform(F.array(stretches), placed), F.lit(0))

    parts = F.flatten(
        F.transform(F.arrays_zip(runs.alias("w"), F.slice(before, F.lit(1), F.size(runs)).alias("b")), pieces)
    )
    rows = F.transform(
        parts,
        lambda p, i: F.struct(
            F.lit("random").alias("kind"),
            i.alias("i"),
            p["before"].cast("long").alias("before"),
            p["length"].cast("long").alias("length"),
            (p["length"] > 0).alias("good"),
        ),
    )
    return F.when(text.rlike(search), rows).otherwise(F.array().cast(_MATCHES))


def secret_spans(docs, model, min_length=MIN_LENGTH, min_ratio=MIN_RATIO):
    """Rows (row, doc_id, text_key, kind, start, end), code points, end exclusive.

    Every row of ``docs`` gives at least one row; without a span kind, start and end are
    NULL. ``row`` tells rows of ``docs`` apart, ``text_key`` is the hash of the text.
    Known forms are found leftmost first, each kind on its own. What they leave of the
    text is searched for runs of ``min_length`` characters or more; a run or a stretch of
    one (``random_stretches``) is a span of kind ``random`` if the models'
    log-likelihood ratio is ``min_ratio`` or more.

    The matches and the text between them are measured where the text is; only lengths
    go through the shuffle that adds them up to positions.
    """
    arrays = [
        _matches(kind, _SEARCH[kind], group, lambda v, least=least: F.length(v) >= least)
        for kind, (_, group, least) in BASE_KINDS.items()
    ]
    # The row's number comes first: beside the explode it would number the matches.
    numbered = text_table(docs).withColumn("row", F.monotonically_increasing_id())
    rest = F.col("text")
    for kind, (_, group, least) in BASE_KINDS.items():
        numbered = numbered.withColumn(f"no_{kind}", _without(F.col("text"), _SEARCH[kind], group, least))
        numbered = numbered.withColumn("rest", _both(rest, F.col(f"no_{kind}"), F.col("text")))
        rest = F.col("rest")
    arrays.append(_random_matches(rest, model, min_length, min_ratio))
    matches = numbered.select(
        "row",
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.explode_outer(F.concat(*arrays)).alias("m"),
    ).select("row", "doc_id", "text_key", "m.*")
    in_order = Window.partitionBy("row", "kind").orderBy("i")
    placed = matches.withColumn(
        "end", F.sum(F.col("before") + F.col("length")).over(in_order)
    ).withColumn("start", F.col("end") - F.col("length"))
    # A row that is no span still stands for its document.
    span = F.coalesce("good", F.lit(False))
    return placed.select(
        "row", "doc_id", "text_key", *[F.when(span, F.col(c)).alias(c) for c in ("kind", "start", "end")]
    )


def scan_secrets(docs, model, min_length=MIN_LENGTH, min_ratio=MIN_RATIO):
    """One row per row of ``docs``: doc_id, counts of known forms, and all spans.

    ``base_sha256`` is the hash of the known forms' spans, ``spans`` the text of all
    spans: ``kind:start:end`` by start and kind, with commas between. A NULL or empty
    text has no span. NULL and repeated ids give a row each; other columns are ignored.
    Texts of any length are searched whole. An empty table gives an empty result.
    """
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    said = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    entry = F.struct("start", order.alias("order"), said.alias("said"))
    grouped = secret_spans(docs, model, min_length, min_ratio).groupBy("row", "doc_id").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS],
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), entry))).alias("all"),
    )
    base = F.filter("all", lambda s: s["order"] <= len(BASE_KINDS))
    return grouped.select(
        "doc_id",
        *[f"n_{k}" for k in BASE_KINDS],
        F.sha2(F.concat_ws(",", base["said"]), 256).alias("base_sha256"),
        F.concat_ws(",", F.col("all")["said"]).alias("spans"),
        "n_random",
    )


def redact_secrets(docs, model, min_length=MIN_LENGTH, min_ratio=MIN_RATIO, mark="[secret]"):
    """``docs`` with each stretch of secret characters replaced by ``mark``.

    The columns are those of ``docs``; ``n_chars``, where there is one, is counted anew.
    Spans that overlap or touch become one mark. All other rows and columns stay, whatever
    the columns' names. NULL and empty texts have no secret and stay as they are; rows that
    repeat an id or a whole row are each redacted; texts of any length are taken whole. An
    empty table gives an empty one.
    """
    id_, key_, spans_ = (unused(name, docs) for name in ("_secret_id", "_secret_key", "_secret_spans"))
    merged = Window.partitionBy("doc_id", "text_key").orderBy("start", "end")
    spans = (
        secret_spans(docs, model, min_length, min_ratio)
        .filter("kind IS NOT NULL")
        .select("doc_id", "text_key", "start", "end")
        .distinct()
        .withColumn("reach", F.max("end").over(merged.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("new", (F.col("reach").isNull() | (F.col("start") > F.col("reach"))).cast("int"))
        .withColumn("stretch", F.sum("new").over(merged))
        .groupBy("doc_id", "text_key", "stretch")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(F.col("doc_id").alias(id_), F.col("text_key").alias(key_))
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(spans_))
    )
    spans = stored(spans, "secret_spans")
    text = docs["text"]
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (
        F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(key_)
    )
    stretches = F.col(spans_)
    ends = F.concat(F.array(F.lit(0).cast("long")), stretches["end"])
    starts = F.concat(stretches["start"], F.array(F.length(text).cast("long")))
    kept = F.zip_with(
        ends, starts, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    )
    clean = F.when(stretches.isNotNull(), F.concat_ws(mark, kept)).otherwise(text)
    fixed = {"text": clean}
    if "n_chars" in docs.columns:
        fixed["n_chars"] = F.when(
            stretches.isNotNull(), F.length(clean).cast(docs.schema["n_chars"].dataType)
        ).otherwise(docs["n_chars"])
    joined = docs.join(spans, same, "left")
    return joined.select(*[fixed.get(c, docs[f"`{c}`"]).alias(c) for c in docs.columns])
