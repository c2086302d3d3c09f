"""One query per operator, on whole tables, and the SQL where SQL can say it."""

from pyspark.sql import functions as F

from urbanstats.llm import minhash
from urbanstats.llm.alignment import align_tokenizers, read_tokenizers
from urbanstats.llm.decontaminate import find_contained
from urbanstats.llm.negatives import mine_hard_negatives
from urbanstats.llm.pieces import encode_round_trip, read_vocabulary
from urbanstats.llm.quality import fit_quality, score_quality
from urbanstats.llm.rendering import extract_text
from urbanstats.llm.repeats import remove_repeated_strings
from urbanstats.llm.secrets import fit_markov, labelled_samples, scan_secrets
from urbanstats.llm.simhash import near_duplicates
from urbanstats.llm.topk import top_k
from urbanstats.llm.urls import host_of, judge_captures, path_of
from urbanstats.llm.windows import remove_repeated_passages


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def op2_html_extraction(spark, sf_dir):
    return extract_text(_table(spark, sf_dir, "pages"))


def op3_sentencepiece(spark, sf_dir, vocabulary="/opt/tokenizers/piece_bpe_32k.model"):
    return encode_round_trip(_table(spark, sf_dir, "documents"), read_vocabulary(vocabulary))


def op4_suffix_array_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return remove_repeated_strings(docs, length=400, with_text=False).drop("spans")


def op5_secret_scans(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return scan_secrets(docs, fit_markov(labelled_samples(docs)))


def op6_substring_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return remove_repeated_passages(docs, length=50, with_text=False).drop("intervals")


def op7_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, _table(spark, sf_dir, "labels")))


def captures_and_lists(pages):
    """Fetch dates for the pages, and dated lists made of their hosts.

    A digest of a host decides which lists name it, or its domain or a folder of it, and
    when: added on one day, for some removed later, for some added again.
    """
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int"))
    captures = pages.select("page_id", "url", day.alias("fetched"))
    hosts = (
        pages.select(host_of(F.col("url")).alias("host"), F.split(path_of(F.col("url")), "/")[0].alias("folder"))
        .filter("host IS NOT NULL")
        .distinct()
        .withColumn("d", F.conv(F.substring(F.md5(F.concat_ws("/", "host", "folder")), 1, 6), 16, 10).cast("int"))
    )
    domain = F.substring_index("host", ".", -2)
    folder = F.concat_ws("/", "host", "folder")
    picked = [
        (F.col("d") % 3 == 0, "hosts", "block", "host", F.col("host")),
        (F.col("d") % 11 == 1, "domains", "block", "domain", domain),
        (F.col("d") % 5 == 2, "folders", "block", "prefix", folder),
        (F.col("d") % 7 == 3, "trusted", "allow", "host", F.col("host")),
    ]
    steps = F.array(
        *[
            F.struct(F.lit(when).alias("when"), F.lit(added).alias("added"), F.lit(only).alias("only"))
            for when, added, only in ((0, True, 1), (60, False, 2), (150, True, 4))
        ]
    )
    entries = None
    for chosen, name, action, kind, value in picked:
        part = (
            hosts.filter(chosen)
            .select("d", value.alias("value"), F.explode(steps).alias("s"))
            .filter(F.col("d") % F.col("s.only") == 0)
            .select(
                F.lit(name).alias("list"),
                F.lit(action).alias("action"),
                F.lit(kind).alias("kind"),
                "value",
                F.date_add(
                    F.lit("2024-01-01").cast("date"), (F.col("d") % 200 + F.col("s.when")).cast("int")
                ).alias("changed"),
                F.col("s.added").alias("added"),
            )
        )
        entries = part if entries is None else entries.unionByName(part)
    return captures, entries


def op8_url_filters(spark, sf_dir):
    return judge_captures(*captures_and_lists(_table(spark, sf_dir, "pages")))


def op9_exact_top_k(spark, sf_dir):
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op10_benchmark_decontamination(spark, sf_dir):
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return find_contained(docs, items).drop("text_key")


def op11_cross_tokenizer_alignment(
    spark,
    sf_dir,
    byte_bpe="/opt/tokenizers/byte_bpe_50k.json",
    piece_model="/opt/tokenizers/piece_bpe_32k.model",
):
    return align_tokenizers(_table(spark, sf_dir, "documents"), read_tokenizers(byte_bpe, piece_model))


def op12_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op13_hard_negative_mining(spark, sf_dir):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(
        _table(spark, sf_dir, "embeddings"),
        F.col("vec_id") % 50 == 0,
        label=shifted,
        positives=5,
        negatives=3,
        window=(50, 95),
        scale=256,
    )


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_secret_scans": op5_secret_scans,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_url_filters": op8_url_filters,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_minhash_near_dedup": op12_minhash_near_dedup,
    "op13_hard_negative_mining": op13_hard_negative_mining,
}

# Every shingle of every document against every shingle of every item.
_OP10 = r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r,
         [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') IF x <> ''] AS w
  FROM documents),
iw AS (
  SELECT item_id,
         [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') IF x <> ''] AS w
  FROM benchmark WHERE item_id IS NOT NULL),
items AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(5, len(w)) AS n, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
        FROM iw WHERE len(w) > 0)),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id),
docs AS (
  SELECT DISTINCT r, doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM dw, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)),
counts AS (
  SELECT r, doc_id, item_id, count(*) AS n_shared FROM docs JOIN items USING (n, s) GROUP BY ALL)
SELECT DISTINCT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM counts JOIN sizes USING (item_id) WHERE n_shared / n_shingles >= 0.8
"""

# Every query against every row.
_OP9 = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank"
  FROM pairs)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
"""

# The state of each entry is its last change up to the fetch day; a removal wins a tie.
_OP8 = r"""
WITH u AS (
  SELECT row_number() OVER () AS r, page_id, date '2024-01-01' + (page_id % 365)::INTEGER AS fetched,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:@]*)', 2)), '\.$', ''), '') AS host,
    coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '') AS path
  FROM pages),
hosts AS (
  SELECT host, folder, ('0x' || substr(md5(host || '/' || folder), 1, 6))::INTEGER AS d
  FROM (SELECT DISTINCT host, split_part(path, '/', 1) AS folder FROM u WHERE host IS NOT NULL)),
named AS (
  SELECT d, 'hosts' AS list, 'block' AS action, 'host' AS kind, host AS value FROM hosts WHERE d % 3 = 0
  UNION ALL
  SELECT d, 'domains', 'block', 'domain', array_to_string(string_split(host, '.')[-2:], '.') FROM hosts WHERE d % 11 = 1
  UNION ALL
  SELECT d, 'folders', 'block', 'prefix', host || '/' || folder FROM hosts WHERE d % 5 = 2
  UNION ALL
  SELECT d, 'trusted', 'allow', 'host', host FROM hosts WHERE d % 7 = 3),
changes AS (
  SELECT list, action, kind, value, date '2024-01-01' + (d % 200 + s.w)::INTEGER AS changed, s.added
  FROM named, (VALUES (0, true, 1), (60, false, 2), (150, true, 4)) AS s(w, added, keep)
  WHERE d % s.keep = 0),
matches AS (
  SELECT r, list, action, kind, value, arg_max(added, (changed, NOT added)) AS active
  FROM u JOIN changes AS c ON c.changed <= u.fetched AND (
    (c.kind = 'host' AND u.host = c.value)
    OR (c.kind = 'domain' AND ('.' || u.host) LIKE ('%.' || c.value))
    OR (c.kind = 'prefix' AND ((u.host || '/' || u.path || '/') LIKE (c.value || '/%'))))
  GROUP BY ALL),
found AS (
  SELECT r, count(*) AS n_active, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         bool_or(action = 'allow') AS allowed
  FROM matches WHERE active GROUP BY r)
SELECT page_id, host, fetched, coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists,
       CASE WHEN allowed THEN 'allow' WHEN n_active > 0 THEN 'block' ELSE 'none' END AS verdict
FROM u LEFT JOIN found USING (r)
"""

# Every pair of documents that share a shingle, and all that is reachable over links.
_OP12 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS r,
         [x FOR x IN regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents WHERE doc_id IS NOT NULL),
s AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (
  SELECT a.r AS u, b.r AS v, count(*) AS c FROM s AS a JOIN s AS b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
links AS (
  SELECT u, v FROM shared JOIN n AS a ON a.r = u JOIN n AS b ON b.r = v
  WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach AS (
  SELECT r AS u, r AS v FROM w
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least_id AS (SELECT reach.u AS r, min(w.doc_id) AS c FROM reach JOIN w ON w.r = reach.v GROUP BY reach.u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, w.doc_id = c AS kept
FROM w JOIN least_id USING (r) LEFT JOIN n USING (r)
"""

# Every anchor against every row.
_OP13 = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS alike,
         list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v AS a JOIN v AS c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r
    FROM pairs WHERE alike)
  WHERE r <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS "rank"
  FROM positives AS p JOIN pairs AS n ON p.anchor_id = n.anchor_id AND NOT n.alike
    AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score)
SELECT anchor_id, positive_id, "rank", negative_id, positive_score, negative_score
FROM negatives WHERE "rank" <= 3
"""

ORACLE = {
    "op8_url_filters": _OP8,
    "op9_exact_top_k": _OP9,
    "op10_benchmark_decontamination": _OP10,
    "op12_minhash_near_dedup": _OP12,
    "op13_hard_negative_mining": _OP13,
}
