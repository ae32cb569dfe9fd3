"""The operators of this package as queries over the driver's tables, with SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretide.llm.bpe import encode_texts, token_ids
from faretide.llm.fingerprints import fingerprints
from faretide.llm.katz import score_held_out
from faretide.llm.language_id import identify
from faretide.llm.license_scan import scan_licenses
from faretide.llm.mixing import mix_sources
from faretide.llm.ngram_jaccard import ngram_components
from faretide.llm.quality_classifier import classify
from faretide.llm.quality_rules import quality_rules
from faretide.llm.runs import describe_runs
from faretide.llm.token_shards import write_shards
from faretide.llm.url_filter import Rule, judge_urls
from faretide.llm.whitening import whiten
from faretide.session import fresh_path, stage

#: A tokenizer's file outside the repository; its path is a parameter of the operator.
TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
#: How to store what is near the size of the input: ids take a third less than by Spark's default.
SMALL = {"compression": "zstd", "parquet.compression.codec.zstd.level": "5"}
RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_ngram_jaccard_join(spark, folder):
    return ngram_components(documents(spark, folder))


def op2_bpe(spark, folder):
    return encode_texts(documents(spark, folder), TOKENIZER, digests=True)


def op3_url_filters(spark, folder):
    return judge_urls(spark.read.parquet(f"{folder}/pages.parquet"), RULES)


def op4_language_id(spark, folder):
    return identify(documents(spark, folder))


def op5_fingerprints(spark, folder):
    return fingerprints(documents(spark, folder))


def op6_mixing(spark, folder):
    return mix_sources(documents(spark, folder))


def op7_quality_classifier(spark, folder):
    found = classify(documents(spark, folder))
    return found.select(
        "doc_id", "votes", F.round("posterior", 6).alias("posterior"), "score", "kept"
    )


def op8_quality_rules(spark, folder):
    return quality_rules(documents(spark, folder))


def op9_token_shards(spark, folder):
    # Both passes of the writer must see the same partitions, and texts are encoded once.
    ids = token_ids(documents(spark, folder), TOKENIZER, packed=True)
    ids = stage(ids, "ids", **SMALL)
    return write_shards(ids, fresh_path(spark, "shards"), ids_col="ids")


def op10_license_scans(spark, folder):
    return scan_licenses(documents(spark, folder))


def op11_periodic_runs(spark, folder):
    return describe_runs(documents(spark, folder), edit=True)


def op12_whitening(spark, folder):
    return whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_lm_scoring(spark, folder):
    return score_held_out(documents(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_bpe,
        op3_url_filters,
        op4_language_id,
        op5_fingerprints,
        op6_mixing,
        op7_quality_classifier,
        op8_quality_rules,
        op9_token_shards,
        op10_license_scans,
        op11_periodic_runs,
        op12_whitening,
        op13_lm_scoring,
    )
}

_WORDS = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORDS}') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r AS (
  SELECT a AS doc_id, a AS other FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce((SELECT min(other) FROM r WHERE r.doc_id = w.doc_id), w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)""",
    "op3_url_filters": f"""
WITH u AS (
  SELECT page_id,
         {_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(h, p, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, arg_max(h || p, len(h) * 1000 + len(p)) AS rule,
         arg_max(verdict, len(h) * 1000 + len(p)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN fits USING (page_id)""",
    "op8_quality_rules": f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
g AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram,
         length(array_to_string(w[i:i + k - 1], '')) AS chars
  FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i
        FROM d, (VALUES (2), (3), (5), (7), (10)) v(k))),
c AS (
  SELECT doc_id, k, gram, count(*) AS n, any_value(chars) AS chars
  FROM g GROUP BY ALL HAVING count(*) > 1),
top AS (
  SELECT doc_id, max(n * chars) FILTER (k = 2) AS top2, max(n * chars) FILTER (k = 3) AS top3
  FROM c GROUP BY doc_id),
p AS (
  SELECT DISTINCT doc_id, k, i + o AS pos
  FROM g JOIN c USING (doc_id, k, gram), range(10) r(o) WHERE o < k AND k > 2),
cover AS (
  SELECT doc_id, count(*) FILTER (k = 3) AS again,
         sum(length(w[pos])) FILTER (k = 5) AS r5, sum(length(w[pos])) FILTER (k = 7) AS r7,
         sum(length(w[pos])) FILTER (k = 10) AS r10
  FROM p JOIN d USING (doc_id) GROUP BY doc_id),
l AS (
  SELECT doc_id, line, count(*) AS n,
         any_value(length(array_to_string(regexp_extract_all(line, '{_WORDS}'), ''))) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_WORDS}') GROUP BY ALL),
lines AS (
  SELECT doc_id, sum(n) AS n_lines, sum(n - 1) AS dup, sum((n - 1) * chars) AS dup_chars
  FROM l GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(again, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(dup_chars, 0)::BIGINT AS dup_chars,
         greatest(length(array_to_string(w, '')), 1)::DOUBLE AS letters,
         coalesce(r5, 0)::DOUBLE AS r5, coalesce(r7, 0)::DOUBLE AS r7,
         coalesce(r10, 0)::DOUBLE AS r10,
         coalesce(top2, 0)::DOUBLE AS top2, coalesce(top3, 0)::DOUBLE AS top3
  FROM d LEFT JOIN top USING (doc_id) LEFT JOIN cover USING (doc_id)
         LEFT JOIN lines USING (doc_id)),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         r5 / letters > 0.35 OR r7 / letters > 0.30 OR r10 / letters > 0.25
         OR top2 / letters > 0.30 OR top3 / letters > 0.28 OR dup_chars > 0.40::DOUBLE * letters
         OR n_dup_lines > 0.40::DOUBLE * greatest(n_lines, 1)
         OR n_symbols > 0.2::DOUBLE * n_words AS bad FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT bad AS kept, n_lines, dup_chars / letters AS dup_line_chars,
       least(greatest(top2 / letters, top3 / letters), 1.0::DOUBLE) AS top_gram_chars,
       greatest(r5 / letters, r7 / letters, r10 / letters) AS repeat_chars,
       n_symbols / greatest(n_words, 1)::DOUBLE AS symbol_share
FROM v""",
    "op6_mixing": f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size,
         strlen(text) AS bytes FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5)
                / 4503599627370496)
            / CASE WHEN bytes / greatest(size, 1) - 1 BETWEEN 3 AND 10 THEN 1.0 ELSE 0.5 END AS key
  FROM d),
s AS (
  SELECT source, sum(size)::DOUBLE AS words, row_number() OVER (ORDER BY source NULLS LAST) AS turn
  FROM d GROUP BY source),
w AS (
  SELECT *, [5.0, 2.0, 1.0][(turn - 1) % 3 + 1]::DOUBLE AS weight,
         sum(words) OVER () * 150 / 100 AS total FROM s),
v AS (
  SELECT *, (total - coalesce(sum(2 * words) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW f AS (ORDER BY 2 * words / weight, source NULLS LAST)),
t AS (
  SELECT source, words,
         CASE WHEN 2 * words / weight <= level THEN 2 * words
              ELSE weight * (SELECT arg_min(level, 2 * words / weight) FROM v
                             WHERE 2 * words / weight > level) END AS target
  FROM v)
SELECT doc_id, size, words::BIGINT AS source_size, target,
       (CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END * size
        + greatest(0, least(size,
            round(target - CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END * words)
            - coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))
       )::BIGINT AS taken
FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source""",
}
