"""The registered queries of the operators, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchlake.llm import byte_bpe, divergence, minhash, outliers, quality, sharding, spelling, token_counts, toxicity, url_filters, warc, weighted_sampling, winnowing
from catchlake.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return keep


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.CnnModel:
    return toxicity.fit_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), fold("doc_id", 3) != 1)


@register("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = toxicity_model(spark, folder)
    scored = toxicity.with_toxicity(docs, model, keep=["doc_id", "lang"])
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         (F.col("score") >= toxicity.threshold_of(model)).alias("rejected"))


SHARDS = 24


@register("op2_sharding")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), F.col("_source").alias("source"))


@register("op3_byte_bpe")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encode_and_decode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                      public_tokenizers.PATTERN)


def quality_model(spark: SparkSession, folder: str) -> quality.MilModel:
    return quality.fit_quality(table(spark, folder, "documents"), table(spark, folder, "labels"), fold("doc_id", 5) != 0)


@register("op4_quality")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    model = quality_model(spark, folder)
    scored = quality.with_quality(table(spark, folder, "documents").select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op5_token_counts")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 4096)


BASE32_SQL = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(digest, {5 * g + 1}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
    for g in range(8) for shift in (15, 10, 5, 0))


@register("op9_warc", f"""
WITH bodies AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS low FROM bodies GROUP BY digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {BASE32_SQL} AS payload_digest,
  CASE WHEN page_id > low THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > low THEN low END AS refers_to
FROM bodies JOIN firsts USING (digest)""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, folder, "pages").select("page_id", "url", "html"))


@register("op6_outliers")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.rule_verdicts(table(spark, folder, "documents"))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@register("op7_url_filters", """
WITH cut AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (SELECT page_id, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
         FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, RULES))} AS rules(host, path, verdict)")
    return url_filters.judged_pages(table(spark, folder, "pages"), rules)


@register("op8_minhash", r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i
  FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON b.gram = a.gram AND b.doc_id > a.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, s.b FROM reached r JOIN steps s ON s.a = r.other)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), minhash.MinHashSettings(words=3, percent=85))


@register("op10_decontamination", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_at AS (SELECT item_id, w, least(len(w), 10) AS span, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, span, array_to_string(w[i:i + span - 1], ' ') AS gram FROM item_at),
doc_at AS (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS i FROM d, (SELECT DISTINCT span FROM item_windows) WHERE len(w) >= span),
doc_windows AS (SELECT doc_id, span, i, array_to_string(w[i:i + span - 1], ' ') AS gram FROM doc_at),
hits AS (SELECT doc_id, i, span, item_id FROM doc_windows JOIN item_windows USING (span, gram)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + span)) AS place FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.contaminated_words(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


#: crc32 is made by its table of 256 remainders, since DuckDB has no function for it; near words meet in what is left without one letter.
@register("op11_spelling_variants", r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT CAST(range AS BIGINT) AS n FROM range(256))),
runs AS (SELECT id, run, count(*) AS k FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
  unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
coded AS (SELECT id, run, k, hex(encode(id || ':' || run)) AS code FROM runs),
hashed AS (SELECT run, k, xor(list_reduce([4294967295] || list_transform(range(length(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM coded, crc),
edited AS (SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cut AS (SELECT word, n, length(word) AS len, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.len = b.len AND a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT w.word, c.word, c.n FROM words w JOIN cut c ON c.rest = w.word
  UNION SELECT c.word, w.word, w.n FROM words w JOIN cut c ON c.rest = w.word),
ranked AS (SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place FROM near),
formed AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
steps AS (SELECT word, word AS at FROM words UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN steps s ON s.word = f.word JOIN formed e ON e.word = s.at AND e.form IS NULL
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


@register("op12_weighted_sampling")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return weighted_sampling.fingerprints(table(spark, folder, "documents"))


@register("op13_divergence_audit", r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tf AS (SELECT lang, source, doc, term, count(*) AS n FROM (SELECT lang, source, doc, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM tf GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(t.n, 0)::HUGEINT AS n FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM tf GROUP BY ALL) t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
priced AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 2 * v) AS p,
  1 + (1000000000 * (lang_n + 2)) // (total + 2 * v) AS q FROM counts JOIN sizes USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM priced WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found) WHERE part = 'pair' OR rank <= 10
""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence_audit(table(spark, folder, "documents"))
