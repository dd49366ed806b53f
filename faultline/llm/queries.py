"""The registered queries of this package: every operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import crf, hardneg, langid, lexical, mixing, multiset, packing, risk, sentencepieces, simhash
from faultline.llm import urlrules, warc, weaklabel
from faultline.llm.common import cut, shared_path

QueryFn = Callable[[SparkSession, str], DataFrame]

# The rules of the url query.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (4-word shingles, 4 bits)."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives with revisits, and read back without a gap."""
    path = shared_path(spark, "archives")
    rows = warc.with_revisits(_table(spark, sf_dir, "pages"), "page_id", "url", "html")
    archives = cut(warc.write_warc(rows, path), "archive-list")
    read = warc.read_back(spark, path, archives)
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")
    return read.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )


def op3_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of all documents and of their edited texts."""
    return multiset.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of the url rules on all pages."""
    rules = urlrules.rule_table(spark, URL_RULES)
    judged = urlrules.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules, "url")
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and risk-controlled rules on all documents."""
    judged = risk.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*cols, F.array_join("failed_rules", ",").alias("failed_rules"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weak-label classifier's verdict on all documents."""
    return weaklabel.classify(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return crf.personal_data(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector against all vectors; every seventh row's label is moved first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    coded = sentencepieces.encode(_table(spark, sf_dir, "documents"), piece_model_path())
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).alias("n_bytes"),
    )


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, QueryFn]:
    ops = (
        op1_simhash, op2_warc, op3_multiset, op4_urls, op5_quality_rules, op6_quality_classifier, op7_language,
        op8_personal_data, op9_packing, op10_mixing, op11_hard_negatives, op12_sentencepiece, op13_search,
    )
    return {f.__name__: f for f in ops}


# The url rules, judged one by one: an independent form of the sweep.
OP4_SQL = r"""
WITH cut AS (
  SELECT page_id,
    CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN NULL ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
rules(verdict, rhost, rpath) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
best AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.rhost || r.rpath, length(r.rhost || r.rpath)) AS rule,
    arg_max(r.verdict, length(r.rhost || r.rpath)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
  GROUP BY ALL)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b USING (page_id, host, path)
"""

OP2_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM m
"""


# Every pair of an anchor and another row is scored.
OP11_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.vector, b.vector), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

# Scores of all pairs of an item and a document that share a term.
OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY ALL), totals),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark),
items AS (SELECT item_id, term, count(*) AS c FROM asked GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id,
    CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // l)))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op4_urls": OP4_SQL, "op11_hard_negatives": OP11_SQL, "op13_search": OP13_SQL}
