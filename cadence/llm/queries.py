"""Registered queries of the subpackage: each applies one operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, fingerprint, html_extract, importance, langid, line_dedup, mixing, near_dup, packing
from . import oracles, substring_dedup, topk, toxicity, url_filter
from .common import table

# Rules of the URL contract.
URL_RULES = (
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
)
# Hosts that judge URLs without a rule: a list a user would bring along.
SPAM_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
SPAM_HOSTS = tuple(f"{name}.example.{top}" for name in SPAM_NAMES for top in ("com", "net", "org"))

SEQUENCE = 4096
END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_pages(pages).select("page_id", "url", "text", "n_chars")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = spark.createDataFrame([(h,) for h in SPAM_HOSTS], "host string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES, hosts).select("page_id", "host", "path", "rule", "verdict")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_dedup.remove_repeated(docs, whole=True)
    return cleaned.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), "removed_lines")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_check(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Machine trained on the labelled documents outside the held-out part."""
    labels = table(spark, sf_dir, "labels").where("toxic is not null").select("doc_id", F.col("toxic").alias("toxic_"))
    labels = labels.where(~langid.held_out(F.col("doc_id"), 4, 2))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id_"), F.col("text").alias("text_"))
    labelled = docs.select("id_").join(labels.withColumnRenamed("doc_id", "id_"), "id_")
    return toxicity.train(labelled, texts=docs)


TOXIC_AT = 0.3


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        langid.held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"),
    )


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = langid.held_out(F.col("doc_id"), 3, 1)
    labelled = docs.where(~part & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = langid.train(labelled.select(F.col("doc_id").alias("id_"), F.col("text").alias("text_"), F.col("lang").alias("lang_")))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", part.alias("held_out"), "lang_pred", "score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dup.link(docs).select("doc_id", "n_shingles", "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "copies", "extra")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID, SEQUENCE)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = substring_dedup.remove_repeated(docs, width=35)
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return left.select("doc_id", "n_words", "n_removed", kept)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gain = importance.gains(docs, table(spark, sf_dir, "benchmark"))
    drawn = importance.draw(importance.weigh(docs, gain, keep=["doc_id"]), percent=5, least_words=20, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the faults of the contract; ``here_`` is false for dropped rows."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select(
        "conv_id",
        "turn",
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.crc32(key) % 20).alias("fault_"),
    )
    text = (
        F.when(F.col("fault_") == 1, "").when(F.col("fault_") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    )
    role = F.when(F.col("fault_") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault_") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault_") != 0).alias("here_"), F.explode(copies)
    ).drop("col")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return conversation_repair.audit(turns, present=F.col("here_"))


_HOST = "coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = "coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '')"
_RULE_ROWS = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
_SPAM_ROWS = ", ".join(f"('{h}')" for h in SPAM_HOSTS)

OP2_SQL = f"""
WITH u AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path, row_number() OVER () AS n FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
spam(name) AS (VALUES {_SPAM_ROWS}),
best AS (
  SELECT u.n, max_by(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) AS rule,
         max_by(r.verdict, length(r.rule_host || r.rule_path)) AS verdict
  FROM u JOIN rules r
    ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
  GROUP BY u.n),
listed AS (
  SELECT DISTINCT u.n FROM u JOIN spam s ON u.host = s.name OR ends_with(u.host, '.' || s.name))
SELECT u.page_id, u.host, u.path, best.rule,
       coalesce(best.verdict, CASE WHEN listed.n IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM u LEFT JOIN best USING (n) LEFT JOIN listed USING (n)
"""

OP3_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.n AS qn, v.vec_id,
         list_inner_product(q.c::DOUBLE[], v.c::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v ON q.n <> v.n WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY qn ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

QUERIES = {
    "op1_html_extract": op1_html_extract,
    "op2_url_filter": op2_url_filter,
    "op3_topk": op3_topk,
    "op4_line_dedup": op4_line_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_toxicity": op6_toxicity,
    "op7_langid": op7_langid,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_mixing": op9_mixing,
    "op10_packing": op10_packing,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_importance": op12_importance,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLE_SQL = {"op2_url_filter": OP2_SQL, "op3_topk": OP3_SQL, **oracles.ORACLE_SQL}
