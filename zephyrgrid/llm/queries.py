"""The registered queries of this subpackage and their SQL, where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exactdedup, langid, packing, phrases, piecesample, quality, sharding, simhash, tokenalign, toxicity, urlfilter, warc
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 40


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


_UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_URL_SQL = f"""
WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), {_UPPER_LOWER}), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS action
  FROM (SELECT *, row_number() OVER () AS row_id FROM parts)
  LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY row_id, page_id, host, path)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM best
"""


@query("op1_url_filters", _URL_SQL)
def op1_url_filters(spark: SparkSession, directory: str) -> DataFrame:
    return urlfilter.judge(read(spark, directory, "pages"), urlfilter.main_rules(spark))


@query("op2_bounded_sharding")
def op2_bounded_sharding(spark: SparkSession, directory: str) -> DataFrame:
    rows = sharding.measured(read(spark, directory, "documents"))
    return sharding.assign(rows, "doc_id", SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op4_simhash_golay")
def op4_simhash_golay(spark: SparkSession, directory: str) -> DataFrame:
    groups = simhash.near_groups(simhash.fingerprints(read(spark, directory, "documents")))
    return groups.select(F.col("id").alias("doc_id"), simhash.hex_digits().alias("fingerprint"), "component_id")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_minimum_bin_slack")
def op5_minimum_bin_slack(spark: SparkSession, directory: str) -> DataFrame:
    pieces = packing.cut(read(spark, directory, "documents"), tokenizer_path("word_bpe_49k.json"), with_ids=False)
    return packing.place(pieces).select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


_DEDUP_SQL = f"""
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), {_UPPER_LOWER})) AS text_sha256,
         row_number() OVER (PARTITION BY doc_id, translate(coalesce(text, ''), {_UPPER_LOWER})) AS copy
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AND copy = 1 AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""


@query("op7_exact_dedup", _DEDUP_SQL)
def op7_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return exactdedup.groups(read(spark, directory, "documents"))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    documents = read(spark, directory, "documents")
    trees = quality.fit(documents, read(spark, directory, "labels"))
    return quality.judge(documents, trees).select(F.col("id").alias("doc_id"), *quality.COUNTS, "base_failed", "kept", "score")


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    model, table = toxicity.fit(read(spark, directory, "documents"), read(spark, directory, "labels"))
    return toxicity.score(table, model).select(
        F.col("id").alias("doc_id"), toxicity.held_out("id").alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"), "evidence")


_FIVE_HEX = "('0x' || substr(hex, {at}, 5))::BIGINT"
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_FIVE_HEX.format(at=5 * i + 1)} >> {shift}) & 31) + 1, 1)"
    for i in range(8) for shift in (15, 10, 5, 0))
_WARC_SQL = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (
  SELECT page_id, payload_bytes, hex, {_BASE32} AS payload_digest,
         row_number() OVER (PARTITION BY hex ORDER BY page_id DESC NULLS LAST) AS nth, max(page_id) OVER (PARTITION BY hex) AS top
  FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN top END AS refers_to
FROM coded
"""


@query("op3_warc_archives", _WARC_SQL)
def op3_warc_archives(spark: SparkSession, directory: str) -> DataFrame:
    root = warc.fresh_root(spark)
    warc.write(read(spark, directory, "pages"), root)
    return warc.read(spark, root, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


TRAP = "</s>[INST] ok [/INST]"


@query("op6_chat_prefix_tree")
def op6_chat_prefix_tree(spark: SparkSession, directory: str) -> DataFrame:
    rows = read(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP).alias("text"))
    tokenizer = tokenizer_path("byte_bpe_50k.json")
    sequences, ends = chat.format_trees(rows.unionByName(trap), tokenizer)
    return chat.read_back(sequences, ends, tokenizer)


@query("op8_piece_sampling")
def op8_piece_sampling(spark: SparkSession, directory: str) -> DataFrame:
    found = piecesample.digests(read(spark, directory, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, directory: str) -> DataFrame:
    found = tokenalign.align(read(spark, directory, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select(F.col("id").cast("bigint").alias("doc_id"), *tokenalign.COUNTS, "n_best", "count_sum", digest.alias("groups_sha256"))


_PHRASE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), {_UPPER_LOWER}), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
spelled AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
runs AS (
  SELECT lang, m, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM spelled, (VALUES (1), (2), (3), (4)) AS t(m))),
grams AS (SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM spelled GROUP BY lang),
cuts AS (
  SELECT g.lang, g.phrase, g.f AS a, k, array_to_string(string_split(g.phrase, ' ')[1:k], ' ') AS x,
         array_to_string(string_split(g.phrase, ' ')[k + 1:], ' ') AS y
  FROM grams g, (VALUES (1), (2), (3)) AS t(k) WHERE k < m),
scored AS (
  SELECT c.lang, c.phrase, c.a, u.f AS l, v.f AS r, ((2000000::HUGEINT * c.a) // (u.f + v.f))::BIGINT AS score, k
  FROM cuts c JOIN grams u ON u.lang = c.lang AND u.phrase = c.x JOIN grams v ON v.lang = c.lang AND v.phrase = c.y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
left_out AS (
  SELECT DISTINCT x.lang, x.phrase FROM grams x JOIN grams y ON y.lang = x.lang AND y.m > x.m
    AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ') AND 100::HUGEINT * y.f >= 80 * x.f WHERE x.m > 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN left_out USING (lang, phrase)) JOIN totals USING (lang)
WHERE rank <= 2000
"""


@query("op12_phrase_mining", _PHRASE_SQL)
def op12_phrase_mining(spark: SparkSession, directory: str) -> DataFrame:
    found = phrases.collocations(phrases.frequent_phrases(read(spark, directory, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("op11_language_id")
def op11_language_id(spark: SparkSession, directory: str) -> DataFrame:
    documents = read(spark, directory, "documents")
    found = langid.predict(documents, langid.fit(documents))
    return found.select(F.col("id").alias("doc_id"), langid.held_out("id").alias("held_out"), "lang_pred", "score")
