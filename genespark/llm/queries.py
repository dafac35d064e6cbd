"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, dartminhash, decontam, huffman, licenses, packing, quality, sharding, storage, toxicity, warc

END_ID = 1
SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.scratch(spark, "ids")
    huffman.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return huffman.read_ids(spark, folder)


def op2_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = dartminhash.classes(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "class_id", "class_size")


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fitted = toxicity.train_on(docs, table(spark, sf_dir, "labels"))
    limit = fitted.limits[-1] if fitted.limits else 1.0
    return toxicity.score(docs, fitted).withColumn("is_toxic", F.col("toxic") >= limit)


def op4_pigeonhole_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_chat_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    folder = storage.scratch(spark, "chat")
    chat.write(rows, folder)
    return chat.read(spark, folder).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_huffman_ids, op2_dartminhash, op3_toxicity_chain, op4_pigeonhole_decontam, op5_lpt_shards, op6_quality_cascade, op7_mixture_packing, op8_license_dice, op9_warc_revisits, op10_chat_rendering, pipeline)}


def quality_sql() -> str:
    """Word statistics by list functions; windows of three words are numbered and counted in each document."""
    rules = {"word_chars * 1 < 2 * n_words", "word_chars * 1 > 20 * n_words", "n_symbols * 10 > 2 * n_words", "n_caps * 10 > 3 * n_words", "n_dup_lines * 10 > 1 * n_words"}
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
tri AS (SELECT r, unnest(range(1, len(ws) - 1)) AS k, ws FROM w WHERE len(ws) >= 3),
grams AS (SELECT r, k, ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2] AS g FROM tri),
twice AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
marked AS (SELECT r, count(DISTINCT k + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
s AS (SELECT w.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines, coalesce(marked.n, 0) AS n_repeat_words,
  len(list_filter(ws, lambda x: strlen(x) > 1 AND regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_caps
  FROM w LEFT JOIN dups USING (r) LEFT JOIN marked USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(sorted(rules))}) AS kept FROM b"""


def license_sql() -> str:
    values = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in sorted(licenses.TEMPLATES.items()))
    words = r"regexp_extract_all(lower({}), '[a-z0-9]+(?:\.[a-z0-9]+)*')"
    pairs = "list_distinct(list_transform(range(1, len({0})), lambda k: {0}[k] || ' ' || {0}[k + 1]))"
    return f"""
WITH t(license, notice) AS (VALUES {values}),
tw AS (SELECT license, {words.format("notice")} AS ws FROM t),
tp AS (SELECT license, {pairs.format("ws")} AS tb FROM tw),
l AS (SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
u AS (SELECT r, doc_id, unnest(range(0, len(ls))) AS line_no, ls FROM l),
lw AS (SELECT r, doc_id, line_no, {words.format("ls[line_no + 1]")} AS ws FROM u),
lp AS (SELECT r, doc_id, line_no, {pairs.format("ws")} AS lb FROM lw WHERE len(ws) BETWEEN 2 AND 200),
s AS (SELECT r, doc_id, line_no, license, 2.0::DOUBLE * len(list_intersect(lb, tb)) / (len(lb) + len(tb)) AS dice FROM lp, tp
  WHERE 2 * least(len(lb), len(tb)) >= {licenses.THRESHOLD} * (len(lb) + len(tb)))
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, license, round(dice, 6) AS dice FROM s WHERE dice >= {licenses.THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY r, line_no ORDER BY dice DESC, license) = 1"""


def warc_sql() -> str:
    piece = "lpad(lower(to_base(CAST(concat('0x', substr(h, {}, 10)) AS BIGINT), 32)), 8, '0')"
    digits = " || ".join(piece.format(1 + 10 * k) for k in range(4))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h FROM p),
d AS (SELECT page_id, payload_bytes, translate(upper({digits}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS i FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN i = 1 OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN i > 1 THEN first END AS refers_to FROM f"""


def chat_sql() -> str:
    escape = r"regexp_replace({}, '(\\|### |###$|</turn>)', '\\\1', 'g')"
    return rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length('### : ' || ' </turn>' || chr(10)) + length(replace({escape.format("role")}, ':', '\:')) + length({escape.format("text")}) AS n FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""


ORACLE_SQL = {"op6_quality_cascade": quality_sql(), "op8_license_dice": license_sql(), "op9_warc_revisits": warc_sql(), "op10_chat_rendering": chat_sql()}
