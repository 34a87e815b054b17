"""One registered query per training-data operator, over its whole table.

Each query calls its operator with production parameters and derives the
digest columns from the operator's real output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tempora.llm import (chat, collocations, decontaminate, html_extract, langid, mixing, ngram_join, periodic,
                         quality, sharding, substring, token_counts, warc)

# the tokenizer file of op12, at the same path on every executor
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "shards")


def op2_byte_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "size",
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "item_id", "start", "n_words", "similarity", "distance")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(_table(spark, sf_dir, "pages"))


def op7_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn(
        "held_out", F.expr("coalesce(crc32(cast(doc_id as string)) % 4 = 2, false)"))
    learned = langid.learn(docs.where("not held_out"))
    # "und" is for null or letterless texts only: nothing is rejected for a narrow margin
    return langid.predict(docs, learned, extra=("held_out",), min_margin=0.0)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema)
    return chat.read_back(chat.format_conversations(rows.union(more)))


def op11_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = BYTE_BPE) -> DataFrame:
    return token_counts.prefix_counts(_table(spark, sf_dir, "documents"), tokenizer).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def with_periods(docs: DataFrame) -> DataFrame:
    """The texts of op13: where crc32(doc_id) is a multiple of 10, the words from a on repeat with period p."""
    hashed = docs.select("doc_id", "text", F.expr("crc32(cast(doc_id as string))").alias("h"))
    parts = hashed.withColumn("w", F.expr(
        r"if(h % 10 = 0, array_remove(split(text, '[\\x20\\x09-\\x0D]+'), ''), cast(null as array<string>))"))
    parts = parts.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))         .withColumn("a", F.expr("if(n > 0, cast(g % n as int), 0)"))         .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    # n <= 0: another remainder, a null text or a text without words
    return parts.select("doc_id", F.expr(
        "if(n > 0, array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), "
        "cast(ceil((n - a) / p) as int))), 1, n - a)), ' '), text)").alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = periodic.collapse(with_periods(_table(spark, sf_dir, "documents")))
    # the greatest length / period exactly: cross products, then the smaller start and period
    best = F.expr("""reduce(runs, cast(null as struct<start:bigint,period:bigint,length:bigint>), (m, r) ->
        if(m is null or r.length * m.period > m.length * r.period
           or (r.length * m.period = m.length * r.period and (r.start, r.period) < (m.start, m.period)), r, m))""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return done.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("m"),
        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("m.start").alias("start"), F.col("m.length").alias("length"),
        F.col("m.period").alias("period"),
        F.expr("1000 * m.length div m.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_byte_sharding, op3_substring_dedup, op4_decontamination, op5_quality_rules,
    op6_html_extraction, op7_warc_zstd, op8_ngram_jaccard_join, op9_language_id, op10_chat_formatting,
    op11_collocation_mining, op12_token_counts, op13_periodic_runs)}
ORACLES: dict[str, str] = {"op11_collocation_mining": collocations.ORACLE_SQL}
