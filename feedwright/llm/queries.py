"""The registered queries of the operators, one for each, and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from feedwright.llm import (
    bpe,
    chat_format,
    collocations,
    conversation_repair,
    html_main,
    mixing,
    packing,
    permutation_index,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
)
from feedwright.llm.common import ascii_lower, read, word_count
from feedwright.llm.exact_dedup import exact_dedup

TOKENIZER = "word_bpe_49k.json"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)
    return marked.select("doc_id", "keep_id", "group_size", "kept", digest.alias("text_sha256"))


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return permutation_index.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, read(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path(TOKENIZER)
    coded = bpe.encode_and_decode(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer)
    return token_digests(coded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def token_digests(decoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return decoded.withColumns(
        {
            "n_tokens": F.size("ids").cast("bigint"),
            "ids_sha256": F.sha2(ids.cast("binary"), 256),
            "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256),
        }
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeated(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_secrets(docs, ranks=secret_scan.learn_words(docs))

    def of(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def listed(findings: Column) -> Column:
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")

    base = F.filter("findings", lambda f: f["kind"] != "guess")
    return found.select(
        "doc_id",
        of("assign"),
        of("access"),
        of("hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
        of("guess"),
        F.array_max(F.transform("findings", lambda f: f["log10_guesses"])).alias("most_log10_guesses"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return found.select("doc_id", "fingerprint", "component_id")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.render_perspectives(read(spark, sf_dir, "conversations"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    extracted = html_main.extract_main(pages, html_main.learn_weights(pages))
    return extracted.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents").select("lang", "text"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    found = conversation_repair.repair(conversation_repair.damaged(conversations))
    digests = conversation_repair.transcript_digests(found.rows)
    every = conversations.select(F.col("conv_id").alias("_conv")).distinct()

    def same(df: DataFrame) -> Column:
        return F.col("_conv").eqNullSafe(df["conv_id"])

    known = every.join(found.report, same(found.report), "left").drop("conv_id").join(digests, same(digests), "left")
    return known.select(
        F.col("_conv").alias("conv_id"),
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_permutation_index": op2_permutation_index,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_bpe": op4_bpe,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_mix_sources": op6_mix_sources,
    "op7_secret_scan": op7_secret_scan,
    "op8_simhash": op8_simhash,
    "op9_chat_format": op9_chat_format,
    "op10_html_extract": op10_html_extract,
    "op11_collocations": op11_collocations,
    "op12_packing": op12_packing,
    "op13_conversation_repair": op13_conversation_repair,
}

UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Only what SQL can express; the others are tested against brute force or held-out accuracy.
ORACLE = {
    "op1_exact_dedup": f"""
        WITH docs AS (SELECT doc_id, translate(coalesce(text, ''), {UPPER_LOWER}) AS body FROM documents),
        best AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM docs GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM docs JOIN best USING (body)""",
    "op9_chat_format": chat_format.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
}
