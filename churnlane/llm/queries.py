"""The registered queries of the training-data operators (Spark)."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.llm import (
    chat,
    decontam,
    divergence,
    langid,
    line_dedup,
    mixing,
    ngram_join,
    pieces,
    quality,
    runs,
    sharding,
    substring,
    tokens,
)
from churnlane.session import read_table


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer file lies; nothing is copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left of each document without those similar to an earlier line of the corpus."""
    return line_dedup.with_digest(line_dedup.remove_similar_lines(read_table(spark, sf_dir, "documents")))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal logged conversations, rendered."""
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and byte-level BPE tokens of every document; over 512 tokens or not."""
    return tokens.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the component of 5-word shingle sets at Jaccard 0.75 or more."""
    return (ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words inside benchmark windows, items found, and the verdict."""
    found = decontam.hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        decontam.contaminated().alias("contaminated"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of each document without the 13-word windows that earlier documents hold."""
    return substring.with_digest(substring.remove_repeats(read_table(spark, sf_dir, "documents")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~langid.held_out()))
    return langid.predict(docs.withColumn("held_out", langid.held_out()), model, carry=("doc_id", "held_out"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix at 100 % of all words takes from every document, by its source's target."""
    return (mixing.mix(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that the quality rules build on, and the cascade's verdict, for every document."""
    return quality.judge(read_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard (0 to 39), slot and the shard after one more joins, for every document."""
    return sharding_of(read_table(spark, sf_dir, "documents"))


def sharding_of(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Rows of ``docs`` over ``shards`` shards under the law ``key``, in the columns of op10."""
    root = sharding.tree(shards)
    rows = sharding.shard_rows(docs, root, later=sharding.grown(root, [shards]))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document with begin and end, and the text that they decode to."""
    out = pieces.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), check=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "library_agrees")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every two sources of a language, and the terms that each source overuses."""
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """For a tenth of the ids, a text that turns periodic after its first words (the query's contract)."""
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, the longest one, and the text without the repeats."""
    return runs.with_digest(runs.periodic_runs(read_table(spark, sf_dir, "documents"), edit=planted_repeats))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup,
    op2_chat_formatting,
    op3_token_counts,
    op4_ngram_jaccard_join,
    op5_benchmark_decontamination,
    op6_substring_dedup,
    op7_language_id,
    op8_mixing,
    op9_quality_rules,
    op10_sharding,
    op11_sentencepiece,
    op12_source_divergence,
    op13_periodic_runs,
)}
