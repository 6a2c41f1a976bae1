"""The registered query of each operator: production parameters, whole tables,
full results in the columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import conversation_trie, embedding_dedup, exact_dedup, line_dedup, mixing, packing, secrets, simhash, spelling, substring_dedup, token_counts, toxicity, url_filter
from tabml.llm.common import read


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents")).drop("row_hash")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the counts and the checksum are of the base
    spans, ``spans`` also has those that decoding finds."""
    found = secrets.secrets(read(spark, sf_dir, "documents"))
    plain = F.transform("decoded", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.select(
        "doc_id", *[secrets.count_kind(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.concat("base", plain)).alias("spans"),
        F.size("decoded").cast("long").alias("n_decoded"), F.col("n_layers").cast("long").alias("n_layers"),
        F.col("n_oversize").cast("long").alias("n_oversize"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles over all documents, linked at up to 3 bits."""
    return simhash.simhash(read(spark, sf_dir, "documents"), words=3, distance=3).drop("fp")


#: the rules of op4
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return url_filter.judge(read(spark, sf_dir, "pages"), RULES)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix_sizes(read(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.98 and more between all embeddings with equal labels."""
    return embedding_dedup.embedding_dedup(read(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the 20-word windows that start earlier."""
    kept = substring_dedup.substring_dedup(read(spark, sf_dir, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece tokens of every document."""
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of all documents in windows of 1024 tokens, ids as a checksum."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed."""
    return packed(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, learned from the labels."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.score(docs, toxicity.fit(docs.select("doc_id", "text"), labels))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that a smaller doc_id has."""
    kept = line_dedup.line_dedup(read(spark, sf_dir, "documents"), chars=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their near words, forms and roots."""
    return spelling.spelling_variants(read(spark, sf_dir, "documents"), chars=7, count=2, every=31, ratio=10)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return conversation_trie.conversation_trie(read(spark, sf_dir, "conversations"), share=(5, 9))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_secrets, op3_simhash, op4_url_filter, op5_source_mix, op6_embedding_dedup, op7_substring_dedup, op8_token_counts, op9_packing, op10_toxicity,
    op11_line_dedup, op12_spelling_variants, op13_conversation_trie)}
