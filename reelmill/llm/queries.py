"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelmill.llm import (
    bpe, chosen_path, count_cells, decontaminate, licence_scan, line_rules, paragraph_dedup, passages,
    quality, secret_scan, spelling, token_counts, toxicity, training_order,
)
from reelmill.llm.indicators import in_hash_part

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.read_vocabulary(path, public_tokenizers.PATTERN)


def default_merges() -> token_counts.Merges:
    import public_tokenizers

    return token_counts.read_merges(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


@query
def op4_byte_bpe(spark, sf_dir):
    """Ids of every text, and the text decoded from them, as digests."""
    vocabulary = default_vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, vocabulary).drop("text")
    both = bpe.decode(encoded, vocabulary)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_decontaminate(spark, sf_dir):
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_chosen_path(spark, sf_dir):
    """Near-duplicate classes of all documents."""
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_nbsvm_quality(spark, sf_dir):
    """Quality score of every document; a fifth of the ids never gives labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = in_hash_part("doc_id", 5)
    model = quality.train(docs, table(spark, sf_dir, "labels").where(part != 0))
    return quality.score(docs, model).select(
        "doc_id",
        (part == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


CHAIN = ("junk", "toxic")


@query
def op1_toxicity_chain(spark, sf_dir):
    """Category probabilities of every document, and whether it is rejected as toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = toxicity.chain_labels(table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, toxicity.train(docs, labels, CHAIN), CHAIN)
    return scored.select("doc_id", "p_junk", "p_toxic", (F.col("p_toxic") >= toxicity.REJECT).alias("toxic"))


@query
def op8_entropy_secrets(spark, sf_dir):
    """Base findings and entropy findings in every document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda f: f["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("found")).alias("spans"),
    )


@query
def op9_line_rules(spark, sf_dir):
    """Line measures and the verdict on every document."""
    judged = line_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query
def op10_paragraph_dedup(spark, sf_dir):
    """Paragraphs that repeat across all documents, and which of them are removed."""
    return paragraph_dedup.removals(table(spark, sf_dir, "documents"))


@query
def op6_licence_rules(spark, sf_dir):
    """Licence sentences and licences of every document."""
    found = licence_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )


@query
def op7_training_order(spark, sf_dir):
    """Slot, shard and byte offset of every token sequence of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed, _ = training_order.materialise(docs, default_vocabulary(), key=20_240_602)
    return placed


@query
def op10_repeated_passages(spark, sf_dir):
    """Runs of 50 words and more that repeat, wherever they start; beside the lines of op10."""
    return passages.passages(table(spark, sf_dir, "documents"))


CONTEXT_TOKENS = 1024


@query
def op13_token_counts(spark, sf_dir):
    """Bytes and tokens of every text, and whether it is longer than the context."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = token_counts.count_tokens(docs, default_merges())
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT_TOKENS).alias("over_limit")
    )


@query
def op12_source_divergence(spark, sf_dir):
    """How far sources of a language are apart, and the terms that mark each source."""
    audit = count_cells.Audit(table(spark, sf_dir, "documents"))
    parts = {"pair": audit.pairs(), "term": audit.top_terms()}
    pair, term = (df.withColumn("part", F.lit(name)) for name, df in parts.items())
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")


@query
def op11_spelling_variants(spark, sf_dir):
    """Words of all documents, the near form that is used more, and the root it leads to."""
    return spelling.variants(table(spark, sf_dir, "documents"))
