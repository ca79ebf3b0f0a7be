"""The training-data pipeline over ``documents``: five stages, each written before the next.

1. toxicity: documents that the classifier chain rejects go.
2. near_dedup: one document of each near-duplicate class stays, the one of least id; linked
   are documents that share at least ``NEAR_PERCENT`` of their five-word shingles.
3. decontaminate: passages of the benchmark are cut out of the texts; a document without a
   word left goes.
4. secrets: findings are replaced by a mark.
5. byte_bpe: every text as token ids, with their number and the digest of the text decoded
   from them.

Stages 1 to 4 return the columns of ``documents``; where a text changes, ``n_chars``
follows it. Rows with a NULL id pass like any other and are never near-duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelmill.llm import bpe, chosen_path, decontaminate, secret_scan, toxicity
from reelmill.llm.queries import CHAIN, default_vocabulary, table
from reelmill.llm.scratch import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

NEAR_PERCENT = 80


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The chain is fitted on the labelled rows among ``docs``."""
    labels = toxicity.chain_labels(table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, toxicity.train(docs, labels, CHAIN), CHAIN)
    return scored.where(F.col("p_toxic") < toxicity.REJECT).select(*docs.columns)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected ids are the smaller side; they are matched, never broadcast unchecked."""
    classes = chosen_path.near_duplicates(docs, percent=NEAR_PERCENT)
    gone = classes.where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    left = (F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words"))
    return _with_text(docs, marked.where(left), decontaminate.without_spans())


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(docs, secret_scan.scan(docs), secret_scan.redacted())


def _byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = default_vocabulary()
    encoded = bpe.encode(docs.select("doc_id", "text"), vocabulary).drop("text")
    decoded = bpe.decode(encoded, vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _with_text(docs: DataFrame, found: DataFrame, text) -> DataFrame:
    """``docs``' columns of ``found`` with a new text and its length."""
    changed = found.withColumn("_text", text)
    size = F.length("_text").cast(docs.schema["n_chars"].dataType)
    same = F.col("_text").eqNullSafe(F.col("text"))
    new = {
        "text": F.col("_text").alias("text"),
        "n_chars": F.when(same, F.col("n_chars")).otherwise(size).alias("n_chars"),
    }
    return changed.select(*[new.get(c, F.col(c)) for c in docs.columns])


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _toxicity),
    ("near_dedup", _near_dedup),
    ("decontaminate", _decontaminate),
    ("secrets", _secrets),
    ("byte_bpe", _byte_bpe),
]

# The classifier chain is trained, so SQL cannot give the rows of ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written and read again."""
    space = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = space.store(stage(spark, docs, sf_dir), name)
    return docs
