"""Substring deduplication by paragraphs: MinHash banding, exact Jaccard, components.

A paragraph is a line of at least ``LEAST_WORDS`` words. Paragraphs with equal sets of
five-word shingles are one item. Items are joined on bands of minwise tokens; rows and
bands are tuned so that a pair at the threshold collides with a probability of at least
``RECALL``. Colliding items are verified by exact Jaccard on whole paragraphs (see
``setlinks`` for large buckets), and in each component all but the first occurrence are
removals.

Only the keys and tokens of paragraphs are shuffled; of the texts, only those that collide
are verified.

Defined results: NULL and empty texts have no paragraphs; rows without an id are left out;
rows that repeat an id with another text are told apart by the text, equal rows are
occurrences of their own; paragraphs that occur once and have no link are left out; very long lines
are one paragraph each; an empty table gives no rows; other columns are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.scratch import Scratch
from reelmill.llm.setlinks import LEAF, minwise, settle, texts_of
from reelmill.llm.words import WordHashes, by_bytes, shingle_set, spaced_words

LEAST_WORDS = 30
PERCENT = 80
RECALL = 0.9999
MOST_TOKENS = 64


def tuned(similarity: float, recall: float = RECALL, tokens: int = MOST_TOKENS) -> tuple[int, int]:
    """Bands and rows: the most rows, so the fewest chance collisions, that reach ``recall``."""
    for rows in range(tokens, 0, -1):
        bands = ceil(log(1 - recall) / log(1 - similarity**rows))
        if bands * rows <= tokens:
            return bands, rows
    raise ValueError("no banding reaches this recall with so many tokens")


def paragraphs(docs: DataFrame, tokens: int, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every paragraph with its place (code points, end exclusive), item and tokens."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("version", T.LongType()),
            T.StructField("paragraph", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("n_words", T.IntegerType()),
            T.StructField("item", T.BinaryType()),
            T.StructField("sketch", T.ArrayType(T.IntegerType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_bytes(batches, "text"):
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "version", "text")]
            for key, version, text in zip(*columns):
                at = 0
                for number, line in enumerate(text.split("\n")):
                    words = spaced_words(line.encode())
                    if len(words) >= least_words:
                        values = shingle_set(hashes.of(words))
                        item = xxhash.xxh3_128_digest(values.tobytes())
                        place = (key, version, number, at, at + len(line), len(words))
                        out.append((*place, item, minwise(values, tokens)))
                    at += len(line) + 1
            filled = list(zip(*out)) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(filled, arrow)], schema=arrow
            )

    given = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    return given.select("doc_id", F.xxhash64("text").alias("version"), "text").mapInArrow(cut, schema)


def removals(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Every paragraph that repeats: its place, its component's first paragraph, its fate.

    Columns: ``doc_id, paragraph, start, end, n_words, first_doc_id, first_paragraph,
    n_copies, removed``. The result reads tables in the session's checkpoint folder.
    """
    bands, rows = tuned(percent / 100)
    space = Scratch(docs.sparkSession, "paragraphs")
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = paragraphs(given, bands * rows, least_words)
    found = space.store(found.withColumn("row", F.monotonically_increasing_id()), "paragraphs")
    place = F.struct("doc_id", "version", "start", "end")
    items = space.store(
        found.groupBy("item").agg(F.min(place).alias("place"), F.any_value("sketch").alias("sketch")),
        "items",
    )
    band = F.array(*[F.xxhash64(F.lit(b), F.slice("sketch", 1 + b * rows, rows)) for b in range(bands)])
    buckets = items.select(F.explode(band).alias("node"), "item")
    sizes = space.store(
        buckets.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "sizes"
    )
    # hashed against the few sizes, so that the many single rows of the bands are not sorted
    members = space.store(buckets.join(sizes.hint("shuffle_hash"), "node"), "members")
    leaves = members.where(F.col("n") <= LEAF).join(items.select("item", "sketch"), "item")
    tight = members.where(F.col("n") > LEAF).select("node", "item")

    asked = members.select("item").distinct().join(items, "item").select("item", "place.*")
    texts = texts_of(asked, given.withColumn("version", F.xxhash64("text")), ["doc_id", "version"])
    part = F.substring(F.col("text"), F.col("start") + F.lit(1), F.col("end") - F.col("start"))
    parts = texts.select("item", part.alias("text"))
    contents = parts.groupBy("item").agg(F.any_value("text").alias("text"))     # read once, by settle

    agreement = least_agreement(percent / 100, bands * rows)
    classes = settle(leaves, tight, contents, agreement, percent, space)
    named = space.store(
        items.join(classes, "item", "left").select(
            "item", F.coalesce("component", "item").alias("component")
        ),
        "named",
    )
    placed = found.drop("sketch").join(named, "item")
    here = F.struct("doc_id", "paragraph", "version", "row")
    groups = space.store(
        placed.groupBy("component").agg(F.min(here).alias("first"), F.count("*").alias("n_copies")).where("n_copies > 1"),
        "repeats",
    )
    return placed.join(groups, "component").select(
        "doc_id",
        "paragraph",
        "start",
        "end",
        "n_words",
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.paragraph").alias("first_paragraph"),
        "n_copies",
        (F.col("row") != F.col("first.row")).alias("removed"),
    )


def least_agreement(similarity: float, tokens: int) -> int:
    """Tokens that a pair at the threshold shares but once in some 1e9 cases."""
    spread = np.sqrt(similarity * (1 - similarity) * tokens)
    return max(1, int(similarity * tokens - 6.5 * spread))
