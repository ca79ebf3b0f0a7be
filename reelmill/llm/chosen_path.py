"""MinHash near-duplicates by a chosen-path set similarity join.

Every document is its set of distinct five-word shingles, and an embedding of it into
minwise tokens. Independent trees branch the documents by a minwise token: the root by one,
each large loose node by ``BRANCHES`` further ones. A pair of similarity s meets in all
branches of one tree with probability at least ``s * (1 - (1-s)**3 ...)``, for s = 0.85
about 0.847 at any depth. ``tuned`` takes as many trees as miss a pair at the threshold with
probability below ``MISSED``: 10 for 0.85, 12 for 0.8. Small nodes are compared
exhaustively; a node whose members are alike on average stops branching and goes to the
pivot and block comparison of ``setlinks``. Links are confirmed on full sets from the whole
texts.

Documents of equal sets are one item from the start, so exact copies never meet as pairs.

Defined results: NULL, empty and blank texts have no shingles and stay alone; texts of
fewer than five words are one shingle; rows with a NULL id stay alone, with a NULL
component, and are kept; rows that repeat an id are one document with several texts; very long
texts are taken whole; an empty table gives no rows; other columns are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.scratch import Scratch
from reelmill.llm.setlinks import LEAF, minwise, settle
from reelmill.llm.words import WordHashes, by_bytes, shingle_set, spaced_words, text_bytes

PERCENT = 85
MISSED = 1e-8               # share of pairs at the threshold that may meet in no tree
SIFTED = 1e-10              # share of them whose sketches may agree in too few tokens
BRANCHES = 3
POOL = 8                    # tokens that one branch of an inner node chooses from
DEPTH = 6
TIGHT = 0.3                 # mean similarity of a node from which branching would not split it

SET = ["h1", "h2", "n_shingles"]


def tuned(percent: int) -> tuple[int, int]:
    """Trees, and tokens of a pair's sketches that have to agree, for a threshold."""
    if not 0 < percent <= 100:
        raise ValueError("percent is above 0 and at most 100")
    similarity, meet = percent / 100, 1.0
    for _ in range(DEPTH):
        meet = 1 - (1 - similarity * meet) ** BRANCHES
    trees = 1
    while (1 - similarity * meet) ** trees >= MISSED:
        trees += 1
    agreeing = np.ones(1)
    for _ in range(trees + BRANCHES * POOL):
        agreeing = np.convolve(agreeing, [1 - similarity, similarity])
    agreement = int((agreeing.cumsum() <= SIFTED).sum())
    return trees, max(1, agreement)


def sketched(docs: DataFrame, tokens: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, h1, h2, sketch)``: the set's size, 128-bit hash and tokens."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("h1", T.LongType()),
            T.StructField("h2", T.LongType()),
            T.StructField("sketch", T.ArrayType(T.IntegerType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_bytes(batches, "text"):
            sizes, marks, sketch = [], [], []
            for value in text_bytes(batch.column("text")):
                values = shingle_set(hashes.of(spaced_words(value)))
                sizes.append(len(values))
                marks.append(np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), dtype=np.int64))
                sketch.append(minwise(values, tokens) if len(values) else None)
            pairs = np.array(marks, dtype=np.int64).reshape(len(marks), 2)
            columns = [batch.column("doc_id"), pa.array(sizes), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
            columns.append(pa.array(sketch, arrow.field("sketch").type))
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(sketches, schema)


def roots(items: DataFrame, trees: int) -> DataFrame:
    """Each item under the root token of every tree."""
    token = F.posexplode(F.slice("sketch", 1, trees)).alias("tree", "token")
    return items.select("item", token).select(F.xxhash64("tree", "token").alias("node"), "item")


def children(large: DataFrame, items: DataFrame, trees: int) -> DataFrame:
    """``(parent, branch, node, item)``: each branch of a node takes a token chosen by the node."""
    place = F.lit(1 + trees) + F.col("branch") * POOL + F.pmod(F.xxhash64("parent", "branch"), F.lit(POOL))
    token = F.element_at("sketch", place.cast("int"))
    return (
        large.select(F.col("node").alias("parent"), "item")
        .join(items, "item")
        .withColumn("branch", F.explode(F.array(*[F.lit(b) for b in range(BRANCHES)])))
        .select("parent", "branch", F.xxhash64("parent", "branch", token).alias("node"), "item")
    )


def branch_out(items: DataFrame, trees: int, space: Scratch) -> tuple[DataFrame, DataFrame]:
    """Small nodes and large tight nodes, each as ``(node, item)``, of all trees.

    The tight ones are written: every comparison of them reads them several times, and would
    join them anew each time.
    """
    frontier, leaves, tight = roots(items, trees), [], []
    for depth in range(DEPTH):
        sizes = space.store(
            frontier.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), f"sizes{depth}"
        )
        members = space.store(frontier.join(sizes, "node"), f"members{depth}")
        leaves.append(members.where(F.col("n") <= LEAF).select("node", "item"))
        large = members.where(F.col("n") > LEAF)
        if large.isEmpty():
            break
        down = space.store(children(large, items, trees), f"children{depth}")
        parts = down.groupBy("parent", "branch", "node").agg(F.count("*").alias("c"))
        alike = F.sum(F.col("c") * F.col("c")) / F.pow(F.sum("c") / BRANCHES, 2) / BRANCHES
        last = F.lit(depth == DEPTH - 1)
        parents = space.store(
            parts.groupBy("parent").agg(((alike >= TIGHT) | last).alias("tight")), f"parents{depth}"
        )
        is_tight = parents.where("tight").select(F.col("parent").alias("node"))
        tight.append(large.join(is_tight, "node").select("node", "item"))
        frontier = down.join(parents.where("not tight"), "parent").select("node", "item")
    none = leaves[0].where("false")
    return reduce(DataFrame.union, leaves), space.store(reduce(DataFrame.union, tight, none), "tight")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row for every row of ``docs``.

    Linked are documents with ``100 * shared >= percent * union``; trees and tokens follow
    ``percent``. The result reads tables in the session's checkpoint folder.
    """
    trees, agreement = tuned(percent)
    space = Scratch(docs.sparkSession, "chosen-path")
    sketches = space.store(sketched(docs, trees + BRANCHES * POOL, doc_id, text), "sketches")
    sets = space.store(
        sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*SET)
        .agg(F.min("doc_id").alias("item"), F.any_value("sketch").alias("sketch")),
        "sets",
    )
    items = sets.select("item", "sketch")
    leaves, tight = branch_out(items, trees, space)
    contents = docs.select(F.col(doc_id).alias("item"), F.col(text).alias("text"))
    classes = settle(leaves.join(items, "item"), tight, contents, agreement, percent, space)
    named = space.store(
        sets.join(classes, "item", "left").select(
            *SET, F.coalesce("component", "item").alias("component_id")
        ),
        "named",
    )
    found = sketches.select("doc_id", *SET).join(named, SET, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
