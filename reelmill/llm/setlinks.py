"""Links between items with similar word-shingle sets, from groups of candidates.

A similarity join hands over nodes: groups of items that may hold links. Small nodes are
sifted by sketches and compared exhaustively on the full sets. Nodes that stay large are
first compared with a few pivots, block by block; what is linked through pivots then needs
no comparison among itself, and the pairs of items in different classes are compared in
blocks of bounded size. No pair list of a group is ever made: a task returns a spanning
forest of the links it found, so classes are exact for all compared pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.components import components
from reelmill.llm.scratch import Scratch
from reelmill.llm.words import WordHashes, by_bytes, mixed, shingle_set, spaced_words, text_bytes

LEAF = 256                  # items of a node that are compared exhaustively at once
BLOCK = 1024                # items of one block of a larger node
PIVOTS = 8
COLUMNS = 4096              # shingles counted in one matrix product


def minwise(values: np.ndarray, size: int) -> np.ndarray:
    """``size`` minwise tokens (32 bits each) of a non-empty set of 64-bit hashes."""
    seeds = mixed(np.arange(1, 2 * size + 1, dtype=np.uint64))
    factors, shifts = seeds[:size] | np.uint64(1), seeds[size:]
    least = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(values), COLUMNS):
        part = values[start : start + COLUMNS, None] * factors + shifts
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    edges: list[tuple[int, int]] = []
    free = linked.any(axis=1)
    while free.any():
        front = np.flatnonzero(free)[:1]
        free[front] = False
        while len(front):
            rows = linked[front] & free
            fresh = np.flatnonzero(rows.any(axis=0))
            edges += zip(front[rows[:, fresh].argmax(axis=0)].tolist(), fresh.tolist())
            free[fresh] = False
            front = fresh
    return edges


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    code = np.cumsum(fresh) - 1
    several = np.bincount(code)[code] > 1
    owner, code = owner[several], code[several]
    counts = np.zeros((len(sets), len(sets)), dtype=np.float32)
    if len(code):
        code = np.cumsum(np.concatenate([[0], np.diff(code) != 0]))
        for start in range(0, int(code[-1]) + 1, COLUMNS):
            low, high = np.searchsorted(code, [start, start + COLUMNS])
            there = np.zeros((len(sets), min(COLUMNS, int(code[-1]) + 1 - start)), dtype=np.float32)
            there[owner[low:high], code[low:high] - start] = 1
            counts += there @ there.T
    return counts.astype(np.int64)


def linked_pairs(sets: list[np.ndarray], side: np.ndarray, label: list, percent: int) -> list[tuple[int, int]]:
    """Spanning links of one group: ``100 * shared >= percent * union``.

    Pairs of the same label are known to be linked; of two items on sides other than 0
    only those on different sides are compared.
    """
    codes = {value: k for k, value in enumerate(dict.fromkeys(label))}
    kind = np.array([codes[value] for value in label])
    asked = (kind[:, None] != kind) & ((side[:, None] != side) | (side == 0))
    if not asked.any():
        return []
    both = shared_counts(sets)
    size = np.array([len(s) for s in sets])
    union = size[:, None] + size - both
    return forest(asked & (100 * both >= percent * union) & (size > 0) & (size[:, None] > 0))


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[pa.RecordBatch]]:
    """Rows of one key at a time, from batches sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        if not len(values):
            continue
        cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
        for start, end in zip(cuts[:-1], cuts[1:]):
            if held and values[start] != last:
                yield held
                held = []
            held.append(batch.slice(start, end - start))
            last = values[start]
    if held:
        yield held


def confirm(members: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` found in groups ``(cluster, item, side, label)`` on full sets."""
    kind = members.schema["item"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    arrow = to_arrow_schema(schema)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def with_sets(given):
            for batch in by_bytes(given, "text"):
                sets = [shingle_set(hashes.of(spaced_words(t))) for t in text_bytes(batch.column("text"))]
                lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield batch.drop_columns(["text"]).append_column("set", lists)

        for group in grouped(with_sets(batches), "cluster"):
            rows = pa.Table.from_batches(group)
            items = rows.column("item").to_pylist()
            if len(items) < 2:
                continue
            sets = [s.values.to_numpy().view(np.uint64) for s in rows.column("set")]
            links = linked_pairs(
                sets, rows.column("side").to_numpy(), rows.column("label").to_pylist(), percent
            )
            if links:
                ends = [[items[a] for a, _ in links], [items[b] for _, b in links]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(e, f.type) for e, f in zip(ends, arrow)], schema=arrow
                )

    sent = members.join(contents, "item").select("cluster", "item", "side", "label", "text")
    dealt = sent.repartition("cluster").sortWithinPartitions("cluster")
    return dealt.mapInArrow(found, schema).distinct()


def sift(leaves: DataFrame, agreement: int) -> DataFrame:
    """Groups worth comparing ``(cluster, item)`` from small nodes ``(node, item, sketch)``.

    Every pair of a node is compared by sketch; items connected by pairs that agree in at
    least ``agreement`` tokens form a group. Groups that several trees find are one.
    """
    kind = leaves.schema["item"].dataType
    schema = T.StructType([T.StructField("cluster", T.LongType()), T.StructField("item", kind)])
    arrow = to_arrow_schema(schema)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters: list[int] = []
        items: list = []
        hashes = WordHashes()
        for node in grouped(batches, "node"):
            rows = pa.Table.from_batches(node)
            sketch = np.stack([s.values.to_numpy() for s in rows.column("sketch")])
            same = np.zeros((len(sketch), len(sketch)), dtype=np.int16)
            for column in sketch.T:
                same += column[:, None] == column
            np.fill_diagonal(same, 0)
            names = rows.column("item").to_pylist()
            root = list(range(len(names)))
            for a, b in forest(same >= agreement):      # parents are reached before children
                root[b] = root[a]
            parts: dict[int, list] = {}
            for name, r in zip(names, root):
                parts.setdefault(r, []).append(name)
            for part in parts.values():
                if len(part) > 1:
                    key = hashes.of(["\0".join(map(str, sorted(part))).encode()])
                    clusters += [int(key.view(np.int64)[0])] * len(part)
                    items += part
            if len(items) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(clusters), pa.array(items, arrow.field(1).type)], schema=arrow)
                clusters, items = [], []
        yield pa.RecordBatch.from_arrays(
            [pa.array(clusters, pa.int64()), pa.array(items, arrow.field(1).type)], schema=arrow
        )

    dealt = leaves.select("node", "item", "sketch").repartition("node").sortWithinPartitions("node")
    return dealt.mapInArrow(groups, schema).distinct()


def pivot_groups(tight: DataFrame) -> DataFrame:
    """Each large node cut into blocks by a hash of the item, a few pivots beside each block."""
    nodes = tight.groupBy("node").agg(
        F.ceil(F.count("*") / BLOCK).alias("blocks"),
        F.array_distinct(
            F.array(*[F.min_by("item", F.xxhash64("item", F.lit(k))) for k in range(PIVOTS)])
        ).alias("pivots"),
    )
    cluster = F.xxhash64("node", "block")
    dealt = tight.join(nodes.select("node", "blocks"), "node").select(
        "node", F.pmod(F.xxhash64("item"), "blocks").alias("block"), "item"
    )
    beside = nodes.select(
        "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "pivots"
    ).select("node", "block", F.explode("pivots").alias("item"))
    return (
        dealt.select(cluster.alias("cluster"), "item", F.lit(2).alias("side"))
        .union(beside.select(cluster.alias("cluster"), "item", F.lit(1).alias("side")))
        .withColumn("label", F.col("item"))
    )


def block_groups(tight: DataFrame, space: Scratch) -> DataFrame:
    """Pairs of blocks of every large node ``(node, item, label)`` that holds several labels.

    A label with many items has blocks of its own, which are not compared with each other;
    rare labels share blocks.
    """
    counts = tight.groupBy("node", "label").agg(F.count("*").alias("n"))
    rare = F.col("n") < BLOCK // 2
    nodes = counts.groupBy("node").agg(
        F.count("*").alias("labels"), F.sum(F.when(rare, F.col("n")).otherwise(0)).alias("rare_items")
    )
    placed = (
        counts.join(nodes.where("labels > 1"), "node")
        .withColumn("bins", F.greatest(F.lit(1), F.ceil(F.when(rare, F.col("rare_items")).otherwise(F.col("n")) / BLOCK)))
        .withColumn("rare", rare)
        .select("node", "label", "rare", "bins")
    )
    spread = F.when(F.col("rare"), F.xxhash64("label")).otherwise(F.xxhash64("item"))
    items = space.store(
        tight.join(placed, ["node", "label"]).select(
            "node",
            "item",
            "label",
            F.when(F.col("rare"), F.lit(0)).otherwise(F.xxhash64("label")).alias("family"),
            F.pmod(spread, "bins").alias("bin"),
        ),
        "block_items",
    )
    blocks = items.select("node", "family", "bin").distinct()
    left = blocks.select("node", F.struct("family", "bin").alias("x"))
    right = blocks.select("node", F.struct("family", "bin").alias("y"))
    pairs = left.join(right, "node").where(
        (F.col("x") < F.col("y")) & ((F.col("x.family") != F.col("y.family")) | (F.col("x.family") == 0))
        | (F.col("x") == F.col("y")) & (F.col("x.family") == 0)
    )
    cluster = F.xxhash64("node", "x", "y")
    alone = F.col("x") == F.col("y")
    asked = pairs.select("node", "x.family", "x.bin", cluster.alias("cluster"), F.when(alone, 0).otherwise(1).alias("side")).union(
        pairs.where(~alone).select("node", "y.family", "y.bin", cluster.alias("cluster"), F.lit(2).alias("side"))
    )
    return items.join(asked, ["node", "family", "bin"]).select("cluster", "item", "side", "label")


def texts_of(needed: DataFrame, texts: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``texts`` whose key is in ``needed``.

    The texts are shuffled once and hashed against their keys, the same at every size: no
    side is broadcast, and the texts are not sorted.
    """
    return texts.join(needed.hint("shuffle_hash"), on)


def settle(
    leaves: DataFrame,
    tight: DataFrame,
    contents: DataFrame,
    agreement: int,
    percent: int,
    space: Scratch,
) -> DataFrame:
    """Classes ``(item, component)`` of all items linked within the given nodes.

    ``leaves`` (node, item, sketch) hold at most ``LEAF`` items each, ``tight`` (node, item)
    any number. Of ``contents (item, text)`` only the items that some group asks for are
    kept, once for all comparisons. Items without a link are left out.
    """
    groups = space.store(sift(leaves, agreement), "groups")
    needed = groups.select("item").union(tight.select("item")).distinct()
    contents = space.store(texts_of(needed, contents, ["item"]), "contents")
    small = groups.select("cluster", "item", F.lit(0).alias("side"), F.col("item").alias("label"))
    first = space.store(confirm(small.union(pivot_groups(tight)), contents, percent), "links")
    classes = components(first, space, "classes")
    if tight.isEmpty():
        return classes
    classes = space.store(classes, "first_classes")
    labelled = tight.join(classes, "item", "left").select(
        "node", "item", F.coalesce("component", "item").alias("label")
    )
    rest = confirm(block_groups(space.store(labelled, "labelled"), space), contents, percent)
    rest = space.store(rest, "more_links")
    return components(first.union(rest), space, "settled")
