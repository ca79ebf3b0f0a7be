"""Benchmark decontamination with an FM-index per shard of training texts.

A window is ``WINDOW`` consecutive words of a benchmark item, or the whole item where it
has fewer. Each task takes its texts in shards, indexes the shard's words, searches all
windows backwards through wavelet-tree ranks, locates the occurrences by sampled suffix
positions and merges the spans to be removed. Only words that occur in some window get a
symbol: any other word ends a run, and runs shorter than the shortest window cannot hold
an occurrence, so they are not indexed. No text is shuffled.

Windows reach the tasks in blocks of at most about ``BLOCK_WINDOWS`` windows, whatever the
benchmark's size: one pass over the texts for each block, spans and items carried along.

Defined results: NULL and empty texts have no words and no hits; benchmark rows without
words match nothing; rows without ``item_id`` count as hits but are not listed; repeated
items and rows count once; repeated documents are marked each; an empty benchmark hits
nothing; a very long text is in one shard, whole; an empty table gives an empty one. Input columns
named like a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import astuple, dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.fm_index import FMIndex
from reelmill.llm.scratch import Scratch
from reelmill.llm.words import by_bytes, plain_words, text_bytes

WINDOW = 10
BLOCK_WINDOWS = 200_000     # windows broadcast at once: some 50 MB
SHARD_BYTES = 8 << 20       # text bytes in one index, beside one longer text

SPAN = T.StructType(
    [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)
RESULTS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hit_words", T.ArrayType(SPAN)),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows, as words joined by blanks, with the items that hold them."""
    schema = "phrase string, item string"

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases, items = [], []
            for item, text in zip(batch.column("item").to_pylist(), text_bytes(batch.column("text"))):
                words = [w.decode() for w in plain_words(text)]
                last = max(len(words) - window, 0) + 1 if words else 0
                phrases += [" ".join(words[k : k + window]) for k in range(last)]
                items += [item] * last
            yield pa.RecordBatch.from_pydict(
                {"phrase": pa.array(phrases, pa.string()), "item": pa.array(items, pa.string())}
            )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return rows.mapInArrow(windows, schema).groupBy("phrase").agg(F.collect_set("item").alias("items"))


@dataclass(frozen=True)
class Block:
    """Windows of one block: words as symbols from 1, a row of symbols for each window."""

    symbols: dict[bytes, int]
    phrases: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def block_of(rows: list) -> Block:
    words = [row["phrase"].encode().split(b" ") for row in rows]
    symbols: dict[bytes, int] = {}
    for word in (w for phrase in words for w in phrase):
        symbols.setdefault(word, len(symbols) + 1)
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    phrases = np.zeros((len(words), int(lengths.max(initial=1))), dtype=np.int64)
    for row, phrase in enumerate(words):
        phrases[row, : len(phrase)] = [symbols[w] for w in phrase]
    return Block(symbols, phrases, lengths, [row["items"] for row in rows])


def occurrences(ids: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Window and first word of every occurrence in a shard (0: not a window's word)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], ids != 0, [0]])))
    starts, ends = edges[::2], edges[1::2]
    kept = ends - starts >= block.lengths.min(initial=1 << 60)
    starts, sizes = starts[kept], (ends - starts)[kept]
    none = np.empty(0, dtype=np.int64)
    if not len(starts):
        return none, none
    first = np.cumsum(sizes + 1) - sizes - 1            # of each run in the indexed text
    offset = np.repeat(starts - first, sizes + 1)
    place = np.arange(len(offset)) + offset
    text = np.append(ids, 0)[place]
    text[first + sizes] = 0
    used = np.zeros(len(block.symbols) + 1, dtype=bool)
    used[text] = True
    inside = np.arange(block.phrases.shape[1]) < block.lengths[:, None]
    there = np.flatnonzero((used[block.phrases] | ~inside).all(axis=1))
    if not len(there):
        return none, none
    seen = np.cumsum(used) - 1                          # symbols of the shard, 0 stays 0
    if not used[0]:
        seen += 1
    index = FMIndex(seen[text])
    low, high = index.search(
        np.where(inside[there], seen[block.phrases[there]], 0), block.lengths[there]
    )
    counts = high - low
    rows = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return np.repeat(there, counts), place[index.locate(rows)]


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch."""
    out: list[list[int]] = []
    for start, end in sorted(zip(starts, ends)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(int(a), int(b)) for a, b in out]


WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def character_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as spans of code points, end exclusive."""
    if not spans:
        return []
    bounds = [match.span() for match in WORD.finditer(text)]
    out, at, done = [], 0, 0
    for first, end in spans:
        at += len(text[done : bounds[first][0]].decode())
        size = len(text[bounds[first][0] : bounds[end - 1][1]].decode())
        out.append((at, at + size))
        at, done = at + size, bounds[end - 1][1]
    return out


def symbols_of(words: list[bytes], block: Block) -> np.ndarray:
    """Words as symbols of the block; the words themselves are held of one text at a time."""
    return np.fromiter(map(block.symbols.get, words, repeat(0)), dtype=np.int32, count=len(words))


def marked_shard(texts: list[bytes], earlier: list[tuple], block: Block) -> list[tuple]:
    """(n_words, items, hit word spans) of each text after searching one block."""
    symbols = [symbols_of(plain_words(text), block) for text in texts]
    sizes = np.array([len(s) for s in symbols], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1           # one 0 after each text
    ids = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    for start, size, row in zip(starts, sizes, symbols):
        ids[start : start + size] = row
    del symbols
    window, at = occurrences(ids, block)
    doc = np.searchsorted(starts, at, side="right") - 1
    order = np.argsort(doc, kind="stable")
    hit_docs, cuts = np.unique(doc[order], return_index=True)
    out = [(int(size), list(items), list(spans)) for size, (items, spans) in zip(sizes, earlier)]
    for k, group in zip(hit_docs, np.split(order, cuts[1:])):
        _, items, spans = out[k]
        found = set(items).union(*(block.items[w] for w in np.unique(window[group])))
        first = at[group] - starts[k]
        span = merged(
            [*(a for a, _ in spans), *first],
            [*(b for _, b in spans), *(first + block.lengths[window[group]])],
        )
        out[k] = (int(sizes[k]), sorted(found), span)
    return out


def search_block(df: DataFrame, block: Block, text: str) -> DataFrame:
    """``df`` (with or without earlier results) after searching one block of windows."""
    shared = df.sparkSession.sparkContext.broadcast(astuple(block))
    again = "hit_words" in df.columns
    kept = [f for f in df.schema.fields if f.name not in RESULTS.names]
    schema = T.StructType([*kept, *RESULTS.fields])
    arrow = to_arrow_schema(schema)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Block(*shared.value)
        for batch in by_bytes(batches, text, SHARD_BYTES):
            texts = text_bytes(batch.column(text))
            if again:
                spans = [
                    [(s["start"], s["end"]) for s in row] for row in batch.column("hit_words").to_pylist()
                ]
                earlier = list(zip(batch.column("items").to_pylist(), spans))
            else:
                earlier = [([], [])] * len(texts)
            rows = marked_shard(texts, earlier, windows)
            named = [[{"start": a, "end": b} for a, b in spans] for _, _, spans in rows]
            cut = [
                [{"start": a, "end": b} for a, b in character_spans(value, spans)]
                for value, (_, _, spans) in zip(texts, rows)
            ]
            results = [
                [size for size, _, _ in rows],
                [sum(b - a for a, b in spans) for _, _, spans in rows],
                [items for _, items, _ in rows],
                named,
                cut,
            ]
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(v, arrow.field(n).type) for n, v in zip(RESULTS.names, results)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(marked, schema)


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with word counts, items found, hit word spans and removal spans.

    ``spans`` are code points of the text, end exclusive, sorted and disjoint.
    """
    space = Scratch(docs.sparkSession, "decontaminate")
    windows = space.store(benchmark_windows(benchmark, window), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    clashing = [c for c in docs.columns if c.lower() in RESULTS.names and c != text]
    out = docs.drop(*clashing)
    for k in range(blocks):
        if k:
            out = space.store(out, f"pass{k}")
        rows = windows.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k).collect()
        out = search_block(out, block_of(rows), text)
    return out


def without_spans(text: str = "text", spans: str = "spans"):
    """The text with its removal spans cut out, as a column expression."""
    source = F.col(text)
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(source)))
    pieces = F.transform(
        F.arrays_zip(ends.alias("a"), starts.alias("b")),
        lambda p: F.substring(source, p["a"] + F.lit(1), p["b"] - p["a"]),
    )
    return F.when(F.size(spans) > 0, F.concat_ws("", pieces)).otherwise(source)
