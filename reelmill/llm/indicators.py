"""Hashed presence features of whole texts, and bounded samples of labelled rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.words import WordHashes, mixed, plain_words, sequence_hashes, text_bytes

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
SAMPLE_ROWS = 8_000         # labelled rows that a classifier is fitted on, at most

PREFIXES = (4, 5, 6, 7)     # characters of a word's beginning

CACHE_BYTES = 64 << 20      # estimated size of what a task remembers of words
ENTRY_BYTES = 260           # of one word beside its characters: dictionary, number, hashes

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")


def buckets(*hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct buckets of 64-bit hashes."""
    return np.unique((np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))


def shape(token: bytes) -> bytes:
    """How a token is written: its case, digits, or the punctuation itself."""
    if token.isdigit():
        return b"0"
    if not (token[:1].isalnum() or token[:1] >= b"\x80"):
        return token
    text = token.decode(errors="replace")
    if text.islower():
        return b"a"
    if text.isupper():
        return b"A" if len(text) == 1 else b"AA"
    return b"Aa" if text[0].isupper() else b"aA"


class ShapeHashes(WordHashes):
    """64-bit hash of a token's shape, remembered by token."""

    def __missing__(self, token: bytes) -> int:
        return self.setdefault(token, WordHashes.__missing__(WordHashes(), shape(token)))


class WordIndicators:
    """Which words a text has, case apart, and which word beginnings, by how many words.

    A beginning of ``PREFIXES`` characters counts once for each distinct word that has it;
    there is one feature for one word or more, for two or more, and for three or more. What is
    remembered of the words met is bounded by bytes.
    """

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.parts = np.zeros((1024, 1 + len(PREFIXES)), dtype=np.uint64)
        self.held = 0

    def learn(self, word: bytes) -> int:
        if len(self.place) == len(self.parts):
            self.parts = np.concatenate([self.parts, np.zeros_like(self.parts)])
        text = word.decode(errors="replace")
        starts = [(b"^" + text[:k].encode()) if len(text) >= k else b"" for k in PREFIXES]
        row = self.place[word] = len(self.place)
        self.parts[row, 0] = xxhash.xxh3_64_intdigest(word)
        self.parts[row, 1:] = [xxhash.xxh3_64_intdigest(start) if start else 0 for start in starts]
        self.held += len(word) + ENTRY_BYTES
        return row

    def __call__(self, text: bytes) -> np.ndarray:
        if self.held > CACHE_BYTES:
            self.__init__()
        known = self.place
        rows = [known[w] if w in known else self.learn(w) for w in set(plain_words(text))]
        parts = self.parts[rows]
        starts, counts = np.unique(parts[:, 1:], return_counts=True)
        starts, counts = starts[starts > 0], counts[starts > 0]
        levels = [mixed(starts[counts >= k] + np.uint64(k)) for k in (1, 2, 3)]
        return buckets(mixed(parts[:, 0]), *levels)


class NgramIndicators:
    """Which words and word pairs a text has, and which pairs and triples of token shapes.

    A shape also says whether the token repeats the one before it.
    """

    def __init__(self) -> None:
        self.words, self.shapes = WordHashes(), ShapeHashes()

    def __call__(self, text: bytes) -> np.ndarray:
        tokens = TOKEN.findall(text)
        ids, shapes = self.words.of(tokens), self.shapes.of(tokens)
        shapes[1:] += (ids[1:] == ids[:-1]).astype(np.uint64)
        parts = [mixed(ids)]
        if len(ids) > 1:
            parts += [sequence_hashes(ids, 2), mixed(sequence_hashes(shapes, 2))]
        if len(ids) > 2:
            parts.append(mixed(sequence_hashes(shapes, 3)))
        return buckets(*parts)


def labelled_sample(labels: DataFrame, key: str, columns: list[str], rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, those of least hash; rows with a NULL are left out."""
    wanted = labels.select(key, *columns).dropna().dropDuplicates([key])
    return wanted.orderBy(F.xxhash64(key), key).limit(rows)


def labelled_features(docs: DataFrame, sample: DataFrame, key: str, text: str, columns: list[str], kind) -> DataFrame:
    """``(key, label, features)`` of the documents of a bounded sample."""
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("label", T.ArrayType(T.IntegerType())),
            T.StructField("features", T.ArrayType(T.IntegerType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = kind()
        for batch in batches:
            rows = [of(value) for value in text_bytes(batch.column("text"))]
            columns = [batch.column("key"), batch.column("label"), pa.array(rows, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    label = F.array(*[F.col(c).cast("int") for c in columns]).alias("label")
    known = sample.select(F.col(key).alias("key"), label)
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return given.join(F.broadcast(known), "key").mapInArrow(features, schema)


def fitted(rows: DataFrame, fit) -> bytes:
    """``fit(labels, features)`` of a bounded sample, run in one task, as bytes.

    The rows are put in order first, so the model does not depend on partitions.
    """

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, features, keys = [], [], []
        for batch in batches:
            keys += batch.column("key").to_pylist()
            labels += batch.column("label").to_pylist()
            features += [f.values.to_numpy() for f in batch.column("features")]
        order = sorted(range(len(keys)), key=lambda k: (keys[k], features[k].tobytes()))
        blob = fit(np.array([labels[k] for k in order], dtype=np.int64), [features[k] for k in order])
        yield pa.RecordBatch.from_pydict({"model": pa.array([blob], pa.binary())})

    return rows.repartition(1).mapInArrow(model, "model binary").first()["model"]


def in_hash_part(key: str, parts: int) -> Column:
    """Remainder of crc32 of the id as text; NULL ids count as part 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(parts)), F.lit(1))
