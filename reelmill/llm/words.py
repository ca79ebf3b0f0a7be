"""Words, their hashes and shingles, over UTF-8 bytes inside a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE_WORDS = 5
SLICE_BYTES = 4 << 20       # text bytes that a task holds as objects at once
CACHE_WORDS = 1 << 19       # words whose hash a task remembers before it starts afresh

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def _letters_only() -> bytes:
    kept = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
    return bytes(b if b in kept else 0x20 for b in LOWER)


LETTERS = _letters_only()


def spaced_words(text: bytes) -> list[bytes]:
    """Runs of bytes other than ASCII white space, A-Z lower-cased."""
    return text.translate(LOWER).split()


def plain_words(text: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters (lower-cased) and bytes of non-ASCII characters."""
    return text.translate(LETTERS).split()


class WordHashes(dict):
    """64-bit hash of a word, remembered for the words a task meets often."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def sequence_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` consecutive ids, order included."""
    count = len(ids) - width + 1
    value = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        value = mixed(value + np.uint64(0x9E3779B97F4A7C15)) + ids[k : k + count]
    return mixed(value)


def shingle_set(ids: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter sequence is one shingle, none is none."""
    if len(ids) == 0:
        return np.empty(0, dtype=np.uint64)
    return np.unique(sequence_hashes(ids, min(width, len(ids))))


def by_bytes(
    batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``most`` bytes of ``column``, beside one longer value.

    A batch has a bounded number of rows, not of bytes; what is made of a slice is.
    """
    for batch in batches:
        yield from sliced(batch, pc.binary_length(batch.column(column)), most)


def sliced(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose sizes (NULL: none) add up to at most ``most``, beside one larger row."""
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // most)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def text_bytes(column: pa.Array) -> list[bytes]:
    """A string column as bytes, NULL as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()
