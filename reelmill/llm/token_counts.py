"""Token counts by rank-synchronous merging of ragged arrays.

A batch of pre-tokens is one flat array of symbols with the owner of each. In every step
each pre-token applies its pair of lowest rank, at all places at once (leftmost first where
they overlap), until no pre-token has a known pair; what is counted is the symbols left. In
a vocabulary whose pieces are made before they are merged on, no merge can bring up a
pair of lower rank, so this equals merging one pair at a time; ``read_merges`` refuses
other vocabularies.

Counts need no shuffle. A task remembers the counts of pre-tokens it met, by a bounded number
of bytes. Special strings are one token each, as the tokenizer library counts them by
default; no begin or end tokens are added and nothing is cut off.

Defined results: NULL and empty texts have no tokens; very long texts are cut in one piece
and merged in batches (a single very long pre-token is a batch of its own); repeated rows
count like any other; an empty table gives an empty one; a column named like the count is
replaced, all others pass.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.bpe import ascii_pattern, with_column

CACHE_BYTES = 24 << 20      # estimated size of the counts a task remembers
ENTRY_BYTES = 150           # of one remembered pre-token beside its characters
GROUP_CHARACTERS = 1 << 20  # characters cut at once
BATCH_SYMBOLS = 1 << 18     # symbols merged at once
NO_RANK = np.iinfo(np.int32).max


@dataclass(frozen=True)
class Merges:
    """Symbols of single bytes, and the merges by sorted pair key; a few megabytes, fixed."""

    first: np.ndarray       # symbol of each byte
    pairs: np.ndarray       # left * size + right, sorted
    ranks: np.ndarray
    made: np.ndarray        # symbol that a merge makes
    size: int
    pattern: str
    special: tuple[str, ...]
    apart: tuple[str, str, str]  # characters newer than the library: letters, digits, others


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    named = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in named]
    return [named.get(b) or chr(0x100 + rest.index(b)) for b in range(256)]


def ranges(characters: list[str]) -> str:
    """Sorted characters as the inside of a character class."""
    codes = np.array([ord(c) for c in characters], dtype=np.int64)
    breaks = np.flatnonzero(np.diff(codes) > 1)
    heads, tails = np.r_[codes[:1], codes[breaks + 1]], np.r_[codes[breaks], codes[-1:]]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(heads.tolist(), tails.tolist()))


def characters_apart() -> tuple[str, str, str]:
    """Letters, digits and others on whose kind the tokenizer library and ``regex`` differ.

    They know different versions of Unicode. Asked for are the characters on which ``regex``
    and Python's own tables differ, a few thousand. Each is returned as ranges.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    cut = ByteLevel(add_prefix_space=False).pre_tokenize_str
    every = "".join(chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000)
    here = {kind: set(regex.findall(rf"\p{{{kind}}}", every)) for kind in "LN"}
    found = {"L": [], "N": [], " ": []}
    for character in every:
        own = unicodedata.category(character)[0]
        known = "L" if character in here["L"] else "N" if character in here["N"] else " "
        if known != (own if own in "LN" else " "):
            ends = [end for _, (_, end) in cut(f"a{character}1")]
            kind = "L" if ends == [2, 3] else "N" if ends == [1, 3] else " "
            if kind != known:
                found[kind].append(character)
    return tuple(ranges(found[kind]) for kind in "LN ")


def read_merges(path: str, pattern: str) -> Merges:
    """Read a vocabulary file of the ``tokenizers`` library on the driver.

    Byte-level BPE without normaliser, prefix space or options that change the merging.
    """
    with open(path, encoding="utf-8") as lines:
        stored = json.load(lines)
    model, cut = stored["model"], stored["pre_tokenizer"]
    plain = model["type"] == "BPE" and cut["type"] == "ByteLevel" and cut["use_regex"]
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    if not plain or cut["add_prefix_space"] or stored["normalizer"] or any(model[o] for o in options):
        raise ValueError("not a plain byte-level BPE vocabulary")
    if any(t[o] for t in stored["added_tokens"] for o in ("single_word", "lstrip", "rstrip")):
        raise ValueError("special strings must match as written")
    ids = model["vocab"]
    size = max(ids.values()) + 1
    merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    left, right, made = (
        np.array([ids[p] for p in part], dtype=np.int64)
        for part in (*zip(*merges), [a + b for a, b in merges])
    )
    ranks = np.arange(len(merges), dtype=np.int64)
    making = np.full(size, -1, dtype=np.int64)
    making[made] = ranks
    if len(np.unique(made)) < len(made) or (np.maximum(making[left], making[right]) >= ranks).any():
        raise ValueError("a piece is merged on before it is made")
    first = np.array([ids[c] for c in byte_characters()], dtype=np.int64)
    order = np.argsort(left * size + right)
    return Merges(
        first, (left * size + right)[order], ranks[order].astype(np.int32), made[order], size,
        pattern, tuple(t["content"] for t in stored["added_tokens"]), characters_apart(),
    )


def cutters(merges: Merges):
    """How to cut ASCII texts, other texts, and texts with characters that are apart.

    Returned are the three ``findall`` and a search for such characters.
    """
    letters, digits, others = merges.apart
    apart = letters + digits + others
    kinds = {r"\p{L}": letters, r"\p{N}": digits}
    exact = merges.pattern.replace(r"\s\p{L}\p{N}", r"[\s\p{L}\p{N}]")
    for kind, more in kinds.items():
        less = "".join(part for part in (letters, digits, others) if part != more)
        set_ = rf"\p{{{kind[3]}}}" + (f"--[{less}]" if less else "") + (f"||[{more}]" if more else "")
        exact = exact.replace(kind, f"[{set_}]")
    return (
        ascii_pattern(merges.pattern).findall,
        regex.compile(merges.pattern).findall,
        regex.compile(exact, regex.V1).findall,
        re.compile(f"[{apart}]").search if apart else lambda text: None,
    )


def merged_sizes(merges: Merges, tokens: list[bytes]) -> np.ndarray:
    """Symbols that are left of each pre-token."""
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    sizes = lengths.copy()
    symbols = merges.first[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(tokens)), lengths)

    def rank(at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``."""
        at = at[at < len(symbols)]
        after = np.minimum(at + 1, len(symbols) - 1)
        pair = symbols[at] * merges.size + symbols[after]
        place = np.minimum(np.searchsorted(merges.pairs, pair), len(merges.pairs) - 1)
        known = (merges.pairs[place] == pair) & (owner[at] == owner[after]) & (after > at)
        return np.where(known, merges.ranks[place], NO_RANK)

    ranks = rank(np.arange(len(symbols)))
    while len(symbols):
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        runs = np.diff(np.r_[heads, len(symbols)])
        least = np.minimum.reduceat(ranks, heads)
        done = least == NO_RANK
        sizes[owner[heads[done]]] = runs[done]
        chosen = (ranks == np.repeat(least, runs)) & (ranks < NO_RANK)
        places = np.flatnonzero(chosen)
        streak = np.flatnonzero(np.r_[True, np.diff(places) > 1]) if len(places) else places
        since = np.arange(len(places)) - np.repeat(streak, np.diff(np.r_[streak, len(places)]))
        places = places[since % 2 == 0]
        pair = symbols[places] * merges.size + symbols[places + 1] if len(places) else places
        symbols[places] = merges.made[np.searchsorted(merges.pairs, pair)]
        keep = ~np.repeat(done, runs)
        keep[places + 1] = False
        moved = (np.cumsum(keep) - 1)[places]
        symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
        touched = np.unique(np.r_[moved, moved[moved > 0] - 1])
        ranks[touched] = rank(touched)
    return sizes


class Counter:
    """Numbers of tokens inside a task."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.cut_ascii, self.cut_any, self.cut_exact, self.is_apart = cutters(merges)
        self.special = (
            regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True))))
            if merges.special
            else None
        )
        self.known: dict[str, int] = {}
        self.held = 0

    def cut(self, text: str) -> list[str]:
        if text.isascii():
            return self.cut_ascii(text)
        return self.cut_exact(text) if self.is_apart(text) else self.cut_any(text)

    def learn(self, tokens: list[str]) -> None:
        """Count new pre-tokens, the long ones in batches of few."""
        tokens = sorted(tokens, key=len)
        start = 0
        while start < len(tokens):
            end, size, batch = start, 0, []
            while end < len(tokens) and (not batch or size + len(tokens[end]) <= BATCH_SYMBOLS):
                batch.append(tokens[end].encode())
                size += len(batch[-1])
                end += 1
            self.known.update(zip(tokens[start:end], merged_sizes(self.merges, batch).tolist()))
            self.held += size + ENTRY_BYTES * len(batch)
            start = end

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; callers bound the characters they hand over at once."""
        extra, cuts = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            extra.append(len(parts) - 1)
            cuts.append([token for part in parts for token in self.cut(part)] if len(parts) > 1 else self.cut(text))
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
        self.learn(list(set().union(*cuts) - self.known.keys()))
        count = self.known.__getitem__
        return [more + sum(map(count, tokens)) for more, tokens in zip(extra, cuts)]

    def count_all(self, texts: list[str]) -> Iterator[int]:
        """Counts text by text, cut in groups of bounded size."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARACTERS:
                yield from self.count(group)
                group, size = [], 0
        yield from self.count(group)


def count_tokens(df: DataFrame, merges: Merges, text: str = "text", count: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of ``text`` as a long column."""
    schema = with_column(df.schema, count, T.LongType())
    kept = schema.names[:-1]
    arrow = to_arrow_schema(schema)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges)
        for batch in batches:
            texts = [value or "" for value in batch.column(text).to_pylist()]
            found = pa.array(list(counter.count_all(texts)), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], found], schema=arrow)

    return df.mapInArrow(counted, schema)
