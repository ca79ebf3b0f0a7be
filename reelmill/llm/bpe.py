"""Byte-level BPE through sentencepiece, with a model serialised from a rank file.

A rank file lists byte tokens by merge rank. Every byte is mapped to one printable
character, each token becomes a piece with the score ``-rank``, the normaliser is the
identity: sentencepiece then merges the pair of lowest rank first, leftmost on ties,
which is byte-level BPE. Texts are cut into pre-tokens first and each is encoded on its
own; a pre-token that is itself a token gets that id.

A task makes its results a few megabytes of text at a time, whatever the size of a batch.

Both directions work row by row, without a shuffle. NULL and empty texts encode to no
ids; ids decode to the bytes of the text exactly. Ids outside the vocabulary fail.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.words import by_bytes, sliced

CACHE_TOKENS = 300_000      # pre-tokens whose ids a task remembers before it starts afresh
GROUP_CHARACTERS = 1 << 20  # characters cut at once
SLICE_IDS = 1 << 20         # ids decoded at once, beside one longer list
FIRST_CHARACTER = 0x100     # byte b is written as the character FIRST_CHARACTER + b


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id and the pattern that cuts texts; about a megabyte, fixed in size."""

    tokens: tuple[bytes, ...]
    pattern: str


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file (base64 token, rank) on the driver."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte must be a token")
    return Vocabulary(tuple(tokens), pattern)


def serialised_model(tokens: Sequence[bytes]) -> bytes:
    """A sentencepiece model file with the ids of ``tokens`` (and one unknown piece last)."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    table = {b: FIRST_CHARACTER + b for b in range(256)}
    for rank, token in enumerate(tokens):
        model.pieces.add(
            piece=token.decode("latin-1").translate(table),
            score=-rank,
            type=pb.ModelProto.SentencePiece.NORMAL,
        )
    model.pieces.add(piece="<unk>", score=0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.unk_id = len(tokens)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


def ascii_pattern(pattern: str) -> re.Pattern:
    """The pattern for texts of ASCII characters only, where letters and digits are few."""
    parts = re.split(r"(\[[^\]]*\])", pattern)
    for k, part in enumerate(parts):
        letters, digits = ("A-Za-z", "0-9") if k % 2 else ("[A-Za-z]", "[0-9]")
        parts[k] = part.replace(r"\p{L}", letters).replace(r"\p{N}", digits)
    return re.compile("".join(parts), re.ASCII)


def as_characters(tokens: list[bytes]) -> list[str]:
    """Each byte as its printable character, all tokens in one pass."""
    characters = np.frombuffer(b"".join(tokens), dtype=np.uint8).astype("<u4") + np.uint32(FIRST_CHARACTER)
    text = characters.tobytes().decode("utf-32-le")
    ends = list(accumulate(map(len, tokens), initial=0))
    return [text[start:end] for start, end in zip(ends, ends[1:])]


class Encoder:
    """Texts to ids inside a task; remembers the ids of pre-tokens it meets often.

    They are kept as the bytes of an array of ``dtype`` (4-byte or 2-byte integers), so
    that a text's ids are one join of them.
    """

    def __init__(self, vocabulary: Vocabulary, model: bytes, dtype: str = "int32") -> None:
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_proto=model)
        self.ranks = {token: rank for rank, token in enumerate(vocabulary.tokens)}
        self.dtype = np.dtype(dtype)
        self.known: dict[str, bytes] = {}
        self.cut_any = regex.compile(vocabulary.pattern).findall
        self.cut_ascii = ascii_pattern(vocabulary.pattern).findall

    def cut(self, text: str) -> list[str]:
        return self.cut_ascii(text) if text.isascii() else self.cut_any(text)

    def learn(self, tokens: list[str]) -> None:
        raw = [token.encode() for token in tokens]
        whole = list(map(self.ranks.get, raw))
        rest = [k for k, rank in enumerate(whole) if rank is None]
        code = self.dtype.char
        self.known.update(
            (t, array(code, (rank,)).tobytes()) for t, rank in zip(tokens, whole) if rank is not None
        )
        if rest:
            ids = self.processor.encode(as_characters([raw[k] for k in rest]), num_threads=1)
            self.known.update((tokens[k], array(code, row).tobytes()) for k, row in zip(rest, ids))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; callers bound the characters they hand over at once."""
        cuts = [self.cut(text) for text in texts]
        distinct = set(chain.from_iterable(cuts))
        if len(self.known) > CACHE_TOKENS:
            self.known.clear()
        self.learn([token for token in distinct if token not in self.known])
        ids = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids, tokens)), dtype=self.dtype) for tokens in cuts]

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids text by text, cut in groups of bounded size."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARACTERS:
                yield from self.encode(group)
                group, size = [], 0
        yield from self.encode(group)


def with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """``schema`` with a last column ``name``, in place of one of that name."""
    kept = [f for f in schema.fields if f.name.lower() != name.lower()]
    return T.StructType([*kept, T.StructField(name, kind)])


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` as an array column (it replaces one so named)."""
    shared = df.sparkSession.sparkContext.broadcast(
        (vocabulary.tokens, vocabulary.pattern, serialised_model(vocabulary.tokens))
    )
    schema = with_column(df.schema, ids, T.ArrayType(T.IntegerType(), False))
    kept = schema.names[:-1]
    arrow = to_arrow_schema(schema)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, pattern, model = shared.value
        encoder = Encoder(Vocabulary(tokens, pattern), model)
        for batch in by_bytes(batches, text):
            texts = [value or "" for value in batch.column(text).to_pylist()]
            flat = list(encoder.encode_all(texts))
            offsets = np.cumsum([0, *map(len, flat)])
            values = np.concatenate(flat) if flat else np.empty(0, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
            columns = [*[batch.column(c) for c in kept], lists.cast(arrow.field(ids).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(encoded, schema)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for (NULL ids: empty)."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary.tokens)
    schema = with_column(df.schema, decoded, T.BinaryType())
    kept = schema.names[:-1]
    arrow = to_arrow_schema(schema)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in chain.from_iterable(
            sliced(b, pc.list_value_length(b.column(ids)), SLICE_IDS) for b in batches
        ):
            lists = batch.column(ids)
            out = []
            for k in range(len(lists)):
                values = lists[k].values
                out.append(b"" if values is None else b"".join(map(token, values.to_numpy().tolist())))
            columns = [*[batch.column(c) for c in kept], pa.array(out, arrow.field(decoded).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(texts, schema)
