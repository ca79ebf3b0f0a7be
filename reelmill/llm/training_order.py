"""Training-order materialisation of token sequences as fixed-stride binary shards.

1. Texts are encoded and packed into sequences of ``length`` tokens, an end-of-text token
   after each text; only the last sequence of a partition is padded. They are written
   once, so every later step sees the same rows even if executors are lost.
2. Each sequence has a dense number: the count of sequences in earlier partitions plus its
   place in its own. A keyed Feistel permutation with cycle-walking maps the numbers
   ``0..n-1`` onto the slots ``0..n-1``, without a sort and without a table.
3. Slots are dealt by range: slot // ``shard_slots`` is the shard and the partition. What a
   task sends to one shard travels as one compressed bundle. Each shard task puts its
   sequences into place and writes one file in slot order.

Slot ``s`` starts at byte ``(s % shard_slots) * stride`` of shard ``s // shard_slots``, so
reading in training order is sequential and resumes at any slot. A file appears by one
rename once complete; a repeated task writes the same bytes.

Defined results: NULL and empty texts have no tokens and appear in no sequence; rows
without an id are written, and their id is left out of ``doc_ids``; repeated rows are
written each; a very long text runs over many sequences; an empty table gives no shard; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.bpe import Encoder, Vocabulary, serialised_model
from reelmill.llm.scratch import Scratch
from reelmill.llm.words import mixed

LENGTH = 1024               # tokens of a sequence
SHARD_SLOTS = 1 << 14       # sequences of a shard: 32 MB
ROUNDS = 6
TOKEN = np.dtype("<u2")     # two bytes hold every id below 65,536

PACKED = T.StructType(
    [
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("tokens", T.BinaryType()),
    ]
)
BUNDLE = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("slots", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("docs", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("packed", T.BinaryType()),
    ]
)
PLACED = T.StructType(
    [
        T.StructField("slot", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("byte_offset", T.LongType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
    ]
)


def feistel(values: np.ndarray, bits: int, key: int, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of the numbers below ``2 ** (2 * bits)``."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64(bits)
    keys = mixed(np.uint64(key) + np.arange(1, ROUNDS + 1, dtype=np.uint64))
    left, right = values >> half, values & mask
    for k in keys[::-1] if inverse else keys:
        if inverse:
            left, right = right ^ (mixed(left + k) & mask), left
        else:
            left, right = right, left ^ (mixed(right + k) & mask)
    return (left << half) | right


def permuted(values: np.ndarray, count: int, key: int, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of ``0..count-1``: the Feistel one, repeated while out of range.

    The domain is less than four times ``count``, so few values walk far.
    """
    bits = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    out = feistel(values.astype(np.uint64), bits, key, inverse)
    while (far := out >= np.uint64(count)).any():
        out[far] = feistel(out[far], bits, key, inverse)
    return out.astype(np.int64)


def squeezed(blocks: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(blocks)


def unsqueezed(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=TOKEN)


def kept_encoder(sent: dict) -> Encoder:
    """The encoder of a broadcast. A worker keeps its copy of the broadcast from task to task,
    and with it the encoder and the pre-tokens it has met."""
    if "encoder" not in sent:
        sent["encoder"] = Encoder(Vocabulary(*sent["vocabulary"]), sent["model"], TOKEN.str)
    return sent["encoder"]


def packed(docs: DataFrame, vocabulary: Vocabulary, length: int) -> DataFrame:
    """Texts as sequences of ``length`` tokens, packed within each partition."""
    end = len(vocabulary.tokens)
    if end > np.iinfo(TOKEN).max:
        raise ValueError("ids must fit two bytes")
    shared = docs.sparkSession.sparkContext.broadcast(
        {"vocabulary": (vocabulary.tokens, vocabulary.pattern), "model": serialised_model(vocabulary.tokens)}
    )
    arrow = to_arrow_schema(PACKED)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(shared.value)
        held = np.empty(0, dtype=TOKEN)
        stop = np.full(1, end, dtype=TOKEN)
        owners: list[tuple[int | None, int]] = []       # document and its end in ``held``

        def rows(full: int) -> pa.RecordBatch:
            nonlocal held, owners
            blocks = held[: full * length].reshape(full, length)
            docs_of: list[list[int]] = [[] for _ in range(full)]
            start = 0
            for doc, last in owners:
                for k in range(start // length, min(full, -(-last // length))):
                    if doc is not None and (not docs_of[k] or docs_of[k][-1] != doc):
                        docs_of[k].append(doc)
                start = last
            cut = full * length
            owners = [(doc, last - cut) for doc, last in owners if last > cut]
            held = held[cut:]
            columns = [
                pa.array([length] * full, pa.int32()),
                pa.array(docs_of, arrow.field("doc_ids").type),
                pa.array([block.tobytes() for block in blocks], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            texts = [value or "" for value in batch.column("text").to_pylist()]
            parts, at = [held], len(held)
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode_all(texts)):
                if len(ids):
                    parts += [ids, stop]
                    at += len(ids) + 1
                    owners.append((doc, at))
            held = np.concatenate(parts)
            if len(held) >= length:
                yield rows(len(held) // length)
        if len(held):
            size = len(held)
            held = np.append(held, np.full(length - size, end, dtype=TOKEN))
            last = rows(1).to_pydict()
            yield pa.RecordBatch.from_pydict({**last, "n_tokens": [size]}, schema=arrow)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return given.mapInArrow(sequences, PACKED).withColumn("row", F.monotonically_increasing_id())


def numbered(sequences: DataFrame) -> tuple[DataFrame, int]:
    """Stored sequences with a dense number, and their count.

    ``row`` holds the writing partition and the place in it; only one row for each
    partition is summed up in order.
    """
    part = F.shiftright("row", 33)
    sizes = sequences.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.col("row").bitwiseAND((1 << 33) - 1)
    count = sequences.count()
    rows = sequences.withColumn("part", part).join(F.broadcast(starts), "part")
    return rows.select((F.col("before") + place).alias("number"), "n_tokens", "doc_ids", "tokens"), count


def bundles(rows: DataFrame, count: int, key: int, shard_slots: int) -> DataFrame:
    """Numbered sequences at their slots, one bundle for each shard and batch of rows."""
    arrow = to_arrow_schema(BUNDLE)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = permuted(batch.column("number").to_numpy(), count, key)
            order = np.argsort(slots, kind="stable")
            shards = slots[order] // shard_slots
            parts = np.split(order, np.flatnonzero(np.diff(shards)) + 1) if len(order) else []
            out = []
            for part in parts:
                taken = batch.take(pa.array(part))
                out.append(
                    (
                        int(slots[part[0]] // shard_slots),
                        slots[part],
                        taken.column("n_tokens").to_numpy(),
                        taken.column("doc_ids").to_pylist(),
                        squeezed(b"".join(taken.column("tokens").to_pylist())),
                    )
                )
            columns = zip(*out) if out else [[] for _ in BUNDLE]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    return rows.mapInArrow(dealt, BUNDLE)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def written(dealt: DataFrame, folder: str, count: int, length: int, shard_slots: int, pad: int) -> DataFrame:
    """Write every shard file; the result lists what lies where."""
    arrow = to_arrow_schema(PLACED)
    stride = length * TOKEN.itemsize

    def shard_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                parts.setdefault(row["shard"], []).append(row)
        for shard, rows in sorted(parts.items()):
            first = shard * shard_slots
            size = min(shard_slots, count - first)
            blocks = np.full((size, length), pad, dtype=TOKEN)
            listed = []
            for row in rows:
                at = np.array(row["slots"]) - first
                blocks[at] = unsqueezed(row["packed"]).reshape(len(at), length)
                listed += zip(row["slots"], at.tolist(), row["sizes"], row["docs"])
            if len(listed) != size:
                raise ValueError(f"shard {shard} has {len(listed)} of {size} sequences")
            files, root = fs.FileSystem.from_uri(folder)
            draft = f"{root}/_{uuid.uuid4().hex}"
            with files.open_output_stream(draft) as out:
                out.write(blocks)
            files.move(draft, f"{root}/{shard_name(shard)}")
            listed.sort()
            columns = [
                [slot for slot, _, _, _ in listed],
                [shard] * size,
                [at * stride for _, at, _, _ in listed],
                [n for _, _, n, _ in listed],
                [docs for _, _, _, docs in listed],
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    shards = max(1, -(-count // shard_slots))
    return dealt.repartitionById(shards, F.col("shard")).mapInArrow(shard_files, PLACED)


def materialise(
    docs: DataFrame,
    vocabulary: Vocabulary,
    key: int,
    folder: str | None = None,
    length: int = LENGTH,
    shard_slots: int = SHARD_SLOTS,
) -> tuple[DataFrame, str]:
    """Write ``docs (doc_id, text)`` in training order; what lies where, and the folder.

    ``folder`` is a URI that all executors reach (by default one in the checkpoint
    folder). ``order.json`` in it holds what ``read_slots`` needs.
    """
    space = Scratch(docs.sparkSession, "training-order")
    folder = folder or space.path("shards")
    if "://" not in folder:
        folder = f"file://{folder}"
    sequences = space.store(packed(docs, vocabulary, length), "sequences", "zstd")
    rows, count = numbered(sequences)
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root)
    order = {"count": count, "key": key, "length": length, "shard_slots": shard_slots}
    with files.open_output_stream(f"{root}/order.json") as out:
        out.write(json.dumps({**order, "pad": len(vocabulary.tokens)}).encode())
    dealt = bundles(rows, count, key, shard_slots)
    placed = written(dealt, folder, count, length, shard_slots, len(vocabulary.tokens))
    placed = space.store(placed, "placed")
    space.drop("sequences")
    return placed, folder


def read_slots(folder: str, start: int = 0) -> Iterator[np.ndarray]:
    """Sequences in training order from slot ``start`` on, one shard file after the other."""
    files, root = fs.FileSystem.from_uri(folder)
    with files.open_input_stream(f"{root}/order.json") as given:
        order = json.loads(given.read())
    stride = order["length"] * TOKEN.itemsize
    slot = start
    while slot < order["count"]:
        shard, at = divmod(slot, order["shard_slots"])
        with files.open_input_file(f"{root}/{shard_name(shard)}") as data:
            data.seek(at * stride)
            while block := data.read(stride):
                yield np.frombuffer(block, dtype=TOKEN)
                slot += 1
