"""Repeated passages, wherever they start: exact windows of words found through sampled grams.

Every run of ``WINDOW`` words that occurs more than once is found, however it is laid out
over lines. A window is told by the least hash of its ``GRAM``-word runs, so equal windows
name the same gram. Only windows whose gram occurs at several places are compared, by the
hash of all their words; of the texts, only those that hold such a gram are read again.

The first place of a window, by id, stays; words in any later one are removals. A window
that overlaps its own first place stays with it.

Defined results: NULL texts and texts of fewer than ``WINDOW`` words have no passages; rows
without an id are left out; rows that repeat an id with another text are told apart by the
text, equal rows are one; very long texts are taken whole; an empty table gives no rows; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelmill.llm.scratch import Scratch
from reelmill.llm.setlinks import texts_of
from reelmill.llm.words import LOWER, WordHashes, mixed, sequence_hashes, spaced_words

GRAM = 25
WINDOW = 2 * GRAM
BATCH = 200_000             # windows of one result batch

_KEY = ["doc_id", "version"]


def _grams(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and for every window the place of its least gram."""
    grams = sequence_hashes(ids, GRAM)
    views = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1)
    return grams, views.argmin(axis=1) + np.arange(len(views))


def _schema(docs: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    key = [("doc_id", docs.schema["doc_id"].dataType), ("version", T.LongType())]
    return T.StructType([T.StructField(*f) for f in [*key, *fields]])


def seeds(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, seeds)``: the least grams of a text's windows, one for each place."""
    schema = _schema(docs, ("seeds", T.ArrayType(T.LongType())))
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                ids = hashes.of(spaced_words(text.encode()))
                if len(ids) < WINDOW:
                    found.append(None)
                    continue
                grams, least = _grams(ids)
                found.append(grams[np.unique(least)].view(np.int64))
            columns = [batch.column(c) for c in _KEY] + [pa.array(found, arrow.field(2).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(cut, schema).where("seeds IS NOT NULL")


def windows(texts: DataFrame) -> DataFrame:
    """Windows whose least gram is among ``seeds``: word number, code points and hash."""
    schema = _schema(
        texts, ("word", T.IntegerType()), ("start", T.LongType()), ("end", T.LongType()), ("window", T.LongType())
    )
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = (batch.column(c).to_pylist() for c in (*_KEY, "text"))
            for key, version, text, asked in zip(*rows, batch.column("seeds")):
                spans = [m.span() for m in re.finditer(r"[^ \t-\r]+", text)]
                ids = hashes.of([text[a:b].encode().translate(LOWER) for a, b in spans])
                grams, least = _grams(ids)
                wanted = asked.values.to_numpy().view(np.uint64)
                at = np.flatnonzero(np.isin(grams[least], wanted))
                ends = np.array(spans, dtype=np.int64)
                value = mixed(mixed(grams[at]) + grams[at + GRAM]).view(np.int64)
                for low in range(0, len(at), BATCH):
                    k = at[low : low + BATCH]
                    columns = [[key] * len(k), [version] * len(k), k, ends[k, 0], ends[k + WINDOW - 1, 1], value[low : low + BATCH]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
                    )

    return texts.select(*_KEY, "text", "seeds").mapInArrow(cut, schema)


def passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every maximal run of words in repeated windows, and whether it is a later copy.

    Columns: ``doc_id, start, end`` (code points, end exclusive), ``n_words, first_doc_id``
    (the least id at which a window of the run occurs first), ``removed``. The result reads
    tables in the session's checkpoint folder.
    """
    space = Scratch(docs.sparkSession, "passages")
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    given = given.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("version", F.xxhash64("text"))
    # Equal rows have the same key and the same seeds: one of them is taken.
    found = seeds(given).groupBy(*_KEY).agg(F.any_value("seeds").alias("seeds"))
    places = space.store(found.select(*_KEY, F.explode("seeds").alias("seed")), "seeds")
    common = places.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
    asked = space.store(
        places.join(common, "seed").groupBy(*_KEY).agg(F.collect_set("seed").alias("seeds")), "asked"
    )
    cut = space.store(windows(texts_of(asked, given, _KEY)), "windows")
    place = F.struct("doc_id", "version", "word")
    # By their places, as equal rows give the same place twice.
    ends = cut.groupBy("window").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeats = space.store(ends.where("first < last").drop("last"), "repeats")
    same = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("version") == F.col("first.version"))
    near = same & (F.col("word") - F.col("first.word") < WINDOW)
    marked = cut.join(repeats, "window").withColumn("removed", ~near)
    order = Window.partitionBy(*_KEY, "removed").orderBy("word")
    fresh = F.coalesce(F.col("word") - F.lag("word").over(order) > WINDOW, F.lit(True))
    runs = marked.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(order))
    return runs.groupBy(*_KEY, "removed", "run").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("word") - F.min("word") + WINDOW).cast("int").alias("n_words"),
        F.min("first.doc_id").alias("first_doc_id"),
    ).select("doc_id", "start", "end", "n_words", "first_doc_id", "removed")
