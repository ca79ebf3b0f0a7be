"""Source divergence audit by count-cell ranking.

Terms are maximal runs of ASCII letters (lower-cased) and non-ASCII characters. A language
keeps the terms of at least ``LEAST_DOCUMENTS`` of its documents. Every group (language,
source) and every language gives each kept term a smoothed share in parts of ``SCALE``; how far
two shares p and q lie apart is ``(p - q) ** 2 div (p + q)``. All arithmetic is on integers.

That figure depends on two counts only, so terms are put in cells of equal counts and it is
worked out once for each cell, not for each term:

* ``terms``: a group's terms by (count in the group, count in the language). Cells of equal
  value are merged, merged cells ranked by their cumulative multiplicity, and only those that
  reach into the first ranks are expanded to terms, in UTF-8 order.
* ``pairs``: two groups' terms by (count in one, count in the other). Only terms that both have
  meet; the rest follows from each group's own cells, as the sum over all kept terms is

      sum over common cells of  m * (f(a, b) - f(a, 0) - f(0, b) + f(0, 0))
      + sum over a's cells of   m * (f(a, 0) - f(0, 0))
      + sum over b's cells of   m * (f(0, b) - f(0, 0))  +  V * f(0, 0)

Counting combines in the task before the first shuffle, under a bound of entries and bytes; a
hot group is then a few partial counts for each of its terms. Windows are pruned to the
first ranks in the map task. The counted terms are written once and read by all later steps.

Defined results: NULL text, language and source count as empty; empty texts have no terms, their
groups still occur; very long texts are taken in pieces; repeated rows count as documents of
their own; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelmill.llm.scratch import Scratch
from reelmill.llm.words import LOWER, text_bytes

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP = 10
HELD_ENTRIES = 400_000      # counts that a task holds before it hands them on
HELD_BYTES = 64 << 20       # bytes of text counted before it does
PIECE_BYTES = 4 << 20       # of one text cut into words at once

TERMS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in LOWER)
COUNTED = "lang string, source string, term string, n long, docs long"
GROUP = ["lang", "source"]


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some megabytes at a time; no term is cut."""
    text = text.translate(TERMS)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PIECE_BYTES)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def partial_counts(docs: DataFrame) -> DataFrame:
    """Counts and documents by group and term, combined within a task; a group also has a
    row with the empty term, so that one without terms occurs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: dict[tuple[str, str], Counter] = defaultdict(Counter)
        documents: dict[tuple[str, str], Counter] = defaultdict(Counter)
        held = entries = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in uses.items():
                found = documents[lang, source]
                names = [b"", *terms]
                counts = [0, *terms.values()]
                docs_of = [0, *map(found.__getitem__, terms)]
                same = [pa.array([value] * len(names), pa.string()) for value in (lang, source)]
                columns = [*same, pa.array(names, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(docs_of, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            uses.clear()
            documents.clear()

        for batch in batches:
            langs, sources = (batch.column(c).to_pylist() for c in GROUP)
            for lang, source, text in zip(langs, sources, text_bytes(batch.column("text"))):
                counts, found = uses[lang, source], documents[lang, source]
                entries -= len(counts)
                seen: set[bytes] = set()
                for words in pieces(text):
                    counts.update(words)
                    seen.update(words)
                found.update(seen)
                held += len(text)
                entries += len(counts)
                if held > HELD_BYTES or entries + len(uses) > HELD_ENTRIES:
                    yield from handed_on()
                    held = entries = 0
        yield from handed_on()

    return docs.mapInArrow(counted, COUNTED)


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * terms))``, exact; NULL without terms."""
    wide = "decimal(20,0)"
    above = (count.cast(wide) + 2) * F.lit(SCALE).cast("decimal(11,0)")
    below = total.cast(wide) + 2 * terms.cast(wide)
    return F.when(terms > 0, F.call_function("div", above, below) + 1)


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


class Audit:
    """The counted corpus, and the two reports on it."""

    def __init__(self, docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> None:
        """Count ``docs (lang, source, text)``; results read the folder written here."""
        self.space = Scratch(docs.sparkSession, "audit")
        given = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*GROUP, "text")]
        counted = partial_counts(docs.select(*given)).groupBy(*GROUP, "term")
        counted = counted.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        counted = self.space.store(counted, "counted")
        terms = counted.where("term <> ''")
        kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
        kept = self.space.store(kept.where(F.col("docs") >= least_documents).drop("docs"), "kept")
        #: (lang, source, term, n, all_n) of the kept terms that a group has
        self.terms = self.space.store(terms.drop("docs").join(kept, ["lang", "term"]), "terms")
        totals = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("lang_total"))
        sizes = self.terms.groupBy(*GROUP).agg(F.sum("n").alias("total"))
        groups = counted.select(*GROUP).distinct().join(sizes, GROUP, "left").join(totals, "lang", "left")
        #: (lang, source, total, v, lang_total) of every group
        self.groups = self.space.store(groups.fillna(0, ["total", "v", "lang_total"]), "groups")

    def top_terms(self, top: int = TOP) -> DataFrame:
        """``(lang, source, item, value, rank)``: terms a group uses more than its language."""
        cells = self.terms.groupBy(*GROUP, "n", "all_n").agg(F.count("*").alias("m"))
        p = share(F.col("n"), F.col("total"), F.col("v"))
        q = share(F.col("all_n"), F.col("lang_total"), F.col("v"))
        shares = cells.join(self.groups, GROUP).select(*cells.columns, p.alias("p"), q.alias("q"))
        valued = shares.where("p > q").withColumn("value", apart(F.col("p"), F.col("q")))
        valued = self.space.store(valued.drop("p", "q"), "cells")
        down = Window.partitionBy(*GROUP).orderBy(F.desc("value"))
        merged = valued.groupBy(*GROUP, "value").agg(F.sum("m").alias("m"))
        first = merged.withColumn("place", F.row_number().over(down)).where(F.col("place") <= top)
        before = F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1))
        reached = first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
        open_cells = valued.drop("m").join(reached.select(*GROUP, "value"), [*GROUP, "value"])
        expanded = self.terms.join(open_cells, [*GROUP, "n", "all_n"])
        order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "term")
        ranked = expanded.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        return ranked.select(*GROUP, F.col("term").alias("item"), "value", "rank")

    def pairs(self) -> DataFrame:
        """``(lang, source, item, value, rank)``: how far all other sources are apart."""
        size = F.struct("source", "total", "v")
        groups = self.groups.select("lang", size.alias("g"))
        left, right = (groups.withColumnRenamed("g", side) for side in ("a", "b"))

        def at(side: str, count) -> Column:
            return share(count, F.col(f"{side}.total"), F.col(f"{side}.v"))

        none = F.lit(0)
        empty = apart(at("a", none), at("b", none))
        key = ["lang", F.least("a.source", "b.source").alias("x"), F.greatest("a.source", "b.source").alias("y")]

        terms = self.terms.select("lang", "term", "source", "n")
        other = terms.toDF("lang", "term", "other", "other_n")
        met = terms.join(other, ["lang", "term"]).where("source < other")
        common = met.groupBy("lang", "source", "other", "n", "other_n").agg(F.count("*").alias("m"))
        common = common.join(left, ["lang"]).where("a.source = source").join(right, ["lang"]).where("b.source = other")
        n, other_n = F.col("n"), F.col("other_n")
        both = apart(at("a", n), at("b", other_n)) - apart(at("a", n), at("b", none))
        both = both - apart(at("a", none), at("b", other_n)) + empty
        of_common = common.select(*key, (F.col("m") * both).alias("value"))

        own = self.terms.groupBy(*GROUP, "n").agg(F.count("*").alias("m"))
        own = own.join(left, "lang").where("a.source = source").join(right, "lang").where("a.source <> b.source")
        of_own = own.select(*key, (F.col("m") * (apart(at("a", n), at("b", none)) - empty)).alias("value"))

        every = left.join(right, "lang").where("a.source < b.source")
        of_every = every.select(*key, F.coalesce(F.col("a.v") * empty, F.lit(0)).alias("value"))

        summed = of_common.union(of_own).union(of_every).groupBy("lang", "x", "y")
        summed = summed.agg(F.sum("value").alias("value"))
        ends = F.array(*[F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in ("xy", "yx")])
        each = summed.select("lang", "value", F.inline(ends))
        order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
        return each.select(*GROUP, "item", "value", F.row_number().over(order).alias("rank"))
