"""Spelling variant grouping by finite-state composition.

The vocabulary is an acceptor V; T rewrites a word by one edit (one code point inserted, deleted
or replaced), and V o T o V accepts the pairs of words that are one edit apart. A path of the
composition reads the same code points on both sides, takes one edit arc and reads the same rest
on both sides. The edit arc is taken at the first place where the words differ, so every pair
has one path.

The composition is enumerated by initial-state partition: the state that both sides reach
by the code points before the edit. A state whose words fit a task (``STATE_WORDS``) is one
partition; its task minimises the acceptor of the words' rests and composes it with T and with
itself. At a larger state Spark takes the arcs: words whose rests behind the arc are equal meet
by that rest (at most one for each code point of the alphabet), and words go on to the states
behind their next code point. So no task holds more than ``STATE_WORDS`` words, however many
words begin alike, and the words are never held in one place. Only counts are shuffled by state;
the list of large states is stored, so Spark joins words to it by its known size.

Defined results: NULL and empty texts have no words; a NULL id counts as the empty text; very
long texts are taken as a whole, row by row; repeated rows count again; ties for the form go
to the least word in code-point order; an empty table gives no rows; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelmill.llm.scratch import Scratch
from reelmill.llm.words import LOWER, text_bytes

LEAST_LENGTH = 5
LEAST_USES = 3
SLIP_ONE_IN = 97            # share of uses that lose a code point, by a hash of id and run
FORM_FACTOR = 2             # a form is used so many times as often as the word, at least
STATE_WORDS = 5_000         # words of a state that one task composes
HELD_ENTRIES = 200_000      # counts that a task holds before it hands them on
HELD_BYTES = 64 << 20       # bytes of text counted before it does

RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
PAIRS = "word string, n long, near string, near_n long"


def partial_words(docs: DataFrame) -> DataFrame:
    """``(word, n)`` counts of the runs of ``docs (id, text)``, combined within a task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: Counter = Counter()
        held = 0

        def handed_on() -> pa.RecordBatch:
            rows = [(word, n) for word, n in uses.items() if n and len(word) >= LEAST_LENGTH]
            uses.clear()
            words, counts = zip(*rows) if rows else ((), ())
            return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(counts, pa.int64())})

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), text_bytes(batch.column("text"))):
                found = Counter(RUN.findall(text.translate(LOWER).decode()))
                uses.update(found)
                seed = crc32(f"{key}:".encode())
                for word, n in found.items():
                    check = crc32(word.encode(), seed)
                    if check % SLIP_ONE_IN == 0:
                        at = check % len(word)
                        uses[word] -= n
                        uses[word[:at] + word[at + 1 :]] += n
                held += len(text)
                if held > HELD_BYTES or len(uses) > HELD_ENTRIES:
                    yield handed_on()
                    held = 0
        yield handed_on()

    return docs.mapInArrow(counted, "word string, n long")


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: words of all texts that are long enough and used often enough."""
    named = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id")
    counted = partial_words(docs.select(named, F.col(text).alias("text")))
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_USES)


class Acceptor:
    """The minimised acceptor of sorted distinct words; states are numbers, the root is last."""

    def __init__(self, words: Iterable[str]) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}
        open_states: list[list] = [[False, []]]     # of the last word: final, finished arcs
        last = ""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self._close(open_states, last, same)
            open_states += [[False, []] for _ in word[same:]]
            open_states[-1][0] = True
            last = word
        self._close(open_states, last, 0)
        self.root = self._state(*open_states[0])

    def _close(self, open_states: list[list], word: str, depth: int) -> None:
        while len(open_states) > depth + 1:
            state = self._state(*open_states.pop())
            open_states[-1][1].append((word[len(open_states) - 1], state))

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        """The one state of this right language."""
        shape = (final, tuple(arcs))
        state = self.known.setdefault(shape, len(self.arcs))
        if state == len(self.arcs):
            self.arcs.append(dict(arcs))
            self.final.append(final)
        return state

    def common(self, p: int, q: int, but: str | None = None) -> Iterator[str]:
        """Words that both states accept, those beginning with ``but`` left out."""
        ways = [(p, q, "")]
        while ways:
            p, q, read = ways.pop()
            if self.final[p] and self.final[q]:
                yield read
            arcs, others = self.arcs[p], self.arcs[q]
            for c in arcs if p == q else arcs.keys() & others.keys():
                if read or c != but:
                    ways.append((arcs[c], others[c], read + c))

    def composed(self) -> Iterator[tuple[str, str]]:
        """Accepted pairs of V o T o V, each once, in either order."""
        ways = [(self.root, "")]
        while ways:
            state, read = ways.pop()
            arcs = self.arcs[state]
            for a, b in combinations(arcs, 2):
                for rest in self.common(arcs[a], arcs[b]):
                    yield read + a + rest, read + b + rest
            for a, behind in arcs.items():
                for rest in self.common(behind, state, but=a):
                    yield read + a + rest, read + rest
                ways.append((behind, read + a))


def composed_in_tasks(partitions: DataFrame) -> DataFrame:
    """Pairs, both ways, of ``(state, word, n)`` whose words differ behind the state only."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(state: str, uses: dict[str, int]) -> Iterator[pa.RecordBatch]:
            found = Acceptor(word[len(state) :] for word in uses).composed()
            rows = [(state + a, state + b) for a, b in found]
            left, right = [a for pair in rows for a in pair], [b for pair in rows for b in pair[::-1]]
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array(left, pa.string()),
                    "n": pa.array([uses[word] for word in left], pa.int64()),
                    "near": pa.array(right, pa.string()),
                    "near_n": pa.array([uses[word] for word in right], pa.int64()),
                }
            )

        current, uses = None, {}
        for batch in batches:
            for state, word, n in zip(*(batch.column(c).to_pylist() for c in ("state", "word", "n"))):
                if state != current and uses:
                    yield from of(current, uses)
                    uses = {}
                current = state
                uses[word] = n
        if uses:
            yield from of(current, uses)

    dealt = partitions.select("state", "word", "n").repartition("state")
    return dealt.sortWithinPartitions("state", "word").mapInArrow(pairs, PAIRS)


def composed_at(words: DataFrame, depth: int) -> DataFrame:
    """Pairs, both ways, of ``(state, word, n)`` whose first difference is at ``depth``."""
    arc = F.substring("word", depth + 1, 1)
    rest = F.concat("state", F.substring("word", depth + 2, F.length("word")))
    read = words.select(rest.alias("rest"), F.lit(True).alias("edited"), arc.alias("arc"), "word", "n")
    plain = words.select(F.col("word").alias("rest"), F.lit(False).alias("edited"), arc.alias("arc"), "word", "n")
    ways = read.where(F.length("word") > depth).union(plain)
    met = ways.groupBy("rest").agg(F.collect_list(F.struct("edited", "arc", "word", "n")).alias("of"))
    met = met.where(F.size("of") > 1).select(F.explode("of").alias("a"), "of")
    each = met.select("a", F.explode("of").alias("b"))
    apart = (F.col("a.edited") | F.col("b.edited")) & (F.col("a.arc") != F.col("b.arc"))
    return each.where(apart).select("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))


def near_pairs(words: DataFrame, space: Scratch, state_words: int = STATE_WORDS) -> DataFrame:
    """``(word, n, near, near_n)``: all pairs one edit apart, both ways, of distinct words."""
    found, small = [], []
    open_words, depth = words.select(F.lit("").alias("state"), "word", "n"), 0
    while True:
        sizes = open_words.groupBy("state").agg(F.count("*").alias("size"))
        large = space.store(sizes.where(F.col("size") > state_words).select("state"), f"large{depth}")
        small.append(open_words.join(large, "state", "left_anti"))
        if large.isEmpty():
            break
        hot = space.store(open_words.join(large, "state", "left_semi"), f"states{depth}")
        found.append(space.store(composed_at(hot, depth), f"pairs{depth}"))
        depth += 1
        state = F.substring("word", 1, depth).alias("state")
        open_words = hot.where(F.length("word") >= depth).select(state, "word", "n")
    pairs = composed_in_tasks(_union(small))
    return space.store(_union([*found, pairs]), "near")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part)
    return whole


def group(words: DataFrame, near: DataFrame, space: Scratch) -> DataFrame:
    """Every word with its form, the root its forms lead to, and its number of near words."""
    best = F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("form")))
    ranked = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(ranked, "word", "left")
    form_n = -F.col("best.down")
    has_form = form_n >= FORM_FACTOR * F.col("n")
    formed = space.store(
        joined.select(
            "word",
            F.when(has_form, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, form_n).alias("form_n"),
        ),
        "formed",
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), space)
    led = formed.join(roots, "word", "left")
    return led.withColumn("root", F.coalesce("root", "word")).select("word", "form", "root", "n", "n_near", "form_n")


def _roots(links: DataFrame, space: Scratch) -> DataFrame:
    """Follow ``(word, root)`` to the last, by doubling: uses grow along a way, so it ends."""
    current, turn = space.store(links, "roots0"), 0
    while True:
        on = current.select(F.col("word").alias("root"), F.col("root").alias("on"))
        moved = current.join(on, "root", "left")
        turn += 1
        moved = space.store(
            moved.select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")),
            f"roots{turn}",
        )
        if moved.where("moved").isEmpty():
            return moved.drop("moved")
        space.drop(f"roots{turn - 1}")
        current = moved.drop("moved")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", state_words: int = STATE_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of all texts."""
    spark: SparkSession = docs.sparkSession
    space = Scratch(spark, "spelling")
    words = space.store(vocabulary(docs, key, text), "words")
    return group(words, near_pairs(words, space, state_words), space)
