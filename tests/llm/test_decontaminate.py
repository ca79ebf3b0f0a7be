import random
import re

import numpy as np
import pytest

from reelmill.llm import decontaminate
from reelmill.llm.fm_index import FMIndex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_force(docs, bench, size=10):
    """Plain loops over words: the windows of every item against every document."""
    out = {}
    for key, text in docs:
        words, hit, items = WORD.findall(lowered(text)), set(), set()
        for item, passage in bench:
            target = WORD.findall(lowered(passage))
            for k in range(max(len(target) - size, 0) + 1 if target else 0):
                window = target[k : k + size]
                for at in range(len(words) - len(window) + 1):
                    if words[at : at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        items.add(str(item))
        out[key] = (len(words), len(hit), sorted(items))
    return out


@pytest.mark.parametrize("sample", [1, 4, 16])
def test_index_finds_every_occurrence(sample):
    rng = np.random.default_rng(sample)
    runs = [rng.integers(1, 4, rng.integers(1, 60)) for _ in range(40)] + [np.tile([1, 2], 100)] * 2
    text = np.concatenate([np.append(run, 0) for run in runs])
    index = FMIndex(text, sample)
    phrases = [rng.integers(1, 4, rng.integers(1, 7)) for _ in range(200)]
    matrix = np.zeros((200, 6), dtype=np.int64)
    for k, phrase in enumerate(phrases):
        matrix[k, : len(phrase)] = phrase
    low, high = index.search(matrix, np.array([len(p) for p in phrases]))
    for k, phrase in enumerate(phrases):
        found = sorted(index.locate(np.arange(low[k], high[k])))
        true = [i for i in range(len(text)) if list(text[i : i + len(phrase)]) == list(phrase)]
        assert found == true


def random_case(seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "Dé", "7"]
    bench = [(k, " ".join(rng.choices(words[:3], k=rng.choice([0, 1, 3, 9, 10, 12, 30])))) for k in range(12)]
    docs = []
    for k in range(60):
        parts = rng.choices(words, k=rng.randrange(40))
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(bench)[1].upper()]
        docs.append((k, rng.choice([" ", "--", "\n"]).join(parts)))
    return docs, bench


@pytest.mark.parametrize("seed,block", [(1, 200_000), (2, 3)])
def test_equals_brute_force(spark, seed, block):
    docs, bench = random_case(seed)
    docs += [(100, None), (101, ""), (102, "x " * 30000), (103, bench[3][1])]
    bench += [(50, None), (51, "..."), (None, "Dé Dé Dé Dé Dé Dé Dé Dé Dé Dé Dé")]
    listed = [b for b in bench if b[0] is not None]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    given = spark.createDataFrame(bench, "item_id long, text string")
    truth = brute_force(docs, listed)
    rows = decontaminate.mark(df, given, block_windows=block).collect()
    assert len(rows) == len(docs)
    for row in rows:
        size, hit, items = truth[row["doc_id"]]
        assert (row["n_words"], row["items"]) == (size, items)
        assert row["n_hit"] >= hit
        assert row["n_hit"] == hit or "Dé" in row["text"]
        assert sum(s["end"] - s["start"] for s in row["hit_words"]) == row["n_hit"]


def test_spans_cut_the_passages(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    text = f"Ünïcode 😀 start {passage.upper()}, the end"
    df = spark.createDataFrame(
        [(1, text, 5), (1, text, 5), (2, "clean text", 6), (3, None, 7), (4, passage, 8)],
        "doc_id long, text string, n_hit long",
    )
    bench = spark.createDataFrame([(9, passage), (9, passage)], "item_id long, text string")
    marked = decontaminate.mark(df, bench)
    cut = marked.withColumn("text", decontaminate.without_spans()).select("doc_id", "text", "n_hit")
    assert sorted(map(tuple, cut.collect()), key=repr) == [
        (1, "Ünïcode 😀 start , the end", 11),
        (1, "Ünïcode 😀 start , the end", 11),
        (2, "clean text", 0),
        (3, None, 0),
        (4, "", 11),
    ]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in decontaminate.mark(docs, none).collect()] == [0]
    assert decontaminate.mark(docs.where("false"), none).count() == 0
