import random

import pyarrow as pa
import pytest

from reelmill.llm import paragraph_dedup as pd, setlinks, words
from reelmill.llm.scratch import Scratch

from test_chosen_path import brute_force, family


def line_of(rng, words):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(words))


def truth(docs):
    """Paragraphs and their classes by comparing every pair."""
    places, lines = [], []
    for doc, text in docs:
        at = 0
        for number, line in enumerate((text or "").split("\n")):
            if doc is not None and len(line.split()) >= pd.LEAST_WORDS:
                places.append((doc, number, at, at + len(line)))
                lines.append(line)
            at += len(line) + 1
    label = brute_force(list(enumerate(lines)), pd.PERCENT)
    groups = {}
    for k, place in enumerate(places):
        groups.setdefault(label[k], []).append(place)
    out = {}
    for group in groups.values():
        first = min(group)
        for place in group if len(group) > 1 else []:
            out[place] = (first[0], first[1], len(group), place != first)
    return out


def random_docs(seed):
    rng = random.Random(seed)
    shared = [family(rng, 12, words, 4) for words in (35, 60, 120)]
    docs = []
    for k in range(80):
        lines = [line_of(rng, rng.choice([5, 40, 70])) for _ in range(3)]
        if rng.random() < 0.6:
            lines.insert(rng.randrange(3), rng.choice(rng.choice(shared)))
        docs.append((k, "\n".join(lines)))
    return docs + [(100, None), (101, ""), (None, docs[0][1]), (102, docs[3][1]), (103, "é " * 20000)]


@pytest.mark.parametrize("block", [1024, 6])
def test_equals_brute_force(spark, monkeypatch, block):
    if block < 1000:
        monkeypatch.setattr(setlinks, "BLOCK", block)
        monkeypatch.setattr(pd, "LEAF", 4)
    docs = random_docs(block)
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item long")
    found = {
        (r["doc_id"], r["paragraph"], r["start"], r["end"]): (
            r["first_doc_id"], r["first_paragraph"], r["n_copies"], r["removed"],
        )
        for r in pd.removals(df).collect()
    }
    assert found == truth(docs)
    assert sum(removed for *_, removed in found.values()) > 10


def test_repeated_ids_and_empty_table(spark):
    rng = random.Random(1)
    a, b = line_of(rng, 40), line_of(rng, 40)
    df = spark.createDataFrame([(1, a), (1, b), (1, b), (2, a)], "doc_id long, text string")
    rows = pd.removals(df).collect()
    assert sorted((r["doc_id"], r["n_copies"], r["removed"]) for r in rows) == [
        (1, 2, False), (1, 2, False), (1, 2, True), (2, 2, True),
    ]
    assert pd.removals(df.where("false")).count() == 0


def test_banding_reaches_its_recall():
    for similarity in (0.7, 0.8, 0.9):
        bands, rows = pd.tuned(similarity)
        assert bands * rows <= pd.MOST_TOKENS
        assert 1 - (1 - similarity**rows) ** bands >= pd.RECALL


def test_a_task_holds_a_few_megabytes_of_a_batch(spark, monkeypatch):
    line = " ".join(f"word{k}" for k in range(2000))
    texts = [f"{line} {k}\n{line}" for k in range(600)]
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    taken = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, fn, schema: taken.append(fn) or self)
    pd.paragraphs(docs, 3)
    batch = pa.record_batch({"doc_id": range(600), "version": range(600), "text": texts})
    cut = list(taken[0](iter([batch])))
    sizes = [sum(len(texts[k]) for k in set(part["doc_id"].to_pylist())) for part in cut]
    assert max(sizes) <= words.SLICE_BYTES + max(map(len, texts)) < sum(sizes)
    whole = pa.Table.from_batches(cut)
    assert whole["doc_id"].to_pylist() == [k for k in range(600) for _ in range(2)]
    assert [texts[k][a:b] for k, a, b in zip(*(whole[c].to_pylist() for c in ("doc_id", "start", "end")))] == [
        line for text in texts for line in text.split("\n")
    ]


def test_bands_are_not_sorted_and_texts_written_once(spark, monkeypatch):
    plans, store = {}, Scratch.store

    def noted(self, df, table, *more):
        plans[table] = df._jdf.queryExecution().sparkPlan().toString()
        return store(self, df, table, *more)

    monkeypatch.setattr(Scratch, "store", noted)
    docs = spark.createDataFrame(random_docs(3), "doc_id long, text string")
    assert pd.removals(docs).count() > 0
    assert "ShuffledHashJoin" in plans["members"] and "SortMergeJoin" not in plans["members"]
    assert "contents" in plans and "parts" not in plans
