import random

import numpy as np
import pytest

from reelmill.llm import chosen_path, setlinks
from reelmill.llm.components import components
from reelmill.llm.scratch import Scratch


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = words.replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute_force(docs, percent=85):
    """Links by comparing every pair, classes by repeated relabelling."""
    sets = [(key, shingles(text)) for key, text in docs if key is not None]
    label = {key: key for key, _ in sets}
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def family(rng, size, words, edits):
    """Copies of one text with up to ``edits`` words replaced in each."""
    base = [rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    truth = brute_force(docs)
    rows = chosen_path.near_duplicates(df).collect()
    assert len(rows) == len(docs)
    by_size = {(key, len(shingles(text))) for key, text in docs}
    for row in rows:
        assert (row["doc_id"], row["n_shingles"]) in by_size
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            assert row["component_id"] == truth[row["doc_id"]], row
            assert row["kept"] == (row["component_id"] == row["doc_id"])


def test_families_and_odd_rows(spark):
    rng = random.Random(5)
    texts = [t for _ in range(20) for t in family(rng, 8, rng.choice([30, 80, 200]), 6)]
    texts += [None, "", "  \n\t", "one two", "One TWO", "a b c d e", "a b c d e f"]
    texts += ["same same same same same same"] * 3 + ["long " * 30000, "long " * 30001]
    rng.shuffle(texts)
    docs = list(enumerate(texts)) + [(None, texts[0]), (None, None)]
    check(spark, docs)


def test_large_groups_pass_through_pivots_and_blocks(spark, monkeypatch):
    """With small limits one spread-out family is tight and one common passage is loose."""
    monkeypatch.setattr(chosen_path, "LEAF", 16)
    monkeypatch.setattr(setlinks, "BLOCK", 24)
    rng = random.Random(8)
    texts = family(rng, 160, 60, 5)
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [f"{passage} " + " ".join(f"u{k}-{j}" for j in range(50)) for k in range(60)]
    check(spark, list(enumerate(texts)))


def test_repeated_ids_and_empty_table(spark):
    base = " ".join(f"w{k}" for k in range(50))
    docs = [(1, base), (1, "something else entirely in here now"), (2, base + " more"), (3, base)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = chosen_path.near_duplicates(df).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(1, 1), (1, 1), (2, 1), (3, 1)]
    assert chosen_path.near_duplicates(df.where("false")).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    edges += [(k, k + 1) for k in range(200, 260)] + [(300, k) for k in range(301, 340)]
    df = spark.createDataFrame(edges, "a long, b long")
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = {r["item"]: r["component"] for r in components(df, Scratch(spark, "test"), "c").collect()}
    looped = {a for a, b in edges if a == b and label[a] == a and a not in found}
    assert found == {k: v for k, v in label.items() if k not in looped}


def test_shared_counts_and_forest():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(12)]
    counts = setlinks.shared_counts(sets)
    for a in range(12):
        for b in range(12):
            if a != b:
                assert counts[a, b] == len(set(sets[a]) & set(sets[b]))
    linked = np.zeros((5, 5), dtype=bool)
    for a, b in [(0, 1), (1, 2), (0, 2), (3, 4)]:
        linked[a, b] = linked[b, a] = True
    assert len(setlinks.forest(linked)) == 3


@pytest.mark.parametrize("similarity", [0.85, 0.95])
def test_sketch_agreement_follows_similarity(similarity):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    both = int(2000 * similarity)
    a = setlinks.minwise(values, 400)
    rest = rng.integers(0, 1 << 63, 1).astype(np.uint64)
    b = setlinks.minwise(np.concatenate([values[:both], rest]), 400)
    assert abs((a == b).mean() - both / 2001) < 0.08


def test_large_tight_nodes_are_joined_once(spark):
    """Every comparison reads the tight nodes from a table; a plan with joins would run them each time."""
    same = [(k, [1] * 60) for k in range(setlinks.LEAF + 10)]
    items = spark.createDataFrame(same, "item long, sketch array<int>")
    _, tight = chosen_path.branch_out(items, 2, Scratch(spark, "test"))
    assert {r["item"] for r in tight.collect()} == {k for k, _ in same}
    assert "Join" not in tight._jdf.queryExecution().executedPlan().toString()
