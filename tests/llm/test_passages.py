"""Repeated passages against a comparison of every window of words."""

import random

from reelmill.llm import passages as ps

SIZE = 50


def covered(docs):
    """Words (document, number) in windows that repeat, and those in later copies."""
    first, here, later = {}, set(), set()
    places = []
    for key, text in sorted((d for d in docs if d[0] is not None and d[1]), key=lambda d: d[0]):
        words = text.lower().split()
        for k in range(len(words) - SIZE + 1):
            window = tuple(words[k : k + SIZE])
            places.append((key, k, window))
            first.setdefault(window, []).append((key, k))
    for key, k, window in places:
        all_ = first[window]
        if len(all_) > 1:
            near = all_[0][0] == key and k - all_[0][1] < SIZE
            (here if near else later).update((key, k + i) for i in range(SIZE))
    return here, later


def found(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    texts, out = dict(docs), {False: set(), True: set()}
    for r in ps.passages(df).collect():
        text = texts[r["doc_id"]]
        at = len(text[: r["start"]].split())
        assert len(text[r["start"] : r["end"]].split()) == r["n_words"]
        out[r["removed"]].update((r["doc_id"], at + i) for i in range(r["n_words"]))
    return out[False], out[True]


def laid_out(rng, words, per_line):
    return "\n".join(" ".join(words[k : k + per_line]) for k in range(0, len(words), per_line))


def test_passages_over_short_lines_and_inside_longer_lines(spark):
    rng = random.Random(10)
    word = lambda: rng.choice(["w", "é", "W"]) + str(rng.randrange(3000))
    shared = [[word() for _ in range(n)] for n in (50, 51, 64, 90, 200)]
    docs = []
    for k in range(60):
        words = [word() for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            words += rng.choice(shared) + [word() for _ in range(rng.randrange(0, 60))]
        docs.append((k, laid_out(rng, words, rng.choice([3, 25, 40, 1000]))))
    docs += [(90, None), (91, ""), (None, docs[0][1]), (92, docs[5][1]), (93, "a " * 130)]
    here, later = covered(docs)
    assert found(spark, docs) == (here, later)
    assert len(later) > 1000


def test_equal_rows_and_empty_table(spark):
    text = " ".join(f"v{k}" for k in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (2, "x " + text)], "doc_id long, text string")
    rows = [(r["doc_id"], r["n_words"], r["first_doc_id"], r["removed"]) for r in ps.passages(df).collect()]
    assert sorted(rows) == [(1, 60, 1, False), (2, 60, 1, True)]
    assert ps.passages(df.where("false")).count() == 0
