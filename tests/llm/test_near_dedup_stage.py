"""The near_dedup stage against a comparison of every pair."""

import random

import pytest

import corpus_pipeline
from reelmill.llm import chosen_path

from test_chosen_path import brute_force, family, shingles

AT = 80


def similarity(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def stage(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = dict(corpus_pipeline.STAGES)["near_dedup"](spark, df, "unused")
    return sorted(r["doc_id"] for r in found.collect())


def test_equals_brute_force_at_the_threshold(spark):
    rng = random.Random(80)
    texts = [t for _ in range(30) for t in family(rng, 6, rng.choice([60, 120, 240]), 6)]
    # From 0.8 to below 0.85: one of 60 words replaced, 51 shingles of 61 shared.
    words = [f"v{k}" for k in range(60)]
    texts += [" ".join(words), " ".join(words[:20] + ["new"] + words[21:])]
    assert 0.8 <= similarity(*texts[-2:]) < 0.85
    docs = list(enumerate(texts))
    truth = brute_force(docs, AT)
    assert len(set(truth.values())) < len(set(brute_force(docs, 85).values()))
    assert stage(spark, docs) == sorted(set(truth.values()))


@pytest.mark.parametrize("percent, trees, agreement", [(85, 10, 13), (80, 12, 11)])
def test_trees_follow_the_threshold(percent, trees, agreement):
    assert chosen_path.tuned(percent) == (trees, agreement)
    assert all(chosen_path.tuned(p)[0] >= chosen_path.tuned(p + 1)[0] for p in range(50, 100))
