import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmill.llm import quality, toxicity
from reelmill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def texts_of(rng, size):
    """Plain texts; toxic ones hold a bad word or a bad stem, junk ones have symbols."""
    out = []
    for k in range(size):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(5, 120))]
        toxic, junk = rng.random() < 0.2, rng.random() < 0.2
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["scum", "Idiot.", f"badstem{rng.randrange(99)}"])
        if junk:
            words = [w + "###" for w in words]
        out.append((k, " ".join(words), int(not junk), int(toxic)))
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = texts_of(random.Random(4), 900)
    docs = spark.createDataFrame([(k, t, "x") for k, t, _, _ in rows], "doc_id long, text string, p_toxic string")
    labels = spark.createDataFrame([(k, q, t) for k, _, q, t in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {k: (q, t) for k, _, q, t in rows}


def test_chain_learns_and_is_repeatable(data):
    docs, labels, truth = data
    chain = ("junk", "toxic")
    train = toxicity.chain_labels(labels.where("doc_id % 3 <> 0"))
    model = toxicity.train(docs, train, chain)
    assert model == toxicity.train(docs.repartition(7), train.repartition(3), chain)
    rows = toxicity.score(docs, model, chain).where("doc_id % 3 = 0").collect()
    wrong = sum((r["p_toxic"] >= toxicity.REJECT) != bool(truth[r["doc_id"]][1]) for r in rows)
    assert wrong <= 0.05 * len(rows)
    wrong = sum((r["p_junk"] >= 0.5) != (truth[r["doc_id"]][0] == 0) for r in rows)
    assert wrong < 0.25 * len(rows)


def test_later_links_use_out_of_fold_probabilities():
    """A second category that only repeats a noisy first one must not trust it blindly."""
    rng = np.random.default_rng(1)
    label = rng.integers(0, 2, 300)
    rows = [np.unique(rng.integers(0, 1 << 20, 40)).astype(np.int32) for _ in range(300)]
    import pickle

    links = pickle.loads(toxicity.fit_chain(np.stack([label, label], axis=1), rows))
    assert abs(links[1]["chain"][0]) < 1.0


def test_odd_rows_of_both_classifiers(spark, data):
    docs, labels, _ = data
    odd = spark.createDataFrame(
        [(None, "scum scum"), (5, None), (6, ""), (6, ""), (7, "scum idiot " * 30000)],
        "doc_id long, text string",
    )
    chain = ("junk", "toxic")
    scored = toxicity.score(odd, toxicity.train(docs, toxicity.chain_labels(labels), chain), chain)
    rows = scored.collect()
    assert len(rows) == 5 and all(0 <= r["p_toxic"] <= 1 for r in rows)
    assert {r["p_toxic"] >= toxicity.REJECT for r in rows if r["text"]} == {True}
    model = quality.train(docs, labels)
    rows = quality.score(odd.withColumn("score", F.lit("old")), model).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    none = labels.where("false")
    assert {r["score"] for r in quality.score(odd, quality.train(docs, none)).collect()} == {0.5}
    empty = toxicity.train(docs, toxicity.chain_labels(none), chain)
    assert all(r["p_toxic"] < 0.01 for r in toxicity.score(odd, empty, chain).collect())
    assert quality.score(odd.where("false"), model).count() == 0


def test_quality_is_held_out_and_repeatable(spark, data):
    docs, labels, truth = data
    train = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = quality.train(docs, train)
    assert model == quality.train(docs.repartition(5), train.repartition(4))
    held = [r for r in quality.score(docs, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    wrong = sum((r["score"] >= 0.3) != bool(truth[r["doc_id"]][0]) for r in held)
    assert wrong <= 0.03 * len(held)


def test_registered_queries_on_held_out_labels(spark):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = QUERIES["op5_nbsvm_quality"](spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    right = sum(r["predicted"] == labels[r["doc_id"]]["quality"] for r in held)
    assert right >= 0.95 * len(held)
    rows = QUERIES["op1_toxicity_chain"](spark, SMALL).collect()
    known = [r for r in rows if r["doc_id"] in labels]
    right = sum(r["toxic"] == bool(labels[r["doc_id"]]["toxic"]) for r in known)
    assert right >= 0.95 * len(known)
