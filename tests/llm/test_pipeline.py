import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelmill.llm import decontaminate, secret_scan

from test_chosen_path import shingles

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, docs, SMALL).cache()
        out[name] = (docs, frame)
        docs = frame
    return out


def test_stages_keep_the_columns_of_documents(spark, steps):
    names = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    for name, (_, after) in list(steps.items())[:-1]:
        assert after.columns == names, name


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    before, after = steps["toxicity"]
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1}
    clean = {r["doc_id"] for r in labels if r["toxic"] == 0}
    assert len(clean & kept) >= 0.98 * len(clean)
    assert len(toxic & kept) <= 0.2 * len(toxic)
    assert after.subtract(before).count() == 0


def classes_by_brute_force(docs, percent):
    """Every pair of texts compared on full shingle sets; class of each id by the least one."""
    sets = {r["doc_id"]: frozenset(shingles(r["text"] or "")) for r in docs}
    first = {}
    for key in sorted(sets):
        first.setdefault(sets[key] or key, key)
    by_size = sorted((len(s), key, s) for s, key in first.items() if isinstance(s, frozenset))
    root = {key: key for key in sets}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for k, (size, a, x) in enumerate(by_size):
        for larger, b, y in by_size[k + 1 :]:
            if 100 * size < percent * larger:
                break
            shared = len(x & y)
            if 100 * shared >= percent * (size + larger - shared):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {key: find(first[s] if s else key) for key, s in sets.items()}


def test_one_document_of_each_class_stays(steps):
    before, after = steps["near_dedup"]
    classes = classes_by_brute_force(before.collect(), corpus_pipeline.NEAR_PERCENT)
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == set(classes.values())
    assert len(set(classes.values())) < len(classes)


def test_benchmark_passages_are_cut(spark, steps):
    before, after = steps["decontaminate"]
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert decontaminate.mark(before, bench).where("n_hit > 0").count() > 0
    assert decontaminate.mark(after, bench).where("n_hit > 0").count() == 0
    clean = decontaminate.mark(before, bench).where("n_hit = 0").select(*before.columns)
    assert clean.subtract(after).count() == 0
    assert after.where(F.length("text") != F.col("n_chars")).count() == before.where(
        F.length("text") != F.col("n_chars")
    ).join(after, "doc_id", "left_semi").count()


def test_secrets_are_masked(steps):
    before, after = steps["secrets"]
    assert secret_scan.scan(before).where(F.size("found") > 0).count() > 0
    assert secret_scan.scan(after).where(F.size("found") > 0).count() == 0
    assert before.count() == after.count()


def test_tokens_give_the_texts_back(steps):
    before, after = steps["byte_bpe"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    rows = after.collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_odd_rows_pass_every_stage(spark):
    docs = spark.createDataFrame(
        [(None, None, "en", None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b", None, "s", 3)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for given in (docs, docs.where("false")):
        frame = given
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SMALL)
        assert frame.count() == given.count()


def test_run_is_registered_whole(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
