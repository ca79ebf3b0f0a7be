import numpy as np
import pytest

from reelmill.llm import bpe, training_order as to
from reelmill.llm.queries import default_vocabulary


@pytest.mark.parametrize("count", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation_is_one_to_one(count):
    numbers = np.arange(count)
    slots = to.permuted(numbers, count, 7)
    assert sorted(slots) == list(range(count))
    assert (to.permuted(slots, count, 7, inverse=True) == numbers).all()
    if count > 60:
        assert (slots != to.permuted(numbers, count, 8)).any()
        assert abs(np.corrcoef(slots, numbers)[0, 1]) < 0.35


def test_shards_hold_every_token_once(spark):
    vocabulary = default_vocabulary()
    texts = ["short", None, "", "same text twice", "same text twice", "long words " * 3000, "é😀 " * 200]
    rows = [(k, text * 1 if text else text, "x") for k, text in enumerate(texts * 4)] + [(None, "no id", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string").repartition(3)
    placed, folder = to.materialise(df, vocabulary, key=5, length=64, shard_slots=50)
    listed = sorted(placed.collect(), key=lambda r: r["slot"])
    count = len(listed)
    assert [r["slot"] for r in listed] == list(range(count))
    assert all(r["shard"] == r["slot"] // 50 and r["byte_offset"] == r["slot"] % 50 * 128 for r in listed)
    read = list(to.read_slots(folder))
    assert len(read) == count
    assert all((a == b).all() for a, b in zip(read[33:], to.read_slots(folder, 33)))
    end = len(vocabulary.tokens)
    order = to.permuted(np.arange(count), count, 5)
    stream, ids = [], set()
    for number in range(count):
        row = listed[order[number]]
        stream += read[order[number]][: row["n_tokens"]].tolist()
        ids.update(row["doc_ids"])
    encoder = bpe.Encoder(vocabulary, bpe.serialised_model(vocabulary.tokens))
    expected = sorted(tuple(i) for i in encoder.encode([r[1] for r in rows if r[1]]))
    found, current = [], []
    for token in stream:
        if token == end:
            found.append(tuple(current))
            current = []
        else:
            current.append(token)
    assert sorted(found) == expected
    assert ids == {r[0] for r in rows if r[1] and r[0] is not None}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    placed, folder = to.materialise(df, default_vocabulary(), key=1)
    assert placed.count() == 0
    assert list(to.read_slots(folder)) == []


def test_tasks_of_a_worker_share_an_encoder():
    vocabulary = default_vocabulary()
    sent = {"vocabulary": (vocabulary.tokens, vocabulary.pattern), "model": bpe.serialised_model(vocabulary.tokens)}
    first = to.kept_encoder(sent)
    ids = [i.tolist() for i in first.encode(["once met, known"])]
    assert to.kept_encoder(sent) is first and " known" in first.known
    assert [i.tolist() for i in to.kept_encoder(sent).encode(["once met, known"])] == ids
