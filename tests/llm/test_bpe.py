import random

import public_tokenizers
import pytest
import tiktoken

from reelmill.llm import bpe
from reelmill.llm.queries import default_vocabulary

ALPHABET = "ab  \n\t\r'sTHtion éüßñ日本語한국😀🏳️‍🌈\x00\x1c\x85​᠎0123४५<|endoftext|>!?.,…—’“"


@pytest.fixture(scope="module")
def vocabulary():
    return default_vocabulary()


@pytest.fixture(scope="module")
def reference(vocabulary):
    ranks = {token: rank for rank, token in enumerate(vocabulary.tokens)}
    return tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_encode_equals_reference_on_random_texts(vocabulary, reference):
    rng = random.Random(3)
    texts = [
        "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(80))) for _ in range(2000)
    ]
    encoder = bpe.Encoder(vocabulary, bpe.serialised_model(vocabulary.tokens))
    found = [ids.tolist() for ids in encoder.encode_all(texts)]
    assert found == [reference.encode_ordinary(t) for t in texts]


def test_round_trip_of_odd_rows(spark, vocabulary, reference):
    texts = [None, "", " ", "a", "a", "é" * 5000, "word " * 40000, "\x00\n\n  x", "😀'll"]
    rows = [(k, text, [9]) for k, text in enumerate(texts)] + [(None, "no id", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    out = bpe.decode(bpe.encode(df, vocabulary), vocabulary).collect()
    assert len(out) == len(rows)
    for row in out:
        assert row["decoded"].decode() == (row["text"] or "")
        assert row["ids"] == reference.encode_ordinary(row["text"] or "")


def test_empty_table(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = bpe.decode(bpe.encode(df, vocabulary), vocabulary)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    assert out.count() == 0


def test_ranks_with_gaps_are_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.read_vocabulary(str(path), "a")


def test_bytes_as_characters():
    table = {b: bpe.FIRST_CHARACTER + b for b in range(256)}
    tokens = [bytes(range(256)), b"", "h\u00e9 \U0001f600".encode(), b"x"]
    assert bpe.as_characters(tokens) == [t.decode("latin-1").translate(table) for t in tokens]
    assert bpe.as_characters([]) == []
