import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reelmill.llm import token_counts
from reelmill.llm.queries import default_merges, op13_token_counts

ALPHABET = "ab  \n\t\r'sTHtion éüßñ日本語한국😀🏳️‍🌈\x00\x1c\x85​᠎0123४५<|endoftext|>!?.,…—’“"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def merges():
    return default_merges()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_random_texts(merges, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(90))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", " <|endoftext|> x", "aaaaaaaaa", "=" * 77]
    assert list(token_counts.Counter(merges).count_all(texts)) == expected(library, texts)


def test_every_character(merges, library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = []
    for k in range(0, len(codes), 64):
        texts.append("".join(f"a{chr(c)}1 {chr(c)}{chr(c)}b  {chr(c)}." for c in codes[k : k + 64]))
    assert list(token_counts.Counter(merges).count_all(texts)) == expected(library, texts)


def test_long_runs_and_small_batches(merges, library, monkeypatch):
    rng = random.Random(7)
    long = "".join(rng.choice("etaoinshrdlu") for _ in range(30_000))
    texts = [long, "ab" * 9000, "a" * 10_001, "", "word " * 20_000, "日本語" * 3000]
    assert list(token_counts.Counter(merges).count_all(texts)) == expected(library, texts)
    monkeypatch.setattr(token_counts, "BATCH_SYMBOLS", 5)
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 100)
    monkeypatch.setattr(token_counts, "GROUP_CHARACTERS", 10)
    few = ["the cat sat", "on the mat", "the cat", "antidisestablishmentarianism"] * 3
    assert list(token_counts.Counter(merges).count_all(few)) == expected(library, few)


def test_odd_rows(spark, merges, library):
    texts = [None, "", " ", "a", "a", "x" * 100_000, "two\nlines"]
    rows = [(k, text, -1) for k, text in enumerate(texts)] + [(None, "no id", None), (0, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens int")
    out = token_counts.count_tokens(df, merges)
    assert out.columns == ["doc_id", "text", "n_tokens"]
    for row in out.collect():
        assert row["n_tokens"] == expected(library, [row["text"] or ""])[0]
    assert out.count() == len(rows)
    assert token_counts.count_tokens(df.where("false"), merges).count() == 0


def test_vocabularies_of_another_kind_are_refused(tmp_path):
    with pytest.raises((ValueError, KeyError)):
        token_counts.read_merges(public_tokenizers.path("word_bpe_49k.json"), "a")
    with open(PATH, encoding="utf-8") as lines:
        stored = json.load(lines)
    stored["model"]["merges"].reverse()
    path = tmp_path / "reversed.json"
    path.write_text(json.dumps(stored))
    with pytest.raises(ValueError, match="before it is made"):
        token_counts.read_merges(str(path), public_tokenizers.PATTERN)


def test_query_equals_library_on_documents(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op13_token_counts(spark, sf_dir).collect()
    assert {r["doc_id"] for r in found} == set(texts)
    wanted = dict(zip(texts, expected(library, list(texts.values()))))
    for row in found:
        assert row["n_tokens"] == wanted[row["doc_id"]]
        assert row["n_bytes"] == len(texts[row["doc_id"]].encode())
        assert row["over_limit"] == (row["n_tokens"] > 1024)
