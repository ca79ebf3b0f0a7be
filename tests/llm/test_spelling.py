import random
import re
from collections import Counter
from zlib import crc32

import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st

from reelmill.llm import spelling
from reelmill.llm.queries import op11_spelling_variants
from reelmill.llm.scratch import Scratch

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counted(docs):
    uses = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            uses[run] += 1
    return {word: n for word, n in uses.items() if len(word) >= 5 and n >= 3}


def one_edit(a, b):
    """Whether the words differ by exactly one edit, by trying all of them."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def close(words):
    """Near words of each word, found by equal words under all single deletions."""
    by_rest = {}
    for word in words:
        for rest in {word, *(word[:k] + word[k + 1 :] for k in range(len(word)))}:
            by_rest.setdefault(rest, set()).add(word)
    near = {word: set() for word in words}
    for group in by_rest.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def brute_force(docs):
    words = counted(docs)
    near, forms = close(words), {}
    for word, n in words.items():
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        forms[word] = best if best and words[best] >= 2 * n else None

    def root(word):
        return root(forms[word]) if forms[word] else word

    return {
        (word, forms[word], root(word), n, len(near[word]), words[forms[word]] if forms[word] else None)
        for word, n in words.items()
    }


def documents(seed, count):
    """Texts of few letters, so that very many words are near."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abÉé") for _ in range(rng.randrange(4, 9))) for _ in range(300)]
    return [
        (k, " ".join(rng.choice(pool[: rng.randrange(1, 300)]) for _ in range(40)).title())
        for k in range(count)
    ]


@pytest.mark.parametrize("state_words", [1, 3, 40, 10_000])
def test_equals_definition_at_every_partition_size(spark, state_words):
    docs = documents(state_words, 150)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = spelling.variants(df, state_words=state_words).collect()
    assert len(found) == len({r["word"] for r in found})
    assert {tuple(r) for r in found} == brute_force(docs)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "Straße straße STRAßE ×÷×÷× ×÷×÷× ×÷×÷×"), (3, "x" * 50_000 + " ")]
    docs += [(4, "colour colours color colors colr "), (4, "colour colours color colors colr ")] * 30
    docs += [(5, "naïve naive naı̈ve " * 400), (6, "a b cd " + "longest " * 70_000), (None, None)]
    wide = spark.createDataFrame(
        [(*d, "s", 1, "f") for d in docs], "doc_id int, text string, state string, n int, form string"
    )
    assert {tuple(r) for r in spelling.variants(wide).collect()} == brute_force(docs)
    names = spark.createDataFrame([(str(k), t) for k, t in docs if k], "doc_id string, text string")
    assert {tuple(r) for r in spelling.variants(names).collect()} == brute_force([d for d in docs if d[0]])


def test_empty_table(spark):
    out = spelling.variants(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert out.count() == 0


def test_words_that_begin_alike_are_split(spark):
    words = [("same" * 3 + f"{k:012b}".replace("0", "o").replace("1", "i"), 5) for k in range(2048)]
    df = spark.createDataFrame(words, "word string, n long")
    near = spelling.near_pairs(df, Scratch(spark, "test"), 100)
    expected = close([w for w, _ in words])
    assert near.count() == sum(map(len, expected.values()))
    assert {(r["word"], r["near"]) for r in near.collect()} == {(a, b) for a in expected for b in expected[a]}


def test_long_ways_lead_to_the_last_form(spark):
    words = [("chain" + "a" * k, 3 * 2**k) for k in range(20)] + [("alone", 9)]
    df = spark.createDataFrame(words, "word string, n long")
    space = Scratch(spark, "test")
    found = spelling.group(df, spelling.near_pairs(df, space), space)
    assert {r["root"] for r in found.where("word <> 'alone'").collect()} == {"chain" + "a" * 19}
    assert rows(found.where("word = 'alone'")) == [("alone", None, "alone", 9, 0, None)]


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text(alphabet="abc", max_size=6), max_size=25))
def test_composition_accepts_each_pair_once(words):
    acceptor = spelling.Acceptor(sorted(words))
    pairs = [frozenset(p) for p in acceptor.composed()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in words for b in words if a != b and one_edit(a, b)}


def test_query_equals_definition(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert {tuple(r) for r in op11_spelling_variants(spark, sf_dir).collect()} == brute_force(docs)
