import re
from collections import Counter, defaultdict

import compare
import pytest
from hypothesis import given, settings, strategies as st

from reelmill.llm import count_cells, oracles
from reelmill.llm.queries import op12_source_divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(docs, least, top):
    """Rows of both reports with Python's integers, straight from the definition."""
    uses, lang_docs, lang_uses = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in docs):
        words = TERM.findall(text.translate(LOWER))
        uses[lang, source].update(words)
        lang_uses[lang].update(words)
        lang_docs[lang].update(set(words))
    kept = {lang: [t for t in lang_uses[lang] if lang_docs[lang][t] >= least] for lang, _ in uses}

    def share(counts, lang, term):
        total = sum(counts[t] for t in kept[lang])
        return 1 + 1_000_000_000 * (counts[term] + 2) // (total + 2 * len(kept[lang]))

    def apart(p, q):
        return (p - q) ** 2 // (p + q)

    rows = set()
    for (lang, source), counts in uses.items():
        pairs, terms = [], []
        for other_lang, other in uses:
            if other_lang == lang and other != source:
                of = uses[lang, other]
                value = sum(apart(share(counts, lang, t), share(of, lang, t)) for t in kept[lang])
                pairs.append((-value, other.encode(), other))
        for t in kept[lang]:
            p, q = share(counts, lang, t), share(lang_uses[lang], lang, t)
            if counts[t] and p > q:
                terms.append((-apart(p, q), t.encode(), t))
        for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
            for rank, (value, _, item) in enumerate(sorted(found)[:limit], 1):
                rows.add((lang, source, part, item, -value, rank))
    return rows


def found(spark, docs, least, top=10, columns="lang string, source string, text string"):
    audit = count_cells.Audit(spark.createDataFrame(docs, columns), least)
    return {
        (r["lang"], r["source"], part, r["item"], r["value"], r["rank"])
        for part, df in (("pair", audit.pairs()), ("term", audit.top_terms(top)))
        for r in df.collect()
    }


DOCS = [
    ("en", "a", "The cat, the dog; THE end"),
    ("en", "a", "cat cat cat é日本"),
    ("en", "b", "a dog and a dog and É日本"),
    ("en", "b", None),
    ("en", None, "the the the the"),
    ("en", "empty", "12 34 !"),
    (None, "a", "only here"),
    (None, None, ""),
    ("de", "a", "x y z x y z"),
    ("de", "a", "x y z x y z"),
    ("de", "a\x00b", "x y ß"),
    ("de", "zz", "zz " * 3000),
]


@pytest.mark.parametrize("least, top", [(1, 10), (2, 2), (3, 1), (99, 10)])
def test_equals_definition(spark, least, top):
    docs = DOCS + DOCS[:3]
    assert found(spark, docs, least, top) == brute_force(docs, least, top)


def test_ties_are_cut_in_utf8_order(spark):
    docs = [("en", "a", "z é a ｚ 日 😀 b c"), ("en", "b", "q"), ("en", "c", "q q")]
    assert found(spark, docs, 1, 3) == brute_force(docs, 1, 3)


def test_small_holds_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(count_cells, "HELD_ENTRIES", 2)
    monkeypatch.setattr(count_cells, "PIECE_BYTES", 3)
    assert found(spark, DOCS, 1) == brute_force(DOCS, 1, 10)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, [], 1) == set()
    wide = "lang string, source string, text string, term string, n int, v int, value int, rank int, m int"
    docs = [(*row, "t", 1, 2, 3, 4, 5) for row in DOCS]
    assert found(spark, docs, 1, columns=wide) == brute_force(DOCS, 1, 10)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZé 1\n日", max_size=40), st.integers(1, 9))
def test_pieces_hold_all_terms(text, size):
    before, count_cells.PIECE_BYTES = count_cells.PIECE_BYTES, size
    try:
        words = [w.decode() for piece in count_cells.pieces(text.encode()) for w in piece]
    finally:
        count_cells.PIECE_BYTES = before
    assert words == TERM.findall(text.translate(LOWER))


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    sql = oracles.CHECKS["op12_source_divergence"]
    assert compare.differences(op12_source_divergence(spark, sf_dir), compare.connect(sf_dir), sql) is None
