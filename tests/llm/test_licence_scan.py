import re

import pytest

from reelmill.llm import licence_scan as ls

MIT = (
    "Copyright (c) 2020 A. Person\n"
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\n"
    "The above copyright notice and this permission notice shall be included in all copies. "
    "The software is provided \"as is\", without warranty of any kind."
)
CASES = [
    ("Released under the MIT License.", ["MIT_NAMED"], ["MIT"]),
    ("x y. Licensed under the Apache License, Version 2.0.\nmore", ["APACHE2_NAMED"], ["Apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL3_NAMED"], ["GPL-3.0"]),
    ("Licensed under CC BY-NC 4.0.", ["CC_BY_NC"], ["CC-BY-NC"]),
    ("All rights reserved.", ["RESERVED"], ["Proprietary"]),
    ("# SPDX-License-Identifier: MIT", ["SPDX"], ["SPDX"]),
    ("Our own licence applies here.", ["UNKNOWN"], ["Unclassified"]),
    (MIT, ["COPYRIGHT", "MIT_GRANT", "MIT_NOTICE", "AS_IS"], ["MIT"]),
    ("Released under the MIT License. Released under the MIT license.", ["MIT_NAMED"] * 2, ["MIT"]),
    ("nothing of the kind", [], []),
    ("", [], []),
    (None, [], []),
]


def by_hand(text):
    """Sentences, identifiers and rules in plain loops."""
    lines = re.sub(r"([.!?])[ \t]+", "\\1\n", (text or "").lower()).split("\n")
    about = [x for x in lines if re.search(ls.ABOUT, x) or "spdx-" in x]
    ids = []
    for line in about:
        plain = re.sub(r"[^a-z0-9.+-]+", " ", line).strip(" ")
        plain = re.sub(r"[ .]+$", "", plain).strip(" ")
        ids.append(next((n for n, p in ls.SENTENCES if re.fullmatch(p, plain)), ls.UNKNOWN))
    rest, found = list(ids), []
    for licence, run in ls.RULES:
        k = 0
        while k + len(run) <= len(rest):
            if tuple(rest[k : k + len(run)]) == run:
                rest[k : k + len(run)] = [None]
                found.append(licence)
            k += 1
    return ids, list(dict.fromkeys(found))


@pytest.fixture(scope="module")
def scanned(spark):
    rows = [(k, text, "old") for k, (text, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "doc_id long, text string, licences string")
    return {r["doc_id"]: r for r in ls.scan(df).collect()}


def test_known_cases(scanned):
    for k, (_, ids, licences) in enumerate(CASES):
        assert (scanned[k]["sentence_ids"], scanned[k]["licences"]) == (ids, licences)


def test_equals_plain_loops(spark):
    parts = [c[0] for c in CASES if c[0]]
    texts = [" ".join(parts[i:] + parts[:i]) for i in range(len(parts))] + ["\n".join(parts * 3)] + parts
    texts += ["word " * 30000 + "license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in ls.scan(df).collect():
        assert (row["sentence_ids"], row["licences"]) == by_hand(row["text"])


def test_empty_table_and_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = ls.scan(df)
    assert out.count() == 0
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
