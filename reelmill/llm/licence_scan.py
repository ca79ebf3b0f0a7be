"""Licence scan by sentence rules, in column expressions.

A text is cut into sentences; each is normalised and mapped to the identifier of a known
licence sentence. The sequence of identifiers is then matched against ordered rules: a
rule that finds its identifiers next to each other takes them, so that later, weaker
rules do not use them again. Sentences that speak of licences but are not known get the
identifier ``UNKNOWN``.

A sentence ends at sentence punctuation, a blank line or a list mark. Lines within it are
joined, comment marks aside, where that gives a known sentence: wherever it starts and over
however many lines. A line that is known by itself is a sentence of its own, so notices
without punctuation are told apart from the lines around them. Lines that follow a known
sentence with an open end belong to it; unknown lines next to each other are one sentence.

Row by row, without a shuffle; only texts with a word of licences leave the JVM.

Defined results: NULL and empty texts have no sentences (empty arrays); repeated rows are
scanned each; very long texts are scanned whole; an empty table gives an empty one; columns named
like a result are replaced.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelmill.llm.expressions import let, whole

UNKNOWN = "UNKNOWN"
# Words without which no sentence is looked at.
ABOUT = r"licen[cs]|copyright|permission|redistribut|warrant|rights reserved|public domain"

# Known sentences, normalised (lower case, single blanks, [a-z0-9.+-] only).
SENTENCES = (
    ("SPDX", r".*spdx-license-identifier [a-z0-9.+-]+"),
    ("MIT_NAMED", r"(this (work|software|project|file|program) is )?(released|licensed|distributed|available) under the (terms of the )?(mit|expat) licen[cs]e"),
    ("MIT_GRANT", r"permission is hereby granted free of charge to any person obtaining a copy.*"),
    ("MIT_NOTICE", r"the above copyright notice and this permission notice shall be included.*"),
    ("APACHE2_NAMED", r"(this (work|software|project|file|program) is )?(released|licensed|distributed) under the apache licen[cs]e( version 2(\.0)?| 2(\.0)?)( the license )?.*"),
    ("APACHE2_COMPLIANCE", r"you may not use this file except in compliance with the license"),
    ("AS_IS", r"(the software is provided|unless required by applicable law).*"),
    ("GPL3_NAMED", r"(this (work|software|project|file|program) is )?(released|licensed|distributed) under the (terms of the )?gnu general public licen[cs]e( as published by the free software foundation)? (either )?version 3( or later)?.*"),
    ("GPL2_NAMED", r"(this (work|software|project|file|program) is )?(released|licensed|distributed) under the (terms of the )?gnu general public licen[cs]e( as published by the free software foundation)? (either )?version 2( or later)?.*"),
    ("GPL_REDISTRIBUTE", r"this program is free software you can redistribute it and.or modify it under the terms of the gnu general public license.*"),
    ("LGPL_NAMED", r".*under the (terms of the )?gnu lesser general public licen[cs]e.*"),
    ("BSD_GRANT", r"redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("BSD_SOURCE", r"redistributions of source code must retain the above copyright notice.*"),
    ("BSD_BINARY", r"redistributions in binary form must reproduce the above copyright notice.*"),
    ("BSD_ENDORSE", r"neither the name of .* may be used to endorse or promote products.*"),
    ("CC_BY_NC", r"(this (work|text|file) is )?licensed under (a )?(cc|creative commons) (by-nc|attribution-noncommercial) ?[0-9.]*( international)?( license)?"),
    ("CC_BY_SA", r"(this (work|text|file) is )?licensed under (a )?(cc|creative commons) (by-sa|attribution-sharealike) ?[0-9.]*( international)?( license)?"),
    ("CC_BY", r"(this (work|text|file) is )?licensed under (a )?(cc|creative commons) (by|attribution) ?[0-9.]*( international)?( license)?"),
    ("CC0", r".*(cc0|dedicated to the public domain).*"),
    ("RESERVED", r"(copyright .*)?all rights reserved"),
    ("COPYRIGHT", r"copyright .*"),
)
# Rules in order, each a run of identifiers; longer and stronger ones first.
RULES = (
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ENDORSE")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY")),
    ("MIT", ("MIT_NAMED", "MIT_GRANT", "MIT_NOTICE", "AS_IS")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE", "AS_IS")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE")),
    ("Apache-2.0", ("APACHE2_NAMED", "APACHE2_COMPLIANCE")),
    ("MIT", ("MIT_NAMED",)),
    ("MIT", ("MIT_GRANT",)),
    ("Apache-2.0", ("APACHE2_NAMED",)),
    ("LGPL", ("LGPL_NAMED",)),
    ("GPL-3.0", ("GPL3_NAMED",)),
    ("GPL-2.0", ("GPL2_NAMED",)),
    ("GPL", ("GPL_REDISTRIBUTE",)),
    ("CC-BY-NC", ("CC_BY_NC",)),
    ("CC-BY-SA", ("CC_BY_SA",)),
    ("CC-BY", ("CC_BY",)),
    ("CC0", ("CC0",)),
    ("SPDX", ("SPDX",)),
    ("Proprietary", ("RESERVED",)),
    ("Unclassified", (UNKNOWN,)),
)


# Parts of the words of ABOUT that no line end can cut.
GATE = r"licen[cs]|copyright|permission|redistribut|warrant|reserved|domain|spdx-"

_ABOUT = re.compile(ABOUT + "|spdx-")
_KNOWN = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
_END = re.compile(r"""[.!?]["')\]*/\s]*$""")
_LISTED = re.compile(r"[^\w(]*(?!\(c\))(?:\(?[0-9a-z]{1,3}\)|[0-9]{1,3}\.|[a-z]\.)\s")
_MARK = re.compile(r"\s*([^\w\s(\"']*)")
_NOTICE = re.compile(r"copyright (c |[0-9])")
# Sentences that go on to their end; a line of copyright ends with the line.
_OPEN = {name for name, pattern in SENTENCES if pattern.endswith(".*")} - {"COPYRIGHT"}
# Sentences that may begin on an earlier line than the words that tell them.
_LED = {name for name, pattern in SENTENCES if pattern.startswith(".*")} - {"SPDX"}


def _over_lines(pattern: str) -> re.Pattern:
    """A known sentence as a run of whole lines: any blank may be a line end."""
    outer = re.match(r"(\.\*)?(.*?)(\.\*)?$", pattern)

    def wider(part: re.Match) -> str:
        return {" ": r"[ \n]", ".": r"[\s\S]", ".*": r"[\s\S]*?"}.get(part[0], part[0])

    inner = re.sub(r"\\.|\[[^]]*\]|\.\*|[. ]", wider, outer[2])
    return re.compile(f"(?m)^{outer[1] or ''}(?:{inner}){outer[3] or ''}$")


_WRAPPED = [(name, _over_lines(pattern)) for name, pattern in SENTENCES if name != "COPYRIGHT"]


def _plain(line: str) -> str:
    plain = re.sub(r"[^a-z0-9.+-]+", " ", line).strip(" ")
    return re.sub(r"[ .]+$", "", plain).strip(" ")


def _known(sentence: str) -> str | None:
    return next((name for name, pattern in _KNOWN if pattern.fullmatch(sentence)), None)


def blocks(text: str) -> list[list[str]]:
    """Lines of a lower-case text up to sentence punctuation, blank lines and list marks."""
    out: list[list[str]] = [[]]
    last = ""
    for line in text.split("\n"):
        mark = _MARK.match(line)[1]
        bullet = mark in ("-", "+", "*", "\u2022") and mark != last
        if out[-1] and (bullet or not re.search(r"[^\W_]", line) or _LISTED.match(line)):
            out.append([])
        last = mark
        pieces = re.split(r"(?<=[.!?])[ \t]+", line)
        for k, piece in enumerate(pieces):
            if re.search(r"[^\W_]", piece):
                out[-1].append(piece)
            if out[-1] and (k + 1 < len(pieces) or _END.search(piece)):
                out.append([])
    return out


def block_identifiers(lines: list[str]) -> list[str]:
    """Identifiers of the sentences in lines that no sentence end parts."""
    if not re.search(GATE, "\n".join(lines)):
        return []
    plain = [_plain(line) for line in lines]
    bare = [line.lstrip(" .+-") for line in plain]
    alone = [_known(p) or _known(b) for p, b in zip(plain, bare)]
    starts = {
        k: (k + 1, name)
        for k, name in enumerate(alone)
        if name and (name != "COPYRIGHT" or _NOTICE.match(bare[k]))
    }
    edges = [-1, *starts, len(lines)]
    for low, high in zip(edges[:-1], edges[1:]):
        if high - low <= 2:
            continue
        joined, taken = "\n".join(bare[low + 1 : high]), set()
        for name, pattern in _WRAPPED:
            for match in pattern.finditer(joined):
                first = low + 1 + joined.count("\n", 0, match.start())
                run = range(first, first + match[0].count("\n") + 1)
                if taken.isdisjoint(run):
                    taken.update(run)
                    starts[first] = (run.stop, name)
    ids, k = [], 0
    while k < len(lines):
        stop, name = starts.get(k, (k + 1, alone[k]))
        if name is None or name in _OPEN:
            while stop < len(lines) and stop not in starts and (name or not alone[stop]):
                stop += 1
        led = name is None and starts.get(stop, (0, ""))[1] in _LED
        said = " ".join(lines[k:stop]) + "\n" + " ".join(bare[k:stop])
        if not led and _ABOUT.search(said):
            ids.append(name or UNKNOWN)
        k = stop
    return ids


def identifiers(text: Column) -> Column:
    """Identifiers of the sentences that speak of licences, in the text's order."""

    def named(texts: pa.Array) -> pa.Array:
        found = [
            [name for block in blocks(t.as_py().lower()) for name in block_identifiers(block)]
            if t.is_valid else []
            for t in texts
        ]
        return pa.array(found, pa.list_(pa.string()))

    asked = F.when(F.rlike(F.lower(text), F.lit(GATE)), text)
    return F.arrow_udf(named, "array<string>")(asked)


def matched(identifiers: Column) -> Column:
    """Licences whose rules match, in the rules' order, each once."""
    start = F.struct(
        F.concat(F.lit(","), F.array_join(identifiers, ",,"), F.lit(",")).alias("rest"),
        F.array().cast("array<string>").alias("found"),
    )

    def apply(state: Column, rule: tuple[str, tuple[str, ...]]) -> Column:
        licence, run = rule
        mark = "," + ",,".join(run) + ","
        hit = lambda s: F.contains(s["rest"], F.lit(mark))
        return let(
            state,
            lambda s: F.struct(
                F.replace(s["rest"], F.lit(mark), F.lit("#")).alias("rest"),
                F.when(hit(s), F.concat(s["found"], F.array(F.lit(licence)))).otherwise(s["found"]).alias("found"),
            ),
        )

    return F.array_distinct(reduce(apply, RULES, start)["found"])


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``sentence_ids`` and ``licences``, both arrays of strings."""
    given = df.drop(*[c for c in df.columns if c.lower() in ("sentence_ids", "licences") and c != text])
    named = given.withColumn("sentence_ids", identifiers(whole(text)))
    none = F.array().cast("array<string>")
    return named.withColumn(
        "licences", F.when(F.size("sentence_ids") > 0, matched(F.col("sentence_ids"))).otherwise(none)
    )
