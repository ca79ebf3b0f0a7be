"""Secret scan in column expressions: fixed patterns and sliding-window entropy.

The base patterns find assignments to secret-like names, access keys and long hexadecimal
strings. The entropy method adds spans: in candidate strings (long runs of one character
class) a window of ``WINDOW`` characters slides along; the counts of its characters are
updated by the one that enters and the one that leaves, and with them the entropy. The
part of a candidate covered by windows at or above the class's threshold is a finding, unless an
allow-list pattern matches the candidate. Base findings are taken out of a candidate first and the
windows slide over each part that remains, so a secret joined to another one is found too.

Positions are code points, end exclusive. Everything is evaluated row by row on the JVM;
nothing is shuffled.

Defined results: NULL and empty texts have no findings (empty arrays); very long texts are
scanned whole; repeated rows are scanned each; an empty table gives an empty one; a column named
like a result is replaced.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from reelmill.llm.expressions import let, whole

# The base patterns, and the least length of what makes a finding.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"       # AKIA and the rest, 20 characters or more
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 20
# Character classes: pattern of a candidate, alphabet, least entropy of a window in bits.
CLASSES = {
    "entropy_hex": (r"(?<![0-9A-Za-z+/_=-])[0-9A-Fa-f]{20,}(?![0-9A-Za-z+/_=-])", "0123456789abcdef", 3.05),
    "entropy_base64": (
        r"[0-9A-Za-z+/_=-]{20,}",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        3.75,
    ),
}
# Candidates that are no secrets: words, numbers, identifiers of lower-case words, paths,
# rules made of one character, and published example keys.
ALLOWED = (
    r"^[A-Z]?[a-z]+$",
    r"^[A-Z]+$",
    r"^[0-9]+$",
    r"^[a-z]+([-_/=+][a-z]+)+$",
    r"^[A-Z]+([-_/=+][A-Z]+)+$",
    r"^(.)\1+$",
    r"(?i)example",
    r"^/?([A-Za-z_-]+/)+[A-Za-z_-]*$",
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)


def matches(text: Column, pattern: str) -> Column:
    """All matches as structs ``(start, end, hit)``, leftmost first, none overlapping.

    The text is split at the matches; the pieces between them give the positions.
    """
    kind = "array<struct<start:int,end:int,hit:string>>"

    def placed(pieces: Column) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

        def step(state: Column, pair: Column) -> Column:
            first = state["at"] + F.length(pair["piece"])
            end = first + F.length(pair["hit"])
            found = F.struct(first.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
            return F.struct(end.alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

        pairs = F.filter(
            F.arrays_zip(pieces.alias("piece"), hits.alias("hit")), lambda p: p["hit"].isNotNull()
        )
        return F.aggregate(pairs, start, step)["found"]

    nothing = F.array().cast(kind)
    return let(
        F.split(text, pattern, -1),
        lambda pieces: F.when(F.size(pieces) > 1, placed(pieces)).otherwise(nothing),
    )


def findings(found: Column, kind: str) -> Column:
    """Findings ``(start, rank, kind, end)`` of one kind; rank is the kind's place."""
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            m["end"].alias("end"),
        ),
    )


def base_findings(text: Column) -> Column:
    value = lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 2))
    assigns = F.filter(matches(text, ASSIGN), lambda m: value(m) >= ASSIGN_VALUE)
    return F.concat(
        findings(assigns, "assign"),
        findings(matches(text, ACCESS), "access"),
        findings(matches(text, HEX), "hex"),
    )


def telling_part(candidate: Column, alphabet: str, threshold: float, fold: bool) -> Column:
    """``(first, last)``: ends of the windows at or above the threshold, 0 if there is none.

    The window's character counts and the sum of ``c * log2(c)`` over them move along with
    it; its entropy is ``log2(WINDOW) - sum / WINDOW``.
    """
    logs = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    least = (log2(WINDOW) - threshold) * WINDOW
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("first"),
        F.lit(0).alias("last"),
    )

    def scan(letters: Column) -> Column:
        def code(at: Column) -> Column:
            return F.instr(F.lit(alphabet), F.substring(letters, at, F.lit(1))) - F.lit(1)

        def step(state: Column, at: Column) -> Column:
            def moved(pair: Column) -> Column:
                def counted(counts: Column) -> Column:
                    here = F.coalesce(F.get(state["counts"], pair["enters"]), F.lit(0))
                    gone = F.coalesce(F.get(state["counts"], pair["leaves"]), F.lit(0))
                    same = pair["enters"] == pair["leaves"]
                    total = state["sum"] + F.when(same, 0.0).otherwise(
                        F.get(logs, here + F.lit(1)) - F.get(logs, here)
                        + F.when(gone > 0, F.get(logs, gone - F.lit(1)) - F.get(logs, gone)).otherwise(0.0)
                    )

                    def judged(total: Column) -> Column:
                        hit = (at >= WINDOW) & (total <= least + 1e-9)
                        return F.struct(
                            counts.alias("counts"),
                            total.alias("sum"),
                            F.when(hit & (state["first"] == 0), at).otherwise(state["first"]).alias("first"),
                            F.when(hit, at).otherwise(state["last"]).alias("last"),
                        )

                    return let(total, judged)

                changed = F.transform(
                    state["counts"],
                    lambda c, k: c
                    + F.when(k == pair["enters"], 1).otherwise(0)
                    - F.when(k == pair["leaves"], 1).otherwise(0),
                )
                return let(changed, counted)

            leaves = F.when(at > WINDOW, code(at - F.lit(WINDOW))).otherwise(-1)
            return let(F.struct(code(at).alias("enters"), leaves.alias("leaves")), moved)

        return F.aggregate(F.sequence(F.lit(1), F.length(letters)), start, step)

    return let(F.lower(candidate) if fold else candidate, scan)


def suppressed(hit: Column) -> Column:
    return F.array_contains(F.array(*[F.rlike(hit, F.lit(p)) for p in ALLOWED]), True)


def overlapping(found: Column, span: Column) -> Column:
    return F.exists(found, lambda f: (f["start"] < span["end"]) & (span["start"] < f["end"]))


def uncovered(m: Column, base: Column) -> Column:
    """The parts of a candidate, a window or longer, that no base finding covers."""
    kind = "array<struct<start:int,end:int,hit:string>>"

    def part(start: Column, end: Column) -> Column:
        hit = F.substring(m["hit"], start - m["start"] + F.lit(1), end - start)
        one = F.array(F.struct(start.alias("start"), end.alias("end"), hit.alias("hit")))
        return F.when(end - start >= WINDOW, one).otherwise(F.array().cast(kind))

    def step(state: Column, f: Column) -> Column:
        return F.struct(
            F.greatest(state["at"], f["end"]).alias("at"),
            F.concat(state["parts"], part(state["at"], f["start"])).alias("parts"),
        )

    inside = F.filter(base, lambda f: (f["start"] < m["end"]) & (m["start"] < f["end"]))
    start = F.struct(m["start"].alias("at"), F.array().cast(kind).alias("parts"))
    cut = F.aggregate(
        inside, start, step, lambda state: F.concat(state["parts"], part(state["at"], m["end"]))
    )
    return F.when(overlapping(base, m), cut).otherwise(F.array(m))


def class_findings(text: Column, base: Column, kind: str) -> Column:
    """Findings among the candidates of one character class."""
    pattern, alphabet, threshold = CLASSES[kind]

    def part(m: Column) -> Column:
        return let(
            telling_part(m["hit"], alphabet, threshold, kind == "entropy_hex"),
            lambda w: F.struct(
                (m["start"] + w["first"] - F.lit(WINDOW)).alias("start"),
                (m["start"] + w["last"]).alias("end"),
                w["first"].alias("first"),
            ),
        )

    candidates = F.filter(matches(text, pattern), lambda m: ~suppressed(m["hit"]))
    parts = F.flatten(F.transform(candidates, lambda m: uncovered(m, base)))
    asked = F.filter(parts, lambda m: ~suppressed(m["hit"]))
    return findings(F.filter(F.transform(asked, part), lambda p: p["first"] > 0), kind)


def entropy_findings(text: Column, base: Column) -> Column:
    """Findings of all classes; the hexadecimal one goes first where two overlap."""

    def both(hexes: Column) -> Column:
        others = class_findings(text, base, "entropy_base64")
        return F.concat(hexes, F.filter(others, lambda o: ~overlapping(hexes, o)))

    return let(class_findings(text, base, "entropy_hex"), both)


def listed(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ","
    )


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``base`` and ``found``: base findings, and all of them, by position."""
    text_kept = df.drop(*[c for c in df.columns if c.lower() in ("base", "found") and c != text])
    with_base = text_kept.withColumn("base", F.sort_array(base_findings(whole(text))))
    more = entropy_findings(whole(text), F.col("base"))
    return with_base.withColumn("found", F.sort_array(F.concat("base", more)))


def redacted(text: str = "text", found: str = "found", mark: str = "[SECRET]") -> Column:
    """The text with every finding replaced by ``mark``; overlapping ones share one mark."""
    kind = "array<string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("parts"))

    def step(state: Column, f: Column) -> Column:
        before = F.substring(F.col(text), state["at"] + F.lit(1), f["start"] - state["at"])
        apart = F.concat(state["parts"], F.array(before, F.lit(mark)))
        return F.struct(
            F.greatest(state["at"], f["end"]).alias("at"),
            F.when(f["start"] >= state["at"], apart).otherwise(state["parts"]).alias("parts"),
        )

    def joined(state: Column) -> Column:
        rest = F.substring(F.col(text), state["at"] + F.lit(1), F.length(text))
        return F.concat(F.array_join(state["parts"], ""), rest)

    return F.when(F.size(found) > 0, let(F.aggregate(found, start, step), joined)).otherwise(F.col(text))
