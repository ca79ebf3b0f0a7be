"""Line-first quality rules in column expressions.

Each line is judged by rules on punctuation, navigation and boilerplate; failing lines are
removed, and a document that loses more than ``LOSS`` of its word characters is rejected.
Documents of fewer than ``LEAST_WORDS`` words, or with more than 30 % of their words in
repeated windows of eight, fail before that. All of it is evaluated row by row on the JVM
without a shuffle; the time grows with ``n log n`` of a text's words.

Defined results: NULL and empty texts have no words and fail; repeated rows are judged
each; very long texts are judged whole; an empty table gives an empty one; columns named like a
result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelmill.llm.expressions import let, whole

SPACES = r"[\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEATED = 30               # percent of words in repeated windows
LOSS = 0.4                  # share of word characters that removed lines may take

SYMBOL_SHARE = 0.05         # of a line's word characters
SHOUTED = 0.3               # doubled exclamation or question marks for each word
VARIETY = 0.35              # distinct words of a longer line, at least
LONG_LINE = 10
MENU_WORDS = 8              # words of a navigation line, at most

# Openings of navigation lines and phrases of boilerplate.
NAVIGATION = (
    r"(?i)^\W*(home|menu|log ?in|log ?out|sign (in|up|out)|register|search|next|previous|back( to top)?|"
    r"skip to (main )?content|read more|more|share( this)?|tweet|follow us|contact( us)?|about( us)?|"
    r"sitemap|subscribe|click here|print|comments?)\b"
)
BOILERPLATE = (
    r"(?i)(all rights reserved|terms (of|and) (use|service|conditions)|privacy policy|cookie(s| policy)|"
    r"enable javascript|lorem ipsum|powered by|copyright \(c\)|©)"
)

RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "lost_chars", "cleaned", "kept",
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def word_characters(text: Column) -> Column:
    return F.length(F.translate(text, WHITE, ""))


def symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more in the text."""
    one = F.lit(1)

    def windows(hashes: Column) -> Column:
        starts = F.slice(hashes, one, F.size(hashes) - F.lit(WINDOW - 1))
        return F.transform(
            starts, lambda h, k: F.xxhash64(h, *[F.get(hashes, k + F.lit(j)) for j in range(1, WINDOW)])
        )

    def covered(ordered: Column) -> Column:
        def twice(s: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - one)["h"], F.get(ordered, k + one)["h"]
            return s["h"].eqNullSafe(before) | s["h"].eqNullSafe(after)

        places = F.sort_array(F.transform(F.filter(ordered, twice), lambda s: s["k"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

        def step(state: Column, k: Column) -> Column:
            end = k + F.lit(WINDOW)
            return F.struct(end.alias("end"), (state["n"] + end - F.greatest(state["end"], k)).alias("n"))

        return F.aggregate(places, start, step)["n"]

    def counted(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
        some = F.size(F.array_distinct(found)) < F.size(found)
        return F.when(some, let(ordered, covered)).otherwise(0)

    def of_hashes(hashes: Column) -> Column:
        return F.when(F.size(hashes) > WINDOW, let(windows(hashes), counted)).otherwise(0)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def failing(line: Column) -> Column:
    """Whether a line fails the rules; lines without words pass."""

    def judged(words: Column) -> Column:
        count = F.size(words)
        noisy = symbols(line) > SYMBOL_SHARE * word_characters(line)
        shouted = F.size(F.split(line, "[!?]{2,}", -1)) - 1 > SHOUTED * count
        same = (count >= LONG_LINE) & (F.size(F.array_distinct(words)) < VARIETY * count)
        menu = (count <= MENU_WORDS) & F.rlike(line, F.lit(NAVIGATION))
        return (count > 0) & (noisy | shouted | same | menu | F.rlike(line, F.lit(BOILERPLATE)))

    return let(words_of(line), judged)


def judge(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measures, the cleaned text and the verdict.

    The first of equal lines stays; later ones are removed as repeats, but do not count as
    a loss of their own beyond the measure ``n_dup_lines``.
    """
    given = df.drop(*[c for c in df.columns if c.lower() in RESULTS and c != text])
    value = whole(text)
    spoken = F.filter(F.split(value, "\n", -1), lambda line: word_characters(line) > 0)

    measures = let(
        words_of(value),
        lambda w: F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words")),
    )
    lines = let(
        spoken,
        lambda all_lines: let(
            F.array_distinct(all_lines),
            lambda once: F.struct(
                (F.size(all_lines) - F.size(once)).alias("n_dup_lines"),
                F.filter(once, lambda line: ~failing(line)).alias("good"),
                F.aggregate(once, F.lit(0), lambda n, line: n + word_characters(line)).alias("once_chars"),
            ),
        ),
    )
    out = given.withColumns({"_m": measures, "_l": lines})
    cleaned = F.array_join("_l.good", "\n")
    n_words, n_repeat = F.col("_m.n_words").cast("long"), F.col("_m.n_repeat_words").cast("long")
    base_failed = (n_words < LEAST_WORDS) | (100 * n_repeat > REPEATED * n_words)
    out = out.withColumns(
        {
            "n_words": n_words,
            "word_chars": word_characters(value).cast("long"),
            "n_symbols": symbols(value).cast("long"),
            "n_dup_lines": F.col("_l.n_dup_lines").cast("long"),
            "n_repeat_words": n_repeat,
            "base_failed": base_failed,
            "lost_chars": (F.col("_l.once_chars") - word_characters(cleaned)).cast("long"),
            "cleaned": cleaned,
            "kept": ~base_failed
            & (F.col("_l.once_chars") - word_characters(cleaned) <= LOSS * F.col("_l.once_chars")),
        }
    )
    return out.drop("_m", "_l")
