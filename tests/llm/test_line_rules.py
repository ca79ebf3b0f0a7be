import random
import re

from pyspark.sql import functions as F

from reelmill.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = WORD.findall(text)
    places, covered = {}, set()
    for k in range(len(words) - 7):
        places.setdefault(tuple(words[k : k + 8]), []).append(k)
    for starts in places.values():
        if len(starts) > 1:
            covered.update(p for k in starts for p in range(k, k + 8))
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": repeats,
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


def verdict(text, base_failed):
    once = list(dict.fromkeys(line for line in text.split("\n") if WORD.search(line)))
    size = lambda line: sum(map(len, WORD.findall(line)))
    good = []
    for line in once:
        words = WORD.findall(line)
        bad = len(re.findall(r"[#*$%&|<>]", line)) > line_rules.SYMBOL_SHARE * size(line)
        bad |= len(re.findall("[!?]{2,}", line)) > line_rules.SHOUTED * len(words)
        bad |= len(words) >= line_rules.LONG_LINE and len(set(words)) < line_rules.VARIETY * len(words)
        bad |= len(words) <= line_rules.MENU_WORDS and bool(re.search(line_rules.NAVIGATION, line, re.A))
        bad |= bool(re.search(line_rules.BOILERPLATE, line))
        if not bad:
            good.append(line)
    total = sum(map(size, once))
    lost = total - sum(map(size, good))
    return "\n".join(good), lost, not base_failed and lost <= line_rules.LOSS * total


def random_texts():
    rng = random.Random(9)
    words = ["a", "bb", "c.", "Ünï", "#x#", "wow!!", "|", "d\te", "😀", "a b c d e f g h i", "x y", "z\u0085"]
    lines = [" ".join(rng.choices(words, k=rng.randrange(30))) for _ in range(120)]
    lines += ["Home | About", "Read more", "All Rights Reserved.", "homely words here", "", "  ", "a a a a a a a a a a a"]
    return ["\n".join(rng.choices(lines, k=rng.randrange(9))) for _ in range(500)]


def test_equals_brute_force(spark):
    texts = random_texts() + ["", "word " * 20000, " ".join(map(str, range(20000))), "a\r\na\r\nb"]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string")
    rows = line_rules.judge(df.withColumn("kept", F.lit("old"))).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        text = row["text"] or ""
        expected = measures(text)
        assert {k: row[k] for k in expected} == expected, text[:300]
        cleaned, lost, kept = verdict(text, expected["base_failed"])
        assert (row["cleaned"], row["lost_chars"], row["kept"]) == (cleaned, lost, kept), text[:300]


def test_plan_stays_on_the_jvm_and_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    judged = line_rules.judge(df)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert judged.count() == 0
