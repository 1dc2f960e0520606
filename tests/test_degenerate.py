import random
import re

from pyspark.sql import functions as F

from stillhouse.functions.degenerate import is_degenerate


def expected(text):
    """The rule, spelled out over a list of lines."""
    lines = [re.sub(r"\s+", " ", x).strip().lower() for x in (text or "").splitlines() if x.strip()]
    if not lines or sum(x.rstrip(":") == "answer" for x in lines) >= 5:
        return True
    if any(len(set(lines[i:i + 5])) == 1 for i in range(len(lines) - 4)):
        return True
    return len(lines) >= 10 and len(set(lines)) / len(lines) < 0.2


def test_worked_cases_and_random_texts(spark):
    cases = [
        None, "", "  \n\t", "Answer:\n" * 5, "Answer:\n" * 4, "x\nAnswer::\na\nanswer\nANSWER:\nb\nAnswer:\nAnswer: ",
        "A  b\na b\n a\tb \nA B\na b", "a\nb\n" * 5, "a\nb\n" * 5 + "a", "answer: 1\n" * 4, "ab\nabc\nabc\nabc\nabc",
        "x\r\nx\rx\x0bx\x0cx", "x x x\x1cx\x1dx", "x　 y\nx y\nx\xa0y\nx\x1fy\nx y", "aa\na\naa\na\naa\naa\naa\naa",
    ]
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randrange(1, 30)
        words = ["Answer:", "answer", "a", "a ", " b", "ab", "", " ", "a  c", "a\tc"][: rng.randrange(1, 11)]
        cases.append("".join(rng.choice(words) + rng.choice(["\n", "\r\n", "\n\n", " \n", "\x85", " "]) for _ in range(n)))
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(is_degenerate(F.col("t"))).collect()]
    assert got == [expected(t) for t in cases]


def test_space_classes_are_pythons(spark):
    import sys

    from stillhouse.functions import text

    chars = [chr(i) for i in range(1, sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF]
    assert [c for c in chars if c.isspace()] == sorted(text.PY_SPACE)
    rows = spark.createDataFrame([(c,) for c in chars[:0x3100]], "c string")
    got = rows.select(
        "c", F.col("c").rlike(text.SPACE).alias("space"), F.col("c").rlike(text.LINE_BREAK).alias("line"),
        F.col("c").rlike(text.INLINE_SPACE).alias("inline"), F.col("c").rlike(text.ODD_INLINE_SPACE).alias("odd"),
    ).collect()
    for r in got:
        breaks = len(f"a{r.c}b".splitlines()) > 1
        assert (r.space, r.line, r.inline, r.odd) == (
            r.c.isspace(), breaks, r.c.isspace() and not breaks, r.c.isspace() and not breaks and r.c != " "
        ), hex(ord(r.c))
