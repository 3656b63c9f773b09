import random
import re

import pytest
from pyspark.sql import functions as F

from seqprep.functions import text as X


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in df.select("i", fn(F.col("t")).alias("o")).orderBy("i").collect()]


# Expected values worked out by hand from the rules.
NORMALIZED = {
    "Hi!": "hi ",
    "a,,b??": "a,b?",
    "x\\y": "x\\y",
    "l'eau": "l eau",
    " A  B ": "a b",
    "!!!": " ",
    "": "",
    None: None,
    "\n\tA\tB\n": "a\tb",
    "a… b+c-d/e=f(g)h•i:j[k]l|m;n": "a b c d e f g h i j k l m n",
    '"Quoted"': " quoted ",
    ",,,,??,,": ",?,",
    "ÉTÉ": "été",
    " x ": "x",
}


def test_normalize(spark):
    assert apply(spark, X.normalize, list(NORMALIZED)) == list(NORMALIZED.values())


def test_final_trim(spark):
    assert apply(spark, lambda t: X.normalize(t, final_trim=True), ["Hi!", "!!!"]) == ["hi", ""]


def step_by_step(text):
    """The seven steps, one after the other, in plain Python."""
    text = text.strip()
    for mark in "*\"\n…+-/=()'•:[]|!;":
        text = text.replace(mark, " ")
    for mark in " !,?":
        while mark * 2 in text:
            text = text.replace(mark * 2, mark)
    return text.lower()


def test_fused_normalize_equals_the_steps(spark):
    rng = random.Random(1)
    alphabet = "aB ,,??!!  \n\t'-;É\\"
    cases = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(500)]
    assert apply(spark, X.normalize, cases) == [step_by_step(c) for c in cases]
    composed = lambda t: F.lower(
        X.collapse_punct(
            X.collapse_punct(X.collapse_punct(X.collapse_spaces(X.strip_special(X.strip(t))), "!"), ","), "?"
        )
    )
    assert apply(spark, composed, cases) == apply(spark, X.normalize, cases)


def test_collapse_punct_knows_its_marks():
    with pytest.raises(ValueError):
        X.collapse_punct(F.lit("x"), ".")


def test_words_split_like_python(spark):
    rng = random.Random(2)
    spaces = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0      　"
    cases = ["".join(rng.choices("ab" + spaces, k=rng.randint(0, 20))) for _ in range(300)]
    assert apply(spark, X.words, cases) == [c.split() for c in cases]
    assert apply(spark, X.word_count, cases) == [len(c.split()) for c in cases]
    assert apply(spark, X.strip, cases) == [c.strip() for c in cases]
    assert apply(spark, X.words, [None]) == [None]


def plain_13a(line):
    """The 13a rules with Python's own regular expressions."""
    line = line.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    for name, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        line = line.replace(name, char)
    line = f" {line} "
    line = re.sub(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 ", line)
    line = re.sub(r"([^0-9])([\.,])", r"\1 \2 ", line)
    line = re.sub(r"([\.,])([^0-9])", r" \1 \2", line)
    line = re.sub(r"([0-9])(-)", r"\1 \2 ", line)
    return line.split()


def test_tok13a(spark):
    cases = ["Hello, world!", "1,234.5 and 3-4", "a&amp;b &lt;x&gt;", "co-\nop <skipped>", "", "..5 ,,,2 1,,,2"]
    rng = random.Random(3)
    cases += ["".join(rng.choices("ab12.,- \n&;<>()$'", k=rng.randint(0, 25))) for _ in range(800)]
    assert apply(spark, X.tok13a, cases) == [plain_13a(c) for c in cases]
