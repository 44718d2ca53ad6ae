"""Fill-in-the-middle against a plain re-computation, and its cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from trendflow.llm import fill_in_middle as fim

SCHEMA = "doc_id long, text string, n string, form int, output string"
LONG = " ".join(f"word{i}" for i in range(60_000))
ROWS = [(i, t, "x", 1, "y") for i, t in enumerate([
    None, "", "a", " ", "one two", "ein Fluß, \U0001F600\U0001F600 weit\n\r\n\tweg", "has <P> inside", "<M>", "almost <P <S M>", "$1 \\2 {3}",
    "x" * 50_000, "\n" * 3000, LONG, "a<", ">b<", "é" * 7])]


def plain(key, text, rate=90, spm=20, seed=1):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in fim.MARKERS) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize(("rate", "spm"), [(90, 20), (100, 0), (100, 100), (0, 50)])
def test_against_plain(spark, rate, spm):
    rows = ROWS + [(None, "no id here", "x", 1, "y")] + [(k, "The cat, the mat; again.", "x", 1, "y") for k in range(100, 160)]
    df = spark.createDataFrame(rows + rows[4:6], SCHEMA)  # repeated rows
    made = fim.transform(df, rate=rate, spm=spm)
    assert made.columns == ["doc_id", "text", "n", "form", "output", "prefix_chars", "middle_chars"]
    got = made.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text, rate, spm), r.doc_id
        assert r.back == (r.text or "")
    forms = {r.form for r in got if r.doc_id is not None and r.doc_id >= 100}
    assert forms == {(90, 20): {"plain", "psm", "spm"}, (100, 0): {"psm"}, (100, 100): {"spm"}, (0, 50): {"plain"}}[rate, spm]


def test_other_markers_and_empty_table(spark):
    df = spark.createDataFrame([(k, "cost $5 \\ now") for k in range(30)], "doc_id long, text string")
    marks = ("[$pre$]", "[\\suf]", "[mid]")
    made = fim.transform(df, rate=100, spm=50, markers=marks)
    got = made.withColumn("back", fim.restore(F.col("output"), F.col("form"), marks)).collect()
    assert all(r.back == r.text and all(m in r.output for m in marks) for r in got) and {r.form for r in got} == {"psm", "spm"}
    assert fim.transform(df.limit(0)).count() == 0


def test_nothing_is_shuffled(spark):
    plan = fim.op13_fill_in_middle(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
