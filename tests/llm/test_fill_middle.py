import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eocube.llm import fill_middle as M

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, percent=50):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or three % 100 >= percent:
        return doc_id, n, "plain", None, None, None, text
    a, b = sorted((one % (n + 1), two % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (doc_id, n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}") if four % 100 < 80 else (doc_id, n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}")


ODD = ["\x01", "\x02\x01 \x02e\x02d\x01", "a\x01\x02 b\x02", " \t\n", "  lead", "trail \n ", "one", "<P>", "x <S> y", "<P <S M>", "<", "a<b S>c <", "$0 \\1 $1", "\x00 null", "    wide", "\U0001f600 \U0001f468‍\U0001f469 x", "\x1c\x1d a\x85b"]


@pytest.mark.parametrize("percent", [50, 100])
def test_against_brute_force(spark, odd, percent):
    more = spark.createDataFrame([(1000 + i * 20 + j, t) for i, t in enumerate(ODD) for j in range(20)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    got = M.fill_in_middle(docs, percent=percent).withColumn("again", M.restored(F.col("output"), F.col("form"))).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter(brute(*r, percent) for r in docs.collect())
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    assert all(r.again in texts[r.doc_id] for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}


def test_extra_columns_and_empty(odd, empty):
    assert M.fill_in_middle(odd.selectExpr("*", "1 as units", "2 as n", "3 as digest", "4 as form")).count() == odd.count()
    assert M.fill_in_middle(empty).count() == 0


def test_very_long_text(spark):
    text = "word  " * 400_000
    docs = spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string")
    got = M.fill_in_middle(docs, percent=100).withColumn("again", M.restored(F.col("output"), F.col("form")))
    assert [tuple(r) for r in got.select("n", F.col("again") == text).distinct().collect()] == [(400_001, True)]


def test_no_python_and_no_shuffle(odd):
    plan = M.fill_in_middle(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan and "Window" not in plan


def test_markers_that_could_run_together(odd):
    with pytest.raises(ValueError, match="markers"):
        M.fill_in_middle(odd, markers=("<P<", "<S>", "<M>"))


def test_markers_of_other_shape(odd):
    marks = ("[pre]", "[suf]", "[mid]")
    got = M.fill_in_middle(odd.where("doc_id is not null"), percent=100, markers=marks).withColumn("again", M.restored(F.col("output"), F.col("form"), marks))
    assert got.where("form <> 'plain' and again <> concat(prefix, middle, suffix)").count() == 0
