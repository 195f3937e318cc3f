import random
import re
import string

import pytest

from eocube.llm import decontaminate as D
from eocube.llm.scratch import Scratch

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items, window=13):
    phrases = {}
    for name, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            phrases.setdefault(tuple(w[i : i + n]), set()).add(None if name is None else str(name))
    lengths = {len(p) for p in phrases}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (names := phrases.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((str(d), len(w), len(hit), tuple(map(str, sorted(found - {None}))) + (None,) * (None in found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(spark, texts):
    rows = [(5, texts[8][100:600]), (5, texts[8][100:600]), (10, "ONE, two!"), (11, "again and again"), (12, None), (13, ""), (14, "?!"), (None, " ".join(texts[14].split()[20:45])), (100, "日本語"), (101, texts[14]), ("null", texts[8][200:500])]
    return spark.createDataFrame([(None if i is None else str(i), t) for i, t in rows], "item_id string, text string").selectExpr("*", "'e' as doc_id", "'e' as spans")


@pytest.mark.parametrize("groups", [1, 4])
def test_odd_documents(odd, empty, items, monkeypatch, groups):
    if groups > 1:
        monkeypatch.setattr(D, "GROUP_CHARS", 500)
    want = brute([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = sorted(((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in D.contamination(odd, items).collect()), key=str)
    assert got == want and any(x[4] for x in got)
    assert D.contamination(empty, items).count() == 0
    assert {r.n_hit for r in D.contamination(odd, items.limit(0)).collect()} == {0}


def test_small_alphabet(spark):
    """Words from a tiny vocabulary: lists are long, matches overlap, documents end anywhere."""
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choice("ab") for _ in range(n))
    docs = [(i, text(rnd.randrange(0, 60))) for i in range(150)]
    items = [(i, text(rnd.randrange(1, 16))) for i in range(12)]
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=5)
    assert sorted(((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got.collect()), key=str) == brute(docs, items, 5)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox"), (2, "the very quick and brown old fox"), (3, "fox brown"), (4, "quick x x x x x fox")], "doc_id long, text string")
    index = Scratch(spark, "t").keep(D.build_index(docs), "i")
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    hit = lambda slop: sorted(r.doc_id for r in D.search(index, items, slop=slop).where("size(items) > 0").collect())
    assert hit(0) == [1] and hit(2) == [1, 2]
