import random

import pytest

import corpus_pipeline as P
from eocube.llm.scratch import Scratch

from .test_decontaminate import brute as contaminated
from .test_near_dedup import brute as components
from .test_substring_dedup import brute as cut
from .test_tokens import check_packing

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave."""
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    store = Scratch(spark, "test")
    for name, stage in P.STAGES:
        after = store.keep(stage(spark, docs, DATA), name)
        out.append((name, docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return {n: x for n, *x in out}


def test_language_keeps_documents_with_letters(stages):
    before, after, *cols = stages["language_id"]
    assert cols[0] == cols[1] and {r.doc_id for r in before} - {r.doc_id for r in after} <= {r.doc_id for r in before if not any(c.isalpha() for c in r.text or "")}


def test_near_dedup(stages):
    before, after, *_ = stages["near_dedup"]
    comp = components([(r.doc_id, r.text) for r in before], 5)
    assert sorted(r.doc_id for r in after) == sorted(d for d, c in comp.items() if c == d) and len(after) < len(before)
    assert set(after) <= set(before)


def test_substring_dedup(stages):
    before, after, *_ = stages["substring_dedup"]
    want = {r.doc_id: (r.text if not n else t, n) for r, (t, _, n) in zip(before, cut([(r.doc_id, r.text) for r in before], P.PASSAGE), strict=True)}
    assert {r.doc_id: r.text for r in after} == {d: t for d, (t, _) in want.items()}
    assert all(r.n_chars == len(r.text) for r in after if want[r.doc_id][1])


def test_decontamination(spark, stages):
    before, after, *_ = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    dirty = {d for d, *_, c in contaminated([(r.doc_id, r.text) for r in before], items) if c}
    assert {str(r.doc_id) for r in after} == {str(r.doc_id) for r in before} - dirty


def test_packing(stages):
    before, after, *_ = stages["packing"]
    n, total = check_packing(before, after)
    assert n <= -(-total // 2048) + 1


def test_run(spark, stages):
    assert P.run(spark, DATA).count() == len(stages["packing"][1])


def test_stages_take_odd_documents(spark, odd, empty):
    for docs in (odd, empty):
        n = docs.count()
        for i, (name, stage) in enumerate(P.STAGES):
            after = Scratch(spark, "odd").keep(stage(spark, docs, DATA), name)
            if i < len(P.STAGES) - 1:
                assert after.columns == docs.columns and after.count() <= n
            docs = after


def test_near_dedup_of_a_large_group(spark):
    """A large group of near copies, one of exact copies and others: one of each group stays."""
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(6))
    base, rows = [word() for _ in range(120)], []
    for i in range(400):
        w = list(base)
        for _ in range(rnd.randrange(1, 4)):
            w[rnd.randrange(120)] = word()
        rows.append((i, " ".join(w)))
    copy = " ".join(word() for _ in range(50))
    rows += [(i, copy) for i in range(400, 900)] + [(i, " ".join(word() for _ in range(40))) for i in range(900, 960)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    comp = components(rows, 5)
    assert sorted(r.doc_id for r in P.near_dedup(spark, docs, DATA).collect()) == sorted(d for d, c in comp.items() if c == d)
