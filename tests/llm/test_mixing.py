import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from eocube.llm import mixing as X
from eocube.llm.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Targets by resharing as the contract words it, in fractions."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = Fraction(percent, 100) * sum(sizes.values())
    target = {s: Fraction(0) for s in names}
    free, left = set(names), total
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] >= most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = Fraction(most * sizes[s])
            left -= target[s]
        free -= over
    return target


def by_source(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    return sizes


def check(docs, **options):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = by_source(rows)
    want = filled(sizes, **{k: v for k, v in options.items() if k != "seed"})
    got = X.sampled(docs, ["doc_id", "source"], **options).collect()
    assert Counter((r.row.doc_id, r.row.source, r.size) for r in got) == Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in rows)
    taken, largest, copies = defaultdict(int), defaultdict(int), defaultdict(set)
    for r in got:
        s = r.row.source
        assert r.source_size == sizes[s] and abs(r.target - float(want[s])) <= 1e-9 * max(1, r.target)
        taken[s] += r.copies * r.size
        largest[s] = max(largest[s], r.size)
        copies[s].add(r.copies)
    for s, n in taken.items():
        assert abs(n - want[s]) <= largest[s], (s, n, want[s])
        e = want[s] / sizes[s] if sizes[s] else 0
        assert copies[s] <= {int(e), -int(-e // 1)} and max(copies[s]) <= options.get("most", 2)
    return got


def test_odd_documents(odd):
    got = check(odd)
    again = X.sampled(odd.repartition(7), ["doc_id", "source"]).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))


def test_a_hot_source_and_many_small_ones(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('s', id % 97) end as source", "case when id % 11 = 0 then null else repeat('w ', cast(pmod(xxhash64(id), 40) as int)) end as text")
    check(docs)
    other = check(docs, seed=7)
    assert len({r.copies for r in other if r.row.source == "hot"}) > 1


@pytest.mark.parametrize("options", [{"percent": 200}, {"percent": 100, "weights": (1,)}, {"percent": 30, "weights": (1, 5)}, {"percent": 290, "most": 3}, {"percent": 0}])
def test_other_shares(spark, options):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('s', cast(floor(log2(id + 1)) as int)) as source", "repeat('w ', cast(id % 7 as int)) as text")
    check(docs, **options)


def test_nothing_to_take(spark, empty):
    assert X.sampled(empty, ["doc_id"]).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None), (3, " ", "a")], "doc_id long, text string, source string")
    assert {(r.copies, r.target) for r in X.sampled(blank, ["doc_id"]).collect()} == {(0, 0.0)}


def test_mixture_is_the_rows_themselves(odd):
    got = X.mixture(odd, seed=3)
    assert got.columns == odd.columns
    want = {(r.row.doc_id, r.row.text): 0 for r in X.sampled(odd, ["doc_id", "text"], seed=3).collect()}
    for r in X.sampled(odd, ["doc_id", "text"], seed=3).collect():
        want[r.row.doc_id, r.row.text] += r.copies
    have = Counter((r.doc_id, r.text) for r in got.collect())
    # rows alike in id, source and size may stand for one another
    assert sum(have.values()) == sum(want.values()) and set(have) <= set(want)


def test_sources_over_many_partitions(spark):
    """Weights follow the order of all sources, however they are dealt out."""
    docs = spark.range(500).selectExpr("id as doc_id", "concat('s', id) as source", "repeat('w ', 10) as text").repartition(9)
    sizes = docs.groupBy(F.lit(True).alias("named"), F.col("source").alias("name")).agg(F.sum(F.lit(10)).alias("source_size"))
    got = {r.name: r.weight for r in X.targets(sizes, Scratch(spark, "test-mix")).collect()}
    assert got == {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(got))}


def test_no_python(odd):
    plan = X.sampled(odd, ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
