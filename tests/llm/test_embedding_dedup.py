import numpy as np
import pytest

from eocube.llm import embedding_dedup as E


def brute(rows, cosine=0.93):
    """n_links and component of each id; rows that repeat id and vector count once."""
    seen, vecs = set(), []
    for i, v, label in rows:
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok and (i, tuple(v), label) not in seen:
            seen.add((i, tuple(v), label))
            vecs.append((i, np.array(v, float), label))
    ids = {i for i, *_ in rows if i is not None}
    up, n = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (a, v, p) in enumerate(vecs):
        for b, w, q in vecs[:k]:
            if p == q and len(v) == len(w) and a != b and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= cosine:
                n[a] += 1
                n[b] += 1
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (n[i], root(i)) for i in ids}


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "'e' as rep", "'e' as n_links", "'e' as key").repartition(3)
    got = E.near_vectors(df, **options).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.vec_id is None:
            assert r.component_id is None and r.kept and r.n_links == 0
        else:
            assert (r.n_links, r.component_id) == want[r.vec_id] and r.kept == (want[r.vec_id][1] == r.vec_id)
    return want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(1, a, 0), (2, b, 0), (3, a, 0), (3, a, 0), (4, a, 1), (5, a, None), (6, None, 0), (7, [], 0), (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 3.0], 0), (10, [1.0, nan, 3.0], 0), (11, [1.0, inf, 3.0], 0), (12, [2.0, 4.0, 6.0], 0), (13, [1.0, 2.0], 0), (14, [-1.0, -2.0, -3.0], 0), (None, a, 0)]
    check(spark, rows)


def test_planted_links(spark, monkeypatch):
    """Links around the threshold in several labels, a common vector, and blocks smaller than a label."""
    monkeypatch.setattr(E, "ROWS", 40)
    rng = np.random.default_rng(7)
    rows, i = [], 0
    for label in range(3):
        for _ in range(60):
            v = rng.normal(size=64)
            for scale in (0.0, *rng.uniform(0.1, 0.5, rng.integers(0, 3))):
                rows.append((i, (v + scale * rng.normal(size=64)).tolist(), label))
                i += 1
    common = rng.normal(size=64).tolist()
    rows += [(i + k, common, 0) for k in range(80)] + [(i + 200, (np.array(common) * 2 + 0.2).tolist(), 0)]
    want = check(spark, rows)
    assert sum(n for n, _ in want.values()) > 100


def test_recall_at_the_threshold():
    """The count is calibrated: of pairs at exactly the threshold, as good as all collide often enough."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(20000, 64))
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    z = 0.93 * x + np.sqrt(1 - 0.93**2) * y
    hits = (np.abs((x - z) @ E.directions(64)) <= E.WIDE * np.sqrt(2 - 2 * 0.93)).sum(1)
    assert (hits >= E.least_collisions(0.9999)).mean() >= 0.998


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_vectors(df).count() == 0


@pytest.mark.parametrize("recall", [0.5, 0.99, 0.9999])
def test_least_collisions_falls_with_recall(recall):
    assert 0 < E.least_collisions(recall) <= E.PROJECTIONS
