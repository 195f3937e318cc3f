import random
import re
import string

import numpy as np
import pytest

from eocube.llm import near_dedup as N

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent=80):
    """Component of each id, and set sizes by row; ids of the rows that aren't null."""
    sets = [(d, shingles(t, k)) for d, t in rows if d is not None]
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: root(d) for d in up}


@pytest.mark.parametrize("k", [4, 5])
def test_odd_documents(spark, odd, k):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    comp = brute(rows, k)
    out = N.near_duplicates(odd, shingle=k).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (comp[r.doc_id], comp[r.doc_id] == r.doc_id)
    assert sorted((str(r.doc_id), r.n_shingles) for r in out) == sorted((str(d), len(shingles(t, k))) for d, t in rows)


def test_groups_of_near_copies(spark):
    """Chains, boilerplate and a large group of copies, each with other edits."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice(string.ascii_lowercase) for _ in range(5))
    line = [word() for _ in range(12)]
    rows, base = [], [word() for _ in range(160)]
    for i in range(300):
        w = list(base)
        for _ in range(rnd.randrange(1, 6)):
            w[rnd.randrange(160)] = word()
        rows.append((i, " ".join(w)))
    chain = [word() for _ in range(120)]
    for i in range(300, 320):
        chain[(i * 7) % 110] = word()
        rows.append((i, " ".join(chain)))
    rows += [(i, " ".join([word() for _ in range(rnd.randrange(5, 40))] + line)) for i in range(320, 620)]
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()}
    assert got == brute(rows, 4)


def pairs_in_boilerplate(n, seed=3):
    """Pairs of 0.8 whose members have 0.765 with all others: 78 of a union of 100 words are everyone's."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(string.ascii_lowercase) for _ in range(8))
    line, rows = [word() for _ in range(78)], []
    for i in range(0, n, 2):
        both = [word() for _ in range(2)]
        rows += [(k, " ".join(line + both + [word() for _ in range(10)])) for k in (i, i + 1)]
    return rows


def test_links_between_pieces_of_a_node(spark, monkeypatch):
    """A node of several pieces whose members are linked to one other each."""
    monkeypatch.setattr(N, "PIECE", 64)
    rows = pairs_in_boilerplate(600)
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_small_table_on_many_partitions(spark):
    """No cut between partitions falls into the nodes of a few documents; an id may have several texts, empty and null ones too."""
    line = " ".join(f"w{i}" for i in range(100))
    rows = [(5, ""), (5, line), (5, None), (6, line + " x"), (6, ""), (7, line + " y z"), (9, "q r s t u v"), (9, ""), (None, line)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(5, 5, True), (6, 5, False), (7, 5, False), (9, 9, True), (None, None, True)}


def test_fringe_links_match_brute_force():
    rnd = np.random.default_rng(5)
    sets = [np.unique(np.concatenate([np.flatnonzero(rnd.random(60) < 0.93), rnd.integers(100, 160, rnd.integers(1, 9))])).astype(np.uint64) for _ in range(150)]
    ids, comp = np.arange(150), np.where(rnd.random(150) < 0.3, 0, np.arange(150))
    want, got = N.Forest(), N.Forest()
    for i in range(150):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                want.join(int(comp[i]), int(comp[j]))
    for u, v in N.fringe_links(ids, comp, sets, 80):
        got.join(int(comp[u]), int(comp[v]))
    assert [got.root(int(c)) for c in comp] == [want.root(int(c)) for c in comp]


def test_empty_table(spark, empty):
    out = N.near_duplicates(empty)
    assert out.count() == 0 and out.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_trees_reach_the_recall():
    assert N.trees_for(0.9998, 0.8) == 12 and (1 - 0.8**3) ** 12 <= 0.0002


def links(sets, percent=80):
    """All linked pairs: shingles that many have as a product of matrices, the others by lists of who has them."""
    has = {}
    for i, x in enumerate(sets):
        for t in x:
            has.setdefault(t, []).append(i)
    often = [t for t, x in has.items() if len(x) > 50]
    m = np.zeros((len(sets), len(often)), np.float32)
    for k, t in enumerate(often):
        m[has[t], k] = 1
    both, size = m @ m.T, np.array([len(x) for x in sets])
    for x in has.values():
        if 1 < len(x) <= 50:
            i = np.array(x)
            both[i[:, None], i[None, :]] += 1
    u, v = np.nonzero(np.triu(100 * both >= percent * (size[:, None] + size[None, :] - both), 1))
    return u, v, both[u, v] / (size[u] + size[v] - both[u, v])


def recall(spark, rows, k):
    """Share of the links of brute force whose ends share a component; also that of those of 0.80 to 0.85."""
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=k).collect()}
    u, v, s = links([shingles(t, k) for _, t in rows])
    same = np.array([got[a] == got[b] for a, b in zip(u.tolist(), v.tolist(), strict=True)])
    want = N.Forest()
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        want.join(a, b)
    assert all(want.root(i) == want.root(c) for i, c in got.items())  # nothing is tied that brute force doesn't tie
    return same.mean(), same[s < 0.85].mean(), (s < 0.85).sum()


def test_recall_in_a_very_large_group(spark):
    """5,200 near copies, each with other edits: far more than a piece of a node; most links are between 0.80 and 0.85."""
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice(string.ascii_lowercase) for _ in range(6))
    base, rows = [word() for _ in range(90)], []
    for i in range(5200):
        w = list(base)
        for _ in range(rnd.randrange(1, 5)):
            w[rnd.randrange(90)] = word()
        rows.append((i, " ".join(w)))
    every, low, n = recall(spark, rows, 4)
    assert n > 100_000 and every >= 0.999 and low >= 0.99


@pytest.mark.parametrize("common", [40, 70])
def test_recall_in_boilerplate(spark, common):
    """Pairs of 0.80 to 0.85 in 4,000 documents that share a large part of their words with all others: nodes are deep."""
    rnd = random.Random(common)
    word = lambda: "".join(rnd.choice(string.ascii_lowercase) for _ in range(8))
    line, rows = [word() for _ in range(common)], []
    for i in range(0, 4000, 2):
        own = [word() for _ in range(88 - common)]
        rows += [(k, " ".join(line + own + [word() for _ in range(rnd.choice((8, 10, 11)))])) for k in (i, i + 1)]
    every, low, n = recall(spark, rows, 1)
    assert n > 1000 and every >= 0.99 and low >= 0.99


def test_members_tied_by_leaders_meet_no_more(spark):
    """A group's pairs aren't all confirmed: those within a component of its leaders' links are left out."""
    from eocube.llm.scratch import Scratch

    rnd = random.Random(12)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rnd.randrange(1, 6)):
            w[rnd.randrange(160)] = f"x{rnd.random()}"
        rows.append((i, " ".join(w)))
    scratch = Scratch(spark, "near")
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4, scratch=scratch).collect()}
    assert got == brute(rows, 4)
    read = lambda name: spark.read.parquet(f"{scratch.path}/{name}")
    assert 2 * (read("pairs").where("depth = 0").count() + read("loose").count()) < read("pairs").count()


def test_untied_pairs(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (3, 9), (8, 9)], "u long, v long")
    tied = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (9, 3)], "node long, component long")
    assert sorted(map(tuple, N._untied(pairs, tied).collect())) == [(1, 3), (2, 3), (8, 9)]
