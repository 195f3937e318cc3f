import random

import numpy as np
import pytest

from eocube.llm import bwt
from eocube.llm import suffix_dedup as S

BIG = 2**63


def brute(rows, n):
    """(kept, bytes, removed, spans) of each row; rows that repeat an id remove only their own later repeats."""
    data = [(BIG if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in data:
        for s in range(len(b) - n + 1):
            w = b[s : s + n]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, b in data:
        dead, seen = bytearray(len(b)), set()
        for s in range(len(b) - n + 1):
            w = b[s : s + n]
            if first[w] < d or w in seen:
                dead[s : s + n] = b"\1" * n
            seen.add(w)
        spans = sum(1 for i, x in enumerate(dead) if x and not (i and dead[i - 1]))
        out.append((bytes(c for c, x in zip(b, dead, strict=True) if not x), len(b), sum(dead), spans))
    return out


def check(df, n, hot=S.HOT):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = sorted((str(d), *x) for (d, _), x in zip(rows, brute(rows, n), strict=True))
    got = sorted((str(r.doc_id), bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in S.remove_repeated_bytes(df, length=n, hot=hot).collect())
    assert got == want
    return sum(x[3] for x in got)


@pytest.mark.parametrize("n", [100, 20])
def test_odd_documents(odd, n):
    assert check(odd, n) > 0


def test_empty_table(empty):
    assert S.remove_repeated_bytes(empty).count() == 0


@pytest.mark.parametrize("hot", [1, 512])
def test_shared_passages_with_edits(spark, hot):
    """Passages that begin and end anywhere, near copies, periodic texts; with and without the way for hot anchors."""
    rnd = random.Random(8)
    text = lambda n, a="abcdefgh é": "".join(rnd.choice(a) for _ in range(n))
    pool = [text(rnd.randrange(30, 200)) for _ in range(6)]
    rows = []
    for i in range(80):
        t = "".join(rnd.choice([text(rnd.randrange(1, 60)), p[rnd.randrange(20) :], p[: len(p) - rnd.randrange(20)]]) for p in rnd.choices(pool, k=3))
        rows.append((i, t))
    rows += [(90, "ab" * 150), (91, "ba" * 120), (92, "a" * 300), (93, "a" * 99), (94, text(100)), (89, rows[5][1])]
    assert check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 40, hot) > 0


def test_merge_sorts_and_groups():
    """Merged order equals a plain sort by the first symbols, and groups are equal prefixes."""
    rnd = random.Random(2)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(1, 40))) for _ in range(30)]
    shard = np.sort(np.array([rnd.randrange(5) for _ in strings]))
    flat = np.frombuffer(b"".join(strings), np.uint8) + np.uint8(1)
    offs = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    depth = 10
    before, start, own = bwt.transform(flat, offs, shard, depth)
    place, group = bwt.merge(before, own, depth)
    begins = offs[:-1] + np.arange(len(strings))
    prefix = []
    for p in start[place]:
        i = int(np.searchsorted(begins, p, "right")) - 1
        prefix.append(strings[i][p - begins[i] :][:depth])
    whole = [(x, g) for x, g in zip(prefix, group.tolist(), strict=True) if len(x) == depth]
    assert [x for x, _ in whole] == sorted(x for x, _ in whole)
    assert len({g for _, g in whole}) == len({x for x, _ in whole}) and all(len({x for x, h in whole if h == g}) == 1 for _, g in whole)
