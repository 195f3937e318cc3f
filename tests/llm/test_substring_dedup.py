import re

import pytest

from eocube.llm.substring_dedup import ladder, remove_repeats

BIG = 2**63


def brute(rows, n):
    """(kept text, words, removed) of each row, by windows that start in a document with a smaller id."""
    words = [(BIG if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, BIG), d)
    out = []
    for d, w in words:
        dead = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                dead[i : i + n] = [True] * n
        out.append((" ".join(x for x, y in zip(w, dead, strict=True) if not y), len(w), sum(dead)))
    return out


@pytest.mark.parametrize(("window", "first"), [(13, 8), (5, 8), (50, 25), (20, 4)])
def test_odd_documents(odd, window, first):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted((str(d), *x) for (d, _), x in zip(rows, brute(rows, window), strict=True))
    got = sorted((str(r.doc_id), r.text, r.n_words, r.n_removed) for r in remove_repeats(odd, window=window, first=first).collect())
    assert got == want and any(x[3] for x in got)


def test_empty_table(empty):
    assert remove_repeats(empty).count() == 0


def test_ladder():
    assert ladder(13) == [7, 13] and ladder(50, 25) == [25, 50] and ladder(5) == [5]
    for n in range(1, 200):
        x = ladder(n)
        assert x[-1] == n and all(a <= b <= 2 * a for a, b in zip(x, x[1:], strict=False))
