import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eocube.llm import collocations as C
from eocube.llm.perfect_hash import Slots


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, longest=4, share=80, most=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            ws = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang][ws[i : i + k]] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in found.items():
            for k in range(2, len(p)):
                dropped |= {q for i in range(len(p) - k + 1) if 100 * a >= share * counts[q := p[i : i + k]]}
        rank = []
        for p, a in found.items():
            if p not in dropped:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                rank.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(rank)[:most], 1)]
    return out


def rows_of(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


@pytest.mark.parametrize("least", [2, 30])
def test_odd_documents(odd, least):
    got = [tuple(r) for r in C.collocations(odd, least=least).collect()]
    assert sorted(got) == sorted(brute(rows_of(odd), least)) and got


def prose(seed, n, vocabulary=40, langs=("en", "es", None, "und")):
    rnd = random.Random(seed)
    word = [rnd.choice(["the", "The", "es", "en", "und", "é", "日本", "a b"])] + [f"w{i}" for i in range(vocabulary)]
    fixed = "an old saying that is often heard"
    for _ in range(n):
        text = [rnd.choice(word) if rnd.random() < 0.8 else fixed for _ in range(rnd.randrange(0, 60))]
        yield rnd.choice(langs), "".join(w + rnd.choice([" ", " ", " ", "\t", ", ", ". ", "\n", "  "]) for w in text)


def test_random_prose(spark):
    rows = list(prose(3, 400))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for longest, most in ((4, 2000), (2, 7), (6, 50)):
        got = [tuple(r) for r in C.collocations(docs, least=6, longest=longest, most=most).collect()]
        assert sorted(got) == sorted(brute(rows, 6, longest, most=most))


def test_small_blocks_and_one_very_common_phrase(spark, monkeypatch):
    """Each document a block of its own, a line that is in all of them, lists in many leaves."""
    line = "this line is in all of the documents here"
    rows = [("en", f"{line} {i % 7} and {i % 13} {line}, {line}") for i in range(300)] + [(None, "no lang " * 40)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(40)
    got = [tuple(r) for r in C.collocations(docs).collect()]
    assert sorted(got) == sorted(brute(rows, 30))


def test_a_word_of_one_language_is_not_that_of_another(spark):
    rows = [("en", "es de es de"), ("es", "en de en de"), ("de", "es en")] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, C.collocations(docs, least=3).collect())) == sorted(brute(rows, 3))


def test_empty(empty, spark):
    assert C.collocations(empty).count() == 0
    assert C.collocations(spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")).count() == 0


def test_counts_in_leaves(monkeypatch):
    """Many lists, in leaves of any size: counts, and which entries are frequent."""
    rnd = np.random.default_rng(5)
    lists_, counts, total = [], [], Counter()
    for _ in range(70):
        k = np.unique(rnd.integers(0, 900, rnd.integers(0, 200)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        c = rnd.integers(1, 4, len(k)).astype(np.uint32)
        lists_.append(k)
        counts.append(c)
        for x, y in zip(k.tolist(), c.tolist(), strict=True):
            total[x] += y
    for leaf in (1, 300, 1 << 18):
        monkeypatch.setattr(C, "LEAF", leaf)
        for others in (None, [x * np.uint64(3) for x in lists_]):
            often, ranks = C._count(lists_, others, counts, 12)
            assert sorted(often.tolist()) == sorted(v for v in total.values() if v >= 12)
            for k, r in zip(lists_, ranks, strict=True):
                assert [often[i] if i >= 0 else 0 for i in r] == [total[x] if total[x] >= 12 else 0 for x in k.tolist()]


def test_keys_that_share_their_first_half():
    h = np.zeros(6, np.uint64)
    g = np.array([1, 2, 1, 2, 3, 1], np.uint64)
    often, ranks = C._count([h[:3], h[3:]], [g[:3], g[3:]], [np.full(3, 10, np.uint32)] * 2, 20)
    assert sorted(often.tolist()) == [20, 30] and [r.tolist() for r in ranks][1][1] == -1


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 100_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 2**63, 2 * n, dtype=np.uint64)
    keys, others = np.unique(keys)[:n], np.arange(n, dtype=np.uint64)
    slots = Slots(keys)
    assert sorted(slots.find(keys).tolist()) == list(range(len(keys)))
    assert (slots.find(others) < max(n, 1)).all()
    assert sum(b.nbytes for b, _, _ in slots.levels) * 8 <= max(4.5 * n, 1024)


def test_the_same_key_twice_is_an_error():
    with pytest.raises(ValueError, match="distinct"):
        Slots(np.array([7, 7, 8], np.uint64))


def test_too_many_phrases_are_an_error():
    with pytest.raises(ValueError, match="too many"):
        C._answers(0, 2, [1], [np.zeros(1, np.int64)], np.arange(3), {})
