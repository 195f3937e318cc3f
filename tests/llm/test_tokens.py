import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eocube.llm import packing, token_files
from eocube.llm.scratch import Scratch
from eocube.llm.tokens import Ids

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = ["a", "B", "'", "s", "'s", "'LL", "9", "0", "!", "»", "é", "e\u0301", "\u0338", "=", "<", "Ω", " ", "\n", "\xa0", "\x1c", "\x85", "\x7f", "\x00", "日", "½", "٣", "<|endoftext|>", "<|", "İ", "ß", "-", "_", "\u200d", "😀"]


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library(plain, name):
    path = public_tokenizers.path(name)
    own, lib = Ids(path, plain), Tokenizer.from_file(path)
    lib.encode_special_tokens = plain
    assert own.cuts == name.startswith("word")
    rnd = random.Random(2)
    for _ in range(300):
        texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(0, 16))) for _ in range(4)]
        ids, at = own.encode(*flat(texts))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_memory_is_emptied(monkeypatch):
    monkeypatch.setattr("eocube.llm.tokens.MOST_CHUNKS", 3)
    own, lib = Ids(PATH), Tokenizer.from_file(PATH)
    for t in ("one two three four five", "six seven", "one eight"):
        assert own.encode(*flat([t]))[0].tolist() == lib.encode(t, add_special_tokens=False).ids
    assert len(own.known) < 7


def ids_of(text):
    lib = Tokenizer.from_file(PATH)
    lib.encode_special_tokens = True
    return lib.encode(text or "", add_special_tokens=False).ids


def test_counts_of_odd_documents(odd, empty):
    rows = odd.collect()
    got = token_files.token_counts(odd, PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(r.doc_id), len(ids_of(r.text))) for r in rows)
    assert token_files.token_counts(empty, PATH).count() == 0


@pytest.mark.parametrize("size", [1, 3, 64])
def test_scan_stitches_blocks(spark, monkeypatch, size):
    """Files of any cut give the documents that a plain split gives."""
    monkeypatch.setattr(token_files, "GROUP_BLOCKS", 4)
    rnd = random.Random(size)
    rows, want = [], []
    for file in range(6):
        ids = [rnd.choice([0, 0, 5, 6, 7, 8, 9]) for _ in range(rnd.randrange(0, 200))] if file else [5] * 50
        rows += [(file, k, np.array(ids[a : a + size], "<u2").tobytes()) for k, a in enumerate(range(0, len(ids), size))]
        start = 0
        docs = []
        for i, x in enumerate(ids):
            if x == 0:
                docs.append((start, i - start, True))
                start = i + 1
        if start < len(ids):
            docs.append((start, len(ids) - start, False))
        want += [(file, k, *d) for k, d in enumerate(docs)]
    df = spark.createDataFrame([(f, k, bytearray(b)) for f, k, b in rows], token_files.BLOCKS).repartition(3)
    assert sorted(map(tuple, token_files.scan(df, 0, scratch=Scratch(spark, "t")).collect())) == sorted(want)


def test_raw_files(spark, tmp_path):
    np.array([4, 4, 9, 9, 5], "<u2").tofile(tmp_path / "a.bin")
    got = token_files.scan(token_files.read_flat(spark, str(tmp_path)), 9).collect()
    assert sorted((r.start, r.n_tokens, r.closed) for r in got) == [(0, 2, True), (3, 0, True), (4, 1, False)]


def check_packing(rows, out, capacity=2048):
    import zlib

    want, tok = [], Tokenizer.from_file(PATH)
    for r in rows:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [0]
        want += [(str(r.doc_id), k, a, len(ids[a : a + capacity]), zlib.crc32(np.array(ids[a : a + capacity], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), capacity))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r.length for r in out)


def test_packing_odd_documents(odd, empty):
    n, total = check_packing(odd.collect(), packing.pack(odd, PATH).collect())
    assert n <= -(-total // 2048) + 1
    assert packing.pack(empty, PATH).count() == 0


def test_packing_many(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    n, total = check_packing(docs.collect(), packing.pack(docs, PATH).collect())
    assert n <= -(-total // 2048) * 1.005 + 1


def test_packing_levels_and_islands(spark, monkeypatch):
    """Small groups: several levels, groups that evolve, and pieces that can't share."""
    monkeypatch.setattr(packing, "GROUP", 16)
    words = ["a " * n for n in [1100] * 9 + [700, 690, 680, 400, 390, 380, 120, 33, 5] * 6]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    n, total = check_packing(df.collect(), packing.pack(df, PATH).collect())
    assert n <= -(-total // 2048) + 4


def test_evolution_beats_or_equals_best_fit():
    rnd = random.Random(4)
    for seed in range(5):
        size = [rnd.choice([5, 7, 11, 13, 17, 34, 35, 51, 52]) for _ in range(60)]
        first = packing.best_fit([], list(range(60)), size, 100)
        best = packing.evolve(size, 100, [first], seed)
        assert sorted(i for b in best for i in b) == list(range(60)) and all(sum(size[i] for i in b) <= 100 for b in best)
        assert packing.lower_bound(size, 100) <= len(best) <= len(first)


def test_crossover_keeps_every_item():
    rnd = random.Random(1)
    size = [rnd.randrange(1, 60) for _ in range(50)]
    a = packing.best_fit([], list(range(50)), size, 100)
    order = list(range(50))
    rnd.shuffle(order)
    b = [[i] for i in order]
    child = packing.crossover(a, b, size, 100, rnd)
    assert sorted(i for x in child for i in x) == list(range(50)) and all(sum(size[i] for i in x) <= 100 for x in child)
