"""Substring dedup by level-wise doubling.

Windows of a short length are looked up in all documents first; only where two
of them that are repeated in different documents overlap or meet is the window
of up to twice the length a candidate at the next level, until the ladder
reaches ``window`` words. Every window of the final length that is repeated
consists of repeated shorter ones, so nothing is lost on the way, and the exact
last level touches only what survived.

The lower levels exchange 32-bit values in hash buckets; a chance collision
there only lets a candidate through. The last level compares hashes of 128 bits
(two polynomials over different word hashes) and the smallest document id of each.

Defined results: a null text is an empty one; a null id sorts after all others
and is equal to no smaller one; rows that repeat an id are one document, so they
never remove each other's words; fewer words than a window: nothing is removed.
A document is never cut between blocks: a very long one must fit a worker, with
some sixty bytes for each of its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import PAIR, answer, blocks_of, buckets_for, elsewhere_earlier_pair, flags, lists, opened, squeeze, twice, with_answers
from .scratch import Scratch
from .text import NO_ID, OTHER_BASE, WHITE, covered, doc_windows, spread, window_hashes, word_hashes, words

_U = np.uint64
ROWS = "bucket int, block_id long, a binary, b binary"


def ladder(window: int, first: int = 8) -> list[int]:
    """Lengths from the first level, of ``first`` words at most, to ``window``, each at most twice the one before."""
    out = [window]
    while out[0] > first:
        out.insert(0, (out[0] + 1) // 2)
    return out


class _Block:
    def __init__(self, ids, buf, offs):
        self.ids, self.buf, self.offs = ids, buf, offs
        self.starts, self.ends, self.first = words(buf, offs, WHITE)
        self.w = word_hashes(buf, self.starts, self.ends)

    def level(self, n: int, alive: np.ndarray | None):
        """Hashes of the windows of ``n`` words, and the places and documents of those that are candidates."""
        h = window_hashes(self.w, n)
        pos, doc = doc_windows(self.first, n)
        if alive is not None:
            k = n - self.below
            good = alive[pos] & alive[pos + k]
            pos, doc = pos[good], doc[good]
        return h[pos], pos, doc

    def distinct(self, h, doc, g=None):
        """Sorted distinct hashes (with ``g``: pairs of hashes), the smallest and the largest document id of each, and each window's index among them."""
        order = np.lexsort((self.ids[doc], h) if g is None else (self.ids[doc], g, h))
        s, key = h[order], self.ids[doc][order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        if g is not None:
            new[1:] |= g[order][1:] != g[order][:-1]
        at = np.flatnonzero(new)
        back = np.empty(len(s), np.int64)
        back[order] = np.cumsum(new) - 1
        last = np.concatenate([at[1:], [len(s)]]) - 1 if len(at) else at
        found = s[at]
        if g is not None:
            found = np.empty(len(at), PAIR)
            found["h"], found["g"] = s[at], g[order][at]
        return found, key[at], key[last], back

    def climb(self, levels, answers, n_buckets, exact):
        """Candidates of the last of ``levels``, given the answers to those before."""
        alive = None
        for n, got in zip(levels[:-1], answers, strict=True):
            h, pos, doc = self.level(n, alive)
            u, lo, hi, back = self.distinct(h, doc)
            repeated = flags(u, n_buckets, got) | (lo != hi)
            alive = np.zeros(len(self.w) + 1, bool)
            alive[pos] = repeated[back]
            self.below = n
        h, pos, doc = self.level(levels[-1], alive)
        g = None
        if exact:
            g = window_hashes(word_hashes(self.buf, self.starts, self.ends, OTHER_BASE), levels[-1])[pos]
        return (*self.distinct(h, doc, g), pos, doc)


def _ask(levels, n_buckets, exact):
    def run(batches):
        for row, block, ids, buf, offs in opened(batches):
            u, lo, *_ = _Block(ids, buf, offs).climb(levels, [row[f"l{n}"] for n in levels[:-1]], n_buckets, exact)
            cut = lists(u["h"] if exact else u, n_buckets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in cut], pa.int32()),
                    pa.array([block] * len(cut), pa.int64()),
                    pa.array([squeeze(u[s]) if exact else squeeze((u[s] & _U(0xFFFFFFFF)).astype(np.uint32)) for _, s in cut], pa.binary()),
                    pa.array([squeeze(lo[s]) if exact else None for _, s in cut], pa.binary()),
                ],
                ["bucket", "block_id", "a", "b"],
            )

    return run


def joined_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each document, joined by one blank: bytes and offsets."""
    at = np.flatnonzero(keep)
    size = ends[at] - starts[at] + 1
    out = buf[np.minimum(spread(starts[at], size), len(buf) - 1)] if len(at) else np.zeros(0, np.uint8)
    stop = np.cumsum(size)
    out[stop - 1] = 32
    before = np.searchsorted(at, first)  # kept words before each document
    edge = np.concatenate([[0], stop])[before]
    lasting = np.ones(len(out), bool)
    some = np.diff(before) > 0
    lasting[edge[1:][some] - 1] = False  # no blank after a document's last word
    return out[lasting], np.concatenate([[0], np.cumsum(np.diff(edge) - some)])


def _finish(levels, n_buckets):
    def run(batches):
        for row, _, ids, buf, offs in opened(batches):
            b = _Block(ids, buf, offs)
            u, lo, _, back, pos, doc = b.climb(levels, [row[f"l{n}"] for n in levels[:-1]], n_buckets, True)
            earlier = flags(u["h"], n_buckets, row[f"l{levels[-1]}"])
            gone = earlier[back] | (ids[doc] > lo[back])
            dead = covered(len(b.starts), pos[gone], levels[-1])
            text, at = joined_words(buf, b.starts, b.ends, ~dead, b.first)
            total = np.concatenate([[0], np.cumsum(dead)])
            removed = total[b.first[1:]] - total[b.first[:-1]]
            kept = pa.Array.from_buffers(pa.large_string(), len(ids), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(text)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=ids == NO_ID), kept.cast(pa.string()), pa.array(np.diff(b.first), pa.int64()), pa.array(removed, pa.int64())], ["doc_id", "text", "n_words", "n_removed"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, first: int = 8, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (the words that stay, joined by one blank), n_words, n_removed.

    A word goes if a window of ``window`` words covers it whose sequence also
    starts in a document with a smaller id; windows are those of the input.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "substring")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = scratch.keep(blocks_of(src), "blocks")
    n_buckets = buckets_for(blocks)
    levels = ladder(window, first)
    for i, n in enumerate(levels):
        exact = i == len(levels) - 1
        asked = blocks.mapInArrow(_ask(levels[: i + 1], n_buckets, exact), ROWS)
        told = scratch.keep(answer(asked, elsewhere_earlier_pair if exact else twice, (PAIR, np.int64) if exact else (np.uint32, np.uint8)), f"level{n}")
        blocks = with_answers(blocks, told, f"l{n}")
    return blocks.mapInArrow(_finish(levels, n_buckets), "doc_id long, text string, n_words long, n_removed long")
