"""Exact substring dedup with merged Burrows-Wheeler transforms of shards.

Sorting every suffix of a corpus, and a hundred passes over all of it to merge
its shards, is out of reach; so text is first narrowed down, without loss:

1. Each window of ``length`` bytes has an anchor, the piece of half its length
   with the smallest hash; equal windows have equal anchors. Windows that share
   an anchor follow one another and form a run, about one for 26 bytes. Only
   runs whose anchor occurs twice can hold a repeated window.
2. Runs that are equal as a whole are decided by the smallest document alone;
   one of them stands for all. An anchor with a single such text needs no more.
3. The texts of the other runs are the shards' strings (a shard is what one
   block of documents has in one hash bucket). Their transforms are merged by
   interleave refinement down to ``length`` symbols; suffixes whose common
   prefix is that long form an interval, and the windows of an interval are
   repeats of its earliest one.

An anchor with more than ``HOT`` different texts (a passage that very many
documents share in different surroundings) would be an unbounded group: its
windows are dealt by their own hashes of 128 bits (two polynomials over different
values of the bytes) instead, and nothing is left out. Whole runs are equal if
their anchors' hashes and their texts' are, 128 bits together.

Defined results: a null text is an empty one; a null id sorts after all others;
rows that repeat an id never remove each other's bytes, but each its own later
repeats; a text shorter than ``length`` loses nothing. A document is never cut
between blocks: a very long one must fit a worker, with some sixty bytes for
each of its bytes (eighty where an anchor is hot).
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import PAIR, answer, answer_rows, blocks_of, buckets_for, elsewhere_earlier_pair, expand, flags, lists, opened, squeeze, twice, with_answers
from .bwt import MOST_SHARDS, merge, transform
from .scratch import Scratch
from .text import _BYTE, NO_ID, OTHER_BASE, covered, doc_windows, mix, powers, spread

HOT, PART = 512, 96 << 10
_U = np.uint64
_BASE = 0xA0761D6478BD642F
_PLACE = 28
ROWS = "bucket int, block_id long, a binary, b binary"


class _Hashed:
    """Hashes of any pieces of a byte string."""

    def __init__(self, buf: np.ndarray, base: int = _BASE, values: np.ndarray = _BYTE):
        self.p, self.q = powers(base, len(buf) + 1)
        self.h = np.zeros(len(buf) + 1, _U)
        np.cumsum(values[buf] * self.p[: len(buf)], out=self.h[1:])

    def of(self, start, stop) -> np.ndarray:
        return mix((self.h[stop] - self.h[start]) * self.q[start] + (stop - start).astype(_U))

    def all(self, n: int) -> np.ndarray:
        """Those of all pieces of ``n`` bytes."""
        x = self.h[n:] - self.h[:-n]
        x *= self.q[: len(x)]
        x += _U(n)
        return mix(x)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` neighbours."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[: len(x) - width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def leftmost_least(grams: np.ndarray, n: int, most: int = (1 << _PLACE) - 1024) -> np.ndarray:
    """Place of the least of each ``n`` neighbours by their upper bits, the first of equals; taken in parts, since a place has _PLACE bits."""
    out = np.empty(len(grams) - n + 1, np.int64)
    for lo in range(0, len(out), most):
        part = grams[lo : lo + most + n - 1]
        key = part >> _U(_PLACE)
        key <<= _U(_PLACE)
        key |= np.arange(len(part), dtype=_U)
        key = sliding_min(key, n)
        key &= _U((1 << _PLACE) - 1)
        out[lo : lo + most] = key.astype(np.int64) + lo
    return out


class _Block:
    def __init__(self, ids, buf, offs, length):
        self.ids, self.buf, self.offs, self.length = ids, buf, offs, length
        self.hash = _Hashed(buf)
        half = length // 2
        pos, doc = doc_windows(offs, length)
        if not len(pos):
            z = np.zeros(0, np.int64)
            self.s0 = self.s1 = self.at = self.doc = z
            self.anchor = self.text = np.zeros(0, _U)
            return
        grams = self.hash.all(half)
        at = leftmost_least(grams, length - half + 1)[pos]
        new = np.ones(len(pos), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(pos)) - 1
        self.s0, self.s1, self.at, self.doc = pos[first], pos[last], at[first], doc[first]
        self.anchor = mix(grams[self.at])  # anchors are the smallest hashes; buckets need even ones
        self.text = mix(self.hash.of(self.s0, self.s1 + length) + (self.at - self.s0).astype(_U))

    def anchors(self):
        """Sorted distinct anchors, how often each occurs, and each run's index among them."""
        u, back, n = np.unique(self.anchor, return_inverse=True, return_counts=True)
        return u, n, back

    def runs(self, answers, n_buckets):
        """Runs with a repeated anchor, and their distinct (anchor, text): hashes, smallest id, each run's index."""
        u, n, back = self.anchors()
        live = np.flatnonzero((flags(u, n_buckets, answers) | (n > 1))[back]) if len(u) else np.zeros(0, np.int64)
        a, t, key = self.anchor[live], self.text[live], self.ids[self.doc[live]]
        order = np.lexsort((key, t, a))
        new = np.ones(len(order), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (t[order][1:] != t[order][:-1])
        at = order[new]
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        return live, a[at], t[at], key[at], of

    def first_in_row(self, of: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Is it the first of its row that is the same entry?"""
        order = np.lexsort((places, rows, of))
        new = np.ones(len(order), bool)
        new[1:] = (of[order][1:] != of[order][:-1]) | (rows[order][1:] != rows[order][:-1])
        out = np.empty(len(order), bool)
        out[order] = new
        return out

    def open_runs(self, row, n_buckets):
        """What the second answers leave: all runs' state, and the distinct runs that are still open."""
        live, a, t, lo, of = self.runs(row["l1"], n_buckets)
        state = _states(a, n_buckets, row["l2"])
        key = self.ids[self.doc[live]]
        repeat = state[0][of] | (key > lo[of]) | ~self.first_in_row(of, self.doc[live], self.s0[live])
        rep = np.full(len(a), -1)
        stay = np.flatnonzero(~repeat)
        rep[of[stay][::-1]] = live[stay][::-1]
        undecided = np.flatnonzero(state[1] & (rep >= 0))
        hot = state[2][undecided]
        return live, of, repeat, rep, a, lo, undecided[~hot], undecided[hot]

    def windows(self, runs: np.ndarray):
        """Starts of the windows of some runs, and the run's index among them."""
        count = self.s1[runs] - self.s0[runs] + 1
        return spread(self.s0[runs], count), np.repeat(np.arange(len(runs)), count)

    def hot_windows(self, runs: np.ndarray, lo: np.ndarray):
        """Starts of the windows of some runs and the run's index; sorted distinct hashes, the smallest id of each, each window's index among them."""
        pos, of = self.windows(runs)
        h = np.empty(len(pos), PAIR)
        if len(pos):
            other = _Hashed(self.buf, OTHER_BASE, _BYTE[::-1])
            h["h"], h["g"] = (x.of(pos, pos + self.length) for x in (self.hash, other))
        return pos, of, *_distinct(h, lo[of])


def _states(a: np.ndarray, n_buckets: int, answers) -> np.ndarray:
    """Three flags for each entry: earlier elsewhere, undecided, hot."""
    out = np.zeros((3, len(a)), bool)
    got = {x["bucket"]: x["bits"] for x in answers or ()}
    for k, s in lists(a, n_buckets):
        if (bits := got.get(k)) is not None:
            n = s.stop - s.start
            out[:, s] = np.unpackbits(np.frombuffer(bits, np.uint8), count=3 * n).astype(bool).reshape(3, n)
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bucket", "block_id", "a", "b"])


def _ask_anchors(length, n_buckets):
    def run(batches):
        for _, block, ids, buf, offs in opened(batches):
            u = _Block(ids, buf, offs, length).anchors()[0]
            yield _batch([(k, block, squeeze((u[s] & _U(0xFFFFFFFF)).astype(np.uint32)), None) for k, s in lists(u, n_buckets)])

    return run


RUN = np.dtype([("anchor", "<u8"), ("text", "<u8")])


def _ask_runs(length, n_buckets):
    def run(batches):
        for row, block, ids, buf, offs in opened(batches):
            _, a, t, lo, _ = _Block(ids, buf, offs, length).runs(row["l1"], n_buckets)
            pair = np.empty(len(a), RUN)
            pair["anchor"], pair["text"] = a, t
            yield _batch([(k, block, squeeze(pair[s]), squeeze(lo[s])) for k, s in lists(a, n_buckets)])

    return run


def _judge_runs(_bucket: int, rows: list[dict], most: int = HOT) -> list[np.ndarray]:
    pairs = [expand(r["a"], RUN) for r in rows]
    key = np.concatenate([expand(r["b"], np.int64) for r in rows])
    a, t = (np.concatenate([p[c] for p in pairs]) for c in ("anchor", "text"))
    order = np.lexsort((key, t, a))
    a, t, k = a[order], t[order], key[order]
    new_a, new = np.ones(len(a), bool), np.ones(len(a), bool)
    new_a[1:] = a[1:] != a[:-1]
    new[1:] = new_a[1:] | (t[1:] != t[:-1])
    least = k[np.flatnonzero(new)][np.cumsum(new) - 1]
    texts = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_a))[np.cumsum(new_a) - 1]
    state = np.empty((3, len(a)), bool)
    state[:, order] = [least < k, (least == k) & (texts > 1), texts > most]
    edge = np.cumsum([0] + [len(p) for p in pairs])
    return [state[:, x:y].reshape(-1) for x, y in zip(edge[:-1], edge[1:], strict=True)]


ITEM = np.dtype([("anchor", "<u8"), ("key", "<i8"), ("row", "<i4"), ("start", "<i8"), ("count", "<i4")])


def _items(b: _Block, runs: np.ndarray, lo: np.ndarray) -> np.ndarray:
    out = np.empty(len(runs), ITEM)
    out["anchor"], out["key"], out["row"] = b.anchor[runs], lo, b.doc[runs]
    out["start"], out["count"] = b.s0[runs], b.s1[runs] - b.s0[runs] + 1
    return out


def _ask_windows(length, n_buckets):
    def run(batches):
        for row, block, ids, buf, offs in opened(batches):
            b = _Block(ids, buf, offs, length)
            _, _, _, rep, a, lo, cold, hot = b.open_runs(row, n_buckets)
            rows = []
            for k, s in lists(a[cold], n_buckets):
                runs = rep[cold[s]]
                items = _items(b, runs, lo[cold[s]])
                text = buf[spread(b.s0[runs], items["count"] + length - 1)]
                rows.append((k, block, squeeze(items), squeeze(text)))
            _, _, u, least, _ = b.hot_windows(rep[hot], lo[hot])
            rows += [(n_buckets + k, block, squeeze(u[s]), squeeze(least[s])) for k, s in lists(u["h"], n_buckets)]
            yield _batch(rows)

    return run


def _distinct(h: np.ndarray, key: np.ndarray):
    """Sorted distinct hashes, the smallest key of each, and each hash's index."""
    order = np.lexsort((key, h["g"], h["h"]))
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    back = np.empty(len(s), np.int64)
    back[order] = np.cumsum(new) - 1
    return s[new], key[order][new], back


def _judge_windows(length: int, n_buckets: int):
    def judge(bucket: int, rows: list[dict]) -> list[np.ndarray]:
        if bucket >= n_buckets:
            return elsewhere_earlier_pair([expand(r["a"], PAIR) for r in rows], [expand(r["b"], np.int64) for r in rows])
        shards = [expand(r["a"], ITEM) for r in rows]
        edge = np.cumsum([0] + [len(x) for x in shards])
        items = np.concatenate(shards)
        of = np.repeat(np.arange(len(shards)), np.diff(edge))
        text = np.concatenate([expand(r["b"], np.uint8) for r in rows])
        again = repeats(items, of, text, length)
        windows = np.cumsum([0, *items["count"]])
        return [again[windows[x] : windows[y]] for x, y in zip(edge[:-1], edge[1:], strict=True)]

    return judge


def repeats(items: np.ndarray, shard: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """For each window of each run: is there an earlier one among them?

    Runs of different anchors have no window in common, so they are taken in
    parts that fit the processor's cache.
    """
    count = items["count"].astype(np.int64)
    size = count + length - 1
    offs, windows = np.cumsum(size) - size, np.cumsum(count) - count
    out = np.zeros(int(count.sum()), bool)
    order = np.argsort(items["anchor"], kind="stable")
    anchor = items["anchor"][order]
    ends = np.flatnonzero(np.concatenate([anchor[1:] != anchor[:-1], [True]])) + 1 if len(order) else np.zeros(0, np.int64)
    total, lo = np.cumsum(size[order]), 0
    for at, hi in enumerate(ends.tolist()):
        if total[hi - 1] - (total[lo - 1] if lo else 0) < PART and at < len(ends) - 1:
            continue
        part = np.sort(order[lo:hi])
        out[spread(windows[part], count[part])] = _repeats(items[part], shard[part], text[spread(offs[part], size[part])], length)
        lo = hi
    return out


def _repeats(items: np.ndarray, shard: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    size = items["count"].astype(np.int64) + length - 1
    offs = np.concatenate([[0], np.cumsum(size)])
    # blocks share a shard where there are more of them than the merge tells apart
    several = shard.astype(np.int64) * MOST_SHARDS // max(int(shard.max(initial=0)) + 1, MOST_SHARDS)
    before, start, own = transform(text + np.uint8(1), offs, several, length)
    place, group = merge(before, own, length)
    begin = start[place]  # with ends of strings counted
    begins = offs[:-1] + np.arange(len(items))
    of = np.searchsorted(begins, begin, "right") - 1
    off = begin - begins[of]
    good = off < items["count"][of]
    of, off, group = of[good], off[good], group[good]
    key, row, at = items["key"][of], shard[of].astype(np.int64) << 32 | items["row"][of], items["start"][of] + off
    order = np.lexsort((at, row, key, group))
    g, k, r = group[order], key[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = g[1:] != g[:-1]
    least = k[np.flatnonzero(new)][np.cumsum(new) - 1] if len(g) else k
    later = ~new
    later[1:] &= r[1:] == r[:-1]
    out = np.zeros(int(items["count"].sum()), bool)
    window = (np.cumsum(items["count"]) - items["count"])[of] + off
    out[window[order]] = (least < k) | later
    return out


def _finish(length, n_buckets):
    def run(batches):
        for row, _, ids, buf, offs in opened(batches):
            b = _Block(ids, buf, offs, length)
            live, of, repeat, rep, a, lo, cold, hot = b.open_runs(row, n_buckets)
            got = {x["bucket"]: x["bits"] for x in row["l3"] or ()}
            gone = [b.windows(live[repeat])[0]]
            stay = np.flatnonzero(~repeat)
            twin = [live[stay], of[stay]]  # runs that stay, with the entry that answers for them
            said: dict[int, np.ndarray] = {}
            for k, s in lists(a[cold], n_buckets):
                runs = rep[cold[s]]
                count = (b.s1[runs] - b.s0[runs] + 1).tolist()
                bits = got.get(k)
                every = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(count)).astype(bool) if bits is not None else np.zeros(sum(count), bool)
                said.update(zip(cold[s].tolist(), np.split(every, np.cumsum(count)[:-1]), strict=True))
            if len(hot):
                pos, i, u, least, back = b.hot_windows(rep[hot], lo[hot])
                elsewhere = flags(u["h"], n_buckets, [{"bucket": k - n_buckets, "bits": x} for k, x in got.items() if k >= n_buckets])
                again = elsewhere[back] | (least[back] < lo[hot][i]) | ~b.first_in_row(back, b.doc[rep[hot]][i], pos)
                said.update(zip(hot.tolist(), np.split(again, np.cumsum(b.s1[rep[hot]] - b.s0[rep[hot]] + 1)[:-1]), strict=True))
            if said:
                for run_, entry in zip(*(x.tolist() for x in twin), strict=True):
                    if (hit := said.get(entry)) is not None:
                        gone.append(b.s0[run_] + np.flatnonzero(hit))
            dead = covered(len(buf), np.concatenate(gone), length) if len(buf) else np.zeros(0, bool)
            total = np.concatenate([[0], np.cumsum(dead)])
            edge = dead.copy()
            edge[1:] &= ~dead[:-1]
            edge[offs[:-1][offs[:-1] < len(buf)]] = dead[offs[:-1][offs[:-1] < len(buf)]]
            spans = np.concatenate([[0], np.cumsum(edge)])
            kept = buf[~dead]
            at = offs - total[offs]
            texts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(kept)])
            cols = [pa.array(ids, pa.int64(), mask=ids == NO_ID), texts.cast(pa.binary()), *(pa.array(x, pa.int64()) for x in (np.diff(offs), np.diff(total[offs]), np.diff(spans[offs])))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return run


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, hot: int = HOT, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, kept (bytes that stay), n_bytes, n_removed, n_spans.

    A byte goes if a string of ``length`` bytes covers it that also starts
    earlier: in a document with a smaller id, or before it in the same one. An
    anchor with over ``hot`` texts is decided by hashes of its windows.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "suffix")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = scratch.keep(blocks_of(src), "blocks")
    n = buckets_for(blocks)
    one = scratch.keep(answer(blocks.mapInArrow(_ask_anchors(length, n), ROWS), twice, (np.uint32, np.uint8)), "anchors")
    blocks = with_answers(blocks, one, "l1")
    two = scratch.keep(answer_rows(blocks.mapInArrow(_ask_runs(length, n), ROWS), ["a", "b"], partial(_judge_runs, most=hot)), "runs")
    blocks = with_answers(blocks, two, "l2")
    three = scratch.keep(answer_rows(blocks.mapInArrow(_ask_windows(length, n), ROWS), ["a", "b"], _judge_windows(length, n)), "windows")
    blocks = with_answers(blocks, three, "l3")
    return blocks.mapInArrow(_finish(length, n), "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
