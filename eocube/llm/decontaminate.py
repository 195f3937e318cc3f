"""Benchmark decontamination with a distributed positional inverted index.

The training texts are indexed once: a shard is a block of documents, with its
terms, their counts and all their positions, delta coded and compressed. Test
phrases are looked up shard by shard: the positions of a phrase's rarest term
(by its count over all shards), shifted by the term's place in the phrase, are
the candidate starts, and the shifted lists of the next rarest terms are
intersected with them until one is empty or all terms are through. With a slop,
a term may be that many places away: proximity matches.

The test side is read in groups of GROUP_CHARS characters (one item at least),
each broadcast in its turn as the hashes of its words and nothing else, so a
benchmark of any size is searched whole; shards never move. Work is that of the
index times the number of groups.

Defined results: a null text has no words; an item without words is no phrase;
items that repeat an id are one item, those without an id one item whose name is
null; a null document id stays null, and each row of the documents gives one
row. A document is never cut: a very long one must fit a worker, with some forty
bytes for each of its bytes; an item is collected whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, expand, squeeze
from .scratch import Scratch
from .text import ALNUM, LOWER, NO_ID, documents, spread, tidy, word_hashes, words

SHARD = "block_id long, ids binary, first binary, terms binary, counts binary, places binary"
GROUP_CHARS, PHRASES = 8 << 20, 1 << 14
_U = np.uint64


def _index(batches):
    part = TaskContext.get().partitionId()
    for seq, (ids, buf, offs) in enumerate(documents(batches, most=BLOCK_BYTES)):
        block, buf = (part << 32) | seq, LOWER[buf]
        starts, ends, first = words(buf, offs, ALNUM)
        w = word_hashes(buf, starts, ends)
        order = np.argsort(w, kind="stable")
        s = w[order]
        at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        gaps = np.diff(order, prepend=0).astype(np.int32)
        cols = [ids, first, s[at], np.diff(at, append=len(s)).astype(np.int32), gaps]
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *(pa.array([squeeze(c)], pa.binary()) for c in cols)], ["block_id", "ids", "first", "terms", "counts", "places"])


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs(doc_id, text)``, a row for each shard; store it before it is searched."""
    return docs.select("doc_id", "text").mapInArrow(_index, SHARD)


class Shard:
    def __init__(self, row: dict):
        self.ids, self.first = expand(row["ids"], np.int64), expand(row["first"], np.int64)
        self.terms = expand(row["terms"], _U)
        self.counts = expand(row["counts"], np.int32).astype(np.int64)
        self.places = np.cumsum(expand(row["places"], np.int32).astype(np.int64))
        self.begin = np.cumsum(self.counts) - self.counts
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64) << 40, self.counts) + self.places

    def number(self, terms: np.ndarray) -> np.ndarray:
        """This shard's number of each term, -1 where it has none."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def search(self, number: np.ndarray, order: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, start, document) of all matches of phrases of one length, given by this shard's ``number`` of each term; ``order``: their terms' places, rarest first."""
        n = number.shape[1]
        which = np.flatnonzero((number >= 0).all(1))
        lead = order[which, 0]
        term = number[which, lead]
        size = self.counts[term] if len(which) else np.zeros(0, np.int64)
        start = self.places[spread(self.begin[term] if len(which) else size, size)] - np.repeat(lead, size)
        which = np.repeat(which, size)
        doc = np.searchsorted(self.first, start + order[which, 0], "right") - 1
        lo, hi = self.first[doc], self.first[doc + 1] if len(doc) else self.first[doc]
        good = (start >= lo) & (start + n <= hi) if not slop else np.ones(len(start), bool)
        which, start, doc, lo, hi = which[good], start[good], doc[good], lo[good], hi[good]
        for k in range(1, n):
            if not len(which):
                break
            off = order[which, k]
            term = number[which, off] << 40
            least, most = np.maximum(start + off - slop, lo), np.minimum(start + off + slop, hi - 1)
            at = np.searchsorted(self.keys, term + least)
            good = (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= term + most) & (least <= most)
            which, start, doc, lo, hi = which[good], start[good], doc[good], lo[good], hi[good]
        return which, start, doc


class Group:
    """A part of the test side: hashes of its items' words, one item after another."""

    def __init__(self, names: list[str | None], texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        buf = LOWER[np.frombuffer(b"".join(raw), np.uint8)] if any(raw) else np.zeros(0, np.uint8)
        starts, ends, self.first = words(buf, np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64), ALNUM)
        self.terms, self.of = np.unique(word_hashes(buf, starts, ends) if len(buf) else np.zeros(0, _U), return_inverse=True)
        self.of = self.of.astype(np.int32)
        self.names, self.count = names, np.zeros(len(self.terms), np.int64)

    def phrases(self, window: int) -> Iterator[tuple[int, np.ndarray]]:
        """(length, begins) of all phrases: each run of ``window`` words of an item, or a shorter item as it is."""
        size = np.diff(self.first)
        for n in np.unique(np.minimum(size, window)).tolist():
            if n:
                count = np.where(size >= window, size - n + 1, 1) if n == window else np.ones(len(size), np.int64)
                own = np.minimum(size, window) == n
                begin = spread(self.first[:-1][own], count[own])
                for lo in range(0, len(begin), PHRASES):
                    yield n, begin[lo : lo + PHRASES]


def _counts(shared):
    def run(batches):
        terms = shared.value
        total = np.zeros(len(terms), np.int64)
        for b in batches:
            for raw, n in zip(b.column("terms").to_pylist(), b.column("counts").to_pylist(), strict=True):
                own, n = expand(raw, _U), expand(n, np.int32)
                if len(own):
                    at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                    total += np.where(own[at] == terms, n[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["at", "n"])

    return run


def _hits(shared, window: int, slop: int):
    def run(batches):
        group = shared.value
        for b in batches:
            for row in b.to_pylist():
                shard = Shard(row)
                docs = len(shard.ids)
                begin, size, doc, item = [], [], [], []
                number = shard.number(group.terms)
                known = np.concatenate([[0], np.cumsum(number[group.of] >= 0)])
                for n, at in group.phrases(window):
                    at = at[known[at + n] - known[at] == n]  # all of its terms are here
                    if not len(at):
                        continue
                    terms = group.of[at[:, None] + np.arange(n)]
                    which, start, own = shard.search(number[terms], np.argsort(group.count[terms], axis=1, kind="stable"), slop)
                    begin.append(start)
                    size.append(np.full(len(start), n))
                    doc.append(own)
                    item.append(np.searchsorted(group.first, at[which], "right") - 1)
                begin, size, doc, item = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (begin, size, doc, item))
                total = int(shard.first[-1])
                step = np.bincount(np.clip(begin, 0, total), minlength=total + 1) - np.bincount(np.clip(begin + size, 0, total), minlength=total + 1)
                hit = np.concatenate([[False], np.cumsum(step[:-1]) > 0, [False]])
                hit_at = [[] for _ in range(docs)]
                edge = np.unique(np.concatenate([np.flatnonzero(hit[1:] != hit[:-1]), shard.first]))
                lo = edge[:-1][hit[1:][edge[:-1]]] if len(edge) > 1 else np.zeros(0, np.int64)
                hi = edge[1:][hit[1:][edge[:-1]]] if len(edge) > 1 else lo
                for d, x, y in zip((np.searchsorted(shard.first, lo, "right") - 1).tolist(), lo.tolist(), hi.tolist(), strict=True):
                    hit_at[d].append({"begin": x - int(shard.first[d]), "stop": y - int(shard.first[d])})
                found: list[set[str | None]] = [set() for _ in range(docs)]
                for d, x in np.unique(np.stack([doc, item], 1), axis=0).tolist():
                    found[d].add(group.names[x])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block_id"]] * docs, pa.int64()),
                        pa.array(range(docs), pa.int32()),
                        pa.array(shard.ids, pa.int64(), mask=shard.ids == NO_ID),
                        pa.array(np.diff(shard.first), pa.int64()),
                        pa.array(hit_at, pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))),
                        pa.array([list(x) for x in found], pa.list_(pa.string())),
                    ],
                    ["block_id", "place", "doc_id", "n_words", "spans", "items"],
                )
                del shard
            tidy()

    return run


def covered_words(spans: Column) -> Column:
    """How many places sorted spans cover, overlaps once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    step = lambda a, s: F.struct((a["n"] + F.greatest(s["stop"] - F.greatest(s["begin"], a["upto"]), F.lit(0).cast("long"))).alias("n"), F.greatest(a["upto"], s["stop"]).alias("upto"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda a: a["n"])


def search(index: DataFrame, items: DataFrame, window: int = 13, slop: int = 0) -> DataFrame:
    """For each indexed document: doc_id, n_words, spans (word places hit), items (names of those with a match).

    ``items(item_id, text)``: each run of ``window`` words is a phrase, a shorter item is one phrase.
    """
    spark = index.sparkSession
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    groups = -(-int(size) // GROUP_CHARS) or 1
    parts = []
    for g in range(groups):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).select(F.col("item_id").cast("string"), "text").collect()
        group = Group([r[0] for r in own], [r[1] for r in own])
        if len(group.terms):
            shared = spark.sparkContext.broadcast(group.terms)
            for r in index.select("terms", "counts").mapInArrow(_counts(shared), "at long, n long").groupBy("at").agg(F.sum("n")).collect():
                group.count[r[0]] = r[1]
        parts.append(index.mapInArrow(_hits(spark.sparkContext.broadcast(group), window, slop), "block_id long, place int, doc_id long, n_words long, spans array<struct<begin:bigint,stop:bigint>>, items array<string>"))
    if groups == 1:
        return parts[0].drop("block_id", "place")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    merged = every.groupBy("block_id", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return merged.drop("block_id", "place")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, share: int = 20, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, contaminated (n_hit > 0 and share * n_hit >= n_words)."""
    scratch = scratch or Scratch(docs.sparkSession, "index")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    index = scratch.keep(build_index(src), "shards")
    out = search(index, items.select("item_id", F.col("text").cast("string").alias("text")), window).withColumn("n_hit", covered_words(F.col("spans")))
    return out.select("doc_id", "n_words", "n_hit", F.array_sort("items").alias("items"), ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
