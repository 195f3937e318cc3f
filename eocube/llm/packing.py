"""Best-fit packing with a grouping genetic algorithm on islands.

A document's ids and an end id are cut only where they exceed a sequence; full
pieces are sequences already. The other pieces are dealt into groups of a few
thousand. Each group is packed by several islands: a chromosome is a list of
bins, crossover injects well-filled bins of one parent whole into the other,
bins that hold the same pieces are dissolved, and displaced pieces are best-fit,
largest first. After an epoch each island's elite moves to the next island.
Groups at the lower bound leave the evolution at once.

Well-filled bins of a group are final; the pieces of its other bins are dealt
anew with those of the other groups, until one group is left. So the waste is
that of a few bins in all and no task sees more than a group.

Defined results: a null or empty text is the end id alone; a null id stays null;
rows that repeat an id are packed each; more than one sequence may not be saved
for certain, the algorithm is a heuristic.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import NO_ID, documents
from .tokens import tokenizer

GROUP, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 2048, 3, 2, 5, 8
ITEM = np.dtype([("doc", "<i8"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])
PIECES = "doc_id long, piece int, start long, length int, crc long"
GROUPS = "grp long, items binary, best binary, done boolean"


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches):
        for docs, buf, offs in documents(batches):
            rows = []
            ids, at = tokenizer(path).encode(buf, offs)
            for d, s, e in zip(docs.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = np.append(ids[s:e], np.uint32(end_id)).astype("<u4")
                for k, lo in enumerate(range(0, len(own), capacity)):
                    part = own[lo : lo + capacity]
                    rows.append((None if d == NO_ID else d, k, lo, len(part), zlib.crc32(part.tobytes())))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "crc"])

    return run


class Bins:
    """Open bins by free space; the tightest that fits is found with one bit operation."""

    def __init__(self, capacity: int):
        self.capacity, self.mask, self.at = capacity, 0, [[] for _ in range(capacity + 1)]

    def add(self, items: list[int], free: int) -> None:
        self.at[free].append(items)
        self.mask |= 1 << free

    def fit(self, item: int, size: int) -> None:
        ahead = self.mask >> size
        if not ahead:
            self.add([item], self.capacity - size)
            return
        free = size + (ahead & -ahead).bit_length() - 1
        items = self.at[free].pop()
        if not self.at[free]:
            self.mask ^= 1 << free
        items.append(item)
        self.add(items, free - size)

    def all(self) -> list[list[int]]:
        return [items for row in self.at for items in row]


def best_fit(bins: list[list[int]], loose: list[int], size: list[int], capacity: int) -> list[list[int]]:
    """``loose`` items, largest first, into the tightest of ``bins`` or new ones."""
    open_ = Bins(capacity)
    for b in bins:
        open_.add(list(b), capacity - sum(size[i] for i in b))
    for i in sorted(loose, key=lambda i: -size[i]):
        open_.fit(i, size[i])
    return open_.all()


def fitness(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    return -len(bins), sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(a: list[list[int]], b: list[list[int]], size: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Whole well-filled bins of ``b`` go into ``a``; what they displace is best-fitted."""
    full = sorted(b, key=lambda x: -sum(size[i] for i in x))
    full = full[: max(1, len(full) * 3 // 4)]
    lo = rng.randrange(len(full))
    injected = full[lo : lo + max(1, len(full) // 4)]
    taken = {i for x in injected for i in x}
    keep = [x for x in a if taken.isdisjoint(x)]
    loose = [i for x in a if not taken.isdisjoint(x) for i in x if i not in taken]
    return best_fit(keep + injected, loose, size, capacity)


def mutate(a: list[list[int]], size: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """The emptiest bins and a few others are dissolved."""
    order = sorted(a, key=lambda x: sum(size[i] for i in x))
    worst, rest = order[:2], order[2:]
    rng.shuffle(rest)
    gone = worst + rest[: max(1, len(rest) // 20)]
    loose = [i for x in gone for i in x]
    rng.shuffle(loose)
    return best_fit(rest[max(1, len(rest) // 20) :], loose, size, capacity)


def lower_bound(size: list[int], capacity: int) -> int:
    return max(-(-sum(size) // capacity), sum(s > capacity // 2 for s in size))


def evolve(size: list[int], capacity: int, seeds: list[list[list[int]]], seed: int) -> list[list[int]]:
    """One epoch of one island: its elite."""
    rng, least = random.Random(seed), lower_bound(size, capacity)
    people = seeds or [best_fit([], list(range(len(size))), size, capacity)]
    key = lambda p: fitness(p, size, capacity)
    best = max(people, key=key)
    if len(best) <= least:
        return best
    while len(people) < POPULATION:
        people.append(mutate(rng.choice(people), size, capacity, rng))
    for _ in range(GENERATIONS):
        a, b = rng.sample(people, 2)
        child = crossover(a, b, size, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, size, capacity, rng)
        people[min(range(len(people)), key=lambda i: key(people[i]))] = child
        best = max(best, child, key=key)
        if len(best) <= least:
            break
    return best


def _as_bins(raw: bytes) -> list[list[int]]:
    of = np.frombuffer(raw, np.int32)
    out: list[list[int]] = [[] for _ in range(int(of.max(initial=-1)) + 1)]
    for i, k in enumerate(of.tolist()):
        out[k].append(i)
    return out


def _as_bytes(bins: list[list[int]], n: int) -> bytes:
    of = np.empty(n, np.int32)
    for k, b in enumerate(bins):
        of[b] = k
    return of.tobytes()


def _items(b: pa.RecordBatch) -> np.ndarray:
    out = np.empty(b.num_rows, ITEM)
    out["doc"] = b.column("doc_id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    for name, col in (("piece", "piece"), ("start", "start"), ("length", "length"), ("crc", "crc")):
        out[name] = b.column(col).to_numpy(zero_copy_only=False)
    return out


def _group(capacity: int):
    """Pieces as groups, each with its first packing."""

    def run(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, np.zeros(0, ITEM)

        def row(items):
            nonlocal seq
            seq += 1
            size = items["length"].tolist()
            bins = best_fit([], list(range(len(size))), size, capacity)
            done = len(bins) <= lower_bound(size, capacity)
            return pa.RecordBatch.from_arrays([pa.array([(part << 20) | seq], pa.int64()), pa.array([items.tobytes()], pa.binary()), pa.array([_as_bytes(bins, len(size))], pa.binary()), pa.array([done])], ["grp", "items", "best", "done"])

        for b in batches:
            held = np.concatenate([held, _items(b)])
            while len(held) >= GROUP:
                yield row(held[:GROUP])
                held = held[GROUP:]
        if len(held):
            yield row(held)

    return run


def _island(capacity: int, epoch: int):
    def run(batches):
        for b in batches:
            best, rest = [], {c: b.column(c).to_pylist() for c in ("grp", "island", "items", "best", "migrant")}
            for g, k, items, own, migrant in zip(*rest.values(), strict=True):
                size = np.frombuffer(items, ITEM)["length"].tolist()
                seeds = [_as_bins(own)] + ([_as_bins(migrant)] if migrant else [])
                best.append(_as_bytes(evolve(size, capacity, seeds, hash((g, k, epoch))), len(size)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("grp", "island", "items")), pa.array(best, pa.binary()), pa.array([int(np.frombuffer(x, np.int32).max()) + 1 for x in best], pa.int32())], ["grp", "island", "items", "best", "bins"])

    return run


def _settle(capacity: int, level: int, last: bool):
    """Pieces of groups with their sequence; bins that aren't well filled only on the last level (sequence null otherwise)."""
    enough = capacity - capacity // 200

    def run(batches):
        for b in batches:
            for g, raw, best in zip(b.column("grp").to_pylist(), b.column("items").to_pylist(), b.column("best").to_pylist(), strict=True):
                items, of = np.frombuffer(raw, ITEM), np.frombuffer(best, np.int32)
                order = np.argsort(of, kind="stable")
                items, of = items[order], of[order].astype(np.int64)
                size = items["length"].astype(np.int64)
                fill = np.bincount(of, size).astype(np.int64)
                offset = np.cumsum(size) - size - (np.cumsum(fill) - fill)[of]
                loose = (fill[of] < enough) & (not last)
                cols = [pa.array(items["doc"], mask=items["doc"] == NO_ID), *(pa.array(items[c]) for c in ("piece", "start", "length")), pa.array(items["crc"].astype(np.int64)), pa.array((level << 56) | (g << 12) | of, mask=loose), pa.array(offset)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "crc", "sequence_id", "offset"])

    return run


def _full(batches):
    part, seq = TaskContext.get().partitionId(), 0
    for b in batches:
        ids = np.arange(seq, seq + b.num_rows, dtype=np.int64) | (part << 32) | (120 << 56)
        seq += b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids), pa.array(np.zeros(b.num_rows, np.int64))], [*b.schema.names, "sequence_id", "offset"])


def _islands(groups: DataFrame, capacity: int, scratch: Scratch, name: str) -> DataFrame:
    """The best packing that the islands found for each group that isn't at its lower bound."""
    rows = groups.where("not done").select("grp", F.explode(F.array([F.lit(i) for i in range(ISLANDS)])).alias("island"), "items", "best", F.lit(None).cast("binary").alias("migrant"))
    for epoch in range(EPOCHS):
        rows = rows.repartition(F.col("grp"), F.col("island"))
        rows = scratch.keep(rows.mapInArrow(_island(capacity, epoch), "grp long, island int, items binary, best binary, bins int"), f"{name}_{epoch}")
        if epoch < EPOCHS - 1:
            elite = rows.select("grp", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("best").alias("migrant"))
            rows = rows.join(elite, ["grp", "island"])
    return rows.groupBy("grp").agg(F.min_by("best", F.struct("bins", "island")).alias("better"))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, scratch: Scratch | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    scratch = scratch or Scratch(docs.sparkSession, "packing")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = scratch.keep(src.mapInArrow(_pieces(tokenizer_path, capacity, end_id), PIECES), "pieces")
    whole = f"{PIECES}, sequence_id long, offset long"
    out = pieces.where(F.col("length") == capacity).mapInArrow(_full, whole)
    pool = pieces.where(F.col("length") < capacity)
    level, before = 0, None
    while True:
        left = pool.count()
        if not left:
            break
        last = left <= GROUP or (level > 1 and 10 * left > 9 * before)  # level 1 is the first that is mixed
        if left <= GROUP:
            pool = pool.coalesce(1)
        elif level:
            pool = pool.repartition(max(1, left // (4 * GROUP)))
        groups = scratch.keep(pool.mapInArrow(_group(capacity), GROUPS), f"groups{level}")
        if groups.where("not done").limit(1).count():
            better = scratch.keep(_islands(groups, capacity, scratch, f"islands{level}"), f"better{level}")
            groups = groups.join(better, "grp", "left").withColumn("best", F.coalesce("better", "best")).drop("better")
        settled = scratch.keep(groups.select("grp", "items", "best").mapInArrow(_settle(capacity, level, last), whole), f"settled{level}")
        out = out.unionByName(settled.where("sequence_id is not null"))
        pool, before, level = settled.where("sequence_id is null").drop("sequence_id", "offset"), left, level + 1
        if last:
            break
    return out.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "sequence_id", "offset")
