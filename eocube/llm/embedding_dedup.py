"""Embedding near-dedup by collision-counting projections.

Vectors of unit length are projected on many random Gaussian directions. On one
of them, two vectors at distance d differ by a normal variable of deviation d,
so a window centred on the query value and ``WIDE`` deviations of the threshold
distance wide on each side catches a true link with a known probability; over
all projections the number of collisions is binomial. Pairs that collide at
least ``least_collisions`` times are verified with the full vectors in double
precision; the count is calibrated so that a link at the threshold reaches it
with probability ``recall``.

Vectors of one label are sorted by the first projection and cut into blocks.
Blocks whose intervals are farther apart than a difference of projections can
be (Cauchy-Schwarz) never meet. Two blocks that meet are counted on projections
alone: each projection is sorted, every vector's window is an interval of that
order, and intervals add up to counts. Vectors are sent only to pairs of blocks
with candidates, once. Equal vectors are one representative with a
multiplicity, so a common vector costs no more than a rare one, and a task
returns counts and a spanning forest of its links, never all pairs of a group.
Work within a label still grows with the square of its blocks.

Defined results: a vector that is null, empty, zero or has a null or non-finite
component, or whose label is null, has no link; vectors of any finite size are
compared, since they are scaled by a power of two first; a block has fewer of
very long vectors (BLOCK_BYTES in all); vectors of different lengths
are never compared; rows that repeat both id and vector count once as a partner;
a row with a null id is returned alone (component null, kept).
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, local_stars
from .scratch import Scratch
from .text import tidy

PROJECTIONS = 24
WIDE = 3.3
ROWS, BLOCK_BYTES = 1024, 8 << 20


def directions(dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(dim)).standard_normal((dim, PROJECTIONS))


def least_collisions(recall: float) -> int:
    """The largest count that a link at the threshold reaches with probability ``recall``."""
    p = math.erf(WIDE / math.sqrt(2))
    tail, n = 0.0, PROJECTIONS
    for k in range(n, -1, -1):
        tail += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if tail >= recall:
            return k
    return 0


def _parse(batches):
    for b in batches:
        out = []
        vecs = b.column("vec")
        offs = vecs.offsets.to_numpy()
        flat = vecs.values.cast(pa.float64())
        bad = ~np.isfinite(flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
        values = np.where(bad, 0.0, flat.fill_null(0.0).to_numpy(zero_copy_only=False)) + 0.0
        for i in range(b.num_rows):
            v = values[offs[i] : offs[i + 1]]
            ok = vecs.is_valid()[i].as_py() if vecs.null_count else True
            out.append(v.tobytes() if ok and len(v) and v.any() and not bad[offs[i] : offs[i + 1]].any() else None)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(out, pa.binary())], ["vec_id", "label", "vec"])


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows with a largest component of about 1: exact, and no square of it overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _project(batches):
    """The projections of each representative."""
    for b in batches:
        vecs = [np.frombuffer(x, np.float64) for x in b.column("vec").to_pylist()]
        dims = np.array([len(v) for v in vecs], np.int32)
        proj, first = [b""] * len(vecs), np.zeros(len(vecs))
        for dim in np.unique(dims).tolist():
            some = np.flatnonzero(dims == dim)
            x = scaled(np.stack([vecs[i] for i in some]))
            x = (x / np.linalg.norm(x, axis=1, keepdims=True) @ directions(dim)).astype(np.float32)
            first[some] = x[:, 0]
            for i, row in zip(some.tolist(), x, strict=True):
                proj[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims), pa.array(first), pa.array(proj, pa.binary())], [*b.schema.names, "dim", "p", "proj"])
        tidy()


def _cut(most: int):
    """Sorted rows as blocks of ``most`` vectors of one label and length."""
    names = ["label", "dim", "rep", "n", "p", "vec", "proj"]

    def block(seq, rows):
        part = TaskContext.get().partitionId()
        own = dict(zip(names, zip(*rows, strict=True), strict=True))
        proj = np.ascontiguousarray(np.frombuffer(b"".join(own["proj"]), np.float32).reshape(len(rows), -1).T)
        cols = [[(part << 32) | seq], [own["label"][0]], [own["dim"][0]], [own["p"][0]], [own["p"][-1]], [np.array(own["rep"], np.int64).tobytes()], [np.array(own["n"], np.int64).tobytes()], [b"".join(own["vec"])], [proj.tobytes()]]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["block_id", "label", "dim", "lo", "hi", "ids", "copies", "vecs", "proj"])

    def run(batches):
        seq, held = 0, []
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                if held and (len(held) >= min(most, max(1, BLOCK_BYTES // (8 * held[0][1]))) or held[0][:2] != r[:2]):
                    yield block(seq, held)
                    seq, held = seq + 1, []
                held.append(r)
        if held:
            yield block(seq, held)

    return run


def candidates(x: np.ndarray, y: np.ndarray, half: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of columns of ``x`` and ``y`` [projection, vector] that collide at least ``least`` times."""
    count = np.zeros((y.shape[1], x.shape[1]), np.uint8)
    rank = np.empty(y.shape[1], np.uint16)
    for a, b in zip(x, y, strict=True):
        order = np.argsort(b, kind="stable")
        s = b[order]
        rank[order] = np.arange(len(s), dtype=np.uint16)
        lo = np.searchsorted(s, a - half).astype(np.uint16)  # a window is the interval of ranks from lo on
        wide = np.searchsorted(s, a + half, "right").astype(np.uint16) - lo
        count += (np.subtract.outer(rank, lo) < wide).view(np.uint8)  # ranks before lo wrap round to large numbers
    j, i = np.nonzero(count >= least)
    return i, j


PACKED = np.dtype([("i", "<u2"), ("j", "<u2")])


def _collide(half: float, least: int):
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = {c: b.column(c)[k].as_py() for c in b.schema.names}
                x, y = (np.frombuffer(row[f"proj{s}"], np.float32).reshape(PROJECTIONS, -1) for s in "ab")
                i, j = candidates(x, y, half, least)
                if row["block_a"] == row["block_b"]:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    pairs = np.empty(len(i), PACKED)
                    pairs["i"], pairs["j"] = i, j
                    yield pa.RecordBatch.from_arrays([pa.array([row["block_a"]], pa.int64()), pa.array([row["block_b"]], pa.int64()), pa.array([row["dim"]], pa.int32()), pa.array([pairs.tobytes()], pa.binary())], ["block_a", "block_b", "dim", "pairs"])
            tidy()

    return run


def _verify(cosine: float):
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = {c: b.column(c)[k].as_py() for c in b.schema.names}
                ids = [np.frombuffer(row[f"ids{s}"], np.int64) for s in "ab"]
                copies = [np.frombuffer(row[f"copies{s}"], np.int64) for s in "ab"]
                raw = [scaled(np.frombuffer(row[f"vecs{s}"], np.float64).reshape(-1, row["dim"])) for s in "ab"]
                norm = [np.linalg.norm(v, axis=1) for v in raw]
                pairs = np.frombuffer(row["pairs"], PACKED)
                i, j = pairs["i"].astype(np.int64), pairs["j"].astype(np.int64)
                links, step = [], max(1, BLOCK_BYTES // (8 * row["dim"]))
                for s in range(0, len(i), step):
                    p, q = i[s : s + step], j[s : s + step]
                    links.append(np.einsum("ij,ij->i", raw[0][p], raw[1][q]) / (norm[0][p] * norm[1][q]) >= cosine)
                good = np.concatenate(links)
                i, j = i[good], j[good]
                add = [np.bincount(i, copies[1][j], len(ids[0])), np.bincount(j, copies[0][i], len(ids[1]))]
                stars = local_stars(np.stack([ids[0][i], ids[1][j]], 1))
                u, v, n = [stars[:, 0]], [stars[:, 1]], [np.zeros(len(stars))]
                for own, c in zip(ids, add, strict=True):
                    some = np.flatnonzero(c)
                    u, v, n = [*u, own[some]], [*v, own[some]], [*n, c[some]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u), pa.int64()), pa.array(np.concatenate(v), pa.int64()), pa.array(np.concatenate(n).astype(np.int64), pa.int64())], ["u", "v", "n"])
            tidy()

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = 0.93, recall: float = 0.9999, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other vectors linked directly), component_id, kept."""
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark, "embedding")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    parsed = scratch.keep(src.mapInArrow(_parse, "vec_id long, label long, vec binary").withColumn("key", F.when(F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.sha2("vec", 256))), "parsed")
    good = parsed.where("key is not null").groupBy("label", "key", "vec_id").agg(F.first("vec").alias("vec"))
    classes = scratch.keep(good.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.first("vec").alias("vec"), F.count("*").alias("n")), "classes")
    first = classes.select("rep", "label", "vec", "n").mapInArrow(_project, "rep long, label long, vec binary, n long, dim int, p double, proj binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "dim", "p", "rep"]
    blocks = scratch.keep(first.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_cut(ROWS), "block_id long, label long, dim int, lo double, hi double, ids binary, copies binary, vecs binary, proj binary"), "blocks")
    meta = blocks.select("block_id", "label", "dim", "lo", "hi")
    a, b = (meta.select(F.col("block_id").alias(f"block_{s}"), "label", "dim", F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}")) for s in "ab")
    # no Gaussian direction is longer than this, so no true link is lost
    longest = (F.sqrt(F.col("dim")) + 8) * math.sqrt(2 - 2 * cosine)
    met = a.join(b, ["label", "dim"]).where((F.col("block_a") <= F.col("block_b")) & (F.col("lo_b") - F.col("hi_a") <= longest) & (F.col("lo_a") - F.col("hi_b") <= longest)).select("block_a", "block_b", "dim")
    both = lambda pairs, names: reduce(lambda rows, s: rows.join(blocks.select(F.col("block_id").alias(f"block_{s}"), *(F.col(c).alias(f"{c}{s}") for c in names)), f"block_{s}"), "ab", pairs)
    half = WIDE * math.sqrt(2 - 2 * cosine) + 1e-5  # projections are single precision
    pairs = scratch.keep(both(met, ["proj"]).mapInArrow(_collide(half, least_collisions(recall)), "block_a long, block_b long, dim int, pairs binary"), "pairs")
    found = scratch.keep(both(pairs, ["ids", "copies", "vecs"]).mapInArrow(_verify(cosine), "u long, v long, n long"), "found")
    members = parsed.where("key is not null").select("vec_id", "label", "key").distinct().join(classes.select("label", "key", "rep", "n"), ["label", "key"])
    members = scratch.keep(members.select("vec_id", "rep", "n"), "members")
    direct = found.where("u = v").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("direct"))
    found = found.where("u <> v").select("u", "v").unionByName(members.where("vec_id <> rep").select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    tied = components(found, scratch).withColumnRenamed("node", "vec_id")
    each = members.join(direct, "rep", "left").groupBy("vec_id").agg(F.sum(F.col("n") - 1 + F.coalesce("direct", F.lit(0))).alias("n_links"))
    out = parsed.select("vec_id").join(each, "vec_id", "left").join(tied, "vec_id", "left")
    own = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"))
