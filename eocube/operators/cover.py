"""Zones as cells of a tree: those wholly inside, and those on the edge with the few sides that matter there.

A zone is cut into squares of 256 pixels on a side. One that no side of the zone
meets lies inside or outside as a whole. One that has too many sides is cut into
sixteen, down to four pixels. What a square on the edge carries is enough for the
exact test of any pixel in it: the sides that meet it, those to its left that begin
or end beside it, and whether the number of the others to its left is odd.

A small zone of few sides isn't cut: the smallest squares of which it meets at most
two by two carry all its sides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from .regions import stored

#: Pixels on a side of the squares of each level.
SIDES = (4, 16, 64, 256)
#: Sides of a zone that a square may carry before it is cut; of one small zone, up to MORE.
FEW, MORE = 16, 64
ROWS = 4096


def _near(e: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """Which sides (x1, y1, x2, y2) meet the closed box?"""
    xlo, ylo, xhi, yhi = box
    x1, y1, x2, y2 = e.T
    apart = (np.maximum(x1, x2) < xlo) | (np.minimum(x1, x2) > xhi) | (np.maximum(y1, y2) < ylo) | (np.minimum(y1, y2) > yhi)
    side = np.stack([(x2 - x1) * (b - y1) - (y2 - y1) * (a - x1) for a in (xlo, xhi) for b in (ylo, yhi)])
    return ~apart & (side.min(0) <= 0) & (side.max(0) >= 0)


def squares(edges: np.ndarray, dx: float, dy: float, hx: float = 0.0, hy: float = 0.0) -> Iterator[tuple[int, int, int, bool, bool, np.ndarray]]:
    """(level, column, row, whole, odd, sides) of each square of a zone; ``hx``, ``hy``: how far a pixel reaches."""
    if not len(edges):
        return
    xs, ys = edges[:, [0, 2]], edges[:, [1, 3]]
    slack = 1e-9 * max(1.0, float(np.abs(edges).max()))  # sides that only just miss a square count as meeting it
    hx, hy = hx + slack, hy + slack

    def beside(e, ylo, yhi):
        return e[(np.minimum(e[:, 1], e[:, 3]) <= yhi + hy) & (np.maximum(e[:, 1], e[:, 3]) >= ylo - hy)]

    def square(level, i, j, e):
        w, h = SIDES[level] * dx, SIDES[level] * dy
        xlo, xhi, ylo, yhi = i * w, (i + 1) * w, j * h, (j + 1) * h
        if not _near(e, (xlo - hx, ylo - hy, xhi + hx, yhi + hy)).any():
            x, y = (xlo + xhi) / 2, (ylo + yhi) / 2
            across = (e[:, 1] <= y) != (e[:, 3] <= y)
            c = e[across]
            if np.count_nonzero(c[:, 0] + (y - c[:, 1]) * (c[:, 2] - c[:, 0]) / (c[:, 3] - c[:, 1]) < x) % 2:
                yield level, i, j, True, False, e[:0]
            return
        here = e[np.minimum(e[:, 0], e[:, 2]) <= xhi + hx]
        past = (np.maximum(here[:, 0], here[:, 2]) < xlo - hx) & (np.minimum(here[:, 1], here[:, 3]) < ylo - hy) & (np.maximum(here[:, 1], here[:, 3]) > yhi + hy)
        if level == 0 or len(here) - np.count_nonzero(past) <= FEW:
            yield level, i, j, False, bool(np.count_nonzero(past) % 2), here[~past]
            return
        k = SIDES[level] // SIDES[level - 1]
        for jj in range(j * k, (j + 1) * k):
            low = jj * SIDES[level - 1] * dy
            own = beside(e, low, low + SIDES[level - 1] * dy)
            for ii in range(i * k, (i + 1) * k):
                yield from square(level - 1, ii, jj, own)

    top = len(SIDES) - 1
    w, h = SIDES[top] * dx, SIDES[top] * dy
    for j in range(int(np.floor((ys.min() - hy) / h)), int(np.floor((ys.max() + hy) / h)) + 1):
        own = beside(edges, j * h, (j + 1) * h)
        for i in range(int(np.floor((xs.min() - hx) / w)), int(np.floor((xs.max() + hx) / w)) + 1):
            yield from square(top, i, j, own)


def _small(zones: DataFrame, dx: float, dy: float, hx: float, hy: float) -> DataFrame:
    """Zones with their boxes ``_b`` and ``_level``, that of the smallest squares that carry all sides; null where the zone is to be cut."""
    least = lambda c: F.array_min(F.transform("edges", lambda e: F.least(e[f"{c}1"], e[f"{c}2"])))
    most = lambda c: F.array_max(F.transform("edges", lambda e: F.greatest(e[f"{c}1"], e[f"{c}2"])))
    out = zones.select("zone", "edges", F.struct(least("x").alias("xlo"), most("x").alias("xhi"), least("y").alias("ylo"), most("y").alias("yhi")).alias("_b"))
    slack = 1e-9 * F.greatest(F.lit(1.0), *(F.abs(f"_b.{c}") for c in ("xlo", "xhi", "ylo", "yhi")))
    ends = (F.col("_b.xlo") - hx - slack, F.col("_b.xhi") + hx + slack, F.col("_b.ylo") - hy - slack, F.col("_b.yhi") + hy + slack)
    out = out.withColumn("_b", F.struct(*(e.alias(c) for e, c in zip(ends, ("xlo", "xhi", "ylo", "yhi"), strict=True))))
    level = F.lit(None).cast("int")
    for k in reversed(range(len(SIDES))):
        near = (F.floor(F.col("_b.xhi") / (SIDES[k] * dx)) - F.floor(F.col("_b.xlo") / (SIDES[k] * dx)) <= 1) & (F.floor(F.col("_b.yhi") / (SIDES[k] * dy)) - F.floor(F.col("_b.ylo") / (SIDES[k] * dy)) <= 1)
        level = F.when(near & F.size("edges").between(1, MORE if k <= 1 else FEW), k).otherwise(level)
    return out.withColumn("_level", level)


def cover(zones: DataFrame, dx: float, dy: float, all_touched: bool = False) -> DataFrame:
    """(zone, _level, _i, _j, whole, odd, edges, _b): the squares of ``zones(zone, edges)``, and the box of a zone that isn't cut."""
    dx, dy = abs(dx), abs(dy)
    hx, hy = (dx / 2, dy / 2) if all_touched else (0.0, 0.0)
    kind = zones.schema["zone"].dataType.simpleString()

    def run(batches):
        for b in batches:
            held: list[tuple] = []
            for n, sides in enumerate(b.column("edges").to_pylist()):
                e = np.array([(s["x1"], s["y1"], s["x2"], s["y2"]) for s in sides or ()], float).reshape(-1, 4)
                for s in squares(e, dx, dy, hx, hy):
                    held.append((n, *s))
                    if len(held) == ROWS:
                        yield _rows(b, held)
                        held = []
            yield _rows(b, held)

    schema = f"zone {kind}, _level int, _i long, _j long, whole boolean, odd boolean, edges {G.EDGE}"
    every = _small(zones, dx, dy, hx, hy)
    cut = every.where("_level is null").select("zone", "edges").mapInArrow(run, schema).withColumn("_b", F.lit(None).cast(every.schema["_b"].dataType))
    side = F.element_at(F.array(*(F.lit(float(s)) for s in SIDES)), F.col("_level") + 1)
    span = lambda c, d: F.sequence(F.floor(F.col(f"_b.{c}lo") / (side * d)), F.floor(F.col(f"_b.{c}hi") / (side * d)))
    few = every.where("_level is not null").withColumn("_i", F.explode(span("x", dx))).withColumn("_j", F.explode(span("y", dy)))
    return few.select("zone", "_level", "_i", "_j", F.lit(False).alias("whole"), F.lit(False).alias("odd"), "edges", "_b").unionByName(cut)


def _rows(b: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
    sides = [h[6] for h in held]
    flat = np.concatenate([np.zeros((0, 4)), *sides])
    struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(4)], ["x1", "y1", "x2", "y2"])
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sides])]).astype(np.int32))
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
    cells = [pa.array([h[k + 1] for h in held], t) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([b.column("zone").take(pa.array([h[0] for h in held], pa.int64())), *cells, pa.ListArray.from_arrays(offsets, struct)], ["zone", "_level", "_i", "_j", "whole", "odd", "edges"])


def square_keys(x: Column, y: Column, dx: float, dy: float, levels: Sequence[int] = range(len(SIDES))) -> Column:
    """An array of the squares of ``levels`` that a pixel's centre lies in."""
    return F.array(*(F.struct(F.lit(k).alias("_level"), F.floor(x / (SIDES[k] * abs(dx))).cast("long").alias("_i"), F.floor(y / (SIDES[k] * abs(dy))).cast("long").alias("_j")) for k in levels))


def cells_in(cells: DataFrame, zones: DataFrame, dx: float, dy: float, all_touched: bool = False, keys: tuple[str, ...] = (), carry: tuple[str, ...] = (), along: tuple[str, ...] = (), work: str | None = None) -> DataFrame:
    """(y, x, zone) of ``cells(y, x)`` in ``zones(zone, edges)``: an equi-join on squares; only those on an edge take the exact test.

    ``keys`` are columns of both that must be equal too, ``carry`` more columns of the zones, ``along`` of the cells; all are in
    the result. With ``work``, a folder that all executors share, squares are made at once and cells get the levels that occur.
    """
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    within = G.inside(x, y, F.col("edges"), dy < 0) != F.col("odd")
    if all_touched:
        within = (G.inside(x, y, F.col("edges")) != F.col("odd")) | G.meets_pixel(x, y, F.col("edges"), dx, dy)
    more = [*keys, *carry]
    found = cover(zones.select(F.struct("zone", *more).alias("zone"), "edges") if more else zones, dx, dy, all_touched)
    if more:
        found = found.select("_level", "_i", "_j", "whole", "odd", "edges", "_b", "zone.*")
    levels = range(len(SIDES))
    if work:
        found = stored(found, work)
        levels = sorted(r[0] for r in found.select("_level").distinct().collect()) or [0]
    keyed = cells.select("y", "x", *keys, *along, F.explode(square_keys(x, y, dx, dy, levels)).alias("_key")).select("y", "x", *keys, *along, "_key.*")
    near = F.col("_b").isNull() | (x.between(F.col("_b.xlo"), F.col("_b.xhi")) & y.between(F.col("_b.ylo"), F.col("_b.yhi")))
    return keyed.join(found, ["_level", "_i", "_j", *keys]).where(F.col("whole") | (near & within)).select("y", "x", "zone", *more, *along)
