"""The union of polygons as one outline without inner edges, by joins.

Sides are cut where they meet (an equi-join on tiles finds the pairs), equal pieces
become one, and a piece is kept if just one of its two sides is covered by any
polygon, which an equi-join with the polygons' squares tells. The kept pieces, with
the inside on their left, follow one another into rings by pointer jumping. No step
holds more than a tile, a square or a ring in one place. Parts of few sides take the
same steps within a task, many of them side by side.

Parts narrower than TOLERANCE times the extent are not told from lines.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cover import cells_in
from .regions import rings_in_order, stored

TOLERANCE = 1e-9
#: Tiles along the longer side of a part that its sides are compared in, at most; sides that a tile has, where they are short and spread evenly.
TILES, IN_TILE = 512, 16
#: Pieces that a task traces at once, whole tiles of parts.
TRACED = 50_000
#: Sides of a part that one task unites with those of other such parts, at most; sides it compares at once, and has in all.
SMALL, UNITED, HELD = 256, 8192, 100_000


def _cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * by - ay * bx


def _grain(eps: float) -> float:
    """Where sides cross is put on a grid of this size, so that sides that lie on each other are cut at equal places."""
    return 2.0 ** math.floor(math.log2(eps / 4))


def _cuts(sides: DataFrame, eps: float) -> DataFrame:
    """(part, id, px, py): where sides of a part meet others; a part's tiles follow its own extent and number of sides."""
    c = lambda n: F.col(n)
    ends = [f(f"{n}1", f"{n}2").alias(f"{n}{at}") for n in "xy" for f, at in ((F.least, "lo"), (F.greatest, "hi"))]
    sides = sides.select("*", *ends)
    parts = sides.groupBy("part").agg((F.max("xhi") - F.min("xlo")).alias("w"), (F.max("yhi") - F.min("ylo")).alias("h"), F.count("*").alias("n"))
    tile = F.greatest(F.greatest("w", "h") / TILES, F.sqrt(c("w") * c("h") / c("n") * IN_TILE), F.lit(16 * eps))
    span = lambda n: F.sequence(F.floor((c(f"{n}lo") - eps) / c("tile")), F.floor((c(f"{n}hi") + eps) / c("tile")))
    dealt = sides.join(parts.select("part", tile.alias("tile")), "part").withColumn("ti", F.explode(span("x"))).withColumn("tj", F.explode(span("y"))).drop("tile")
    a, b = dealt.alias("a"), dealt.alias("b")
    near = lambda n: (c(f"a.{n}lo") <= c(f"b.{n}hi") + 2 * eps) & (c(f"b.{n}lo") <= c(f"a.{n}hi") + 2 * eps)
    pairs = a.join(b, (c("a.part") == c("b.part")) & (c("a.ti") == c("b.ti")) & (c("a.tj") == c("b.tj")) & (c("a.id") < c("b.id")) & near("x") & near("y"))
    side = [c(f"{s}.{n}").alias(f"{s}{n}") for s in "ab" for n in ("id", "x1", "y1", "x2", "y2")]
    pairs = pairs.select(c("a.part").alias("part"), *side, *((c(f"{s}.{n}2") - c(f"{s}.{n}1")).alias(f"{s}{n}") for s in "ab" for n in "xy"))
    wx, wy = c("bx1") - c("ax1"), c("by1") - c("ay1")
    pairs = pairs.withColumns({"d": _cross(c("ax"), c("ay"), c("bx"), c("by")), "da": _cross(wx, wy, c("bx"), c("by")), "db": _cross(wx, wy, c("ax"), c("ay")), "na": c("ax") * c("ax") + c("ay") * c("ay"), "nb": c("bx") * c("bx") + c("by") * c("by")})

    def on(s: str, x: Column, y: Column) -> Column:
        """Does an end of the other lie on this side?"""
        px, py = x - c(f"{s}x1"), y - c(f"{s}y1")
        along = (px * c(f"{s}x") + py * c(f"{s}y")) / c(f"n{s}")
        return (F.abs(_cross(c(f"{s}x"), c(f"{s}y"), px, py)) <= eps * F.sqrt(f"n{s}")) & along.between(0, 1)

    ends = [(mine, c(f"{other}x{k}"), c(f"{other}y{k}")) for mine, other in ("ab", "ba") for k in (1, 2)]
    t, u = c("da") / F.nullif("d", F.lit(0.0)), c("db") / F.nullif("d", F.lit(0.0))
    pairs = pairs.withColumns({"apart": (F.abs("d") > TOLERANCE * F.sqrt(c("na") * c("nb"))) & t.between(0, 1) & u.between(0, 1), **{f"on{k}": on(*e) for k, e in enumerate(ends)}})
    crosses = c("apart") & ~(c("on0") | c("on1") | c("on2") | c("on3"))
    point = lambda s, x, y: F.struct(c(f"{s}id").alias("id"), x.alias("px"), y.alias("py"))
    grain = _grain(eps)
    met = [F.rint((c(f"a{n}1") + t * c(f"a{n}")) / grain) * grain for n in "xy"]
    found = F.array(*(F.when(c(f"on{k}"), point(*e)) for k, e in enumerate(ends)), *(F.when(crosses, point(s, *met)) for s in "ab"))
    return pairs.select("part", F.explode(found).alias("p")).where("p is not null").select("part", "p.*").distinct()


def _in_order(then: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, where paths begin in it, their last pieces, on a cycle?) of pieces, each followed by piece ``then`` or, where that is their number, by none."""
    n = len(then)
    then = np.append(then, n)
    least, far = np.arange(n + 1), then
    for _ in range(n.bit_length()):  # by doubled steps, as far as it goes
        least, far = np.minimum(least, least[far]), far[far]
    ring = far[:n] < n  # a cycle never ends: it is cut before its least piece
    then[:n][ring & (then[:n] == least[:n])] = n
    left, last, far = np.append(np.ones(n, np.int64), 0), np.arange(n + 1), then
    for _ in range(n.bit_length()):
        left, last, far = left + left[far], np.where(far < n, last[far], last), far[far]
    row = np.lexsort((-left[:n], last[:n]))
    first = np.flatnonzero(np.append(True, np.diff(last[row]) != 0)[:n])
    return row, first, last[row[first]], ring


def _lists(first: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    at = pa.array(np.append(first, len(values[0])).astype(np.int32))
    return [pa.ListArray.from_arrays(at, pa.array(v)) for v in values]


def _trace(table: pa.Table) -> pa.Table:
    """The pieces of some tiles as paths that enter and leave their tile, and as rings that don't."""
    table = table.sort_by("id")
    own, after, x, y = (table.column(c).to_numpy() for c in ("id", "after", "x", "y"))
    row, first, end, ring = _in_order(np.where(table.column("stays").to_numpy(), np.searchsorted(own, after), len(own)))
    head = row[first]
    return pa.Table.from_arrays([table.column("part").take(pa.array(head)).combine_chunks(), pa.array(own[head]), pa.array(after[end]), pa.array(ring[head]), *_lists(first, x[row], y[row])], names=["part", "id", "after", "ring", "xs", "ys"])


def _each(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, each ``n`` times, beside ``first``, ``first`` + 1, ..."""
    k = np.repeat(np.arange(len(n)), n)
    return k, np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + first[k]


def _different(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, number of each row) of the different rows of columns, in order."""
    row = np.lexsort(keys[::-1])
    new = np.append(True, np.logical_or.reduce([np.diff(k[row]) != 0 for k in keys]))[: len(row)]
    number = np.empty(len(row), np.int64)
    number[row] = np.cumsum(new) - 1
    return row[new], number


def _unite(part: np.ndarray, zone: np.ndarray, away: np.ndarray, e: np.ndarray, eps: float) -> tuple[np.ndarray, ...]:
    """(part, first, x, y): the rings of some small parts, by the same steps as for large ones, all pairs of a part at once.

    ``part``, ``zone`` and ``e`` are those of sides, in order of both; ``away`` is that of zones.
    """
    x1, y1, x2, y2 = e.T
    turn = (x1 > x2) | ((x1 == x2) & (y1 > y2))
    s = np.where(turn[:, None], e[:, [2, 3, 0, 1]], e)
    own = _different(part, *s.T)[0]
    own = own[(s[own, 0] != s[own, 2]) | (s[own, 1] != s[own, 3])]
    s, g = s[own], part[own]
    a, b = _each(np.arange(len(g)) + 1, np.searchsorted(g, g, "right") - np.arange(len(g)) - 1)
    lo, hi = np.minimum(s[:, :2], s[:, 2:]), np.maximum(s[:, :2], s[:, 2:])
    for c in (0, 1):
        near = (lo[a, c] <= hi[b, c] + 2 * eps) & (lo[b, c] <= hi[a, c] + 2 * eps)
        a, b = a[near], b[near]
    v = s[:, 2:] - s[:, :2]
    n2 = (v * v).sum(1)
    cross = lambda p, q: p[:, 0] * q[:, 1] - p[:, 1] * q[:, 0]
    w, d = s[b, :2] - s[a, :2], cross(v[a], v[b])
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(w, v[b]) / d, cross(w, v[a]) / d
        crosses = (np.abs(d) > TOLERANCE * np.sqrt(n2[a] * n2[b])) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    at, cuts = [np.arange(len(g))] * 2, [s[:, :2], s[:, 2:]]
    for mine, other in ((a, b), (b, a)):
        for k in (0, 2):
            p = s[other, k : k + 2] - s[mine, :2]
            along = (p * v[mine]).sum(1) / n2[mine]
            on = (np.abs(cross(v[mine], p)) <= eps * np.sqrt(n2[mine])) & (along >= 0) & (along <= 1)
            at, cuts, crosses = [*at, mine[on]], [*cuts, s[other[on], k : k + 2]], crosses & ~on
    met = np.rint((s[a[crosses], :2] + t[crosses, None] * v[a[crosses]]) / _grain(eps)) * _grain(eps)
    at, cuts = np.concatenate([*at, a[crosses], b[crosses]]), np.concatenate([*cuts, met, met])
    row = np.lexsort((cuts[:, 1], cuts[:, 0], ((cuts - s[at, :2]) * v[at]).sum(1), at))
    at, cuts = at[row], cuts[row]
    piece = np.flatnonzero((at[1:] == at[:-1]) & (cuts[1:] != cuts[:-1]).any(1))
    g, s = g[at[piece]], np.concatenate([cuts[piece], cuts[piece + 1]], 1)
    own = _different(g, *s.T)[0]
    g, s = g[own], s[own]
    # is the place to the left of a piece's middle covered, and that to its right?
    v = s[:, 2:] - s[:, :2]
    off = np.stack([-v[:, 1], v[:, 0]], 1) * (4 * eps / np.sqrt((v * v).sum(1)))[:, None]
    middle = (s[:, :2] + s[:, 2:]) / 2
    point = np.concatenate([middle + off, middle - off])
    start = np.flatnonzero(np.append(True, np.diff(zone) != 0)[: len(zone)])
    sides, of = np.diff(np.append(start, len(zone))), part[start]
    low, high = np.minimum.reduceat(np.minimum(e[:, :2], e[:, 2:]), start), np.maximum.reduceat(np.maximum(e[:, :2], e[:, 2:]), start)
    both = np.concatenate([g, g])
    first = np.searchsorted(of, both)
    p, z = _each(first, np.searchsorted(of, both, "right") - first)
    for c in (0, 1):
        near = (point[p, c] >= low[z, c]) & (point[p, c] <= high[z, c])
        p, z = p[near], z[near]
    k, side = _each(start[z], sides[z])
    px, py = point[p[k]].T
    across = (e[side, 1] <= py) != (e[side, 3] <= py)
    k, side, px, py = k[across], side[across], px[across], py[across]
    left = e[side, 0] + (py - e[side, 1]) * (e[side, 2] - e[side, 0]) / (e[side, 3] - e[side, 1]) < px
    inside = np.bincount(k[left], minlength=len(p)) % 2 == 1
    taken = away[zone[start]][z]
    count = lambda hit: np.bincount(p[hit], minlength=len(point)) > 0
    covered = (count(inside & ~taken) & ~count(inside & taken)).reshape(2, -1)
    kept = covered[0] != covered[1]
    g, s = g[kept], np.where(covered[0, kept, None], s[kept], s[kept][:, [2, 3, 0, 1]])
    # the sharpest turn to the left goes on
    n = len(g)
    corner = _different(np.concatenate([g, g]), *np.concatenate([s[:, :2], s[:, 2:]]).T)[1]
    row = np.argsort(corner[:n], kind="stable")
    first = np.searchsorted(corner[:n][row], corner[n:])
    i, j = _each(first, np.searchsorted(corner[:n][row], corner[n:], "right") - first)
    j, v = row[j], s[:, 2:] - s[:, :2]
    best = np.lexsort((np.arctan2(cross(v[i], v[j]), (v[i] * v[j]).sum(1)), i))
    then = np.full(n, n)
    then[i[best]] = j[best]  # the last of a piece stays
    row, first, _, _ = _in_order(then)
    return g[row[first]], first, s[row, 0], s[row, 1]


def _united(eps: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.take(pa.compute.sort_indices(table, [("part", "ascending")]))
        edges = table.column("edges").combine_chunks()
        zone = np.repeat(np.arange(len(table)), np.diff(edges.offsets.to_numpy()))
        flat = edges.flatten()
        e = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2")], 1) + 0.0  # no negative zeros
        names = table.column("part").combine_chunks().dictionary_encode()
        part, away, out = names.indices.to_numpy()[zone], table.column("away").to_numpy(), []
        ends = np.flatnonzero(np.append(np.diff(part) != 0, True)) + 1  # of parts
        while len(ends):  # some thousand sides at a time
            low = ends[0] - np.searchsorted(part[: ends[0]][::-1] != part[ends[0] - 1], True)
            take = max(1, np.searchsorted(ends, low + UNITED, "right"))
            at = slice(low, ends[take - 1])
            out.append(_unite(part[at], zone[at], away, e[at], eps))
            ends = ends[take:]
        first = np.concatenate([f + n for (_, f, _, _), n in zip(out, np.cumsum([0, *(len(o[2]) for o in out)]), strict=False)])
        g, x, y = (np.concatenate([o[k] for o in out]) for k in (0, 2, 3))
        return pa.Table.from_arrays([names.dictionary.take(pa.array(g)), pa.array(np.arange(len(g))), *_lists(first, x, y)], names=["part", "ring", "xs", "ys"])

    return run


def union(zones: DataFrame, work: str, by: str | None = None, away: str | None = None) -> DataFrame:
    """(part, ring, xs, ys): outlines of the union of ``zones(zone, edges)``, one union for each value of ``by``.

    Zones for which the boolean column ``away`` is true are taken away from the others.

    Rings around a part run against the clock, those around its holes with it;
    ``work`` is a folder that all executors share.
    """
    part = F.col(by).cast("string") if by else F.lit("")
    own = stored(zones.select("zone", part.alias("part"), (F.col(away) if away else F.lit(False)).alias("away"), "edges").dropDuplicates(["part", "away", "edges"]), f"{work}/zones")  # equal zones cover the same
    box = own.select(F.explode("edges").alias("e")).select("e.*").where("x1 <> x2 or y1 <> y2")
    box = box.agg(*(f(F.least(f"{c}1", f"{c}2") if n == "min" else F.greatest(f"{c}1", f"{c}2")).alias(f"{c}{n}") for c in "xy" for n, f in (("min", F.min), ("max", F.max)))).first()
    if box.xmin is None:
        return own.select("part", F.lit(0).cast("long").alias("ring"), F.expr("edges.x1 as xs"), F.expr("edges.y1 as ys")).limit(0)
    extent = max(box.xmax - box.xmin, box.ymax - box.ymin)
    eps = TOLERANCE * extent
    sizes = stored(own.where("size(edges) > 0").groupBy("part").agg(F.sum(F.size("edges")).alias("sides")), f"{work}/sizes")
    few = sizes.where(F.col("sides") <= SMALL)
    total = few.agg(F.sum("sides"), F.count("*")).first()
    if not total[1]:
        return _by_joins(own, extent, work)
    small = own.where("size(edges) > 0").join(few.select("part"), "part").select("part", "away", "edges", F.pmod(F.xxhash64("part"), F.lit(1 + total[0] // HELD)).alias("group"))
    rings = small.groupBy("group").applyInArrow(_united(eps), "part string, ring long, xs array<double>, ys array<double>")
    if not sizes.where(F.col("sides") > SMALL).limit(1).count():
        return rings
    return rings.unionByName(_by_joins(own.join(few.select("part"), "part", "left_anti"), extent, work))


def _by_joins(own: DataFrame, extent: float, work: str) -> DataFrame:
    """``union`` of parts of any size."""
    eps = TOLERANCE * extent
    sides = own.select("part", F.explode("edges").alias("e")).select("part", "e.*").where("x1 <> x2 or y1 <> y2")
    # both directions of a side are one
    turn = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    first, second = (F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in (("x1", "y1"), ("x2", "y2")))
    sides = sides.select("part", F.when(turn, second).otherwise(first).alias("p"), F.when(turn, first).otherwise(second).alias("q"))
    sides = sides.select("part", *(F.col(s)[k].alias(n) for s, k, n in (("p", "x", "x1"), ("p", "y", "y1"), ("q", "x", "x2"), ("q", "y", "y2")))).distinct()
    sides = stored(sides.withColumn("id", F.monotonically_increasing_id()), f"{work}/sides")
    cuts = _cuts(sides, eps).groupBy("part", "id").agg(F.collect_set(F.struct("px", "py")).alias("cuts"))
    along = lambda p: (p["px"] - F.col("x1")) * (F.col("x2") - F.col("x1")) + (p["py"] - F.col("y1")) * (F.col("y2") - F.col("y1"))
    points = F.array_union(F.coalesce("cuts", F.array()), F.array(F.struct(F.col("x1").alias("px"), F.col("y1").alias("py")), F.struct(F.col("x2").alias("px"), F.col("y2").alias("py"))))
    row = sides.join(cuts, ["part", "id"], "left").select("part", F.sort_array(F.transform(points, lambda p: F.struct(along(p).alias("t"), p["px"].alias("x"), p["py"].alias("y")))).alias("ps"))
    pieces = row.select("part", F.explode(F.expr("transform(sequence(0, size(ps) - 2), k -> struct(ps[k].x as x1, ps[k].y as y1, ps[k + 1].x as x2, ps[k + 1].y as y2))")).alias("s")).select("part", "s.*")
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    pieces = pieces.where(length > 0).distinct().withColumn("id", F.monotonically_increasing_id())
    pieces = stored(pieces, f"{work}/pieces")
    # is the place to the left of a piece's middle covered, and that to its right?
    reach = F.lit(4 * eps) / length
    middle = [(F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2]
    off = [-(F.col("y2") - F.col("y1")) * reach, (F.col("x2") - F.col("x1")) * reach]
    beside = pieces.select("part", "id", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), (middle[0] + s * off[0]).alias("x"), (middle[1] + s * off[1]).alias("y")) for s in (1, -1)))).alias("b")).select("part", "id", "b.*")
    hit = cells_in(beside, own, extent / 4096, extent / 4096, keys=("part",), carry=("away",), along=("id", "side"), work=f"{work}/squares")
    at = lambda s: (F.bool_or(F.col("side") == s) & ~F.bool_or((F.col("side") == s) & F.col("away"))).cast("int")
    covered = hit.groupBy("part", "id").agg((at(1) - at(-1)).alias("side")).where("side <> 0")  # 0: on both sides
    kept = pieces.join(covered, ["part", "id"])
    ahead = F.col("side") > 0
    kept = kept.select("part", "id", *(F.when(ahead, F.col(f"{c}{k}")).otherwise(F.col(f"{c}{3 - k}")).alias(f"{c}{k}") for k in (1, 2) for c in "xy"))
    kept = stored(kept, f"{work}/kept")
    tile = lambda c: F.floor(F.col(c) / (extent / TILES))
    then = kept.select("part", F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("id").alias("after"), (F.col("x2") - F.col("x1")).alias("nx"), (F.col("y2") - F.col("y1")).alias("ny"))
    ux, uy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    turned = F.atan2(_cross(ux, uy, F.col("nx"), F.col("ny")), ux * F.col("nx") + uy * F.col("ny"))  # the sharpest turn to the left goes on
    follow = kept.join(then, ["part", "x2", "y2"]).groupBy("part", "id").agg(F.max_by("after", turned).alias("after"), *(F.first(c).alias(c) for c in ("x1", "y1", "x2", "y2")))
    # traced within tiles, so that only paths between tiles are put in order by number
    stays = (tile("x1") == tile("x2")) & (tile("y1") == tile("y2"))
    groups = 1 + kept.count() // TRACED
    dealt = follow.select("part", "id", "after", F.col("x1").alias("x"), F.col("y1").alias("y"), stays.alias("stays"), F.pmod(F.xxhash64("part", tile("x1"), tile("y1")), F.lit(groups)).alias("group"))
    paths = dealt.groupBy("group").applyInArrow(_trace, "part string, id long, after long, ring boolean, xs array<double>, ys array<double>")
    return rings_in_order(stored(paths, f"{work}/paths"), ["part"], work)


def ring_area() -> Column:
    """The signed area of a ring (xs, ys)."""
    return F.expr("aggregate(sequence(0, size(xs) - 1), 0D, (s, k) -> s + (xs[k] * ys[(k + 1) % size(xs)] - xs[(k + 1) % size(xs)] * ys[k]) / 2)")


def ring_length() -> Column:
    return F.expr("aggregate(sequence(0, size(xs) - 1), 0D, (s, k) -> s + sqrt(power(xs[(k + 1) % size(xs)] - xs[k], 2) + power(ys[(k + 1) % size(xs)] - ys[k], 2)))")


def dissolve(zones: DataFrame, work: str, by: str | None = None) -> DataFrame:
    """(part, wkt): each connected outline of the union as a polygon with its holes; a hole goes to the smallest outline around it."""
    rings = stored(union(zones, work, by).withColumn("area", ring_area()).withColumn("id", F.monotonically_increasing_id()), f"{work}/rings")
    outer, holes = rings.where("area > 0"), rings.where("area < 0")
    extent = rings.agg(F.max(F.array_max("xs")) - F.min(F.array_min("xs")), F.max(F.array_max("ys")) - F.min(F.array_min("ys"))).first()
    size = max(extent[0] or 1.0, extent[1] or 1.0)
    edges = F.expr("transform(sequence(0, size(xs) - 1), k -> struct(xs[k] as x1, ys[k] as y1, xs[(k + 1) % size(xs)] as x2, ys[(k + 1) % size(xs)] as y2))")
    # a place just off the hole's first side, on the part's side of it
    dx, dy = F.col("xs")[1] - F.col("xs")[0], F.col("ys")[1] - F.col("ys")[0]
    reach = F.lit(4 * TOLERANCE * size) / F.sqrt(dx * dx + dy * dy)
    place = holes.select("part", "id", ((F.col("xs")[0] + F.col("xs")[1]) / 2 - dy * reach).alias("x"), ((F.col("ys")[0] + F.col("ys")[1]) / 2 + dx * reach).alias("y"))
    hit = cells_in(place.select("part", "y", "x").distinct(), outer.select(F.col("id").alias("zone"), "part", "area", edges.alias("edges")), size / 4096, size / 4096, keys=("part",), carry=("area",))
    around = place.join(hit, ["part", "y", "x"])
    owner = around.groupBy("part", "id").agg(F.min_by("zone", "area").alias("of"))
    text = F.expr("concat('(', array_join(transform(concat(arrays_zip(xs, ys), slice(arrays_zip(xs, ys), 1, 1)), p -> concat_ws(' ', cast(p.xs as string), cast(p.ys as string))), ', '), ')')")
    every = outer.select("part", F.col("id").alias("of"), F.struct((-F.col("area")).alias("area"), text.alias("text")).alias("r")).unionByName(holes.join(owner, ["part", "id"]).select("part", "of", F.struct((-F.col("area")).alias("area"), text.alias("text")).alias("r")))
    return every.groupBy("part", "of").agg(F.sort_array(F.collect_list("r")).alias("rs")).select("part", F.concat(F.lit("POLYGON ("), F.array_join("rs.text", ", "), F.lit(")")).alias("wkt"))
