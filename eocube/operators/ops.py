"""Cube operations: clip, merge, select, union, regrid, coarsen, nearest dates."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DatacubeMergeError, DatacubeOperationError, DatacubeValidationError
from ..functions import geometry as G
from ..functions.query_lang import parse_time
from ..model import KEYS, GridSpec, bands_of

COMPAT = ("identical", "equals", "broadcast_equals", "no_conflicts", "override", "minimal")


def clip(df: DataFrame, geometry, keep_rectangle: bool = True, check: bool = False, buffer: float = 0.0, metres: float = 0.0) -> DataFrame:
    """Pixels of a geometry. First its bounding box, which reaches the scan, then the exact test.

    ``keep_rectangle`` keeps the box's other pixels with missing values; ``check``
    raises an error where nothing is left. ``buffer`` is in the units of the
    coordinates, ``metres`` is for degrees.
    """
    area = G.dissolve(G.parse(geometry))
    x, y = F.col("x"), F.col("y")
    b = area.bbox
    if metres:  # a degree of latitude has at least 110,574 metres, one of longitude shrinks with the latitude
        up = metres / 110_574
        across = up / max(0.01, math.cos(math.radians(min(89.0, max(abs(b[1]), abs(b[3])) + up))))
        out = df.where(G.in_box(x, y, (b[0] - across, b[1] - up, b[2] + across, b[3] + up)))
        hit = G.within_metres(area, x, y, metres)
        return out.withColumns({c: F.when(hit, F.col(c)) for c in bands_of(df)}) if keep_rectangle else out.where(hit)
    out = df.where(G.in_box(x, y, (b[0] - buffer, b[1] - buffer, b[2] + buffer, b[3] + buffer)))
    hit = G.within_buffer(area, x, y, buffer) if buffer else G.contains(area, x, y)
    out = out.withColumns({c: F.when(hit, F.col(c)) for c in bands_of(df)}) if keep_rectangle else out.where(hit)
    if check and not out.limit(1).count():
        raise DatacubeOperationError("the geometry has no pixel of the cube")
    return out


def clip_box(df: DataFrame, bbox) -> DataFrame:
    return df.where(G.in_box(F.col("x"), F.col("y"), G.parse_bbox(bbox)))


def merge(left: DataFrame, right: DataFrame, compat: str = "no_conflicts", check_now: bool = False) -> DataFrame:
    """Both cubes side by side, over all cells of either.

    For bands that both have: ``override`` takes the left one as it is,
    ``no_conflicts`` what is there if the two never differ, the others demand
    equal columns (``minimal`` and ``broadcast_equals`` like ``equals`` here). A
    conflict stops any query that reads the result, whichever bands it takes;
    ``check_now`` runs the join for it at once.
    """
    if compat not in COMPAT:
        raise ValueError(f"compat is one of {COMPAT}, not {compat!r}")
    both = [b for b in bands_of(left) if b in bands_of(right)]
    other = right.withColumnsRenamed({b: f"_r_{b}" for b in both})
    out = left.join(other, list(KEYS), "full_outer")
    if both and compat != "override":
        differ = [~F.col(b).eqNullSafe(F.col(f"_r_{b}")) if compat != "no_conflicts" else F.col(b) != F.col(f"_r_{b}") for b in both]
        conflict = reduce(lambda a, b: a | b, differ)
        if check_now and out.where(conflict).limit(1).count():
            raise DatacubeMergeError(f"bands {both} differ ({compat})")
        stop = F.raise_error(F.lit(f"DatacubeMergeError: bands {both} differ ({compat})"))
        out = out.where(F.when(F.coalesce(conflict, F.lit(False)), stop.cast("boolean")).otherwise(True))
    if compat == "no_conflicts":
        out = out.withColumns({b: F.coalesce(b, f"_r_{b}") for b in both})
    return out.drop(*(f"_r_{b}" for b in both))


def select_time(df: DataFrame, start=None, end=None, check: bool = False) -> DataFrame:
    """Times from start to end, both included; a date alone as the end is that whole day."""
    if start is None and end is None:
        return df
    out = df
    if start is not None:
        out = out.where(F.col("time") >= F.lit(parse_time(start)).cast("timestamp_ntz"))
    if end is not None:
        out = out.where(F.col("time") <= F.lit(parse_time(end, end=True)).cast("timestamp_ntz"))
    if check and not out.limit(1).count():
        lo, hi = df.agg(F.min("time"), F.max("time")).first()
        raise DatacubeOperationError(f"no time between {start} and {end}; the cube has {lo} to {hi}")
    return out


def nth_time(df: DataFrame, i: int) -> DataFrame:
    """Pixels of the time with number ``i`` in order."""
    times = df.select("time").distinct()
    ranked = times.withColumn("_n", F.row_number().over(Window.orderBy("time")) - 1)
    return df.join(F.broadcast(ranked.where(F.col("_n") == i).select("time")), "time", "left_semi")


def rechunk(df: DataFrame, by: str = "time") -> DataFrame:
    """One time's pixels together, or neighbours in space."""
    return df.repartition("time") if by == "time" else df.repartitionByRange("y", "x")


def union(*cubes: DataFrame, how: str = "avg", by: str = "date") -> DataFrame:
    """Cubes of several sensors on one grid: bands that one lacks are missing there, then one image for each date."""
    if not cubes:
        raise DatacubeValidationError("no cubes")
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cubes)
    day = F.to_date("time") if by == "date" else F.col("time")
    return every.groupBy(day.alias("time"), "y", "x").agg(*(F.expr(f"{how}(`{b}`)").alias(b) for b in bands_of(every)))


def sizes(df: DataFrame) -> DataFrame:
    """One row: how many times, rows and columns there are."""
    return df.agg(*(F.count_distinct(c).alias(f"n_{c}") for c in KEYS))


def align_by_position(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cells of two cubes whose times correspond by their order: the n-th of ``right`` takes the n-th time of ``left``; others go."""
    number = lambda df, c: df.select(F.col("time").alias(c)).distinct().withColumn("_n", F.row_number().over(Window.orderBy(c)))
    pairs = number(left, "_left").join(number(right, "time"), "_n").select("_left", "time")
    moved = right.join(pairs, "time").withColumn("time", F.col("_left")).drop("_left")
    return left.join(moved, list(KEYS))


def same_grid(*cubes: DataFrame) -> None:
    """An error unless all cubes have as many rows and columns."""
    sizes = [c.agg(F.count_distinct("x"), F.count_distinct("y")).first() for c in cubes]
    if len({tuple(s) for s in sizes}) > 1:
        raise ValueError(f"the cubes' sizes differ: {sizes}")


def _cells(df: DataFrame, target: GridSpec, source_crs: int, target_crs: int) -> DataFrame:
    """(_x, _y, _sx, _sy): the cells of a grid, and where they lie in the source's system."""
    cells = df.sparkSession.range(target.nx * target.ny).select((target.x0 + (F.col("id") % target.nx) * target.dx).alias("_x"), (target.y0 + F.floor(F.col("id") / target.nx) * target.dy).alias("_y"))
    sx, sy = G.transform_point(F.col("_x"), F.col("_y"), target_crs, source_crs, F)
    return cells.select("_x", "_y", sx.alias("_sx"), sy.alias("_sy"))


def regrid_nearest(df: DataFrame, source: GridSpec, target: GridSpec, source_crs: int = 4326, target_crs: int = 4326) -> DataFrame:
    """Values of the nearest source cell for each target cell; arithmetic on indices and one equi-join."""
    cells = _cells(df, target, source_crs, target_crs).select("_x", "_y", source.column(F.col("_sx")).alias("_i"), source.row(F.col("_sy")).alias("_j"))
    own = df.withColumn("_i", source.column(F.col("x"))).withColumn("_j", source.row(F.col("y"))).drop("x", "y")
    return own.join(cells, ["_i", "_j"]).select("time", F.col("_y").alias("y"), F.col("_x").alias("x"), *bands_of(df))


#: Weights by distance in source cells, and how far they reach: the published kernels.
WEIGHTS = {
    "bilinear": (1, lambda t: F.greatest(1 - t, F.lit(0.0))),
    "cubic": (2, lambda t: F.when(t < 1, (t * 1.5 - 2.5) * t * t + 1).when(t < 2, ((t * -0.5 + 2.5) * t - 4) * t + 2).otherwise(0.0)),
    "cubic_spline": (2, lambda t: F.when(t < 1, (t * 0.5 - 1) * t * t + 2 / 3).when(t < 2, F.pow(2 - t, 3) / 6).otherwise(0.0)),
    "lanczos": (3, lambda t: F.when(t == 0, 1.0).when(t < 3, F.sin(t * math.pi) * F.sin(t * (math.pi / 3)) * 3 / (t * t * math.pi**2)).otherwise(0.0)),
    "gauss": (2, lambda t: F.when(t < 2, F.exp(t * t * -2)).otherwise(0.0)),
}


def regrid(df: DataFrame, source: GridSpec, target: GridSpec, kernel: str = "bilinear", source_crs: int = 4326, target_crs: int = 4326) -> DataFrame:
    """The mean of the source cells around each target cell, weighted by a kernel; missing ones lose their weight.

    Target cells are projected into the source's system as columns, so a cube in
    one system goes to a grid in another with one equi-join on cell numbers.
    """
    if kernel == "nearest":
        return regrid_nearest(df, source, target, source_crs, target_crs)
    if kernel not in WEIGHTS:
        raise ValueError(f"kernel is 'nearest' or one of {sorted(WEIGHTS)}, not {kernel!r}")
    reach, weight = WEIGHTS[kernel]
    cells = _cells(df, target, source_crs, target_crs).withColumn("_u", (F.col("_sx") - source.x0) / source.dx).withColumn("_v", (F.col("_sy") - source.y0) / source.dy)
    beside = F.sequence(F.lit(1 - reach), F.lit(reach))
    part = lambda c: F.transform(beside, lambda k: F.struct((F.floor(c) + k).cast("int").alias("at"), weight(F.abs(c - F.floor(c) - k)).alias("w")))
    near = cells.select("_x", "_y", F.explode(part(F.col("_u"))).alias("_a"), F.col("_v")).select("_x", "_y", "_a", F.explode(part(F.col("_v"))).alias("_b"))
    near = near.select("_x", "_y", F.col("_a.at").alias("_i"), F.col("_b.at").alias("_j"), (F.col("_a.w") * F.col("_b.w")).alias("_w")).where("_w <> 0")
    own = df.withColumn("_i", source.column(F.col("x"))).withColumn("_j", source.row(F.col("y"))).drop("x", "y")
    mean = lambda b: F.sum(F.col(b) * F.col("_w")) / F.nullif(F.sum(F.when(F.col(b).isNotNull(), F.col("_w"))), F.lit(0.0))
    return own.join(near, ["_i", "_j"]).groupBy("time", F.col("_y").alias("y"), F.col("_x").alias("x")).agg(*(mean(b).alias(b) for b in bands_of(df)))


def regrid_bilinear(df: DataFrame, source: GridSpec, target: GridSpec) -> DataFrame:
    return regrid(df, source, target)


def multi_collection(cubes: list[tuple[DataFrame, GridSpec]], how: str = "avg") -> DataFrame:
    """Cubes of several collections on the first one's grid, as one."""
    (first, grid), *rest = cubes
    return union(first, *(df if g == grid else regrid_nearest(df, g, grid) for df, g in rest), how=how)


def centroid_pixel(df: DataFrame, grid: GridSpec) -> DataFrame:
    """The series of the grid's middle cell."""
    return df.where((grid.column(F.col("x")) == grid.nx // 2) & (grid.row(F.col("y")) == grid.ny // 2))


def times_with_few(df: DataFrame, hit: Column, most: float) -> DataFrame:
    """Pixels of times where less than ``most`` of the pixels meet a condition."""
    share = df.groupBy("time").agg(F.avg(F.coalesce(hit, F.lit(False)).cast("int")).alias("_share"))
    return df.join(share.where(F.col("_share") < most).select("time"), "time", "left_semi")


#: Ranges that a round of a selection tells apart.
RANGES = 1 << 14


def order_statistics(df: DataFrame, wanted: list[tuple[str, float]]) -> list[float | None]:
    """Exact percentiles of bands, interpolated between neighbours, for (band, share) each; None where a band has no value.

    Each rank is found by selection: values within the bounds known so far are
    counted in RANGES ranges, and the range that holds the rank gives the next
    bounds, until they are one value. A round is one aggregate with partial counts
    for all ranks, so no task holds a band's values, only counts of ranges.
    """
    bands = list(dict.fromkeys(b for b, _ in wanted))
    clean = df.select(*(F.when(~F.isnan(F.col(b).cast("double")), F.col(b).cast("double")).alias(b) for b in bands)).persist()
    try:
        ends = clean.agg(*(f(b).alias(f"{n}_{b}") for b in bands for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max)))).first()
        ranks = {(b, k) for b, p in wanted if ends[f"n_{b}"] for k in (math.floor(p * (ends[f"n_{b}"] - 1)), math.ceil(p * (ends[f"n_{b}"] - 1)))}
        open_ = {(b, k): (0, ends[f"lo_{b}"], ends[f"hi_{b}"]) for b, k in ranks}  # values before the bounds, and the bounds
        value = {}
        while open_:
            value |= {t: lo for t, (_, lo, hi) in open_.items() if lo == hi}
            open_ = {t: x for t, x in open_.items() if t not in value}
            if open_:
                open_ = _narrower(clean, open_)
    finally:
        clean.unpersist()
    out = []
    for b, p in wanted:
        if not ends[f"n_{b}"]:
            out.append(None)
            continue
        place = p * (ends[f"n_{b}"] - 1)
        lo, hi = value[b, math.floor(place)], value[b, math.ceil(place)]
        out.append(lo if lo == hi else lo + (hi - lo) * (place - math.floor(place)))
    return out


def _narrower(clean: DataFrame, bounds: dict) -> dict:
    """The same ranks with the bounds of the range that each lies in."""
    todo = list(bounds)

    def cell(b, lo, hi):
        c = F.col(b)
        low, high = max(lo, -1.7e308), min(hi, 1.7e308)  # infinite values are in the first and last range
        step = high / RANGES - low / RANGES
        n = F.floor((c - F.lit(low)) / F.lit(step)) if step > 0 and math.isfinite(1 / step) else F.lit(0)
        inner = F.least(F.lit(RANGES - 2), F.greatest(F.lit(1), n + 1))
        return F.when(c.between(lo, hi), F.when(c == lo, 0).when(c == hi, RANGES - 1).otherwise(inner).cast("int"))

    cells = F.array(*(F.struct(F.lit(n).alias("t"), cell(b, lo, hi).alias("c"), F.col(b).alias("v")) for n, ((b, _), (_, lo, hi)) in enumerate(bounds.items())))
    counts = clean.select(F.explode(F.filter(cells, lambda x: x["c"].isNotNull())).alias("x")).groupBy("x.t", "x.c").agg(F.count("*").alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))
    run = Window.partitionBy("t").orderBy("c").rowsBetween(Window.unboundedPreceding, 0)  # over RANGES rows at most
    rank = F.element_at(F.array(*(F.lit(k - bounds[b, k][0]).cast("long") for b, k in todo)), F.col("t") + 1)
    hit = counts.withColumn("to", F.sum("n").over(run)).where((F.col("to") > rank) & (F.col("to") - F.col("n") <= rank)).collect()
    return {todo[r.t]: (bounds[todo[r.t]][0] + r.to - r.n, r.lo, r.hi) for r in hit}


def _percentiles(df: DataFrame, wanted: list[tuple[str, float]], accuracy: int | None) -> list[Column]:
    """One value for each as a column: exact ones are found now, sketches (off by 1/accuracy in rank) too, in one aggregate."""
    if accuracy is None:
        return [F.lit(v).cast("double") for v in order_statistics(df, wanted)]
    row = df.agg(*(F.percentile_approx(b, p, accuracy).alias(str(n)) for n, (b, p) in enumerate(wanted))).first()
    return [F.lit(v).cast("double") for v in row]


def above_percentile(df: DataFrame, band: str, p: float, accuracy: int | None = None) -> DataFrame:
    """Pixels of a band above its percentile over the whole cube, which is found at once.

    It is exact, by a few aggregates of bounded size; with ``accuracy`` it is a
    sketch, off by 1/accuracy in rank.
    """
    (cut,) = _percentiles(df, [(band, p)], accuracy)
    return df.where(F.col(band) > cut)


#: Names of aggregates that a coarser grid can take of a cell's pixels.
RESAMPLING = {"average": "avg({})", "min": "min({})", "max": "max({})", "sum": "sum({})", "med": "median({})", "q1": "percentile({}, 0.25)", "q3": "percentile({}, 0.75)", "mode": "mode({}, true)"}


def coarsen(df: DataFrame, factor: int, grid: GridSpec, method: str = "average", trim: bool = False) -> DataFrame:
    """Blocks of ``factor`` cells on a side as one; ``trim`` leaves out blocks that the grid's edge cuts."""
    if method not in RESAMPLING:
        raise ValueError(f"method is one of {sorted(RESAMPLING)}, not {method!r}")
    i, j = F.floor(grid.column(F.col("x")) / factor), F.floor(grid.row(F.col("y")) / factor)
    rows = df.withColumn("i", i.cast("long")).withColumn("j", j.cast("long"))
    if trim:
        rows = rows.where((F.col("i") < grid.nx // factor) & (F.col("j") < grid.ny // factor))
    return rows.groupBy("time", "j", "i").agg(*(F.expr(RESAMPLING[method].format(f"`{b}`")).alias(b) for b in bands_of(df)))


def nearest_dates(times: DataFrame, targets: DataFrame, days: int = 0, method: str = "nearest") -> DataFrame:
    """(target, date, delta): for each target date the nearest date of ``times`` within ``days``; a date that is the nearest of several targets is listed once, with the nearest of them.

    Dates are spread over the days they can serve, so the join is an equi-join on the date.
    """
    lo, hi = {"nearest": (-days, days), "ffill": (0, days), "bfill": (-days, 0)}[method]
    own = times.select(F.to_date("time").alias("date")).distinct()
    reach = own.select("date", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("delta")).select("date", F.date_add("date", F.col("delta")).alias("target"), F.abs("delta").alias("delta"))
    found = targets.select(F.to_date("time").alias("target")).distinct().join(reach, "target")
    w = Window.partitionBy("target").orderBy("delta", F.col("date").desc())
    best = found.withColumn("_rank", F.row_number().over(w)).where("_rank = 1")
    once = Window.partitionBy("date").orderBy("delta", "target")
    return best.withColumn("_rank", F.row_number().over(once)).where("_rank = 1").select("target", "date", "delta")


def difference(df: DataFrame) -> DataFrame:
    """Each band minus its value at the pixel's time before; the first time is left out."""
    w = Window.partitionBy("y", "x").orderBy("time")
    out = df.withColumn("_before", F.lag("time").over(w)).withColumns({b: F.col(b) - F.lag(b).over(w) for b in bands_of(df)})
    return out.where("_before is not null").drop("_before")


def time_gaps(df: DataFrame) -> DataFrame:
    """(time, days) since the time before, over the distinct times."""
    w = Window.orderBy("time")
    return df.select("time").distinct().select("time", F.datediff("time", F.lag("time").over(w)).alias("days"))


def stretch(df: DataFrame, bands: list[str], lower: float = 0.02, upper: float = 0.98, accuracy: int | None = None) -> DataFrame:
    """Each band from its percentiles (``accuracy`` as in ``above_percentile``) to 0..255."""
    cuts = _percentiles(df, [(b, p) for b in bands for p in (lower, upper)], accuracy)
    ends = dict(zip(bands, zip(cuts[::2], cuts[1::2], strict=True), strict=True))
    return df.withColumns({b: F.least(F.lit(255.0), F.greatest(F.lit(0.0), (F.col(b) - lo) * 255 / F.nullif(hi - lo, F.lit(0.0)))) for b, (lo, hi) in ends.items()})


def area_hectares(df: DataFrame, hit: Column, grid: GridSpec) -> DataFrame:
    """(time, hectares) of pixels that meet a condition; coordinates in metres."""
    return df.groupBy("time").agg((F.sum(F.coalesce(hit, F.lit(False)).cast("int")) * abs(grid.dx * grid.dy) * 1e-4).alias("hectares"))


def space_mean(df: DataFrame, bands: list[str] | None = None) -> DataFrame:
    """(time, means of bands)."""
    return df.groupBy("time").agg(*(F.avg(b).alias(b) for b in bands or bands_of(df)))


def summary(df: DataFrame, band: str) -> DataFrame:
    """One row: min, max, mean and population deviation of a band."""
    return df.agg(F.min(band).alias("min"), F.max(band).alias("max"), F.avg(band).alias("mean"), F.stddev_pop(band).alias("std"))


def lookup(df: DataFrame, codes: DataFrame, band: str) -> DataFrame:
    """Pixels with what a code table (code, source, date) says of ``band``, and the date's number in order."""
    dates = codes.select("date").distinct().withColumn("date_index", F.row_number().over(Window.orderBy("date")) - 1)
    return df.join(codes.withColumnRenamed("code", band), band, "left").join(dates, "date", "left")
