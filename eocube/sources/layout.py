"""A catalogue laid out so that searches skip what they can't need.

Items are written by month, and within a month by the size of their boxes and the
place of their centres on a space-filling curve, so that a file and a row group
hold neighbours. A box becomes ranges of that curve, grown by what an item of each
size reaches beyond its centre; a span of time becomes months. These are plain
comparisons of stored numbers: Spark prunes folders by them and Parquet row groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import query_lang as Q
from . import catalog

#: Bits of a coordinate on the curve, and the widest box of each size in degrees.
BITS = 16
SIZES = (0.01, 0.1, 1.0, 8.0, 64.0, 360.0)
#: Ranges of the curve that a box becomes at most, for each size.
RANGES = 24
OWN = ("_month", "_size", "_curve")


def _corner(bbox: Column, k: int) -> Column:
    """The k-th of west, south, east and north of a box of four or six numbers."""
    six = F.element_at(bbox, (1, 2, 4, 5)[k])
    return F.when(F.size(bbox) == 6, six).otherwise(F.element_at(bbox, k + 1))


def _spread(c: Column) -> Column:
    """Sixteen bits, one place apart."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def _scaled(c: Column, low: float, wide: float) -> Column:
    top = (1 << BITS) - 1
    return F.least(F.lit(top), F.greatest(F.lit(0), F.floor((c - low) / wide * (1 << BITS)))).cast("long")


def curve(lon: Column, lat: Column) -> Column:
    """The place of a point on the curve: the bits of its coordinates in turn."""
    return _spread(_scaled(lon, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(_scaled(lat, -90.0, 180.0)), 1))


def curve_ranges(box: tuple[float, float, float, float], most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of the curve, both ends in, that hold all points of a box: squares are cut while there are few enough."""
    edge = 1 << BITS
    cell = lambda v, low, wide: min(edge - 1, max(0, int((v - low) // (wide / edge))))
    x0, x1 = cell(box[0], -180.0, 360.0), cell(box[2], -180.0, 360.0)
    y0, y1 = cell(box[1], -90.0, 180.0), cell(box[3], -90.0, 180.0)
    done, todo = [], [(0, 0, 0, edge)]  # first place on the curve, corner, side
    while todo and len(done) + len(todo) <= most:
        todo.sort(key=lambda s: -s[3])
        z, x, y, side = todo.pop(0)
        if x0 <= x and x + side - 1 <= x1 and y0 <= y and y + side - 1 <= y1 or side == 1:
            done.append((z, x, y, side))
            continue
        half = side // 2
        for k in range(4):
            a, b = x + (k & 1) * half, y + (k >> 1) * half
            if a <= x1 and a + half > x0 and b <= y1 and b + half > y0:
                todo.append((z + k * half * half, a, b, half))
    spans = sorted((z, z + side * side - 1) for z, _, _, side in done + todo)
    out = spans[:1]
    for lo, hi in spans[1:]:
        if lo == out[-1][1] + 1:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def lay_out(items: DataFrame, path: str, files: int | None = None) -> None:
    """Write items; ``files`` (by default the number of shuffle partitions) are split at months.

    Items without a time or a box are kept, in folders and sizes of their own that every search reads.
    """
    box = [_corner(F.col("bbox"), k) for k in range(4)]
    wide = F.greatest(box[2] - box[0], box[3] - box[1])
    size = reduce(lambda c, k: c.when(wide <= SIZES[k], k), range(1, len(SIZES)), F.when(wide <= SIZES[0], 0))
    marked = items.withColumn("_month", (F.year("datetime") * 100 + F.month("datetime"))).withColumn("_size", F.coalesce(size, F.lit(-1))).withColumn("_curve", F.coalesce(curve((box[0] + box[2]) / 2, (box[1] + box[3]) / 2), F.lit(0)).cast("long"))
    n = files or int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked.repartitionByRange(n, *OWN).sortWithinPartitions(*OWN).write.partitionBy("_month").mode("overwrite").parquet(path)


def search(spark: SparkSession, path: str, *, datetime=None, bbox=None, intersects=None, **more) -> DataFrame:
    """``catalog.search`` on a catalogue that was laid out; conditions of time and place skip folders and row groups."""
    items = spark.read.parquet(path)
    if datetime is not None:
        lo, hi = Q.parse_range(datetime)
        if lo is not None:
            items = items.where(F.col("_month") >= lo.year * 100 + lo.month)
        if hi is not None:
            items = items.where(F.col("_month") <= hi.year * 100 + hi.month)
    area = G.parse_bbox(bbox) if bbox is not None else G.total_bounds(G.parse(intersects)) if intersects is not None else None
    if area is not None:
        near = F.col("_size") == -1
        for k, wide in enumerate(SIZES):
            reach = wide / 2 + 1e-9
            spans = curve_ranges((area[0] - reach, area[1] - reach, area[2] + reach, area[3] + reach))
            near |= (F.col("_size") == k) & reduce(lambda a, b: a | b, (F.col("_curve").between(*s) for s in spans))
        items = items.where(near)
    return catalog.search(items, datetime=datetime, bbox=bbox, intersects=intersects, **more).drop(*OWN)
