"""Rasters as a Spark data source, and cubes loaded from many of them by chunks.

``read_rasters`` is a Python data source: a partition is a range of tile rows of
one file, conditions on path, sample, row, col, x and y are pushed into it, and
only the byte ranges of tiles that are left are read.

``load_cube`` puts overlapping rasters of any supported system onto one grid. The
grid is cut into chunks. A raster is dealt to the chunks its footprint meets (an
explode of chunk numbers, never a comparison of all pairs); a chunk of one time is
one group of a few rows, which opens its rasters in the mosaic's order, reads the
window that its cells still lack, and stops when none is missing. So a task reads
no more than its chunk, whatever a raster's size, and a raster behind others that
cover it is not read at all.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from ..errors import DatacubeCreationError
from ..functions import geometry as G
from ..model import GridSpec
from .tiff import Image, Ranges, fitting, store

FORMAT_NAME = "eocube_tiff"
SCHEMA = "path string, sample int, row int, col int, x double, y double, value double"
#: Pixels that a partition has at least, and files up to which headers are read in planning.
PART_PIXELS, PLANNED_FILES = 1 << 22, 1000
FOOTPRINT = "path string, time timestamp_ntz, band string, place long, sample int, epsg int, dx double, xmin double, ymin double, xmax double, ymax double"


def files_of(path: str) -> list[str]:
    """Paths of a folder's TIFF files, in order, or the file itself."""
    fs, name = store(path)
    info = fs.get_file_info(name)
    if info.type == pafs.FileType.Directory:
        return sorted(f.path for f in fs.get_file_info(pafs.FileSelector(name, recursive=True)) if f.is_file and f.extension.lower() in ("tif", "tiff"))
    return [name] if info.is_file else []


class _Part(InputPartition):
    def __init__(self, path: str, first: int, last: int | None):
        self.path, self.first, self.last = path, first, last


class RasterReader(DataSourceReader):
    def __init__(self, path: str, pixels: int):
        self.path, self.pixels = path, pixels
        self.least: dict[str, float] = {}
        self.most: dict[str, float] = {}
        self.paths: set[str] | None = None

    def pushFilters(self, filters):  # noqa: N802 - the name of the interface
        """Bounds of all columns but the value; those of whole numbers and paths need no second test."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") else ""
            if isinstance(f, IsNotNull) and name != "value":
                continue
            if name == "path" and isinstance(f, EqualTo | In):
                found = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.paths = found if self.paths is None else self.paths & found
                continue
            if name in ("sample", "row", "col", "x", "y") and self._bound(name, f):
                if name in ("x", "y"):
                    yield f  # prunes, and is tested again
                continue
            yield f

    def _bound(self, name: str, f) -> bool:
        step = 1 if name not in ("x", "y") else 0
        lo = f.value if isinstance(f, EqualTo | GreaterThanOrEqual) else f.value + step if isinstance(f, GreaterThan) else None
        hi = f.value if isinstance(f, EqualTo | LessThanOrEqual) else f.value - step if isinstance(f, LessThan) else None
        if lo is not None:
            self.least[name] = max(lo, self.least.get(name, lo))
        if hi is not None:
            self.most[name] = min(hi, self.most.get(name, hi))
        return lo is not None or hi is not None

    def _within(self, image: Image) -> tuple[int, int, int, int]:
        """The rows and columns that conditions leave: first and past the last."""
        dx, _, x0, _, dy, y0 = image.transform or (1.0, 0.0, -0.5, 0.0, 1.0, -0.5)
        edge = []
        for name, axis, size, origin, step in (("row", "y", image.height, y0, dy), ("col", "x", image.width, x0, dx)):
            lo, hi = max(0, self.least.get(name, 0)), min(size - 1, self.most.get(name, size - 1))
            ends = [(v - origin) / step - 0.5 for v in (self.least.get(axis, -math.inf), self.most.get(axis, math.inf))]
            low, high = min(ends), max(ends)
            lo = max(lo, math.ceil(low - 1e-6) if low > 0 else 0)
            hi = min(hi, math.floor(high + 1e-6) if high < size else size - 1)
            edge += [lo, hi + 1]
        return tuple(edge)

    def partitions(self):
        files = [f for f in files_of(self.path) if self.paths is None or f in self.paths]
        if len(files) > PLANNED_FILES:  # their headers are read by the tasks
            return [_Part(f, 0, None) for f in files]
        out = []
        for f in files:
            with Ranges(f) as read:
                image = Image(read)
            top, bottom, left, right = self._within(image)
            if top >= bottom or left >= right:
                continue
            rows = max(1, self.pixels // max(1, image.tile_h * (right - left))) * image.tile_h
            first = top // image.tile_h * image.tile_h
            out += [_Part(f, max(r, top), min(r + rows, bottom)) for r in range(first, bottom, rows)]
        return out or [_Part("", 0, 0)]

    def read(self, part):
        if not part.path:
            return
        with Ranges(part.path) as read:
            image = Image(read)
            top, bottom, left, right = self._within(image)
            top, bottom = max(top, part.first), min(bottom, part.last) if part.last is not None else bottom
            dx, _, x0, _, dy, y0 = image.transform or (1.0, 0.0, -0.5, 0.0, 1.0, -0.5)
            samples = range(int(max(0, self.least.get("sample", 0))), int(min(image.samples - 1, self.most.get("sample", image.samples - 1))) + 1)
            for r in range(top // image.tile_h * image.tile_h, bottom, image.tile_h):
                lo, hi = max(r, top), min(r + image.tile_h, bottom)
                if lo >= hi or left >= right or not samples:
                    continue
                a, _, _ = image.window((lo, left, hi - lo, right - left))
                rows, cols = (v.reshape(-1).astype(np.int32) for v in np.mgrid[lo:hi, left:right])
                for s in samples:
                    v = a[:, :, s].reshape(-1).astype(float)
                    gone = np.isnan(v) if image.nodata is None else (v == image.nodata) | np.isnan(v)
                    n = len(v)
                    yield pa.RecordBatch.from_arrays([pa.array([part.path] * n), pa.array(np.full(n, s, np.int32)), pa.array(rows), pa.array(cols), pa.array(x0 + (cols + 0.5) * dx), pa.array(y0 + (rows + 0.5) * dy), pa.array(v, mask=gone)], [c.split()[0] for c in SCHEMA.split(", ")])


class RasterSource(DataSource):
    """Options: path, and pixels (of a partition, about)."""

    @classmethod
    def name(cls):
        return FORMAT_NAME

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return RasterReader(self.options["path"], int(self.options.get("pixels", PART_PIXELS)))


def read_rasters(spark: SparkSession, path: str, pixels: int = PART_PIXELS) -> DataFrame:
    """Pixels of all TIFF files under ``path``; no-data values are missing. Conditions reach the files' tiles."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RasterSource)
    return spark.read.format(FORMAT_NAME).option("pixels", str(pixels)).load(path)


# -- cubes from many rasters ---------------------------------------------------------------


def _outline(image: Image, crs: int) -> tuple[float, float, float, float]:
    """The bounding box of a raster in another system, from points along its edges."""
    dx, _, x0, _, dy, y0 = image.transform
    t = np.linspace(0.0, 1.0, 33)
    w, h = dx * image.width, dy * image.height
    xs = np.concatenate([x0 + t * w, x0 + t * w, np.full(33, x0), np.full(33, x0 + w)])
    ys = np.concatenate([np.full(33, y0), np.full(33, y0 + h), y0 + t * h, y0 + t * h])
    xs, ys = G.transform_point(xs, ys, image.epsg or crs, crs, np)
    return float(xs.min()), float(ys.min()), float(xs.max()), float(ys.max())


def footprints(assets: DataFrame, crs: int, fail_on_error: bool = True) -> DataFrame:
    """``assets(path, time, band, place[, sample])`` with what the files' headers say, and their boxes in ``crs``.

    Files that can't be read are an error, or left out.
    """
    sample = F.col("sample").cast("int") if "sample" in assets.columns else F.lit(0)
    src = assets.select("path", F.col("time").cast("timestamp_ntz").alias("time"), "band", F.col("place").cast("long").alias("place"), sample.alias("sample"))

    def run(batches):
        for b in batches:
            out = []
            for i, path in enumerate(b.column("path").to_pylist()):
                try:
                    with Ranges(path) as read:
                        image = Image(read)
                        if image.transform is None:
                            raise ValueError("the raster has no place")
                        out.append((i, image.epsg or crs, abs(image.transform[0]), *_outline(image, crs)))
                except (OSError, ValueError, KeyError, struct.error) as e:  # nothing there, no TIFF file, or one that is cut short
                    if fail_on_error:
                        raise ValueError(f"{path}: {e}") from e
            own = b.take(pa.array([x[0] for x in out], pa.int64()))
            kinds = [pa.int32(), *[pa.float64()] * 5]
            yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array([x[k + 1] for x in out], t) for k, t in enumerate(kinds))], [c.split()[0] for c in FOOTPRINT.split(", ")])

    return src.mapInArrow(run, FOOTPRINT)


def grid_of(seen: DataFrame, crs: int, resolution: float | None = None, bbox: tuple[float, float, float, float] | None = None) -> GridSpec:
    """A grid over all ``footprints``, or a box: cells as wide as the finest raster's of that system, edges at their multiples."""
    r = seen.agg(F.min(F.when(F.col("epsg") == crs, F.col("dx"))).alias("dx"), *(F.min(c).alias(c) for c in ("xmin", "ymin")), *(F.max(c).alias(c) for c in ("xmax", "ymax"))).first()
    step = resolution or r.dx
    if r.xmin is None or not step:
        raise DatacubeCreationError("no raster, or none in the grid's system: give a resolution")
    x0, y0, x1, y1 = bbox or (r.xmin, r.ymin, r.xmax, r.ymax)
    left, right = math.floor(x0 / step + 1e-9), math.ceil(x1 / step - 1e-9)
    low, top = math.floor(y0 / step + 1e-9), math.ceil(y1 / step - 1e-9)
    return GridSpec((left + 0.5) * step, (top - 0.5) * step, step, -step, max(1, right - left), max(1, top - low))


def _sampled(image: Image, sample: int, x: np.ndarray, y: np.ndarray, crs: int, how: str) -> np.ndarray:
    """Values of a raster at points of a system; NaN where it has none."""
    sx, sy = G.transform_point(x, y, crs, image.epsg or crs, np)
    dx, _, x0, _, dy, y0 = image.transform
    u, v = (np.asarray(sx) - x0) / dx, (np.asarray(sy) - y0) / dy
    out = np.full(len(x), np.nan)
    on = (u >= 0) & (u < image.width) & (v >= 0) & (v < image.height)
    if not on.any():
        return out
    u, v = u[on], v[on]
    reach = 0 if how == "nearest" else 1
    top, left = max(0, int(v.min()) - reach), max(0, int(u.min()) - reach)
    a, top, left = image.window((top, left, int(v.max()) + 1 + reach - top, int(u.max()) + 1 + reach - left))
    a = a[:, :, sample].astype(float)
    if image.nodata is not None:
        a[a == image.nodata] = np.nan
    if how == "nearest":
        out[on] = a[np.floor(v).astype(int) - top, np.floor(u).astype(int) - left]
        return out
    u, v = u - 0.5, v - 0.5
    total, weight = np.zeros(len(u)), np.zeros(len(u))
    for j in (0, 1):
        for i in (0, 1):
            r, c = np.floor(v).astype(int) + j, np.floor(u).astype(int) + i
            w = (1 - abs(v - r)) * (1 - abs(u - c))
            there = (r >= top) & (r < top + a.shape[0]) & (c >= left) & (c < left + a.shape[1])
            got = np.where(there, a[np.clip(r - top, 0, a.shape[0] - 1), np.clip(c - left, 0, a.shape[1] - 1)], np.nan)
            w = np.where(np.isnan(got), 0.0, w)
            total, weight = total + w * np.nan_to_num(got), weight + w
    with np.errstate(invalid="ignore", divide="ignore"):
        out[on] = np.where(weight > 0, total / weight, np.nan)
    return out


def load_cube(assets: DataFrame, grid: GridSpec, bands: list[str], crs: int = 4326, chunk: int = 256, by: str = "time", resampling: str = "nearest", bbox: tuple[float, float, float, float] | None = None, fail_on_error: bool = True) -> DataFrame:
    """(time, y, x, bands): rasters ``assets(path, time, band, place[, sample])`` on a grid, the smallest place first.

    One image for each time, or with ``by="date"`` for each day. Cells that no
    raster covers have no row; ``bbox`` (of the grid's system) leaves out chunks
    beyond it before anything is read. Coarse grids read overviews.
    """
    if resampling not in ("nearest", "bilinear"):
        raise ValueError("resampling is 'nearest' or 'bilinear'")
    seen = footprints(assets, crs, fail_on_error).where(F.col("band").isin(bands))
    box = bbox or grid.extent
    clipped = {n: (F.greatest if n.endswith("min") else F.least)(F.col(n), F.lit(float(v))) for n, v in zip(("xmin", "ymin", "xmax", "ymax"), box, strict=True)}
    seen = seen.withColumns(clipped).where((F.col("xmin") < F.col("xmax")) & (F.col("ymin") < F.col("ymax")))

    def span(low, high, origin, step, n):
        ends = [(F.col(c) - origin) / step + 0.5 for c in (low, high)]
        first, last = (F.least(*ends), F.greatest(*ends))
        return F.sequence(F.greatest(F.lit(0), F.floor(first / chunk)).cast("int"), F.least(F.lit((n - 1) // chunk), F.floor(last / chunk)).cast("int"))

    inside = (F.col("xmax") > F.lit(grid.extent[0])) & (F.col("xmin") < F.lit(grid.extent[2])) & (F.col("ymax") > F.lit(grid.extent[1])) & (F.col("ymin") < F.lit(grid.extent[3]))
    when = F.date_trunc("day", "time").cast("timestamp_ntz") if by == "date" else F.col("time")
    dealt = seen.where(inside).withColumn("time", when).withColumn("ci", F.explode(span("xmin", "xmax", grid.x0, grid.dx, grid.nx))).withColumn("cj", F.explode(span("ymin", "ymax", grid.y0, grid.dy, grid.ny)))
    schema = "time timestamp_ntz, y double, x double, " + ", ".join(f"`{b}` double" for b in bands)

    def mosaic(table: pa.Table) -> pa.Table:
        ci, cj = (table.column(c)[0].as_py() for c in ("ci", "cj"))
        i = np.arange(ci * chunk, min((ci + 1) * chunk, grid.nx))
        j = np.arange(cj * chunk, min((cj + 1) * chunk, grid.ny))
        y, x = (v.reshape(-1) for v in np.meshgrid(grid.y0 + j * grid.dy, grid.x0 + i * grid.dx, indexing="ij"))
        if bbox is not None:
            own = (x >= bbox[0]) & (x <= bbox[2]) & (y >= bbox[1]) & (y <= bbox[3])
            x, y = x[own], y[own]
        out = {b: np.full(len(x), np.nan) for b in bands}
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("band", "place", "path", "sample")), strict=True))
        for band, _, path, sample in rows:
            left = np.flatnonzero(np.isnan(out[band]))
            if not len(left):  # the others lie behind what is there
                continue
            with Ranges(path) as read:
                first = Image(read)
                image = fitting(read, abs(grid.dx)) if (first.epsg or crs) == crs else first
                out[band][left] = _sampled(image, sample, x[left], y[left], crs, resampling)
        some = ~np.logical_and.reduce([np.isnan(v) for v in out.values()])
        n = int(some.sum())
        values = [pa.array(out[b][some], mask=np.isnan(out[b][some])) for b in bands]
        return pa.Table.from_arrays([pa.array([table.column("time")[0].as_py()] * n, pa.timestamp("us")), pa.array(y[some]), pa.array(x[some]), *values], names=["time", "y", "x", *bands])

    return dealt.select("time", "ci", "cj", "band", "place", "path", "sample").groupBy("time", "ci", "cj").applyInArrow(mosaic, schema)
