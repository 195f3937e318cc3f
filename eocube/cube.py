"""The cube: an immutable wrapper of a pixel table and its metadata; every operation is a plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .errors import DatacubeMaskingError, DatacubeValidationError, DatacubeVisualizationError
from .functions import geometry as G
from .functions import indices as I
from .model import KEYS, CubeMeta, GridSpec, bands_of, from_nan, to_nan
from .operators import buffer, filters, mask, ops, temporal, whittaker, zonal
from .session import work_dir


class Datacube:
    def __init__(self, df: DataFrame, meta: CubeMeta | None = None, time_coords: DataFrame | None = None):
        missing = [k for k in KEYS if k not in df.columns]
        if missing:
            raise DatacubeValidationError(f"the pixel table lacks {missing}")
        self._df, self.meta, self.time_coords = from_nan(df), meta or CubeMeta(), time_coords

    @property
    def df(self) -> DataFrame:
        return self._df

    def with_df(self, df: DataFrame, time_coords: DataFrame | None = None, **attrs) -> "Datacube":
        return Datacube(df, self.meta.with_attrs(**attrs), self.time_coords if time_coords is None else time_coords)

    # -- what is there --

    @property
    def bands(self) -> list[str]:
        return bands_of(self._df)

    @property
    def crs(self) -> str:
        return self.meta.crs

    @property
    def resolution(self) -> tuple[float, float]:
        return self.grid.dx, self.grid.dy

    @property
    def grid(self) -> GridSpec:
        if self.meta.grid is None:
            raise DatacubeValidationError("the cube has no grid; see infer_grid")
        return self.meta.grid

    @property
    def extent(self) -> tuple[float, float, float, float]:
        return self.grid.extent

    @property
    def timestamps(self) -> DataFrame:
        return self._df.select("time").distinct().orderBy("time")

    @property
    def shape(self) -> dict[str, int]:
        t, y, x = self._df.agg(F.count_distinct("time"), F.count_distinct("y"), F.count_distinct("x")).first()
        return {"time": t, "y": y, "x": x}

    def info(self) -> dict:
        return {"bands": self.bands, "crs": self.crs, "grid": self.meta.grid, **self.meta.attrs}

    def __repr__(self) -> str:
        return f"Datacube(bands={self.bands}, crs={self.crs})"

    def infer_grid(self) -> "Datacube":
        """The grid from the coordinates that occur, taken as regular."""
        one = lambda c: self._df.agg(F.min(c), F.max(c), F.count_distinct(c)).first()
        (x0, x1, nx), (y0, y1, ny) = one("x"), one("y")
        grid = GridSpec(float(x0), float(y0), (x1 - x0) / max(nx - 1, 1) or 1.0, (y1 - y0) / max(ny - 1, 1) or 1.0, nx, ny)
        return Datacube(self._df, CubeMeta(self.meta.crs, grid, self.meta.attrs), self.time_coords)

    def to_nan(self) -> DataFrame:
        """The pixel table with missing values as NaN, for those who leave the engine."""
        return to_nan(self._df)

    # -- operations --

    def apply_mask(self, mask_band: str = "cloud_mask", clear_values=None, exclude_values=None, custom: Callable[[DataFrame], Column] | None = None, mask_cube: "Datacube | None" = None, fill_value: float | None = None, statistics: bool = False, clear_cover: float | None = None, geometry=None, bbox=None, drop_mask: bool = False) -> "Datacube":
        df = self._df
        if mask_cube is not None:
            df = ops.merge(df, mask_cube.df.select(*KEYS, mask_band), "override")
        clear = mask.clear_condition(df, mask_band, clear_values, exclude_values, custom)
        out = mask.mask_pixels(df, mask_band, clear, fill_value, drop_mask)
        if clear_cover is not None and not statistics:
            raise DatacubeMaskingError("clear cover needs statistics=True")
        if not statistics:
            return self.with_df(out)
        stats = mask.statistics(df, clear, geometry, bbox)
        if clear_cover is not None:
            out, stats = mask.clear_cover(out, stats, clear_cover), stats.where(F.col("clear_percent") >= clear_cover)
        coords = stats if self.time_coords is None else self.time_coords.join(stats, "time", "left")
        return self.with_df(out, coords)

    def add_indices(self, indices, **params) -> "Datacube":
        return self.with_df(I.add_indices(self._df, indices, **params))

    def clip(self, geometry, **options) -> "Datacube":
        parts = [G.reproject(g, self.crs) if g.crs != self.crs else g for g in G.parse(geometry)]
        return self.with_df(ops.clip(self._df, parts, **options))

    def merge(self, other: "Datacube", compat: str = "no_conflicts") -> "Datacube":
        return self.with_df(ops.merge(self._df, other.df, compat), **other.meta.attrs)

    def select_time(self, start=None, end=None, check: bool = True) -> "Datacube":
        return self.with_df(ops.select_time(self._df, start, end, check))

    def select_bands(self, bands: list[str]) -> "Datacube":
        return self.with_df(self._df.select(*KEYS, *bands))

    def rechunk(self, by: str = "time") -> "Datacube":
        return self.with_df(ops.rechunk(self._df, by))

    def temporal_aggregate(self, method: str = "mean", freq: str = "1ME", groupby: str | None = None) -> "Datacube":
        return self.with_df(temporal.temporal_aggregate(self._df, method, freq, groupby))

    def resample(self, freq: str = "1ME", method: str = "mean") -> "Datacube":
        return self.temporal_aggregate(method, freq)

    def whittaker(self, beta: float = 1e4, weights: dict | None = None, bands: list[str] | None = None) -> "Datacube":
        names = bands or self.bands
        out = whittaker.smooth(self._df.select(*KEYS, *names), beta, weights, names)
        return self.with_df(out.withColumnRenamed("day", "time"))

    def zonal_stats(self, zones, reducers: list[str] | None = None, all_touched: bool = True, buffer_metres: float | None = None, metres_crs: str = "EPSG:6933") -> DataFrame:
        """Statistics by zone; with ``buffer_metres`` zones are first grown (shrunk) by metres of the plane ``metres_crs``."""
        dx, dy = self.resolution if self.meta.grid else (1.0, 1.0)
        if buffer_metres:
            parts = zones if isinstance(zones, DataFrame) else buffer.zones_of(self._df.sparkSession, zones)
            parts = buffer.buffer_metres(parts, buffer_metres, work_dir(self._df.sparkSession), self.meta.crs, metres_crs)
        else:
            parts = zones if isinstance(zones, DataFrame) else G.parse(zones)
        return zonal.zonal_stats(self._df, parts, reducers, all_touched, dx=dx, dy=dy)

    def lee_filter(self, band: str, window: int = 7) -> "Datacube":
        return self.with_df(filters.lee(self._df, band, window, self.grid))

    # -- data of pictures; drawing is left to others --

    def picture(self, bands: list[str], time: int = 0, background: float = 0.0) -> DataFrame:
        """Pixels of some bands at the time with number ``time``, missing ones as ``background``."""
        missing = [b for b in bands if b not in self.bands]
        if missing:
            raise DatacubeVisualizationError(f"no bands {missing}; there are {self.bands}")
        return ops.nth_time(self._df.select(*KEYS, *bands), time).fillna(background, bands)
