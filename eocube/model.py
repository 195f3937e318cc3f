"""Data model: grids, cube metadata, and the schemas of catalogue tables.

A cube is a wide pixel table (time, y, x, one column for each band) with its
small metadata on the driver. Missing values are NULL inside the engine; NaN is
turned into NULL where data enter and back where they leave.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME, Y, X = "time", "y", "x"
KEYS = (TIME, Y, X)


@dataclass(frozen=True)
class GridSpec:
    """Pixel centres x0 + i*dx, y0 + j*dy; dy is negative where rows go down."""

    x0: float
    y0: float
    dx: float
    dy: float
    nx: int
    ny: int

    @property
    def extent(self) -> tuple[float, float, float, float]:
        """Outer edges: xmin, ymin, xmax, ymax."""
        xs = (self.x0 - self.dx / 2, self.x0 + (self.nx - 0.5) * self.dx)
        ys = (self.y0 - self.dy / 2, self.y0 + (self.ny - 0.5) * self.dy)
        return min(xs), min(ys), max(xs), max(ys)

    def column(self, x: Column) -> Column:
        return F.round((x - self.x0) / self.dx).cast("int")

    def row(self, y: Column) -> Column:
        return F.round((y - self.y0) / self.dy).cast("int")


@dataclass(frozen=True)
class CubeMeta:
    crs: str = "EPSG:4326"
    grid: GridSpec | None = None
    attrs: dict = field(default_factory=dict)

    def with_attrs(self, **more) -> "CubeMeta":
        return replace(self, attrs=self.attrs | more)


ASSET = T.StructType(
    [
        T.StructField("href", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("roles", T.ArrayType(T.StringType())),
        T.StructField("gsd", T.DoubleType()),
        T.StructField("proj_code", T.StringType()),
        T.StructField("proj_epsg", T.IntegerType()),
        T.StructField("proj_wkt2", T.StringType()),
        T.StructField("proj_transform", T.ArrayType(T.DoubleType())),
        T.StructField("proj_shape", T.ArrayType(T.IntegerType())),
        T.StructField(
            "raster_bands",
            T.ArrayType(T.StructType([T.StructField("data_type", T.StringType()), *(T.StructField(n, T.DoubleType()) for n in ("scale", "offset", "nodata", "spatial_resolution")), T.StructField("unit", T.StringType())])),
        ),
        T.StructField("alternate", T.MapType(T.StringType(), T.StructType([T.StructField("href", T.StringType())]))),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("start_datetime", T.TimestampNTZType()),
        T.StructField("end_datetime", T.TimestampNTZType()),
        T.StructField("geometry", T.StringType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("properties", T.StringType()),
        T.StructField("assets", T.MapType(T.StringType(), ASSET)),
        T.StructField("stac_extensions", T.ArrayType(T.StringType())),
        T.StructField("links", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("rel", "href", "type")]))),
    ]
)

JOB = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("job_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        *(T.StructField(n, T.LongType()) for n in ("items_total_count", "items_written_count", "items_deleted_count", "items_skipped_count", "items_error_count")),
        T.StructField("items_skipped_subset", T.ArrayType(T.StringType())),
        T.StructField("item_errors_subset", T.ArrayType(T.StringType())),
    ]
)


def bands_of(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEYS]


def from_nan(df: DataFrame, bands: list[str] | None = None) -> DataFrame:
    """NaN becomes NULL, so that every aggregate skips it."""
    kinds = dict(df.dtypes)
    todo = [b for b in bands or bands_of(df) if kinds[b] in ("float", "double")]
    return df.withColumns({b: F.when(~F.isnan(b), F.col(b)) for b in todo}) if todo else df


def to_nan(df: DataFrame, bands: list[str] | None = None) -> DataFrame:
    kinds = dict(df.dtypes)
    todo = [b for b in bands or bands_of(df) if kinds[b] in ("float", "double")]
    return df.withColumns({b: F.coalesce(F.col(b), F.lit(float("nan")).cast(kinds[b])) for b in todo}) if todo else df
