"""Building cubes: loading, scale and offset, properties as coordinates, band names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import DatacubeCreationError
from ..model import KEYS, bands_of, from_nan
from ..sources.loaders import load


def build(spark: SparkSession, source: DataFrame | str, engine: str = "parquet", assets: list[str] | dict[str, str] | None = None, nodata: dict[str, float] | None = None, dtype: str | None = None, **options) -> DataFrame:
    """A pixel table with one row for each cell, missing values as NULL.

    ``assets`` selects bands, as a dict it renames them too; ``nodata`` values become missing.
    """
    df = load(spark, engine, source, **options) if isinstance(source, str) else source
    if "latitude" in df.columns or "longitude" in df.columns:
        df = df.withColumnsRenamed({"latitude": "y", "longitude": "x"})
    for c in KEYS:
        if c not in df.columns:
            raise DatacubeCreationError(f"the pixel table has no column {c!r}")
    if assets is not None:
        missing = [a for a in assets if a not in df.columns]
        if missing:
            raise DatacubeCreationError(f"missing assets: {missing}")
        df = df.select(*KEYS, *assets)
    df = from_nan(df.where(F.col("time").isNotNull()))
    if nodata:
        df = df.withColumns({b: F.when(F.col(b) != v, F.col(b)) for b, v in nodata.items() if b in df.columns})
    if dtype:
        df = df.withColumns({b: F.col(b).cast(dtype) for b in bands_of(df)})
    return df.withColumnsRenamed(assets) if isinstance(assets, dict) else df


def one_per_cell(df: DataFrame, how: dict[str, str] | None = None) -> DataFrame:
    """Cells that several rows give become one: the mean, or what ``how`` names for a band."""
    return df.groupBy(*KEYS).agg(*(F.expr(f"{(how or {}).get(b, 'avg')}(`{b}`)").alias(b) for b in bands_of(df)))


def scale_offset(df: DataFrame, params: DataFrame, on: str = "time", order: str | None = None, bands: list[str] | None = None) -> DataFrame:
    """value * scale + offset with the parameters of the pixel's time.

    ``params`` has ``on`` and, for each band, ``<band>_scale`` and ``<band>_offset``;
    what is missing is the identity. Of several rows of one time, the last by
    ``order`` counts. Parameters have a row for each time, so the join is a
    broadcast if they are small and a shuffle on time if not.
    """
    todo = [b for b in bands or bands_of(df) if f"{b}_scale" in params.columns or f"{b}_offset" in params.columns]
    if not todo:
        return df
    cols = [c for b in todo for c in (f"{b}_scale", f"{b}_offset") if c in params.columns]
    p = params.groupBy(on).agg(*(F.max_by(c, order).alias(c) if order else F.first(c).alias(c) for c in cols))
    both = df.join(p, on, "left")
    part = lambda c, d: F.coalesce(F.col(c), F.lit(d)) if c in cols else F.lit(d)
    new = {b: F.col(b) * part(f"{b}_scale", 1.0) + part(f"{b}_offset", 0.0) for b in todo}
    return both.withColumns(new).drop(*cols)


#: Since this day the products' own offset is applied already.
S2_SINCE, S2_COLLECTION = "2022-02-28", "sentinel-2-l2a"
S2_BANDS = ("coastal", "blue", "green", "red", "rededge1", "rededge2", "rededge3", "nir", "nir08", "swir16", "swir22")


def legacy_offset(collection: Column, band: str, time: Column, offset: Column) -> Column:
    """The offset, 0 for the reflectance bands of the collection whose products changed."""
    rule = (collection == S2_COLLECTION) & (time >= F.lit(S2_SINCE).cast("timestamp_ntz"))
    return F.when(rule, 0.0).otherwise(offset) if band in S2_BANDS else offset


def attribute_scale(value: Column, attrs: Column) -> Column:
    """Scale and offset from whichever attribute is there; what is no number is the identity."""
    first = lambda names, d: F.coalesce(*(attrs[n].try_cast("double") for n in names), F.lit(d))
    return value * first(("scale_factor", "scale", "scaling_factor"), 1.0) + first(("add_offset", "offset"), 0.0)


def time_properties(times: DataFrame, items: DataFrame, names: list[str], order: str = "pos") -> DataFrame:
    """The properties of the last item of each time, NULL where a time has none; keyed by time, never copied to pixels."""
    own = items.groupBy(F.col("datetime").alias("time")).agg(*(F.max_by(n, order).alias(n) for n in names))
    return times.select("time").distinct().join(own, "time", "left")


def _numbered(rows: DataFrame, time: str, *order: str) -> DataFrame:
    """With _n, the place from 1 by time and ``order``, nulls first: rows are numbered within their day, only days' counts are summed in one task."""
    marked = rows.withColumn("_day", F.to_date(time))
    days = marked.groupBy(F.col("_day").alias("_of")).agg(F.count("*").alias("_c"))
    before = days.select("_of", F.coalesce(F.sum("_c").over(Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = marked.withColumn("_k", F.row_number().over(Window.partitionBy("_day").orderBy(time, *order)))
    return ranked.join(before, F.col("_day").eqNullSafe(F.col("_of"))).withColumn("_n", F.col("_k") + F.col("_before")).drop("_day", "_of", "_before", "_k")


def positional_properties(times: DataFrame, items: DataFrame, names: list[str], order: str = "pos") -> DataFrame:
    """The properties of the items by position: the n-th time gets those of the n-th item; times beyond the items get none."""
    own = _numbered(times.select("time").distinct(), "time")
    ranked = _numbered(items, "datetime", order).select("_n", *names)
    return own.join(ranked, "_n", "left").drop("_n")


def wrap_longitude(df: DataFrame, x: str = "x") -> DataFrame:
    """0..360 becomes -180..180 if there is anything beyond 180 and nothing below 0."""
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None or lo < 0 or hi <= 180:
        return df
    return df.withColumn(x, F.pmod(F.col(x) + 180, F.lit(360.0)) - 180)


#: Common names of the bands of public collections; red edges by their wavelength in tens of nanometres.
COMMON = {
    "sentinel-2-l2a": {b: b for b in (*S2_BANDS, "scl")} | {"rededge70": "rededge1", "rededge74": "rededge2", "rededge78": "rededge3", "swir1": "swir16", "swir2": "swir22", "cloud_mask": "scl"},
    "landsat-c2l2-sr": {"coastal": "coastal", "blue": "blue", "green": "green", "red": "red", "nir": "nir08", "swir1": "swir16", "swir2": "swir22", "cloud_mask": "qa_pixel"},
    "venus-l2a": {
        "coastal": "image_file_SRE_B02", "blue": "image_file_SRE_B03", "green": "image_file_SRE_B04", "red": "image_file_SRE_B07", "rededge70": "image_file_SRE_B08", "rededge74": "image_file_SRE_B09",
        "rededge78": "image_file_SRE_B10", "nir": "image_file_SRE_B11", "cloud_mask": "detailed_cloud_mask",
    },
}


def common_bands(collection: str) -> dict[str, str]:
    """The known common names of a collection's bands, an error for another collection."""
    if collection not in COMMON:
        raise NotImplementedError(f"no common band names for {collection!r}; there are {sorted(COMMON)}")
    return dict(COMMON[collection])


def map_bands(collection: str, assets: list[str] | dict | None) -> dict[str, str] | dict | list[str] | None:
    """{asset: the name it was asked by}, which is a common name or the asset's own.

    What a known collection lacks is dropped; an unknown one and a dict pass through.
    """
    if assets is None or isinstance(assets, dict) or collection not in COMMON:
        return assets
    own = COMMON[collection]
    held = set(own.values())
    return {own.get(a, a): a for a in assets if a in own or a in held}


#: Resampling kernels by number.
KERNELS = ("nearest", "bilinear", "cubic", "cubic_spline", "lanczos", "average", "mode", "gauss", "max", "min", "med", "q1", "q3")


def load_options(**options) -> dict:
    """Options under their own names: epsg as crs, kernels by name, and of several areas the most exact one."""
    out = {k: v for k, v in options.items() if v is not None}
    if "epsg" in out:
        out["crs"] = f"EPSG:{out.pop('epsg')}"
    if isinstance(out.get("resampling"), int):
        out["resampling"] = KERNELS[out["resampling"]]
    for better, worse in (("geobox", "geopolygon"), ("geobox", "intersects"), ("geobox", "bbox"), ("geopolygon", "intersects"), ("intersects", "bbox")):
        if better in out:
            out.pop(worse, None)
    return out
