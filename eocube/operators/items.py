"""Operators on tables of items: de-duplication, assets, metadata, properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.collections import scale_rows
from ..functions.query_lang import property_of


def _key(items: DataFrame, name: str) -> Column:
    if name == "date":
        return F.coalesce(F.to_date("datetime").cast("string"), F.col("id").cast("string"))
    if name == "collection_id":
        return F.col("collection").cast("string")
    return F.coalesce(property_of(items, name).cast("string"), F.lit(""))


def deduplicate(items: DataFrame, by: str | list[str], keep: str = "last", order: str = "pos", ordered: bool = False) -> DataFrame:
    """One item for each key tuple, the first or last by ``order``; ``ordered``: in the order in which keys appear first.

    Keys are compared as separate columns, so no value can run into the next one.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep is 'first' or 'last', not {keep!r}")
    keys = [_key(items, n) for n in ([by] if isinstance(by, str) else by)]
    named = items.withColumns({f"_k{i}": k for i, k in enumerate(keys)})
    cols = [f"_k{i}" for i in range(len(keys))]
    w = Window.partitionBy(*cols)
    ranked = named.withColumn("_rank", F.row_number().over(w.orderBy(F.col(order).asc() if keep == "first" else F.col(order).desc())))
    if ordered:
        ranked = ranked.withColumn("_first", F.min(order).over(w))
    out = ranked.where("_rank = 1")
    return (out.orderBy("_first") if ordered else out).drop("_rank", "_first", *cols)


def footprint(items: DataFrame) -> Column:
    """The projection transform of the first asset by name, else the bbox (rounded where there are no assets)."""
    first = F.array_min(F.map_keys("assets"))
    transform = F.element_at("assets", first)["proj_transform"]
    rounded = F.transform("bbox", lambda v: F.round(v, 6))
    return F.coalesce(transform.cast("string"), F.when(F.size(F.map_keys("assets")) > 0, F.col("bbox").cast("string")), rounded.cast("string"))


def anchors(times: Column, minutes: float) -> Column:
    """Of sorted times, those that begin a group: each more than ``minutes`` after the last anchor."""
    gap = F.lit(round(minutes * 60_000_000))
    return F.aggregate(times, F.array().cast("array<bigint>"), lambda acc, t: F.when((F.size(acc) > 0) & (t - F.element_at(acc, -1) <= gap), acc).otherwise(F.concat(acc, F.array(t))))


def _sessions(items: DataFrame, place: list[str], time: str, minutes: float, closed: bool) -> DataFrame:
    """With _t (microseconds) and _s, a number for each stretch of a place's times without a gap of more than ``minutes`` (``closed``: or as much)."""
    gap = F.col("_t") - F.lag("_t").over(Window.partitionBy(*place).orderBy("_t"))
    most = round(minutes * 60_000_000)
    named = items.withColumn("_t", F.unix_micros(F.col(time).cast("timestamp")))
    cut = named.withColumn("_cut", F.coalesce((gap >= most) if closed else (gap > most), F.lit(False)).cast("long"))
    return cut.withColumn("_s", F.sum("_cut").over(Window.partitionBy(*place).orderBy("_t").rangeBetween(Window.unboundedPreceding, 0))).drop("_cut")


def near_duplicates(items: DataFrame, place: list[str], time: str = "datetime", updated: str = "updated", minutes: float = 60) -> DataFrame:
    """Of items of one place within ``minutes`` of the group's first item, all with the latest update.

    Grouping is greedy in time order. Times of a place are cut at gaps that end a
    group for certain; between two of them it is a fold within the JVM over
    times, not items.
    """
    named = _sessions(items, place, time, minutes, False)
    place = [*place, "_s"]
    found = named.groupBy(*place).agg(anchors(F.array_sort(F.collect_set("_t")), minutes).alias("_a"))
    starts = found.select(*place, F.explode("_a").alias("_t"), F.lit(True).alias("_start"))
    marked = named.join(starts, [*place, "_t"], "left")
    w = Window.partitionBy(*place).orderBy("_t").rangeBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_anchor", F.max(F.when(F.col("_start"), F.col("_t"))).over(w))
    newest = F.max(updated).over(Window.partitionBy(*place, "_anchor"))
    return marked.withColumn("_newest", newest).where(F.col(updated).eqNullSafe(F.col("_newest"))).withColumn("group_start", F.timestamp_micros("_anchor").cast("timestamp_ntz")).drop("_t", "_s", "_start", "_anchor", "_newest")


def replace_hrefs(items: DataFrame, path: str = "alternate.download.href") -> DataFrame:
    """Each asset's href from a dotted path within it, kept where that is missing."""
    parts = path.split(".")

    def at(asset: Column) -> Column:
        c = asset
        for p in parts:
            c = c[p]
        return c

    return items.withColumn("assets", F.transform_values("assets", lambda _, a: a.withField("href", F.coalesce(at(a), a["href"]))))


def http_href(href: Column) -> Column:
    """s3://bucket/key as an https address."""
    return F.regexp_replace(href, "^s3://([^/]+)/(.*)$", "https://$1.s3.amazonaws.com/$2")


def default_scales(assets: DataFrame, defaults: DataFrame) -> DataFrame:
    """scale, offset and nodata of (collection, asset) rows, from ``defaults`` where missing or zero."""
    d = defaults.select("collection", "asset", *(F.col(c).alias(f"_{c}") for c in ("scale", "offset", "nodata")))
    out = assets.join(d, ["collection", "asset"], "left")
    return out.withColumns({"scale": F.coalesce(F.nullif("scale", F.lit(0.0)), "_scale"), "offset": F.coalesce(F.nullif("offset", F.lit(0.0)), "_offset"), "nodata": F.coalesce("nodata", "_nodata")}).drop("_scale", "_offset", "_nodata")


def explode_assets(items: DataFrame, keys: list[str] | None = None, href: str | None = None) -> DataFrame:
    """(id, collection, asset, href, type): a row for each asset wanted, with the href of a dotted path."""
    out = items.select("id", "collection", F.explode("assets").alias("asset", "value"))
    if keys is not None:
        out = out.where(F.col("asset").isin(keys))
    found = F.col("value.href")
    if href:
        c = F.col("value")
        for p in href.split("."):
            c = c[p]
        found = F.coalesce(c, found)
    return out.select("id", "collection", "asset", found.alias("href"), F.col("value.type").alias("type"))


#: Who serves an address, by its form.
RESOLVERS = (("s3", "^s3://"), ("presigned", "[?&](X-Amz-Signature|Signature|sig)="), ("api", "/(assets|download)/"))


def resolver(href: Column) -> Column:
    out = F.lit("default")
    for name, pattern in reversed(RESOLVERS):
        out = F.when(href.rlike(pattern), F.lit(name)).otherwise(out)
    return F.when(href.isNotNull(), out)


def enrich(assets: DataFrame, headers: DataFrame, force: bool = False) -> DataFrame:
    """Fill the asset metadata of TIFF rows (id, asset, href, type, ...) from raster headers, keyed by href."""
    names = [c for c in headers.columns if c != "href" and c in assets.columns]
    h = headers.select("href", *(F.col(c).alias(f"_{c}") for c in names))
    tiff = F.coalesce(F.col("type").startswith("image/tiff"), F.lit(False))
    out = assets.join(h, "href", "left")
    pick = lambda c: F.coalesce(f"_{c}", c) if force else F.coalesce(c, f"_{c}")
    return out.withColumns({c: F.when(tiff, pick(c)).otherwise(F.col(c)) for c in names}).drop(*(f"_{c}" for c in names))


def promote(assets: DataFrame, names: list[str], item: str = "id") -> DataFrame:
    """For each item, the values that all its assets agree on; NULL where there are several or none."""
    return assets.groupBy(item).agg(*(F.when(F.size(F.collect_set(n)) == 1, F.first(n, ignorenulls=True)).alias(n) for n in names))


def last_occurrences(first: DataFrame, second: DataFrame, time: str = "time", order: str = "pos") -> DataFrame:
    """Of each date of ``first``, its last rows: as many as ``second`` has of that date."""
    n = second.groupBy(F.to_date(time).alias("_date")).agg(F.count("*").alias("_n"))
    ranked = first.withColumn("_date", F.to_date(time)).withColumn("_rank", F.row_number().over(Window.partitionBy(F.to_date(F.col(time))).orderBy(F.col(order).desc())))
    return ranked.join(n, "_date").where("_rank <= _n").drop("_date", "_rank", "_n")


def polarizations(assets: Column) -> Column:
    """VV, VH, HH, HV of an item by the names of its assets."""
    keys = F.array_join(F.transform(F.map_keys(assets), lambda k: F.lower(k)), "\n")
    return F.array_compact(F.array(*[F.when(keys.contains(p), F.lit(p.upper())) for p in ("vv", "vh", "hh", "hv")]))


def filter_by_polarization(items: DataFrame, required: list[str]) -> DataFrame:
    want = F.array(*[F.lit(p.upper()) for p in required])
    return items.where(F.size(F.array_except(want, polarizations(F.col("assets")))) == 0)


def filter_by_cloud_cover(items: DataFrame, most: float, name: str = "eo:cloud_cover") -> DataFrame:
    """Strictly less than ``most``; unknown cover is dropped."""
    return items.where(property_of(items, name).cast("double") < most)


def item_info(items: DataFrame, names: dict[str, str]) -> DataFrame:
    """The id and some properties under new names."""
    return items.select("id", *(property_of(items, p).alias(n) for n, p in names.items()))


def default_scale_table(spark) -> DataFrame:
    """The known default scales as a table for ``default_scales``."""
    return spark.createDataFrame(scale_rows(), "collection string, asset string, scale double, offset double, nodata double")


def enhance_assets(items: DataFrame, alternate: str | None = "download", http: bool = False, add_default_scale: bool = False) -> DataFrame:
    """Alternate addresses, https addresses and default scales for the items' assets, in this order."""
    out = replace_hrefs(items, f"alternate.{alternate}.href") if alternate else items
    if http:
        out = out.withColumn("assets", F.transform_values("assets", lambda _, a: a.withField("href", http_href(a["href"]))))
    if add_default_scale:
        # the table has a few rows; it becomes a literal map, so the items need no join
        known = F.create_map(*[x for c, a, s, o, n in scale_rows() for x in (F.lit(f"{c}/{a}"), F.struct(F.lit(s).alias("scale"), F.lit(o).alias("offset"), F.lit(n).alias("nodata")))])

        def filled(name, a):
            d = known[F.concat(F.col("collection"), F.lit("/"), name)]

            def one(b):
                for f in ("scale", "offset"):
                    b = b.withField(f, F.coalesce(F.nullif(b[f], F.lit(0.0)), d[f], b[f]))
                return b.withField("nodata", F.coalesce(b["nodata"], d["nodata"]))

            return a.withField("raster_bands", F.transform(a["raster_bands"], one))

        out = out.withColumn("assets", F.transform_values("assets", filled))
    return out


def thin(items: DataFrame, place: list[str], minutes: float = 5, time: str = "datetime") -> DataFrame:
    """Items of a place that are ``minutes`` or more after the last one kept; of equal times all are kept."""
    named = _sessions(items, place, time, minutes, True)
    place = [*place, "_s"]
    # anchors are more than a gap apart; times count in whole microseconds
    kept = named.groupBy(*place).agg(anchors(F.array_sort(F.collect_set("_t")), minutes - 1 / 60_000_000).alias("_a"))
    return named.join(kept.select(*place, F.explode("_a").alias("_t")), [*place, "_t"], "left_semi").drop("_t", "_s")
