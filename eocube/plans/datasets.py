"""The driver's tables as cubes, items, series and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import Geometry, box
from ..model import GridSpec
from ..operators.xcal import RULES

ZONES = [box(0, 0, 500, 50), box(250, 25, 900, 75), box(5000, 0, 6000, 10)]
TRIANGLE = Geometry("Polygon", (((100.0, 10.0), (1500.0, 10.0), (1500.0, 80.0)),))
GRID = GridSpec(0.0, 0.0, 1.0, 1.0, 2000, 100)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as observations: several may fall on a cell."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("time"), F.col("l_suppkey").alias("y"), F.col("l_partkey").alias("x"),
        F.col("l_discount").alias("red"), F.col("l_quantity").alias("nir"), F.col("l_tax").alias("swir16"), F.col("l_extendedprice").alias("blue"),
        F.col("l_linenumber").alias("scl"), F.concat("l_returnflag", "l_linestatus").alias("platform"),
    )


def pixels(spark: SparkSession, sf_dir: str, *bands: str) -> DataFrame:
    """One row for each cell: mean bands, smallest class; only the bands asked for are read."""
    how = {"red": F.avg, "nir": F.avg, "swir16": F.avg, "blue": F.avg, "scl": F.min}
    return raw_pixels(spark, sf_dir).groupBy("time", "y", "x").agg(*(how[b](b).alias(b) for b in bands or how))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    place = (F.col("o_custkey") % 50).cast("double")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("collection"), F.col("o_orderdate").alias("datetime"), F.col("o_orderstatus").alias("platform"),
        ((F.col("o_orderkey") * 37) % 101).alias("cloud_cover"), (F.col("o_custkey") % 50).alias("footprint"), F.array(place, place, place + 1.5, place + 1.5).alias("bbox"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 7).cast("int")).alias("updated"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("pos"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("ts").alias("time"), F.col("user_id").alias("pixel"), "event_id", "event_type", "value", "props")


def event_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir).select("time", (F.col("pixel") % 10).alias("y"), F.col("pixel").alias("x"), "value")


def rules(spark: SparkSession) -> DataFrame:
    rows = [
        "(1, 'AF', TIMESTAMP_NTZ'1990-01-01', TIMESTAMP_NTZ'1996-12-31', 'nir', NULL, NULL, 2.0D, 0.5D)",
        "(2, 'AF', TIMESTAMP_NTZ'1996-01-01', CAST(NULL AS TIMESTAMP_NTZ), 'nir', NULL, NULL, 1.5D, 0.0D)",
        "(3, 'RF', TIMESTAMP_NTZ'1990-01-01', CAST(NULL AS TIMESTAMP_NTZ), 'nir', NULL, 20.0D, 1.0D, 0.5D)",
        "(3, 'RF', TIMESTAMP_NTZ'1990-01-01', CAST(NULL AS TIMESTAMP_NTZ), 'nir', 20.0D, 40.0D, 2.0D, 0.0D)",
        "(4, '', TIMESTAMP_NTZ'1999-01-01', CAST(NULL AS TIMESTAMP_NTZ), 'nir', NULL, NULL, 0.5D, 1.0D)",
    ]
    names = ", ".join(c.split()[0] for c in RULES.split(", "))
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})").select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in RULES.split(", ")))
