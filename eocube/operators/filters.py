"""Neighbourhood filters on images."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model import GridSpec


def box_sums(df: DataFrame, band: str, window: int, grid: GridSpec, dense: bool = False) -> DataFrame:
    """Count, sum and sum of squares of the valid pixels of each pixel's window: along rows, then along columns.

    In a dense cube (each cell of each time has a row) two window frames do. In
    a sparse one each pixel is dealt to the rows that it counts for, where a
    frame along the row adds up what is there: one shuffle on (time, row), no
    join; a cell without a row still counts for nobody but is passed by.
    """
    h = window // 2
    v = F.col(band).cast("double")
    rows = df.withColumn("_i", grid.column(F.col("x"))).withColumn("_j", grid.row(F.col("y")))
    along = Window.partitionBy("time", "_j").orderBy("_i").rangeBetween(-h, h)
    if dense:
        across = Window.partitionBy("time", "_i").orderBy("_j").rangeBetween(-h, h)
        one = rows.withColumns({"_n": F.count(v).over(along), "_s": F.sum(v).over(along), "_q": F.sum(v * v).over(along)})
        return one.withColumns({"_n": F.sum("_n").over(across), "_s": F.sum("_s").over(across), "_q": F.sum("_q").over(across)})
    own = F.struct(*(F.col(c) for c in df.columns))
    dealt = rows.select("time", "_i", "_j", v.alias("_c"), own.alias("_own"), F.explode(F.sequence(F.lit(-h), F.lit(h))).alias("_d"))
    dealt = dealt.where("_d = 0 or _c is not null").select("time", "_i", (F.col("_j") + F.col("_d")).alias("_j"), "_c", F.when(F.col("_d") == 0, F.col("_own")).alias("_own"))
    sums = dealt.withColumns({"_n": F.count("_c").over(along), "_s": F.sum("_c").over(along), "_q": F.sum(F.col("_c") * F.col("_c")).over(along)})
    return sums.where("_own is not null").select("_i", "_j", "_n", "_s", "_q", "_own.*")


def lee(df: DataFrame, band: str, window: int, grid: GridSpec, dense: bool = False) -> DataFrame:
    """Lee's speckle filter: mean + k (value - mean), where k is the local variance over local plus overall variance.

    Windows are square and of one time; variances are over valid pixels; a
    missing pixel stays missing.
    """
    sums = box_sums(df, band, window, grid, dense)
    mean = F.col("_s") / F.col("_n")
    sums = sums.withColumn("_m", mean).withColumn("_v", F.greatest(F.col("_q") / F.col("_n") - mean * mean, F.lit(0.0)))
    whole = df.groupBy("time").agg(F.var_pop(band).alias("_w"))
    k = F.col("_v") / F.nullif(F.col("_v") + F.col("_w"), F.lit(0.0))
    out = F.when(F.col(band).isNotNull(), F.col("_m") + F.coalesce(k, F.lit(0.0)) * (F.col(band) - F.col("_m")))
    return sums.join(whole, "time").withColumn(band, out).drop("_i", "_j", "_n", "_s", "_q", "_m", "_v", "_w")


def per_time(df: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str | None = None) -> DataFrame:
    """Any function of one time's pixels; an image must fit a task's memory."""
    return df.groupBy("time").applyInPandas(f, schema or df.schema)
