"""Aggregation along time, and filling of gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DatacubeOperationError
from ..functions.freq import bucket, needs_origin, step_of
from ..model import bands_of

#: Aggregates by name; deviation and variance are those of the population.
METHODS = {
    "mean": F.avg,
    "median": F.median,
    "min": F.min,
    "max": F.max,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "std": F.stddev_pop,
    "var": F.var_pop,
}


def _method(name: str):
    if name not in METHODS:
        raise ValueError(f"method is one of {sorted(METHODS)}, not {name!r}")
    return METHODS[name]


def temporal_aggregate(df: DataFrame, method: str = "mean", freq: str = "1ME", groupby: str | None = None, fill_gaps: bool = False) -> DataFrame:
    """One image for each period, or for each date with ``groupby="time.date"``; missing values are skipped.

    One shuffle on (period, y, x), partly aggregated before it. ``fill_gaps``
    adds an image of missing values for each period without data between the
    first and the last: rows for the cells of the grid and those periods alone.
    """
    if "time" not in df.columns:
        raise DatacubeOperationError("the cube has no time")
    f = _method(method)
    if groupby not in (None, "time.date"):
        raise ValueError(f"groupby is 'time.date', not {groupby!r}")
    bands = bands_of(df)
    if groupby:
        label = F.to_date("time")
    elif needs_origin(freq):
        first = df.agg(F.min("time").alias("_origin"))
        df = df.crossJoin(F.broadcast(first))
        label = bucket(F.col("time"), freq, F.col("_origin"))
    else:
        label = bucket(F.col("time"), freq)
    out = df.groupBy(label.alias("time"), "y", "x").agg(*(f(b).alias(b) for b in bands))
    if not fill_gaps:
        return out
    empty = periods(df, "1D" if groupby else freq).join(out.select("time").distinct(), "time", "left_anti")
    missing = out.select("y", "x").distinct().crossJoin(empty)
    return out.unionByName(missing, allowMissingColumns=True).select("time", "y", "x", *bands)


def periods(df: DataFrame, freq: str) -> DataFrame:
    """(time): the labels of all periods from the first to the last time of ``df``, by the rule that labels them."""
    span = df.agg(F.min("time").alias("_lo"), F.max("time").alias("_hi")).where("_lo is not null")
    step = step_of(freq)
    first = F.to_date("_lo").cast("timestamp_ntz") if step else F.to_date("_lo")
    every = span.select("_lo", "_hi", F.explode(F.sequence(first, F.col("_hi") if step else F.to_date("_hi"), F.expr(f"interval {step or '1 day'}"))).alias("_t"))
    return every.select(bucket(F.col("_t"), freq, F.col("_lo")).alias("time"), (bucket(F.col("_lo"), freq, F.col("_lo"))).alias("_from")).where("time >= _from").select("time").distinct()


def by_date_if_repeated(df: DataFrame, method: str = "mean") -> DataFrame:
    """Images of one date become one; if no date repeats, times stay as they are."""
    times = df.select("time").distinct()
    dup = times.agg((F.count_distinct(F.to_date("time")) < F.count("*")).alias("_dup"))
    f = _method(method)
    label = F.when(F.col("_dup"), F.to_date("time").cast("timestamp_ntz")).otherwise(F.col("time"))
    return df.crossJoin(F.broadcast(dup)).groupBy(label.alias("time"), "y", "x").agg(*(f(b).alias(b) for b in bands_of(df)))


def gap_fill(df: DataFrame, value: str, series: list[str], time: str = "time") -> DataFrame:
    """A row for each day between a series' first and last one, linear between neighbours.

    Each observation makes the days up to the next, so nothing is joined and the
    window sees observations only.
    """
    w = Window.partitionBy(*series).orderBy("_day")
    day = df.where(F.col(value).isNotNull()).withColumn("_day", F.to_date(time))
    ahead = day.withColumn("_next", F.lead("_day").over(w)).withColumn("_then", F.lead(value).over(w))
    n = F.datediff("_next", "_day")
    steps = F.sequence(F.lit(0), F.coalesce(n - 1, F.lit(0)))
    out = ahead.select(*series, "_day", value, "_then", n.alias("_n"), F.explode(steps).alias("_k"))
    lerp = F.when(F.col("_k") == 0, F.col(value)).otherwise(F.col(value) + (F.col("_then") - F.col(value)) * F.col("_k") / F.col("_n"))
    return out.select(*series, F.date_add("_day", F.col("_k")).alias("day"), lerp.alias(value))


def fill_dates(df: DataFrame, targets: DataFrame, value: str, series: list[str], method: str = "ffill") -> DataFrame:
    """The last (``ffill``) or next (``bfill``) value of each series at each of its target days; an as-of join by one window."""
    own = df.select(*series, F.to_date("time").alias("day"), value, F.lit(False).alias("_asked"))
    asked = targets.select(*series, F.to_date("time").alias("day"), F.lit(None).cast("double").alias(value), F.lit(True).alias("_asked"))
    order = [F.col("day").asc(), F.col("_asked").asc()] if method == "ffill" else [F.col("day").desc(), F.col("_asked").asc()]
    w = Window.partitionBy(*series).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return own.unionByName(asked).withColumn(value, F.last(value, ignorenulls=True).over(w)).where("_asked").select(*series, "day", value)


def percentile(c: Column, p: float) -> Column:
    return F.percentile(c, F.lit(p))
