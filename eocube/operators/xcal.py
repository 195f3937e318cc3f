"""Cross-sensor calibration by rules that hold for a platform and a span of time."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RULES = "rule int, platform string, published timestamp_ntz, expires timestamp_ntz, band string, low double, high double, scale double, offset double"


def matching(times: DataFrame, rules: DataFrame) -> DataFrame:
    """(time, platform, rule): the first rule of the platform that holds at the time, else of the general platform ''.

    Rules are few; times are distinct (time, platform) pairs, not pixels.
    """
    heads = rules.select("rule", F.col("platform").alias("_p"), "published", "expires").distinct()
    holds = (F.col("time") >= F.col("published")) & (F.col("expires").isNull() | (F.col("time") <= F.col("expires")))
    asked = times.withColumn("_p", F.explode(F.array_distinct(F.array(F.coalesce("platform", F.lit("")), F.lit("")))))
    found = asked.join(heads, "_p").where(holds)
    w = Window.partitionBy("time", "platform").orderBy((F.col("_p") == "").cast("int"), "rule")
    return found.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").select("time", "platform", "rule")


def calibrate(df: DataFrame, rules: DataFrame, platform: str = "platform", bands: list[str] | None = None, drop_unmatched: bool = False) -> DataFrame:
    """Bands times scale plus offset of the first part of the rule whose span (low, high] has the value; no bounds: all values."""
    names = bands or [r[0] for r in rules.select("band").distinct().collect() if r[0] in df.columns]
    times = df.select("time", F.col(platform).alias("platform")).distinct()
    part = F.struct("low", "high", "scale", "offset")
    wide = rules.groupBy("rule").agg(*(F.sort_array(F.collect_list(F.when(F.col("band") == b, part))).alias(f"_f_{b}") for b in names))
    chosen = matching(times, rules).join(wide, "rule").withColumnRenamed("platform", platform).drop("rule")
    out = df.join(chosen, ["time", platform], "inner" if drop_unmatched else "left")

    def apply(b: str):
        v = F.col(b)
        fits = F.filter(f"_f_{b}", lambda p: (p["low"].isNull() | (v > p["low"])) & (p["high"].isNull() | (v <= p["high"])))
        # element 0 exists only if some part fits
        return F.when(F.size(fits) > 0, v * fits[0]["scale"] + fits[0]["offset"]).otherwise(v)

    return out.withColumns({b: apply(b) for b in names}).drop(*(f"_f_{b}" for b in names))


