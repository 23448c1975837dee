"""Survival curves and a linear model with fixed effects, as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def survival_rows(t: DataFrame, start: str, end: str, as_of: str) -> DataFrame:
    """Adds event (1: ended by then) and duration in days to the end or to as_of; negative ones are left out."""
    last = F.lit(as_of).cast("date")
    event = F.coalesce(F.col(end) <= last, F.lit(False)).cast("int")
    out = t.withColumn("event", event).withColumn("duration", F.datediff(F.when(F.col("event") == 1, F.col(end)).otherwise(last), F.col(start)))
    return out.where("duration >= 0")


def kaplan_meier(t: DataFrame, group: str, duration: str, event: str) -> DataFrame:
    """Per group and time: at_risk, events, survival (0 from the time on at which all at risk end).

    Windows run over a group's distinct times, after aggregation.
    """
    times = t.dropna(subset=[group, duration]).groupBy(group, duration).agg(F.count(F.lit(1)).alias("_n"), F.sum(event).alias("events"))
    before = Window.partitionBy(group).orderBy(duration).rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(group).orderBy(duration).rowsBetween(Window.unboundedPreceding, 0)
    times = times.withColumn("at_risk", F.sum("_n").over(Window.partitionBy(group)) - F.coalesce(F.sum("_n").over(before), F.lit(0)))
    left = 1 - F.col("events") / F.col("at_risk")
    times = times.withColumns({"_ln": F.when(left > 0, F.log(left)), "_none": F.when(left > 0, 0).otherwise(1)})
    alive = F.when(F.max("_none").over(so_far) == 1, 0.0).otherwise(F.exp(F.coalesce(F.sum("_ln").over(so_far), F.lit(0.0))))
    return times.withColumn("survival", alive).where("events > 0").select(group, duration, "at_risk", "events", "survival")


def fe_slope(t: DataFrame, y: str, x: str, group: str) -> DataFrame:
    """One row: n, slope of y on x within groups, its heteroskedasticity-robust (HC0) standard error; closed form."""
    t = t.dropna(subset=[y, x, group]).select(F.col(group).alias("_g"), F.col(y).cast("double").alias("_y"), F.col(x).cast("double").alias("_x"))
    means = t.groupBy("_g").agg(F.avg("_y").alias("_my"), F.avg("_x").alias("_mx"))
    d = t.join(means, "_g").select((F.col("_y") - F.col("_my")).alias("_y"), (F.col("_x") - F.col("_mx")).alias("_x"))
    s = d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_x") * F.col("_y")).alias("xy"), F.sum(F.col("_x") * F.col("_x")).alias("xx"), F.sum(F.col("_x") ** 2 * F.col("_y") ** 2).alias("xxyy"), F.sum(F.col("_x") ** 3 * F.col("_y")).alias("xxxy"), F.sum(F.col("_x") ** 4).alias("xxxx"))
    b = F.try_divide("xy", "xx")
    meat = F.col("xxyy") - 2 * b * F.col("xxxy") + b * b * F.col("xxxx")
    return s.select("n", b.alias("slope"), F.try_divide(F.sqrt(F.greatest(meat, F.lit(0.0))), "xx").alias("robust_se"))
