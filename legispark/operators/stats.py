"""Counts, rates, funnels, distributions and rankings per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legispark.functions import scalar as S
from legispark.operators.ranks import distribution, joined, percentiles, value_places

#: Sketches of distinct values have 2 to this power counters.
SKETCH_LG = 12


def rate_table(t: DataFrame, by: Sequence[str], flags: Sequence[str], min_n: int = 0, means: Sequence[str] = ()) -> DataFrame:
    """Per group without null keys: n, each flag's sum and share, means of more columns; groups under min_n are left out."""
    t = t.dropna(subset=list(by)) if by else t
    out = t.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.col(f).cast("long")), F.lit(0)).alias(f"n_{f}") for f in flags], *[F.avg(c).alias(f"mean_{c}") for c in means])
    for f in flags:
        out = out.withColumn(f"{f}_rate", S.share(F.col(f"n_{f}"), F.col("n")))
    return out.where(F.col("n") >= min_n) if min_n else out


def with_overall(groups: DataFrame, t: DataFrame, flags: Sequence[str]) -> DataFrame:
    """groups with the mean of each flag over all rows of t (overall_ and its name): the line that groups are held against."""
    means = t.agg(*[F.avg(f).alias(f"overall_{f}") for f in flags])
    return groups.crossJoin(F.broadcast(means))  # one row


def span(t: DataFrame, term: str, date: str) -> DataFrame:
    """One row: n, terms (sorted), the first and last date."""
    return t.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(term)).alias("terms"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def rollup_counts(t: DataFrame, by: str, flags: Sequence[str]) -> DataFrame:
    """rate_table per group and, with a null key and is_total = 1, over all rows."""
    out = t.where(F.col(by).isNotNull()).rollup(by).agg(F.grouping(by).cast("int").alias("is_total"), F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.col(f).cast("long")), F.lit(0)).alias(f"n_{f}") for f in flags])
    for f in flags:
        out = out.withColumn(f"{f}_rate", S.share(F.col(f"n_{f}"), F.col("n")))
    return out


def funnel(t: DataFrame, stages: Sequence[tuple[str, Sequence[str]]], exclude_mode_of: str | None = None, least_share: float = 0.3, bar: int | None = None) -> DataFrame:
    """Per stage: number, label, rows with any of its dates, share of the first stage, share and loss from the one before.

    With bar, also the length of a bar of so many cells at most.

    With exclude_mode_of: if one date makes up more than least_share of that column's dates, it is the end of a term and
    rows that have it in the column don't count there.
    """
    if exclude_mode_of:
        c = exclude_mode_of
        counts = t.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_d")).count()
        most = counts.agg(F.min(F.struct(-F.col("count"), F.col("_d")))["_d"].alias("_end"), F.max("count").alias("_most"), F.sum("count").alias("_all"))
        end = F.when(F.col("_most") > least_share * F.col("_all"), F.col("_end"))
        t = t.crossJoin(F.broadcast(most.select(end.alias("_end")))).withColumn(c, F.when(F.col("_end").isNull() | (F.col(c) != F.col("_end")), F.col(c)))  # one row
    counts = t.agg(*[F.count(F.coalesce(*cols)).alias(f"s{i}") for i, (_, cols) in enumerate(stages)])
    stack = ", ".join(f"{i}, '{label}', s{i}" for i, (label, _) in enumerate(stages))
    rows = counts.selectExpr("s0 AS base", f"stack({len(stages)}, {stack}) AS (stage, label, n)")
    before = F.lag("n").over(Window.orderBy("stage"))  # a row per stage
    rows = rows.withColumn("before", before)
    bars = [] if bar is None else [F.floor(F.coalesce(F.try_divide("n", "base"), F.lit(0)) * bar).cast("int").alias("bar")]
    return rows.select("stage", "label", "n", S.share(F.col("n"), F.col("base")).alias("share_of_base"), F.try_divide("n", "before").alias("survival"), (F.col("before") - F.col("n")).alias("loss"), *bars)


def pivot_counts(t: DataFrame, by: Sequence[str], on: str, values: Sequence[object], normalise: bool = False) -> DataFrame:
    """Rows per group and value, a column each; 0 where there are none. normalise: shares of the group's listed values."""
    out = t.dropna(subset=[*by, on]).groupBy(*by).pivot(on, list(values)).agg(F.count(F.lit(1))).na.fill(0)
    if not normalise:
        return out
    names = [str(v) for v in values]
    total = sum((F.col(f"`{n}`") for n in names[1:]), F.col(f"`{names[0]}`"))
    return out.select(*by, *[S.share(F.col(f"`{n}`"), total).alias(n) for n in names])


def coverage_profile(t: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per group and column: rows, values that aren't null, their percent; in one pass."""
    counts = t.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(f"_{c}") for c in cols])
    stack = ", ".join(f"'{c}', `_{c}`" for c in cols)
    rows = counts.selectExpr(*by, "total", f"stack({len(cols)}, {stack}) AS (column_name, n)")
    return rows.withColumn("percent", S.percent(F.col("n"), F.col("total")))


def duration_stats(t: DataFrame, by: Sequence[str], days: str | Column, probs: Sequence[float] = (0.25, 0.5, 0.75), exact: bool = True) -> DataFrame:
    """Per group: n, min, max, mean and percentiles of a number of days, nulls left out.

    exact interpolates (see ranks.distribution); else percentile_approx is used, in one pass.
    """
    t = t.select(*by, S.column(days).alias("_d")).where("_d is not null")
    names = [f"p{round(100 * p)}" for p in probs]
    if exact:
        found = distribution(t, by, "_d", probs)
        return found.select(*by, "n", F.col("least").alias("min_days"), F.col("greatest").alias("max_days"), F.col("mean").alias("mean_days"), *[F.col("percentiles")[i].alias(n) for i, n in enumerate(names)])
    plain = [F.count("_d").alias("n"), F.min("_d").alias("min_days"), F.max("_d").alias("max_days"), F.avg("_d").alias("mean_days")]
    return t.groupBy(*by).agg(*plain, *[F.percentile_approx("_d", p).cast("double").alias(n) for p, n in zip(probs, names, strict=True)])


def period_counts(t: DataFrame, ts: str, unit: str, by: Sequence[str] = (), fill: bool = False) -> DataFrame:
    """Rows per group and period (its first day). fill: also, with 0, the empty periods between a group's first and last."""
    out = t.where(F.col(ts).isNotNull()).groupBy(*by, F.date_trunc(unit, ts).cast("date").alias("period")).agg(F.count(F.lit(1)).alias("n"))
    if not fill:
        return out
    step = {"month": "interval 1 month", "day": "interval 1 day", "week": "interval 7 days", "year": "interval 1 year"}[unit]
    grid = out.groupBy(*by).agg(F.min("period").alias("_a"), F.max("period").alias("_b")).select(*by, F.explode(F.sequence("_a", "_b", F.expr(step))).alias("period"))
    return grid.join(out, [*by, "period"], "left").na.fill(0, ["n"])


def month_means(t: DataFrame, ts: str, by: str) -> DataFrame:
    """The mean over groups of the rows in each month of the year; months without rows count 0."""
    t = t.where(F.col(ts).isNotNull() & F.col(by).isNotNull())
    counts = t.groupBy(by, F.month(ts).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    grid = t.select(by).distinct().withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    return grid.join(counts, [by, "month"], "left").groupBy("month").agg(F.avg(F.coalesce("n", F.lit(0))).alias("mean_n"))


def value_counts(t: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column_name, value, n: how often each value stands in each column; nulls left out; one pass over the table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]))
    return t.select(pairs.alias("_p")).select("_p.*").where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def group_spread(t: DataFrame, by: Sequence[str], value: str, min_n: int = 1, exact: bool = True) -> DataFrame:
    """Per group: n, mean, median, sample deviation, quartiles, least and greatest.

    exact interpolates (see ranks.distribution); else percentile_approx is used, in one pass.
    """
    t = t.dropna(subset=[*by, value])
    if exact:
        out = distribution(t, by, value, [0.5, 0.25, 0.75])
    else:
        three = F.percentile_approx(value, [0.5, 0.25, 0.75], 100_000).alias("percentiles")
        out = t.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.min(value).alias("least"), F.max(value).alias("greatest"), three)
    parts = [F.col("percentiles")[i].alias(name) for i, name in enumerate(("median", "p25", "p75"))]
    return out.where(F.col("n") >= min_n).select(*by, "n", "mean", parts[0], "sd", *parts[1:], "least", "greatest")


def with_median(groups: DataFrame, t: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """groups with the exact median of t's values in each group, null where there is none."""
    return joined(groups, percentiles(t, by, value, [0.5]).select(*by, F.col("percentiles")[0].alias(name)), by)


def gap(t: DataFrame, by: str, group: str, a: object, b: object, value: str) -> DataFrame:
    """Per `by`: the means of groups a and b and their distance; rows without both are left out."""
    out = t.groupBy(by).agg(F.avg(F.when(F.col(group) == a, F.col(value))).alias("mean_a"), F.avg(F.when(F.col(group) == b, F.col(value))).alias("mean_b"))
    return out.withColumn("gap", F.abs(F.col("mean_a") - F.col("mean_b"))).where("gap is not null")


def rank_avg_trunc(t: DataFrame, partition: Sequence[str], order: str, ascending: bool = True) -> DataFrame:
    """Adds rank (ties share their mean rank, cut to a whole number) and group_size; null orders have no rank.

    Ranks come from the places of each distinct value (ranks.value_places): no task holds a group's rows or values.
    """
    places = value_places(t, partition, order, ascending)
    ranks = places.select(*partition, order, F.floor(F.col("n_before") + 1 + (F.col("n_equal") - 1) / 2).alias("rank"))
    sizes = places.groupBy(*partition).agg(F.sum("n_equal").alias("group_size"))
    out = joined(joined(t.drop("rank", "group_size"), ranks, [*partition, order]), sizes, partition)
    return out.withColumn("group_size", F.coalesce("group_size", F.lit(0)))


def shift(t: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Adds before and shift: the value at the key's row before, and the change; keys with one row have none."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(order))
    return t.withColumn("before", before).withColumn("shift", F.col(value) - F.col("before")).where("before is not null")


def shift_summary(t: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Mean and median of the changes' sizes, by the later row's order."""
    rows = shift(t, key, order, value).select(order, F.abs("shift").alias("_size"))
    return distribution(rows, [order], "_size", [0.5]).select(order, "n", F.col("mean").alias("mean_shift"), F.col("percentiles")[0].alias("median_shift"))


def correlation(t: DataFrame, key: str, order: str, value: str, a: object, b: object) -> DataFrame:
    """Pearson's correlation of the keys' values at a and b."""
    wide = t.where(F.col(order).isin(a, b)).groupBy(key).agg(F.avg(F.when(F.col(order) == a, F.col(value))).alias("x"), F.avg(F.when(F.col(order) == b, F.col(value))).alias("y"))
    return wide.dropna().agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("correlation"))


def quantile_bins(t: DataFrame, col: str, n: int = 10, exact: bool = True) -> DataFrame:
    """Adds bin, from 0: by n quantiles, equal edges merged, each bin closed on its right and the first on both sides; null has none.

    exact interpolates (see ranks.distribution); else percentile_approx is used.
    """
    probs = [i / n for i in range(n + 1)]
    found = percentiles(t, [], col, probs) if exact else t.agg(F.percentile_approx(col, probs, 100_000).alias("percentiles"))
    edges = found.select(F.array_distinct("percentiles").alias("_edges"))
    below = F.size(F.filter("_edges", lambda e: e < F.col(col)))
    return joined(t, edges, []).withColumn("bin", F.when(F.col(col).isNotNull(), F.greatest(below - 1, F.lit(0)))).drop("_edges")


def trend(t: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope and intercept of y on x."""
    return t.groupBy(*by).agg(F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def histogram(t: DataFrame, col: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per bin of equal width, from 0; the last holds `high` too; values outside are left out."""
    at = F.least(F.floor((F.col(col) - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return t.where(F.col(col).between(low, high)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def distinct_sketches(t: DataFrame, by: Sequence[str], col: str, lg_k: int = SKETCH_LG) -> DataFrame:
    """Per group: sketch, which stands for the distinct values of a column (text, bytes or whole numbers) in some kilobytes.

    Kept per term, sketches of old terms are merged with a new one's instead of reading their rows again.
    """
    return t.groupBy(*by).agg(F.hll_sketch_agg(col, lg_k).alias("sketch"))


def distinct_estimates(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group of sketches: n_distinct of what they stand for together; its standard error is sketch_error of itself."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def sketch_error(lg_k: int = SKETCH_LG) -> float:
    """The relative standard error of an estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def new_id_estimates(sources: Sequence[tuple[str, DataFrame]], key: str, lg_k: int = SKETCH_LG) -> DataFrame:
    """tables.new_ids by sketches: per source, in the order given, about how many distinct ids it has, and how many that no earlier one has."""
    rows = [t.agg(F.hll_sketch_agg(key, lg_k).alias("sketch")).select(F.lit(i).alias("_rank"), F.lit(s).alias("source"), "sketch") for i, (s, t) in enumerate(sources)]
    every = reduce(DataFrame.unionByName, rows)
    so_far = F.hll_sketch_estimate(F.hll_union_agg("sketch").over(Window.orderBy("_rank")))  # a row per source
    rows = every.select("_rank", "source", F.hll_sketch_estimate("sketch").alias("n_ids"), so_far.alias("_all"))
    return rows.select("source", "n_ids", F.greatest(F.lit(0), F.col("_all") - F.coalesce(F.lag("_all").over(Window.orderBy("_rank")), F.lit(0))).alias("n_new"))


def unpivoted(t: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "measure", value: str = "value") -> DataFrame:
    return t.unpivot(list(keys), list(cols), name, value)


def overview(counts: Mapping[str, DataFrame], dates: tuple[DataFrame, str] | None = None) -> DataFrame:
    """table_name, n: rows of each table, one union of counts."""
    out = None
    for name, t in counts.items():
        row = t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n", F.lit(None).cast("date").alias("latest"))
        out = row if out is None else out.unionByName(row)
    if dates:
        t, c = dates
        out = out.unionByName(t.agg(F.count(c).alias("n"), F.max(c).cast("date").alias("latest")).select(F.lit(f"latest {c}").alias("table_name"), "n", "latest"))
    return out
