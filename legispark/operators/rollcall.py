"""Roll calls in long form: contested items, active members, bridging members, one-dimensional scaling, alignment."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legispark.functions import scalar as S
from legispark.operators.tables import keep_first
from legispark.sources.kept import kept, kept_path, removed
from legispark.sources.sinks import bucketed, dropped

#: A term's scores have converged when a round adds a smaller share to what they explain; rounds after which none goes on.
TOLERANCE, MOST_ROUNDS = 1e-3, 60
#: Cells in a part of the scaling's tables at most, about: parts grow in number, not in size.
PART_CELLS = 1_000_000


def matrix(votes: DataFrame, member: str, item: str, vote: str, codes: Mapping[str, int], order: list[str], by: Sequence[str] = ()) -> DataFrame:
    """by, member, item, code: one cell each (the first in the order), cells without member, item or vote left out."""
    t = keep_first(votes.dropna(subset=[member, item, vote]), [*by, member, item], order)
    return t.select(*by, member, item, S.coded(vote, codes).alias("code"))


def contested(t: DataFrame, item: str, yes: str, min_minority: float = 0.025) -> DataFrame:
    """Per item: n (yes or no), yes_share, minority, is_contested; yes is 1, 0 or null for neither."""
    out = t.groupBy(item).agg(F.count(yes).alias("n"), F.coalesce(F.avg(F.col(yes).cast("double")), F.lit(0.0)).alias("yes_share"))
    out = out.withColumn("minority", F.when(F.col("n") > 0, _minority(F.col("yes_share"))).otherwise(0.0))
    return out.withColumn("is_contested", F.col("minority") >= min_minority)


def _minority(yes_share: Column) -> Column:
    return F.least(yes_share, 1 - yes_share)


def active(t: DataFrame, member: str, yes: str, min_votes: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Members (of each group) with so many yes or no votes, and how many."""
    return t.groupBy(*by, member).agg(F.count(yes).alias("n_votes")).where(F.col("n_votes") >= min_votes)


def prepared(t: DataFrame, member: str, item: str, yes: str, min_minority: float = 0.025, min_votes: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """The cells of contested items, then of members who are active on those, within each group.

    An item's and a member's figures are added to their cells, so each step shuffles the cells once, instead of
    making them again for every join with a list.
    """
    per_item, per_member = Window.partitionBy(item), Window.partitionBy(*by, member)
    t = t.where(F.col(item).isNotNull()).withColumn("_share", F.coalesce(F.avg(F.col(yes).cast("double")).over(per_item), F.lit(0.0)))
    t = t.where(_minority(F.col("_share")) >= min_minority).drop("_share")
    t = t.dropna(subset=[*by, member]).withColumn("_n", F.count(yes).over(per_member))
    return t.where(F.col("_n") >= min_votes).drop("_n")


def matrix_summary(t: DataFrame, member: str, item: str, yes: str, min_minority: float = 0.025) -> DataFrame:
    items = contested(t, item, yes, min_minority).agg(F.count(F.lit(1)).alias("n_items"), F.count_if("is_contested").alias("n_contested"))
    return t.agg(F.countDistinct(member).alias("n_members"), F.count(yes).alias("n_votes")).crossJoin(items)  # one row each


def bridging(t: DataFrame, member: str, term: str) -> DataFrame:
    """Per member: sorted terms, their number, whether there are two or more."""
    out = t.dropna(subset=[member, term]).groupBy(member).agg(F.array_sort(F.collect_set(term)).alias("terms"))
    return out.withColumn("n_terms", F.size("terms")).withColumn("is_bridge", F.col("n_terms") >= 2)


def scale_terms(t: DataFrame, group: str, member: str, item: str, yes: str, anchor: DataFrame | None = None, tol: float = TOLERANCE, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """group, member, score, rounds: in every group the leading dimension of the item-centred votes, mean 0 and deviation 1.

    One power iteration for all groups: a round averages scores to item weights and weights to scores. The cells stand
    in two saved tables, bucketed by item and by member, so a round moves sums of members and of items, never cells.
    Their buckets hold about PART_CELLS cells at most, and the rounds' shuffles have as many parts, in a session of their
    own. Nothing is sorted: buckets meet hash tables of their scores or weights; an item's mean goes with its weight.
    It ends when in every group what the scores explain grows by a smaller share than tol; rounds is null where a group
    isn't that far after most_rounds. The sign makes the anchor's members (member column) positive on average; without
    one, the group's member with the most votes (the least of them). Items are of one group. A group in which nobody
    differs has scores of 0; cells that are neither yes nor no, or lack a key, are left out.
    """
    spark = t.sparkSession
    cells = t.where(F.col(yes).isNotNull()).dropna(subset=[group, member, item]).select(F.col(group).alias("_g"), F.col(member).alias("_m"), F.col(item).alias("_i"), (2.0 * F.col(yes) - 1).alias("_v"))
    cells = kept(cells, "cells")
    cores = spark.sparkContext.defaultParallelism
    n = cores * max(1, -(-cells.count() // (PART_CELLS * cores)))
    name, own = f"cells_{uuid.uuid4().hex}", _session(spark, n)
    by_item = bucketed(own.read.schema(cells.schema).parquet(cells.written_to), f"{name}_items", ["_g", "_i"], n, kept_path(own, name), ordered=False)
    removed(cells)
    centre = by_item.groupBy("_g", "_i").agg(F.avg("_v").alias("_c"))
    by_member = bucketed(by_item.join(centre.hint("shuffle_hash"), ["_g", "_i"]), f"{name}_members", ["_g", "_m"], n, kept_path(own, name), ordered=False)
    if anchor is not None:
        anchor = kept(anchor.select(member), "anchor")
        anchor = own.read.schema(anchor.schema).parquet(anchor.written_to)
    lead = kept(_anchors(by_member, member, anchor), "lead")
    centred = F.col("_v") - F.col("_c")
    start = F.avg(centred * (1e-3 * (F.pmod(F.xxhash64("_m"), F.lit(1009)) / 1009.0 - 0.5) + F.coalesce("_lead", F.lit(0))))
    weights = by_member.join(lead, ["_g", "_m"], "left").groupBy("_g", "_i").agg(start.alias("_w"), F.max("_c").alias("_c"))
    scores, explained, done = None, {}, {}
    for k in range(1, most_rounds + 1):
        raw = by_item.join(weights.hint("shuffle_hash"), ["_g", "_i"]).groupBy("_g", "_m").agg(F.avg(centred * F.col("_w")).alias("_s"))
        raw = kept(raw, "scaling")
        norm = raw.groupBy("_g").agg(F.avg("_s").alias("_a"), F.stddev_pop("_s").alias("_d"))  # a row per group
        now = {g: d for g, _, d in norm.collect()}
        done |= {g: k for g, d in now.items() if g not in done and (not d or g in explained and abs(d - explained[g]) <= tol * d)}
        if scores is not None:
            removed(scores)
        scores, explained = raw, now
        level = raw.join(F.broadcast(norm), "_g").select("_g", "_m", S.share(F.col("_s") - F.col("_a"), F.col("_d")).alias("_s"))
        if len(done) == len(now):
            break
        weights = by_member.join(level.hint("shuffle_hash"), ["_g", "_m"]).groupBy("_g", "_i").agg(F.avg(centred * F.col("_s")).alias("_w"), F.max("_c").alias("_c"))
    sign = level.join(lead, ["_g", "_m"]).groupBy("_g").agg(F.when(F.avg("_s") < 0, -1.0).otherwise(1.0).alias("_sign"))
    rounds = F.create_map(*[F.lit(x) for item in done.items() for x in item])[F.col("_g")] if done else F.lit(None).cast("int")
    out = level.join(F.broadcast(sign), "_g", "left").select(F.col("_g").alias(group), F.col("_m").alias(member), (F.col("_s") * F.coalesce("_sign", F.lit(1.0))).alias("score"), rounds.alias("rounds"))
    out = kept(out, "scaled")
    for table in ("items", "members"):
        dropped(own, f"{name}_{table}")
    return spark.read.schema(out.schema).parquet(out.written_to)


def _session(spark: SparkSession, parts: int) -> SparkSession:
    """A session of the same application that shuffles into so many parts; the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", parts)
    return own


def _anchors(cells: DataFrame, member: str, anchor: DataFrame | None) -> DataFrame:
    """_g, _m, _lead (1): the members of each group who are to be positive."""
    votes = cells.groupBy("_g", "_m").agg(F.count(F.lit(1)).alias("_n"))
    if anchor is not None:
        return votes.join(anchor.select(F.col(member).alias("_m")).distinct(), "_m", "left_semi").select("_g", "_m", F.lit(1).alias("_lead"))
    return votes.groupBy("_g").agg(F.min_by("_m", F.struct(-F.col("_n"), "_m")).alias("_m"), F.lit(1).alias("_lead"))


def scale_1d(t: DataFrame, member: str, item: str, yes: str, iters: int = 6, anchor: DataFrame | None = None) -> DataFrame:
    """member, score: scale_terms of one group, by so many rounds."""
    return scale_terms(t.withColumn("_one", F.lit(1)), "_one", member, item, yes, anchor, 0.0, iters).select(member, "score")


def _links(scores: DataFrame, member: str, term: str, score: str) -> list:
    """A row per ordered pair of terms that share members: their number, sums, and the line from the first term's scores to the second's."""
    t = scores.select(F.col(member).alias("_m"), F.col(term).alias("_t"), F.col(score).cast("double").alias("_x")).dropna()
    pairs = t.join(t.select("_m", F.col("_t").alias("_u"), F.col("_x").alias("_y")), "_m")
    x, y = F.col("_x"), F.col("_y")
    sums = {"n": F.count(F.lit(1)), "x": F.sum(x), "y": F.sum(y), "xx": F.sum(x * x), "yy": F.sum(y * y), "xy": F.sum(x * y), "slope": F.regr_slope(y, x), "start": F.regr_intercept(y, x)}
    return pairs.groupBy("_t", "_u").agg(*[c.alias(k) for k, c in sums.items()]).collect()  # terms squared at most


def _chained(links: list, lines: dict) -> dict:
    """Lines of the terms that chains of shared members lead to, fitted at once: every pair of terms should agree on its members.

    lines has those that are given; the least squares of all pairs that aren't both given decide the rest.
    """
    apart = lambda n, a, aa: n * aa - a * a > 1e-9 * max(1.0, n * aa)
    usable = [p for p in links if p["_t"] != p["_u"] and p["n"] >= 2 and apart(p["n"], p["x"], p["xx"]) and apart(p["n"], p["y"], p["yy"])]
    reached = set(lines)
    while more := {p["_t"] for p in usable if p["_u"] in reached} - reached:
        reached |= more
    place = {t: 2 * i for i, t in enumerate(sorted(reached - set(lines)))}
    a, b = np.zeros((2 * len(place), 2 * len(place))), np.zeros(2 * len(place))
    for p in usable:  # each pair comes both ways; a term's own equations are those in which it is the first
        if p["_t"] not in place or p["_u"] not in reached:
            continue
        i = place[p["_t"]]
        a[i : i + 2, i : i + 2] += [[p["xx"], p["x"]], [p["x"], p["n"]]]
        other = np.array([[p["xy"], p["x"]], [p["y"], p["n"]]])
        if p["_u"] in place:
            j = place[p["_u"]]
            a[i : i + 2, j : j + 2] -= other
        else:
            b[i : i + 2] += other @ lines[p["_u"]]
    found = np.linalg.lstsq(a, b, rcond=None)[0] if place else b
    return {t: (float(found[i]), float(found[i + 1])) for t, i in place.items()}


def align_terms(scores: DataFrame, member: str, term: str, score: str, base: int) -> DataFrame:
    """Adds aligned: each term's scores put on the base term's line by members of several terms.

    A term that shares members with the base goes by these; the others by all chains of shared members that lead there,
    fitted at once. Two members at least must be shared, and differ in both terms. Terms without such a chain stay.
    """
    links = _links(scores, member, term, score)
    lines = {p["_t"]: (p["slope"], p["start"]) for p in links if p["_u"] == base and p["slope"] is not None} | {base: (1.0, 0.0)}
    lines |= _chained(links, lines)
    fit = scores.sparkSession.createDataFrame([(t, *line) for t, line in lines.items()], f"{term} {scores.schema[term].dataType.simpleString()}, _k double, _c double")
    out = scores.join(F.broadcast(fit), term, "left")  # a row per term
    return out.withColumn("aligned", F.when(F.col("_k").isNull(), F.col(score)).otherwise(F.col("_k") * F.col(score) + F.col("_c"))).drop("_k", "_c")


def with_parties(scores: DataFrame, sat: DataFrame, member: str, term: str, party: str) -> DataFrame:
    """scores with parties and terms of each member (sorted, joined by / and ,) and the party of the term.

    sat: member, term, party, repeated at will. The party is the term's own (the least of several), else the scores'
    own if they have one, else the member's parties.
    """
    sat = sat.select(F.col(member).alias("_m"), F.col(term).alias("_t"), F.col(party).alias("_p")).distinct()
    joined = lambda c, mark: F.array_join(F.array_sort(F.collect_set(c)).cast("array<string>"), mark)
    person = sat.groupBy("_m").agg(joined("_p", "/").alias("parties"), joined("_t", ",").alias("terms"))
    here = sat.groupBy("_m", "_t").agg(F.min("_p").alias("_p"))
    rows = scores.withColumnsRenamed({party: "_own"}) if party in scores.columns else scores.withColumn("_own", F.lit(None).cast("string"))
    rows = rows.join(person, F.col(member) == F.col("_m"), "left").drop("_m")
    rows = rows.join(here, (F.col(member) == F.col("_m")) & (F.col(term) == F.col("_t")), "left")
    return rows.withColumn(party, F.coalesce("_p", "_own", F.nullif("parties", F.lit("")))).drop("_m", "_t", "_p", "_own")
