"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

A source's target is filled by complete epochs of all its documents, then by a fraction: documents in the order of
exponential keys divided by their quality weights, as long as the running size stays nearest the rest of the target.
So a source takes all keys before one place in its order. The place is found without ordering a whole source: sizes are
summed by steps of log(key), prefix sums tell the step that holds the rest of the target, that step is divided once
more, and only the documents of the last, small step are sorted and summed one by one. No text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legispark.llm import text as T
from legispark.llm.storage import written

WORDS = r"[^\x20\x09-\x0D]+"
#: Weights that sources get in turn, and the most epochs.
WEIGHTS, MOST = (1, 2, 3), 3
#: Steps of the keys for each doubling, and steps within one of them.
STEPS, FINER = 64, 1024
#: Rows that are counted before they are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 10_000
#: 52 bits of the hash make the uniform number; the least weight of a document.
HEX_DIGITS, LEAST_WEIGHT = 13, 0.1


def words(text: Column) -> Column:
    """The number of words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 less the symbols `#*$%&|<>` per character, ten times counted, LEAST_WEIGHT at least, as for null or empty texts."""
    size = F.length(text)
    symbols = size - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.greatest(F.lit(LEAST_WEIGHT), 1 - 10 * symbols / F.nullif(size, F.lit(0)))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sources: source, source_size (a row each). Adds target: least(most * source_size, level * weight).

    Sources take the weights in turn, by code point, null last. The level shares out all sizes; where a target would
    pass `most` times its source's size it stops there and the rest is shared anew, which ends at one level for all:
    that of the first source, by the level at which it fills up, then by code point, that the rest doesn't fill. Running
    sums over a row per source, in one task. Sources with nothing have the target 0.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())  # a row per source
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()))
    rows = rows.withColumn("_place", place)
    before, every = Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    filled, passed = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("cap", "weight"))
    level = F.try_divide(F.sum("source_size").over(every) - filled, F.sum("weight").over(every) - passed)
    rows = rows.withColumn("level", level)
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("_place", "level"))).over(every)
    return rows.withColumn("level", first["level"]).select("source", "source_size", "weight", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _attached(rows: DataFrame, small: DataFrame, on: list[str], n: int) -> DataFrame:
    """Joined; broadcast where `small` was counted and is small, else shuffled, with skewed keys split at run time."""
    return rows.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, on)


class Keys:
    """Column expressions of a table of documents: its sources, sizes, prints (hashes of seed, id and text) and keys."""

    def __init__(self, id_col: str, text_col: str, source_col: str, weight: Column | None, seed: str):
        id_, text = T.col(id_col), T.col(text_col)
        self.source = F.struct(T.col(source_col).alias("s"))
        self.size = words(text)
        self.print = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(id_.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
        own = F.coalesce((weight if weight is not None else quality_weight(text)).cast("double"), F.lit(LEAST_WEIGHT))
        self.weight = F.greatest(own, F.lit(LEAST_WEIGHT))

    def of(self, docs: DataFrame, *more: Column) -> DataFrame:
        """_in, _print, _key, and more."""
        uniform = (F.conv(F.substring("_print", 1, HEX_DIGITS), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**HEX_DIGITS))
        rows = docs.select(self.source.alias("_in"), self.print.alias("_print"), self.weight.alias("_own"), *more)
        return rows.withColumn("_key", -F.log(uniform) / F.col("_own")).drop("_own")


def _holding(sums: DataFrame, plan: DataFrame, n: int, order: list[str]) -> DataFrame:
    """sums: _in, order, _sum. The row of each source in which its running sum reaches _rest: _in, order, _sum and _rest less what is before."""
    before = Window.partitionBy("_in").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    rows = _attached(sums, plan.select("_in", "_rest"), ["_in"], n)
    return rows.where("_before < _rest and _rest <= _before + _sum").withColumn("_rest", F.col("_rest") - F.col("_before")).drop("_before")


def plan(rows: DataFrame) -> tuple[DataFrame, int]:
    """rows: _in, _size, _print, _key. A row per source, and their number: what its documents take.

    _source_size, _target, _epochs; _cut_key and _cut_print: keys before that place are taken once more; of the _copies
    rows that stand there, _taken are. Both are null where whole epochs fill the target.
    """
    per = written(rows.groupBy("_in").agg(F.sum("_size").alias("_source_size")), "sources")
    n = per.count()
    goal = targets(per.select(F.col("_in.s").alias("source"), F.col("_source_size").alias("source_size"))).select(F.struct(F.col("source").alias("s")).alias("_in"), F.col("target").alias("_target"))
    epochs = F.coalesce(F.floor(F.try_divide("_target", "_source_size")), F.lit(0)).cast("long")
    whole = per.join(goal, "_in").withColumn("_epochs", epochs).withColumn("_rest", F.col("_target") - F.col("_epochs") * F.col("_source_size"))
    whole = written(whole, "targets")

    place = F.log2("_key") * STEPS
    rows = rows.withColumn("_step", F.floor(place).cast("long")).withColumn("_fine", F.floor((place - F.floor(place)) * FINER).cast("long"))
    steps = rows.groupBy("_in", "_step").agg(F.sum("_size").alias("_sum"))  # some thousands for a source
    step = written(_holding(steps, whole, n, ["_step"]).drop("_sum"), "steps")
    near = _attached(rows, step, ["_in", "_step"], n)
    fine = near.groupBy("_in", "_fine").agg(F.sum("_size").alias("_sum"))
    fine = written(_holding(fine, step, n, ["_fine"]).drop("_sum"), "steps")
    last = _attached(near.drop("_rest"), fine, ["_in", "_fine"], n)
    places = last.groupBy("_in", "_key", "_print").agg(F.sum("_size").alias("_sum"), F.count(F.lit(1)).alias("_copies"))
    cut = _holding(places, fine, n, ["_key", "_print"])
    size = F.col("_sum") / F.col("_copies")
    more = F.greatest(F.lit(0), F.least(F.col("_copies"), F.floor(F.col("_rest") / size - 0.5) + 1))
    taken = F.when(F.col("_copies") == 1, (F.col("_sum") - F.col("_rest") <= F.col("_rest")).cast("long")).otherwise(more.cast("long"))
    cut = cut.select("_in", F.col("_key").alias("_cut_key"), F.col("_print").alias("_cut_print"), "_copies", taken.alias("_taken"))
    return written(whole.drop("_rest").join(cut, "_in", "left"), "plan"), n


def _times(rows: DataFrame, plan: DataFrame, n: int) -> DataFrame:
    """rows (_in, _print, _key and others) with the plan's columns and _times."""
    rows = _attached(rows, plan, ["_in"], n)
    here = (F.col("_key") == F.col("_cut_key")) & (F.col("_print") == F.col("_cut_print"))
    before = (F.col("_key") < F.col("_cut_key")) | ((F.col("_key") == F.col("_cut_key")) & (F.col("_print") < F.col("_cut_print")))
    some = (F.col("_taken") > 0) & (F.col("_taken") < F.col("_copies"))
    once = F.coalesce(before | (here & (F.col("_taken") == F.col("_copies"))), F.lit(False))
    out = rows.withColumn("_times", F.col("_epochs") + once.cast("long"))
    if plan.where(some).isEmpty():
        return out
    split = F.coalesce(here & some, F.lit(False))  # of repeats of one row, some: at most one row of each source
    number = F.row_number().over(Window.partitionBy("_in").orderBy("_print"))
    ranked = out.where(split).withColumn("_times", F.col("_times") + (number <= F.col("_taken")).cast("long"))
    return out.where(~split).unionByName(ranked)


def mix(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, seed: str = "mix") -> DataFrame:
    """The columns `keep` of docs (all by default), and _size, _source_size, _target, _times: how often a row is taken, 0 to MOST.

    Null texts have the size 0; they are taken with the epochs, and in the fraction where their key comes up. Equal keys
    go by id and text; rows that repeat id and text are told apart by nothing, so which of them is taken makes no
    difference to the texts. A null source is a source, a null weight counts as LEAST_WEIGHT. An empty table gives an
    empty result. Reruns agree: keys come from hashes of the seed, the id and the text. Columns of docs that are named
    like the new ones are dropped.
    """
    new = ["_size", "_source_size", "_target", "_times"]
    kept = [c for c in (keep or docs.columns) if c.lower() not in new]
    keys = Keys(id_col, text_col, source_col, weight, seed)
    row = F.struct(*[T.col(c) for c in kept]) if kept else F.struct(F.lit(1).alias("one"))
    rows = written(keys.of(docs, keys.size.alias("_size"), row.alias("_row")), "sizes")
    out = _times(rows, *plan(rows.drop("_row")))
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], *new)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, seed: str = "mix") -> DataFrame:
    """docs with each row as often as the mix takes it, with all its columns as they are, whatever they are named."""
    keys = Keys(id_col, text_col, source_col, weight, seed)
    sizes = written(keys.of(docs, keys.size.alias("_size")), "sizes")
    rows = _times(keys.of(docs, F.struct("*").alias("_row")), *plan(sizes))
    again = rows.where("_times > 0").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_times")).alias("_copy"))
    return again.select("_row.*")
