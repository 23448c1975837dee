"""Conversations in reply order without quotes, by linking quoted passages to the messages they come from.

A line's quote level is the number of `>` before its text. Neighbouring lines of a level are a run, and its stretches
without blank lines are paragraphs; runs, paragraphs and single lines are normalised and hashed. A quoted one joins, within
its conversation, the earlier messages that have the same at any level nearer their own text, as a quote may be a part of a
message and the message between may have left it out. The turn that has most of the quoted lines is the one replied to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legispark.llm.storage import written

#: Possessive, so that Java repeats it in a loop: marks may be any number.
QUOTE = r"^[ \t]*(?:>[ \t]?)++"
#: Lines that announce a quote, dropped where a quote follows.
LEAD = r"(?i)^.*\b(?:wrote|writes|said|schrieb|escribió|a écrit)\s*:\s*$"
#: Rounds of pointer doubling; each doubles the length of reply chains that are followed to their start.
MOST_ROUNDS = 40
#: Turns that are numbered in one window.
STRETCH = 4096


def normal(text: Column) -> Column:
    """Lowered, white space as single spaces, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def lines(messages: DataFrame) -> DataFrame:
    """msg, conv, turn, text: a row per line with its number, level and text without marks; empty texts have one empty line."""
    split = F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r?\n|\r", -1))
    rows = messages.select("msg", "conv", "turn", split.alias("line", "raw"))
    marks = F.regexp_extract("raw", QUOTE, 0)
    rows = rows.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", "")))
    rows = rows.withColumn("body", F.when(F.col("level") > 0, F.substring("raw", F.length(marks) + 1, F.length("raw"))).otherwise(F.col("raw")))
    return rows.select("msg", "conv", "turn", "line", "level", "body", normal(F.col("body")).alias("norm"))


def passages(rows: DataFrame) -> DataFrame:
    """msg, conv, turn, level, hash, lines (numbers): runs of a level with blank lines left out, their paragraphs, and their lines."""
    order = Window.partitionBy("msg").orderBy("line")  # the lines of one message
    full = rows.where("norm <> ''")
    turned = F.lag("level").over(order) != F.col("level")
    full = full.withColumn("new", turned.cast("int")).withColumn("gap", (turned | (F.lag("line").over(order) + 1 < F.col("line"))).cast("int"))
    full = full.withColumn("run", F.sum(F.coalesce("new", F.lit(1))).over(order)).withColumn("part", F.sum(F.coalesce("gap", F.lit(1))).over(order))
    inner = F.array_sort(F.collect_list(F.struct("line", "norm")))
    parts = full.groupBy("msg", "conv", "turn", "level", "run", "part").agg(inner.alias("inner"))
    runs = parts.groupBy("msg", "conv", "turn", "level", "run").agg(F.array_sort(F.flatten(F.collect_list("inner"))).alias("whole"), F.collect_list("inner").alias("parts"))
    none = F.slice("parts", 1, 0)
    some = F.when(F.size("parts") > 1, F.filter("parts", lambda x: F.size(x) > 1)).otherwise(none)  # a single part is the run, a part of one line is that line
    single = F.when(F.size("whole") > 1, F.transform("whole", lambda x: F.array(x))).otherwise(none)
    runs = runs.select("msg", "conv", "turn", "level", F.explode(F.concat(F.array("whole"), some, single)).alias("x"))
    return runs.select("msg", "conv", "turn", "level", F.sha2(F.array_join(F.col("x.norm"), " "), 256).alias("hash"), F.col("x.line").alias("lines"))


def reply_links(rows: DataFrame) -> DataFrame:
    """msg, parent (turn): the earlier turn of the conversation that a message quotes.

    Each passage and line names the latest earlier turn for each level nearer to its own text. Of the turns named, the one
    that has the outermost of the message's linked quotes is taken, then the one that has most of its quoted lines, then
    the latest.
    """
    found = passages(rows).where("conv is not null and turn is not null")
    own = found.select("conv", "turn", "level", "hash").distinct()
    levels = own.groupBy("conv", "hash").agg(F.collect_set("level").alias("levels"))  # at which a passage occurs, not all up to the quote's
    quoted = found.where("level > 0").join(levels, ["conv", "hash"])
    quoted = quoted.select("conv", "hash", F.explode(F.filter("levels", lambda x: x < F.col("level"))).alias("from_level"), "turn", "msg", "level", "lines", F.lit(None).cast("long").alias("from_turn"))
    origin = own.select("conv", "hash", F.col("level").alias("from_level"), "turn", F.lit(None).cast("string").alias("msg"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("array<int>").alias("lines"), F.col("turn").alias("from_turn"))
    # the latest earlier turn in one sorted pass, as a common passage would join with all its quotes
    earlier = Window.partitionBy("conv", "hash", "from_level").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    met = written(quoted.unionByName(origin).withColumn("from_turn", F.max("from_turn").over(earlier)).where("msg is not null and from_turn is not null").drop("turn"), "quotes")
    named = met.groupBy("msg").agg(F.collect_set("from_turn").alias("turns"))
    # a message's own passages with the turns it names, not with all turns that have them
    asked = met.select("conv", "msg", "hash", "level", "lines").distinct().join(named.where("size(turns) > 1").select("msg", F.explode("turns").alias("turn")), "msg")
    has = own.groupBy("conv", "turn", "hash").agg(F.min("level").alias("nearest"))
    had = asked.join(has, ["conv", "turn", "hash"]).where("nearest < level")
    had = had.groupBy("msg", "turn").agg(F.min("level").alias("level"), F.size(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("n"))
    best = had.groupBy("msg").agg(F.max(F.struct((-F.col("level")).alias("l"), "n", "turn"))["turn"].alias("parent"))
    return named.where("size(turns) = 1").select("msg", F.col("turns")[0].alias("parent")).unionByName(best)


def threads(links: DataFrame) -> DataFrame:
    """conv, turn, parent: adds the turn at which each chain of replies starts, and its length, by pointer doubling."""
    state = written(links.select("conv", "turn", "parent", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth")), "replies")
    for _ in range(MOST_ROUNDS):
        above = state.select("conv", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        state = written(state.join(above, ["conv", "up"], "left").select("conv", "turn", "parent", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")), "replies")
        if not state.where("moved").limit(1).count():
            break
        state = state.drop("moved")
    return state.select("conv", "turn", "parent", F.col("up").alias("thread"), "depth")


def conversations(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """A row per message: conv_id, turn, role, position, reply_to, thread, depth, n_quoted (lines), text without quotes.

    reply_to is the turn quoted, thread the turn at which the chain of replies starts (its own without a link), depth the
    length of the chain. position numbers a conversation's messages from 0 by thread, turn, text: every reply follows
    what it replies to. Quoted lines and a line that announces them are dropped, the rest is trimmed. Null texts are
    empty; null conversations or turns link with nothing and their messages are ordered first. Messages that repeat a
    turn share its links and each have a row. A text of any length is split in one task, and quoted at any number of levels. An empty table gives an
    empty result. Other columns are ignored.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.withColumn("msg", F.sha2(F.to_json(F.struct("conv", "turn", "role", "text")), 256))  # no two rows of different fields have one
    all_lines = lines(rows.groupBy("msg", "conv", "turn").agg(F.first("text").alias("text")))
    parents = reply_links(all_lines).join(rows.select("msg", "conv", "turn").distinct(), "msg")
    parents = parents.groupBy("conv", "turn").agg(F.max("parent").alias("parent"))
    found = threads(parents)

    after = Window.partitionBy("msg").orderBy("line")
    told = all_lines.withColumn("next", F.lead("level").over(after))
    keep = (F.col("level") == 0) & ~((F.coalesce("next", F.lit(0)) > 0) & F.col("body").rlike(LEAD))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("line", "body")))), lambda x: x["body"]), "\n")
    plain = told.groupBy("msg").agg(body.alias("plain"), F.count_if(F.col("level") > 0).alias("n_quoted"))
    out = rows.drop("text").join(plain, "msg").join(found, ["conv", "turn"], "left")
    out = out.select("conv", "turn", "role", "msg", F.col("parent").alias("reply_to"), F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"), "n_quoted", F.regexp_replace("plain", r"^\s+|\s+$", "").alias("text"))
    out = written(out.withColumn("part", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-1))), "messages")
    key = F.struct("conv").alias("c"), F.struct("thread").alias("t")
    sizes = out.groupBy(*key, "part").count()
    before = Window.partitionBy("c").orderBy("t", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row per thread and stretch
    sizes = sizes.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = Window.partitionBy("c", "t", "part").orderBy("turn", "text", "msg")
    out = out.withColumns({"c": key[0], "t": key[1]}).join(sizes, ["c", "t", "part"])
    position = F.col("base") + F.row_number().over(own) - 1
    return out.select(F.col("conv").alias("conv_id"), "turn", "role", position.alias("position"), "reply_to", "thread", "depth", "n_quoted", "text")
