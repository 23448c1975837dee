"""Votes of members out of transcripts and appendices, in Spark's string functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legispark.functions import vocabulary as V
from legispark.functions.scalar import recoded

CUT, END, REST = "\u0001", "\u0002", 2**31 - 1
#: Distances in characters: between headers of one vote, and of the last section.
GAPS = {"inline": 1500, "appendix": 3000}
LAST = {"inline": 2000, "appendix": 3000}
CONTEXT, TOTALS, MOST_CONTEXT, OVERSHOOT, MISMATCH = 500, 300, 100, 1.2, 5
NAME = "[가-힣]{2,4}"


def _header(style: str, headers: Sequence[str]) -> str:
    """Looks at one range of first characters before it tries all headers."""
    firsts = f"(?=[{min(headers)[0]}-{max(headers)[0]}])"
    if style == "inline":
        return firsts + r"(" + "|".join(headers) + r")\s*\((\d+)인\)"
    spaced = "|".join(r"\s*".join(h) for h in headers)
    return firsts + rf"({spaced})\s*[(（]?\s*(\d+)\s*인\s*[)）]?"


def _tail(text: str | Column, n: int) -> Column:
    """The last n characters. F.right works its text out twice."""
    return F.substring(text, -n, REST)


def _sums(values: str | Column) -> Column:
    """The running sums of an array of whole numbers, from 0 on: one more than there are numbers."""
    return F.aggregate(values, F.array(F.lit(0)), lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x))


def _events(t: DataFrame, id_cols: Sequence[str], text: str, style: str, headers: Sequence[str]) -> DataFrame:
    """A row per event: id columns, event (from 1), first (its first section), pieces (from a header to the next), is_end (the text's last), before, _begins.

    Headers whose distance stays under the gap are one event: a piece longer than that ends its event. No gap is shorter
    than CONTEXT, so one piece of text holds what stands before an event. All is folded within the text's row, in time
    that grows with the text; _begins (the offsets of all sections) alone takes longer, and goes where it isn't asked for.
    """
    plain = F.replace(F.replace(F.col(text), F.lit(CUT), F.lit("")), F.lit(END), F.lit(""))
    marked = F.regexp_replace(plain, _header(style, headers), f"{CUT}$0{END}")
    rows = t.select(*id_cols, F.split(marked, CUT).alias("_pieces"))
    rows = rows.withColumn("_begins", _sums(F.transform("_pieces", lambda p, i: F.length(p) - (i > 0).cast("int"))))
    places = F.slice(F.sequence(F.lit(0), F.size("_pieces") - 1), F.lit(2), F.size("_pieces"))  # from 1, none without a header
    rows = rows.withColumn("_firsts", F.filter(places, lambda i: (i == 1) | (F.length(F.get("_pieces", i - 1)) > GAPS[style])))
    event = lambda first, k: F.struct(
        (k + 1).alias("event"), first.alias("first"), F.get("_firsts", k + 1).isNull().alias("is_end"),
        F.slice("_pieces", first + 1, F.coalesce(F.get("_firsts", k + 1), F.size("_pieces")) - first).alias("pieces"),
        _tail(F.replace(_tail(F.get("_pieces", first - 1), CONTEXT + 1), F.lit(END), F.lit("")), CONTEXT).alias("before"),
    )
    return rows.select(*id_cols, "_begins", F.explode(F.transform("_firsts", event)).alias("_e")).select(*id_cols, "_begins", "_e.*")


def _split(events: DataFrame, style: str, headers: Sequence[str]) -> DataFrame:
    """A row per section of the events, with header, expected, begin and body."""
    kept = [c for c in events.columns if c not in ("first", "pieces", "is_end", "_begins")]
    rows = events.select(*kept, "first", "is_end", "_begins", F.size("pieces").alias("_n"), F.posexplode("pieces").alias("_k", "_piece"))
    section, head = F.col("first") + F.col("_k"), F.substring_index("_piece", END, 1)
    is_last = F.col("is_end") & (F.col("_k") == F.col("_n") - 1)
    body = F.substring("_piece", F.length(head) + 2, F.when(is_last, LAST[style]).otherwise(REST))
    header = F.regexp_replace(F.regexp_extract(head, _header(style, headers), 1), r"\s+", "")
    return rows.select(*kept, section.alias("section"), F.get("_begins", section).alias("begin"), header.alias("header"), F.regexp_extract(head, r"(\d+)", 1).try_cast("int").alias("expected"), body.alias("body"))


def sections(t: DataFrame, id_cols: Sequence[str], text: str, style: str, headers: Sequence[str] = V.VOTE_HEADERS) -> DataFrame:
    """A row per vote header: id columns, section (from 1), header, expected, begin (offset from 0), body, event, before.

    body runs to the next header of any event, the last one's LAST characters at most. Headers whose distance stays
    under the gap are one event. before has the CONTEXT characters ahead of the first header of the section's event.
    Texts aren't shuffled, and only sections leave the row.
    """
    return _split(_events(t, id_cols, text, style, headers), style, headers)


def names(rows: DataFrame, noise: Sequence[str], headers: dict[str, str]) -> DataFrame:
    """Adds names: runs of 2 to 4 syllables without the noise words; far more than expected are cut to the expected."""
    found = F.filter(F.regexp_extract_all("body", F.lit(f"({NAME})"), 1), lambda x: ~x.isin(*noise)) if noise else F.regexp_extract_all("body", F.lit(f"({NAME})"), 1)
    rows = rows.where(F.col("header").isin(*headers)).withColumn("names", found)
    rows = rows.withColumn("n_found", F.size("names"))
    over = F.col("n_found") > OVERSHOOT * F.col("expected")
    return rows.withColumns({"names": F.when(over, F.slice("names", 1, F.greatest("expected", F.lit(1)))).otherwise(F.col("names")), "is_mismatch": F.abs(F.col("n_found") - F.col("expected")) > MISMATCH})


def with_contexts(rows: DataFrame, style: str, ends: Sequence[str] = V.AGENDA_ENDS) -> DataFrame:
    """Adds bill_context and the announced totals of each section's event, from the text before its first header.

    The context is in transcripts the last numbered agenda item, else the first phrase with such an ending; in
    appendices the first numbered phrase with such an ending, its number included.
    """
    near = _tail("before", TOTALS)
    tail = "(?:" + "|".join(ends) + ")"
    numbered = F.regexp_extract_all("before", F.lit(r"(?m)^\s*\d+\.\s+([^(\n]+)" if style == "inline" else rf"(\d+\.[^\n]+?{tail})"), 1)
    phrase = F.nullif(F.regexp_extract("before", rf"([가-힣\s]{{5,50}}{tail})", 1), F.lit(""))
    picked = F.coalesce(F.try_element_at(numbered, F.lit(-1)), phrase) if style == "inline" else F.get(numbered, 0)
    totals = r"재석\s*(\d+)\s*인\s*중\s*찬성\s*(\d+)\s*인"
    about = {"bill_context": F.substring(F.trim(picked), 1, MOST_CONTEXT), "agg_total": F.regexp_extract(near, totals, 1).try_cast("int"), "agg_yes": F.regexp_extract(near, totals, 2).try_cast("int")}
    return rows.withColumns(about).drop("before")


def voted(t: DataFrame, id_cols: Sequence[str], text: str, style: str = "inline", noise: Sequence[str] = (), headers: dict[str, str] | None = None, ends: Sequence[str] = V.AGENDA_ENDS) -> DataFrame:
    """A row per section that counts: id columns, event, section, vote, names, bill_context, agg_total, agg_yes. Contexts are found once an event."""
    headers = headers or V.VOTE_LABELS
    every = list(dict.fromkeys([*headers, V.SKIPPED_HEADER])) if headers is V.VOTE_LABELS else list(headers)
    events = with_contexts(_events(t.where(F.col(text).isNotNull()), id_cols, text, style, every), style, ends)
    found = names(_split(events, style, every), noise, headers)
    return found.select(*id_cols, "event", "section", recoded("header", headers).alias("vote"), "names", "bill_context", "agg_total", "agg_yes")


def members(rows: DataFrame) -> DataFrame:
    """A row per name, with its place. Outer, as Spark would else find all names once more to tell which rows have none."""
    return rows.select("*", F.posexplode_outer("names").alias("place", "member_name")).where(F.col("place").isNotNull()).drop("names")


def parse_votes(t: DataFrame, id_cols: Sequence[str], text: str, style: str = "inline", noise: Sequence[str] = (), headers: dict[str, str] | None = None, ends: Sequence[str] = V.AGENDA_ENDS) -> DataFrame:
    """A row per member and vote: id columns, event, vote, member_name, place, bill_context, agg_total, agg_yes.

    headers maps the section headers that count to votes; an event ends where the next one's first header stands. Texts
    that are null or have no header give no rows. Texts are read once and never shuffled.
    """
    rows = members(voted(t, id_cols, text, style, noise, headers, ends))
    return rows.select(*id_cols, "event", "section", "vote", "place", "member_name", "bill_context", "agg_total", "agg_yes")


def mismatches(t: DataFrame, id_cols: Sequence[str], text: str, style: str, noise: Sequence[str] = (), headers: dict[str, str] | None = None) -> DataFrame:
    """Sections whose names are more than MISMATCH off the announced number."""
    headers = headers or V.VOTE_LABELS
    return names(sections(t, id_cols, text, style, list(headers)), noise, headers).where("is_mismatch").select(*id_cols, "event", "header", "expected", "n_found")


def mention_counts(t: DataFrame, by: Sequence[str], text: str, phrases: dict[str, str]) -> DataFrame:
    """Per group: texts that hold each phrase, and how often they do."""
    aggs = []
    for name, phrase in phrases.items():
        aggs += [F.count_if(F.contains(F.col(text), F.lit(phrase))).alias(f"{name}_texts"), F.coalesce(F.sum(F.regexp_count(F.col(text), F.lit(phrase))), F.lit(0)).cast("long").alias(f"{name}_times")]
    return t.groupBy(*by).agg(*aggs)
