"""Members' votes: consolidation of sources, text parsing, profiles, linkage, ideology."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legispark.functions import scalar as S
from legispark.functions import vocabulary as V
from legispark.operators import people, rollcall, stats, tables, textvotes
from legispark.sources.scan import vote_feed


def consolidate(api: DataFrame, inline: DataFrame, appendix: DataFrame, by_name: bool = False) -> DataFrame:
    """All three sources in one table, each member's vote on each bill or event once.

    Feed rows are one by term, bill and member (by code where there is one, or by name alone); parsed rows by term,
    meeting, member and event, those of appendices first.
    """
    cols = [*V.VOTE_COMMON, *V.VOTE_OPTIONAL]
    api = tables.align_union(vote_feed(api), cols=cols)
    who = F.col("member_name") if by_name else F.coalesce("member_id", "member_name")
    api = tables.keep_first(api.withColumn("_who", who), ["term", "bill_id", "_who"], [F.col("date").asc_nulls_last(), F.col("vote").asc_nulls_last(), F.col("member_name").asc_nulls_last(), F.col("meeting_id").asc_nulls_last()]).drop("_who")
    text = tables.align_union(appendix.withColumn("source", F.lit("appendix")), inline.withColumn("source", F.lit("inline")), cols=cols)
    text = text.withColumn("meeting_id", F.col("meeting_id").cast("string"))
    text = tables.keep_first(text, ["term", "meeting_id", "member_name", "vote_event"], [F.when(F.col("source") == "appendix", 0).otherwise(1), F.col("vote").asc_nulls_last(), F.col("date").asc_nulls_last(), F.col("bill_context").asc_nulls_last()])
    out = api.select(*[F.col(c).cast("string") for c in cols]).unionByName(text.select(*[F.col(c).cast("string") for c in cols]))
    out = out.withColumns({c: F.col(c).try_cast("int") for c in ("term", "vote_event", "agg_total", "agg_yes")})
    return out.withColumns({"vote": S.recoded(S.squeezed("vote"), V.VOTE_LABELS), "date": S.safe_date(F.substring("date", 1, 10))})


def parse_speeches(speeches: DataFrame, style: str, noise: list[str], plenary_only: bool = True) -> DataFrame:
    """Members' votes out of speeches; events are numbered per meeting by speech and place in it.

    Speeches are parsed once. Events are numbered while their names are still together, so sections move, not votes; those
    without a name don't count.
    """
    if plenary_only:
        speeches = speeches.where(F.col("hearing_type") == V.PLENARY)
    ids = ["meeting_id", "term", "date", "speech_order"]
    rows = textvotes.voted(speeches.dropna(subset=["meeting_id", "speech_order"]).select(*ids, "speech_text"), ids, "speech_text", style, noise)
    number = F.dense_rank().over(Window.partitionBy("meeting_id", F.size("names") > 0).orderBy("speech_order", "event"))  # a row per section
    return textvotes.members(rows.withColumn("vote_event", number)).select("meeting_id", "speech_order", "term", "date", "vote", "member_name", "bill_context", "agg_total", "agg_yes", "vote_event")


def appendix_meetings(speeches: DataFrame, term: int | None = None, phrase: str = V.APPENDIX_PHRASE) -> DataFrame:
    """Plenary meetings that refer to an appendix: date and session of the first such speech, and how often they do."""
    t = speeches.where((F.col("hearing_type") == V.PLENARY) & F.contains("speech_text", F.lit(phrase)))
    t = t if term is None else t.where(F.col("term") == term)
    times = F.sum(F.regexp_count("speech_text", F.lit(phrase))).cast("long")
    return t.groupBy("meeting_id").agg(F.min_by("date", "speech_order").alias("date"), times.alias("n_vote_refs"), F.min_by("session", "speech_order").alias("session"))


def with_blocs(t: DataFrame, party: str = "party") -> DataFrame:
    """Adds party_bloc and party_family."""
    return t.withColumns({"party_bloc": S.recoded(party, V.BLOCS, V.OTHER_BLOC), "party_family": S.recoded(party, V.FAMILIES)})


def party_legend(points: DataFrame, party: str = "party") -> DataFrame:
    """Parties with their number of member-terms, in display order: known families first, then by number and name."""
    order = F.array_position(F.array(*map(F.lit, V.FAMILIES)), F.col(party))
    counts = points.where(F.col(party).isNotNull()).groupBy(party).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("place", F.when(order > 0, order).otherwise(len(V.FAMILIES) + 1)).orderBy("place", F.desc("n"), party)


def legislator_profile(bills: DataFrame, points: DataFrame, members: DataFrame, name: str, age: int | None = None, mona: str | None = None) -> dict[str, DataFrame]:
    """record (bills led, enacted, reflected in others, median days), top (newest enacted), ranks, person.

    Without a code it is the name's commonest in the bills, the least of several.
    """
    own = bills.where(F.col("rst_proposer") == name) if mona is None else bills.where(F.col("rst_mona_cd") == mona)
    own = own if age is None else own.where(F.col("age") == age)
    code = own.agg(F.mode("rst_mona_cd", True).alias("mona_cd"))
    record = own.agg(F.count(F.lit(1)).alias("led"), F.coalesce(F.sum("enacted"), F.lit(0)).alias("enacted"), F.coalesce(F.sum("passed") - F.sum("enacted"), F.lit(0)).alias("reflected"), F.median("days_to_proc").alias("median_days"))
    record = record.crossJoin(code).withColumn("enacted_rate", S.percent(F.col("enacted"), F.col("led")))  # one row each
    ranked = stats.rank_avg_trunc(points, ["term"], "aligned")
    ranks = ranked.join(F.broadcast(code), F.col("member_id") == F.col("mona_cd")) if mona is None else ranked.where(F.col("member_id") == mona)
    person = members.where((F.col("mona_cd") == mona) if mona else (F.col("member_name") == name))
    return {"record": record, "top": tables.topk(own.where("enacted = 1"), 5, [F.desc_nulls_last("proc_dt"), "bill_id"]), "ranks": ranks, "person": tables.topk(person, 1, [F.desc_nulls_last("age"), "mona_cd"])}


def link_bill_texts(bills: DataFrame, texts: DataFrame, sponsors: DataFrame) -> dict[str, DataFrame]:
    """edges of cosponsorship, and per term the share of bills with a text."""
    role = F.when(F.col("REP_DIV").contains("대표"), "lead").otherwise("co")
    edges = sponsors.select(F.col("BILL_ID").alias("bill_id"), F.col("PPSR_NM").alias("member_name"), F.col("NASS_CD").alias("member_id"), F.col("PPSR_POLY_NM").alias("party"), role.alias("role"))
    return {"edges": edges, "coverage": tables.coverage(bills, texts, "bill_id", ["age"])}


def link_speeches(speeches: DataFrame, meetings: DataFrame) -> dict[str, DataFrame]:
    """Hearings, speeches per term and kind, and dates that hearings share with committee meetings."""
    per = people.meeting_summary(speeches, ["meeting_id", "term", "date", "committee", "hearing_type"], "speaker", "party")
    by = speeches.groupBy("term", "hearing_type").agg(F.countDistinct("meeting_id").alias("n_meetings"), F.count(F.lit(1)).alias("n_speeches"))
    dates = meetings.select(F.col("age").alias("term"), F.col("jrcmit_conf_dt").alias("date"))
    return {"hearings": per, "speeches": by, "overlap": tables.date_overlap(speeches, dates, "term", "date")}


def id_mapping(sources: Mapping[str, DataFrame], code: str, name: str) -> dict[str, DataFrame]:
    """Each member code once with the name of the first source that has one, flags of the sources, and their coverage."""
    flags = tables.flag_membership(sources, code)
    out = flags.join(tables.first_name(list(sources.items()), code, name), code)
    counts = flags.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(f"in_{s}")).alias(s) for s in sources])
    coverage = counts.unpivot(["total"], list(sources), "source", "n").withColumn("percent", S.percent(F.col("n"), F.col("total")))
    return {"mapping": out, "coverage": coverage}


def members_of_term(feed: DataFrame, age: int) -> DataFrame:
    """The members of a term out of the feed of all members, with their party and seat of that term; by party, then name. Missing texts are empty."""
    rows = people.member_history(feed, V.MEMBER_TERMS, {new: old for old, new in V.MEMBER_LISTS.items()}, f"제{age}대")
    texts = [F.coalesce(F.col(old), F.lit("")).alias(new) for old, new in V.MEMBER_FEED.items()]
    lists = [F.coalesce(F.col(new), F.lit("")).alias(new) for new in V.MEMBER_LISTS.values()]
    return rows.select(*texts, F.lit(age).alias("age"), *lists).orderBy("party", "member_name", "mona_cd")


def parsed_summary(parsed: DataFrame, term: str = "term", event: str = "vote_event", member: str = "member_name") -> DataFrame:
    """Per term of parsed votes: events (distinct numbers), records and members."""
    return parsed.groupBy(term).agg(F.countDistinct(event).alias("vote_events"), F.count(member).alias("total_records"), F.countDistinct(member).alias("unique_members"))


def ideal_points(votes: DataFrame, terms: list[int], base: int, iters: int = rollcall.MOST_ROUNDS, min_votes: int = 20) -> DataFrame:
    """member_id, term, score, rounds, aligned out of roll calls: scaling of all terms at once, then alignment over bridging members."""
    own = votes.where(F.col("term").isin(*terms)).withColumn("item", F.concat_ws("_", F.col("term").cast("string"), F.col("bill_id").cast("string")))
    cells = rollcall.matrix(own, "member_id", "item", "vote", V.VOTE_CODES, ["vote"], ["term"])
    cells = cells.withColumn("yes", F.when(F.col("code") == 1, 1).when(F.col("code") == 6, 0)).where("yes is not null")
    cells = rollcall.prepared(cells, "member_id", "item", "yes", min_votes=min_votes, by=["term"])
    return rollcall.align_terms(rollcall.scale_terms(cells, "term", "member_id", "item", "yes", most_rounds=iters), "member_id", "term", "score", base)


def ideology_table(points: DataFrame, name: str | None = None, party: str | None = None, term: int | None = None, order: str = "rank", ascending: bool = True) -> DataFrame:
    """All member-terms with rank and group size, the greatest first in rank; searched by parts of name or party, sorted."""
    t = stats.rank_avg_trunc(points, ["term"], "aligned", ascending=False)
    for c, part in (("member_name", name), ("party", party)):
        t = t if part is None else t.where(F.coalesce(F.contains(F.lower(c), F.lit(part.lower())), F.lit(False)))
    t = t if term is None else t.where(F.col("term") == term)
    return t.orderBy(F.col(order).asc_nulls_last() if ascending else F.col(order).desc_nulls_last(), "term", "member_id")
