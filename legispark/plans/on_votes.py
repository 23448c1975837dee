"""Queries on roll calls, scores and texts of votes."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from legispark.functions.scalar import share
from legispark.operators import people, rollcall, stats, tables, textvotes
from legispark.plans.bindings import SCORES, VOTES, dealt, listed, query, read, rounded, scores, votes
from legispark.plans.votes import parsed_summary

ITEMS = "items AS (SELECT item, count(yes) AS n, coalesce(avg(yes), 0.0) AS yes_share FROM votes GROUP BY item), contested AS (SELECT item, n, yes_share, CASE WHEN n > 0 THEN least(yes_share, 1 - yes_share) ELSE 0.0 END AS minority FROM items)"


@query(f"WITH {VOTES}, {ITEMS} SELECT item, n, round(yes_share, 6) AS yes_share, round(minority, 6) AS minority, minority >= 0.025 AS is_contested FROM contested")
def contested_votes(spark, d):
    return rounded(rollcall.contested(votes(spark, d), "item", "yes"))


@query(f"WITH {VOTES}, {ITEMS} SELECT member, count(yes) AS n_votes FROM votes WHERE item IN (SELECT item FROM contested WHERE minority >= 0.025) GROUP BY member HAVING count(yes) >= 20")
def active_members(spark, d):
    t = votes(spark, d)
    items = rollcall.contested(t, "item", "yes").where("is_contested").select("item")
    return rollcall.active(t.join(items, "item", "left_semi"), "member", "yes")


@query(f"WITH {VOTES}, {ITEMS} SELECT (SELECT count(DISTINCT member) FROM votes) AS n_members, (SELECT count(yes) FROM votes) AS n_votes, count(*) AS n_items, count(*) FILTER (minority >= 0.025) AS n_contested FROM contested")
def matrix_summary(spark, d):
    return rollcall.matrix_summary(votes(spark, d), "member", "item", "yes")


@query(f"WITH {VOTES} SELECT member, item, CASE vote WHEN 'A' THEN 1 WHEN 'N' THEN 6 WHEN 'R' THEN 9 END AS code FROM (SELECT *, row_number() OVER (PARTITION BY member, item ORDER BY line, date, part, price, vote) AS n FROM votes) WHERE n = 1")
def vote_matrix(spark, d):
    return rollcall.matrix(votes(spark, d), "member", "item", "vote", {"A": 1, "N": 6, "R": 9}, ["line", "date", "part", "price", "vote"])


@query(f"WITH {VOTES} SELECT array_to_string(list_transform(terms, lambda x: x::VARCHAR), ',') AS terms, len(terms)::INT AS n_terms, len(terms) >= 2 AS is_bridge, member FROM (SELECT member, list_sort(list(DISTINCT term)) AS terms FROM votes GROUP BY member)")
def bridging_members(spark, d):
    return rollcall.bridging(votes(spark, d), "member", "term").withColumn("terms", F.array_join(F.col("terms").cast("array<string>"), ","))


@query(f"WITH {VOTES} SELECT item, member, line, vote, source, date, part, price FROM (SELECT *, row_number() OVER (PARTITION BY item, line, member ORDER BY date, part, price, vote, source) AS n FROM votes) WHERE n = 1")
def dedup_api_votes(spark, d):
    return tables.keep_first(votes(spark, d), ["item", "line", "member"], ["date", "part", "price", "vote", "source"]).select("item", "member", "line", "vote", "source", "date", "part", "price")


@query(f"WITH {VOTES} SELECT item, line, source, vote, member FROM (SELECT *, row_number() OVER (PARTITION BY item, line ORDER BY (source <> 'F')::INT, date, member, part, price) AS n FROM votes) WHERE n = 1")
def dedup_priority(spark, d):
    first = F.when(F.col("source") == "F", 0).otherwise(1)
    return tables.keep_first(votes(spark, d), ["item", "line"], [first, "date", "member", "part", "price"]).select("item", "line", "source", "vote", "member")


@query(f"WITH {VOTES} SELECT count(*) AS n_before, (SELECT count(*) FROM (SELECT DISTINCT item, line, member FROM votes)) AS n_after, count(*) - (SELECT count(*) FROM (SELECT DISTINCT item, line, member FROM votes)) AS n_removed FROM votes")
def dedup_accounting(spark, d):
    from legispark.operators.checks import dedup_accounting as accounting

    t = votes(spark, d)
    return accounting(t, t.select("item", "line", "member").distinct())


@query(f"WITH {VOTES} SELECT term, round(count(*) FILTER (vote = 'A') / count(*), 6) AS \"A\", round(count(*) FILTER (vote = 'N') / count(*), 6) AS \"N\", round(count(*) FILTER (vote = 'R') / count(*), 6) AS \"R\" FROM votes GROUP BY term")
def vote_share_row_norm(spark, d):
    return rounded(stats.pivot_counts(votes(spark, d), ["term"], "vote", ["A", "N", "R"], normalise=True))


@query(f"WITH {VOTES} SELECT term, count(*) FILTER (source = 'F') AS \"F\", count(*) FILTER (source = 'O') AS \"O\" FROM votes GROUP BY term")
def votes_by_source_pivot(spark, d):
    return stats.pivot_counts(votes(spark, d), ["term"], "source", ["F", "O"])


@query(f"WITH {VOTES} SELECT term, count(*) AS n_rows, count(DISTINCT member) AS n_members, count(DISTINCT item) AS n_events, count(DISTINCT source) AS n_sources FROM votes GROUP BY term")
def rollcall_summary(spark, d):
    return votes(spark, d).groupBy("term").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("member").alias("n_members"), F.countDistinct("item").alias("n_events"), F.countDistinct("source").alias("n_sources"))


RATES = "rates AS (SELECT item, count(yes) AS n, 100.0::DOUBLE * sum(yes) / count(yes) AS rate FROM votes GROUP BY item HAVING count(yes) > 0)"


def _rates(spark, d):
    return votes(spark, d).groupBy("item").agg(F.count("yes").alias("n"), F.try_divide(100.0 * F.sum("yes"), F.count("yes")).alias("rate")).where("n > 0")


@query(f"WITH {VOTES}, {RATES} SELECT least(floor(rate / (100 / 30::DOUBLE)), 29)::INT AS bin, count(*) AS n FROM rates GROUP BY ALL")
def approval_histogram(spark, d):
    return stats.histogram(_rates(spark, d), "rate", 0.0, 100.0, 30)


@query(f"WITH {VOTES}, {RATES} SELECT rate < 80 AS is_contested, count(*) AS n_items, round(avg(rate), 6) AS mean_rate FROM rates GROUP BY ALL")
def contested_split(spark, d):
    return rounded(_rates(spark, d).groupBy((F.col("rate") < 80).alias("is_contested")).agg(F.count(F.lit(1)).alias("n_items"), F.avg("rate").alias("mean_rate")))


@query(f"WITH {SCORES} SELECT term, round(avg(aligned) FILTER (bloc = 'ASIA'), 6) AS mean_a, round(avg(aligned) FILTER (bloc = 'EUROPE'), 6) AS mean_b, round(abs(avg(aligned) FILTER (bloc = 'ASIA') - avg(aligned) FILTER (bloc = 'EUROPE')), 6) AS gap FROM scores GROUP BY term HAVING gap IS NOT NULL")
def polarization_gap(spark, d):
    return rounded(stats.gap(scores(spark, d), "term", "bloc", "ASIA", "EUROPE", "aligned"))


SPREAD = "count(aligned) AS n, round(avg(aligned), 6) AS mean, round(median(aligned), 6) AS median, round(stddev_samp(aligned), 6) AS sd, round(quantile_cont(aligned, 0.25), 6) AS p25, round(quantile_cont(aligned, 0.75), 6) AS p75, round(min(aligned), 6) AS least, round(max(aligned), 6) AS greatest"


@query(f"WITH {SCORES} SELECT party, term, {SPREAD} FROM scores GROUP BY ALL HAVING count(aligned) >= 3")
def party_term_stats(spark, d):
    return rounded(stats.group_spread(scores(spark, d), ["party", "term"], "aligned", 3))


@query(f"WITH {SCORES} SELECT bloc, term, {SPREAD} FROM scores GROUP BY ALL HAVING count(aligned) >= 2")
def score_distribution(spark, d):
    return rounded(stats.group_spread(scores(spark, d), ["bloc", "term"], "aligned", 2))


@query(f"WITH {SCORES} SELECT member, term, aligned, floor(rank() OVER (PARTITION BY term ORDER BY aligned) + (count(*) OVER (PARTITION BY term, aligned) - 1) / 2)::BIGINT AS rank, count(aligned) OVER (PARTITION BY term) AS group_size FROM scores")
def rank_in_term(spark, d):
    return stats.rank_avg_trunc(scores(spark, d), ["term"], "aligned").select("member", "term", "aligned", "rank", "group_size")


@query(f"WITH {SCORES} SELECT member, term, party, aligned, floor(rank() OVER (PARTITION BY term ORDER BY aligned DESC) + (count(*) OVER (PARTITION BY term, aligned) - 1) / 2)::BIGINT AS rank FROM scores QUALIFY contains(lower(party), 'nation_1') AND term = 1998")
def ideology_search(spark, d):
    t = stats.rank_avg_trunc(scores(spark, d), ["term"], "aligned", ascending=False)
    return t.where(F.contains(F.lower("party"), F.lit("nation_1")) & (F.col("term") == 1998)).select("member", "term", "party", "aligned", "rank")


@query(f"WITH {SCORES}, s AS (SELECT term, aligned - lag(aligned) OVER (PARTITION BY member ORDER BY term) AS shift FROM scores) SELECT term, count(shift) AS n, round(avg(abs(shift)), 6) AS mean_shift, round(median(abs(shift)), 6) AS median_shift FROM s WHERE shift IS NOT NULL GROUP BY term")
def member_shift_lag(spark, d):
    return rounded(stats.shift_summary(scores(spark, d), "member", "term", "aligned"))


@query(f"WITH {SCORES} SELECT count(*) AS n, round(corr(a.aligned, b.aligned), 6) AS correlation FROM scores a JOIN scores b ON a.member = b.member AND a.term = 1997 AND b.term = 1998")
def term_correlation(spark, d):
    return rounded(stats.correlation(scores(spark, d), "member", "term", "aligned", 1997, 1998))


@query(f"WITH {SCORES}, f AS (SELECT s.term, regr_slope(b.aligned, s.aligned) AS k, regr_intercept(b.aligned, s.aligned) AS c FROM scores s JOIN scores b ON b.member = s.member AND b.term = 1998 GROUP BY s.term) SELECT member, term, aligned AS score, round(CASE WHEN k IS NULL THEN aligned ELSE k * aligned + c END, 5) AS aligned FROM scores LEFT JOIN f USING (term)")
def term_alignment(spark, d):
    t = scores(spark, d).select("member", "term", F.col("aligned").alias("score"))
    return rollcall.align_terms(t, "member", "term", "score", 1998).withColumn("aligned", F.round("aligned", 5))


@query()
def rollcall_scaling(spark, d):
    """Iterative: tested on planted positions instead of SQL."""
    t = votes(spark, d).where("yes is not null")
    return rounded(rollcall.scale_1d(rollcall.prepared(t, "member", "item", "yes"), "member", "item", "yes", iters=6), 4)


@query(f"WITH {SCORES}, {VOTES} SELECT member, party, n_votes, round(yes_share, 6) AS yes_share, term, aligned, rank FROM (SELECT member, count(yes) AS n_votes, avg(yes) AS yes_share FROM votes GROUP BY member) JOIN (SELECT *, floor(rank() OVER (PARTITION BY term ORDER BY aligned) + (count(*) OVER (PARTITION BY term, aligned) - 1) / 2)::BIGINT AS rank FROM scores) USING (member) WHERE member = 7")
def legislator_profile(spark, d):
    own = votes(spark, d).where("member = 7").groupBy("member").agg(F.count("yes").alias("n_votes"), F.avg("yes").alias("yes_share"))
    ranked = stats.rank_avg_trunc(scores(spark, d), ["term"], "aligned")
    return rounded(ranked.where("member = 7").join(own, "member").select("member", "party", "n_votes", "yes_share", "term", "aligned", "rank"))


HEADERS = {"VOTEYES": "A", "VOTENO": "N", "VOTEABS": "R"}
NOISE = ["결의안", "재석", "찬성"]
RENDER = {"A": "VOTEYES", "N": "VOTENO", "R": "VOTEABS"}


def _name() -> Column:
    """A member's number as four syllables."""
    return F.translate(F.lpad(F.col("member").cast("string"), 4, "0"), "0123456789", "가나다라마바사아자차")


def _line(names: str, vote: str, said: Column) -> Column:
    """A header with the number announced, then the names; null without names."""
    return F.when(F.size(names) > 0, F.concat(F.lit(f"{RENDER[vote]}("), said.cast("string"), F.lit("인)\n"), F.array_join(names, " ")))


def vote_texts(spark, d):
    """Each item's votes rendered as a transcript: a header with the number for each vote, then syllable names."""
    groups = dealt(votes(spark, d), "item").groupBy("item").agg(*listed(RENDER, "vote", _name()))
    head = F.concat(F.lit("12. "), F.col("item").cast("string"), F.lit(" 동의안\n재석 9인 중 찬성 5인\n"))
    return groups.select("item", F.concat(head, F.concat_ws("\n", *[_line(v, v, F.size(v)) for v in RENDER])).alias("text"))


@query(f"WITH {VOTES} SELECT item, vote, translate(lpad(member::VARCHAR, 4, '0'), '0123456789', '가나다라마바사아자차') AS member_name, count(*) AS n, item || ' 동의안' AS bill_context, 9 AS agg_total, 5 AS agg_yes FROM votes GROUP BY ALL")
def vote_text_roundtrip(spark, d):
    """Renders all votes as texts and parses them back; the SQL has the votes themselves."""
    out = textvotes.parse_votes(vote_texts(spark, d), ["item"], "text", "inline", headers=HEADERS)
    return out.groupBy("item", "vote", "member_name", "bill_context", "agg_total", "agg_yes").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {VOTES} SELECT item, CASE vote WHEN 'A' THEN 'VOTEYES' WHEN 'N' THEN 'VOTENO' ELSE 'VOTEABS' END AS header, count(*)::INT AS expected, 1::BIGINT AS event, 0 AS n_off FROM votes GROUP BY item, vote")
def vote_sections(spark, d):
    rows = textvotes.names(textvotes.sections(vote_texts(spark, d), ["item"], "text", "appendix", list(HEADERS)), [], HEADERS)
    return rows.select("item", "header", "expected", "event", (F.col("n_found") - F.col("expected")).alias("n_off"))


def event_texts(spark, d):
    """Each item's votes as a text with an event for each source, far apart; abstentions are announced as one, noes as ten more than there are."""
    t = dealt(votes(spark, d), "item").withColumn("group", F.concat("source", "vote"))
    groups = t.groupBy("item").agg(*listed([s + v for s in "FO" for v in RENDER], "group", _name()))
    said = {"A": F.size, "N": lambda names: F.size(names) + 10, "R": lambda names: F.lit(1)}

    def event(source: str, yes: int) -> Column:
        body = F.concat_ws("\n", *[_line(source + v, v, said[v](source + v)) for v in RENDER])
        return F.when(F.length(body) > 0, F.concat(F.lit(f"7. {source} 결의안\n재석 8인 중 찬성 {yes}인\n"), body, F.lit("\n" + "-" * 1510)))

    return groups.select("item", F.concat_ws("\n", event("F", 3), event("O", 4)).alias("text"))


EVENTS = "named AS (SELECT item, source, vote, translate(lpad(member::VARCHAR, 4, '0'), '0123456789', '가나다라마바사아자차') AS member_name FROM votes), placed AS (SELECT *, row_number() OVER (PARTITION BY item, source, vote ORDER BY member_name) AS place, dense_rank() OVER (PARTITION BY item ORDER BY source) AS event FROM named)"


@query(f"WITH {VOTES}, {EVENTS} SELECT item, event, vote, member_name, source || ' 결의안' AS bill_context, 8 AS agg_total, CASE source WHEN 'F' THEN 3 ELSE 4 END AS agg_yes, count(*) AS n FROM placed WHERE vote <> 'R' OR place = 1 GROUP BY ALL")
def vote_text_events(spark, d):
    """Several events in a text: grouped by the gaps between headers, each with its own context; more names than announced are cut."""
    out = textvotes.parse_votes(event_texts(spark, d), ["item"], "text", "inline", NOISE, HEADERS)
    return out.groupBy("item", "event", "vote", "member_name", "bill_context", "agg_total", "agg_yes").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {VOTES}, {EVENTS} SELECT item, event, 'VOTENO' AS header, (count(*) + 10)::INT AS expected, count(*)::INT AS n_found FROM placed WHERE vote = 'N' GROUP BY item, event UNION ALL SELECT item, event, 'VOTEABS', 1, count(*) FROM placed WHERE vote = 'R' GROUP BY item, event HAVING count(*) > 6")
def vote_text_mismatches(spark, d):
    return textvotes.mismatches(event_texts(spark, d), ["item"], "text", "inline", NOISE, HEADERS)


@query(f"WITH {VOTES} SELECT term, count(DISTINCT line) AS vote_events, count(member) AS total_records, count(DISTINCT member) AS unique_members FROM votes GROUP BY term")
def parsed_vote_summary(spark, d):
    return parsed_summary(votes(spark, d), "term", "line", "member")


@query(f"WITH {SCORES}, {VOTES}, sat AS (SELECT DISTINCT member, term, source AS party FROM votes), p AS (SELECT member, string_agg(DISTINCT party, '/' ORDER BY party) AS parties, string_agg(DISTINCT term::VARCHAR, ',' ORDER BY term::VARCHAR) AS terms FROM sat GROUP BY member), h AS (SELECT member, term, min(party) AS here FROM sat GROUP BY ALL) SELECT s.member, s.term, aligned, parties, terms, coalesce(here, s.party) AS party FROM scores s LEFT JOIN p USING (member) LEFT JOIN h ON h.member = s.member AND h.term = s.term")
def scores_with_parties(spark, d):
    sat = votes(spark, d).select("member", "term", F.col("source").alias("party"))
    return rollcall.with_parties(scores(spark, d).drop("bloc"), sat, "member", "term", "party")


@query("SELECT role, count(*) FILTER (contains(text, 'the')) AS the_texts, coalesce(sum((length(text) - length(replace(text, 'the', ''))) / 3), 0)::BIGINT AS the_times, count(*) FILTER (contains(text, 'tion')) AS tion_texts, coalesce(sum((length(text) - length(replace(text, 'tion', ''))) / 4), 0)::BIGINT AS tion_times FROM conversations GROUP BY role")
def mention_counts(spark, d):
    return textvotes.mention_counts(read(spark, d, "conversations"), ["role"], "text", {"the": "the", "tion": "tion"})


@query("SELECT conv_id, count(text) AS n_speeches, count(DISTINCT text) AS n_speakers, string_agg(DISTINCT role, ', ' ORDER BY role) AS parties FROM conversations GROUP BY conv_id")
def hearing_summary(spark, d):
    return people.meeting_summary(read(spark, d, "conversations"), ["conv_id"], "text", "role")


@query("SELECT conv_id, arg_min(text, turn) AS first_text, min(turn) AS first_turn FROM conversations WHERE contains(text, 'th') GROUP BY conv_id")
def appendix_references(spark, d):
    t = read(spark, d, "conversations").where(F.contains("text", F.lit("th")))
    return t.groupBy("conv_id").agg(F.min_by("text", "turn").alias("first_text"), F.min("turn").alias("first_turn"))


SPONSORS = "lists AS (SELECT l_orderkey AS bill, min(l_suppkey) AS lead, array_to_string(list_sort(list(DISTINCT l_suppkey::VARCHAR)), ', ') AS co FROM lineitem GROUP BY l_orderkey), edges AS (SELECT bill, lead AS src, trim(unnest(string_split(co, ','))) AS dst FROM lists), e AS (SELECT bill, src, dst FROM edges WHERE src::VARCHAR <> dst)"


def _edges(spark, d):
    co = F.array_join(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))), ", ")
    lists = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("bill")).agg(F.min("l_suppkey").alias("lead"), co.alias("co"))
    return people.edges(lists, "lead", "co", ["bill"])


@query(f"WITH {SPONSORS} SELECT bill, src, dst FROM e")
def cosponsor_edges(spark, d):
    return _edges(spark, d).select("bill", "src", "dst")


@query(f"WITH {SPONSORS} SELECT src, dst, count(*) AS weight FROM e GROUP BY ALL")
def edge_weights(spark, d):
    return people.edge_weights(_edges(spark, d))


@query(f"WITH {SPONSORS} SELECT node, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree FROM (SELECT src::VARCHAR AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e) GROUP BY node")
def node_degrees(spark, d):
    return people.degrees(_edges(spark, d))


@query(f"WITH {VOTES}, x AS (SELECT member, vote, count(*) AS n FROM votes GROUP BY ALL) SELECT member, vote, n, round(n / sum(n) OVER (PARTITION BY member), 6) AS share FROM x")
def member_vote_shares(spark, d):
    per = votes(spark, d).groupBy("member", "vote").agg(F.count(F.lit(1)).alias("n"))
    return rounded(per.withColumn("share", share(F.col("n"), F.sum("n").over(Window.partitionBy("member")))))
