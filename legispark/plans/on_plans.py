"""Queries through the whole plans: saved tables, consolidation, parsed meetings, profiles, details, linkage."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from legispark.functions import vocabulary as V
from legispark.operators import ranks, stats, tables
from legispark.plans import bills as bill_plans
from legispark.plans import votes as vote_plans
from legispark.plans.bindings import BILLS, COMMITTEE, LIFE, SCORES, VOTES, bills, committee, dealt, lifecycle, listed, query, read, rounded, scores, stages, votes
from legispark.sources import scan, sinks
from legispark.sources.kept import kept_path

DIGITS = "0123456789"
SYLLABLES = "가나다라마바사아자차"
NAMED = f"translate(lpad(member::VARCHAR, 4, '0'), '{DIGITS}', '{SYLLABLES}')"


def named(member: str = "member"):
    """A member's number as four syllables."""
    return F.translate(F.lpad(F.col(member).cast("string"), 4, "0"), DIGITS, SYLLABLES)


def _coded(labels: dict[str, str], column: str):
    return F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[F.col(column)]


def _case(labels: dict[str, str], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items()) + " END"


CAST = {"A": V.YES, "N": V.NO, "R": V.ABSTAIN}
HEADER = {"A": "찬성의원", "N": "반대의원", "R": "기권의원"}


@query(f"""WITH {VOTES}, api AS (SELECT term, item, member, min(date) AS date FROM votes WHERE line <= 4 GROUP BY ALL),
api2 AS (SELECT term, item, member, date, min({_case(CAST, "vote")}) AS vote FROM api JOIN (SELECT term AS t, item AS i, member AS m, date AS d, vote FROM votes WHERE line <= 4) x ON x.t = term AND x.i = item AND x.m = member AND x.d = date GROUP BY ALL),
parsed AS (SELECT term, item, {NAMED} AS name, line, CASE source WHEN 'F' THEN 0 ELSE 1 END AS first, {_case(CAST, "vote")} AS vote, date FROM votes WHERE line > 4),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY term, item, name, line ORDER BY first, vote, date) AS n FROM parsed) WHERE n = 1)
SELECT term, 'api' AS source, item::VARCHAR AS bill_id, NULL::VARCHAR AS meeting_id, NULL::INT AS vote_event, vote, date, member::VARCHAR AS member_id FROM api2
UNION ALL SELECT term, CASE first WHEN 0 THEN 'appendix' ELSE 'inline' END, NULL, item::VARCHAR, line, vote, date, NULL FROM best""")
def consolidated_votes(spark, d):
    """All three sources through consolidate: votes of lines 1 to 4 as the feed's, the others as parsed ones, of appendices or transcripts."""
    t = votes(spark, d).withColumn("cast", _coded(CAST, "vote"))
    feed = t.where("line <= 4").select(named().alias("HG_NM"), F.col("member").cast("string").alias("MONA_CD"), F.col("cast").alias("RESULT_VOTE_MOD"), F.col("item").cast("string").alias("BILL_ID"), F.col("date").cast("string").alias("VOTE_DATE"), F.col("term").alias("AGE"))
    texts = t.where("line > 4").select("source", "term", F.col("item").alias("meeting_id"), F.col("date").cast("string").alias("date"), named().alias("member_name"), F.col("cast").alias("vote"), F.col("line").alias("vote_event"))
    inline, appendix = (texts.where(F.col("source") == s).drop("source") for s in ("O", "F"))
    out = vote_plans.consolidate(feed, inline, appendix)
    return out.select("term", "source", "bill_id", "meeting_id", "vote_event", "vote", "date", "member_id")


def _lines(headers: dict[str, str], opened: str, closed: str):
    """A line for each list of names that has any: its header, their number and the names; by header."""
    line = lambda k, h: F.when(F.size(k) > 0, F.concat(F.lit(h + opened), F.size(k).cast("string"), F.lit(closed), F.array_join(k, " ")))
    return F.concat_ws("\n", *[line(k, h) for k, h in sorted(headers.items(), key=lambda x: x[1])])


@query(f"""WITH {VOTES}, m AS (SELECT *, {NAMED} AS name FROM votes), s AS (SELECT term, item, source, vote, name FROM m)
SELECT item AS meeting_id, term, dense_rank() OVER (PARTITION BY item ORDER BY term, source)::INT AS vote_event, {_case(CAST, "vote")} AS vote, name AS member_name, source || ' 법률안' AS bill_context, 7 AS agg_total, 5 AS agg_yes FROM s""")
def plenary_votes(spark, d):
    """Each meeting's votes as speeches of the plenary, one of each year and source, parsed by parse_speeches; events go through a meeting."""
    groups = dealt(votes(spark, d), "item").groupBy("item", "term", "source").agg(*listed(HEADER, "vote", named()))
    speech = groups.select("item", "term", "source", _lines(HEADER, "(", "인)\n").alias("body"))
    head = F.concat(F.lit("3. "), "source", F.lit(" 법률안\n재석 7인 중 찬성 5인\n"))
    speech = speech.select(F.col("item").alias("meeting_id"), "term", F.make_date("term", F.lit(1), F.lit(1)).alias("date"), (2 * F.col("term") + (F.col("source") == "O").cast("int")).alias("speech_order"), F.lit(V.PLENARY).alias("hearing_type"), F.concat(head, "body").alias("speech_text"))
    out = vote_plans.parse_speeches(speech, "inline", [])
    return out.select("meeting_id", "term", "vote_event", "vote", "member_name", "bill_context", "agg_total", "agg_yes")


@query("SELECT conv_id AS meeting_id, arg_min(role, turn) AS session, min(turn)::INT AS first_turn, sum((length(text) - length(replace(text, 'the ', ''))) / 4)::BIGINT AS n_vote_refs FROM conversations WHERE contains(text, 'the ') GROUP BY conv_id")
def appendix_meetings(spark, d):
    """Conversations as meetings, through the plan that counts their references to an appendix; turns stand for dates."""
    t = read(spark, d, "conversations").select(F.col("conv_id").alias("meeting_id"), F.col("turn").alias("speech_order"), F.col("turn").cast("int").alias("date"), F.col("role").alias("session"), F.lit(V.PLENARY).alias("hearing_type"), F.lit(22).alias("term"), F.col("text").alias("speech_text"))
    return vote_plans.appendix_meetings(t, 22, "the ").withColumnRenamed("date", "first_turn")


PROFILE = f"""{LIFE}, {SCORES}, r AS (SELECT *, floor(rank() OVER (PARTITION BY term ORDER BY aligned) + (count(*) OVER (PARTITION BY term, aligned) - 1) / 2)::BIGINT AS rank, count(*) OVER (PARTITION BY term) AS size FROM scores), own AS (SELECT * FROM life WHERE sponsor = 37)"""


@query(f"""WITH {PROFILE}, top AS (SELECT * FROM own WHERE enacted = 1 ORDER BY s7 DESC NULLS LAST, bill_id LIMIT 5)
SELECT 'record' AS part, count(*)::VARCHAR AS key, round(median(days_to_proc), 6) AS value FROM own
UNION ALL SELECT 'top', bill_id::VARCHAR, year(s7)::DOUBLE FROM top
UNION ALL SELECT 'rank', term::VARCHAR, (rank * 1000 + size)::DOUBLE FROM r WHERE member = 37
UNION ALL SELECT 'person', 'M' || c_custkey, c_nationkey::DOUBLE FROM customer WHERE c_custkey = 37""")
def legislator_whole_profile(spark, d):
    """All four tables of the profile's plan: bills led with their median days, the newest enacted, ranks in each term, the person."""
    code = F.col("sponsor").cast("string")
    t = lifecycle(spark, d).withColumns({"rst_proposer": F.concat(F.lit("M"), code), "rst_mona_cd": code, "age": F.col("term"), "proc_dt": F.col("s7")})
    points = scores(spark, d).withColumn("member_id", F.col("member").cast("string"))
    people = read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("mona_cd"), F.concat(F.lit("M"), F.col("c_custkey").cast("string")).alias("member_name"), F.lit(1).alias("age"), "c_nationkey")
    found = vote_plans.legislator_profile(t, points, people, "M37", mona="37")
    row = lambda part, table, key, value: found[table].select(F.lit(part).alias("part"), key.cast("string").alias("key"), value.cast("double").alias("value"))
    out = row("record", "record", F.col("led"), F.col("median_days")).unionByName(row("top", "top", F.col("bill_id"), F.year("proc_dt")))
    out = out.unionByName(row("rank", "ranks", F.col("term"), F.col("rank") * 1000 + F.col("group_size"))).unionByName(row("person", "person", F.col("member_name"), F.col("c_nationkey")))
    return rounded(out)


@query("SELECT 'PRC_' || o_orderkey AS bill_id, o_orderkey::VARCHAR AS bill_no, o_orderstatus AS status, o_orderdate::DATE AS ppsl_dt, t.n AS propose_reason FROM orders LEFT JOIN (SELECT l_orderkey, count(*)::VARCHAR AS n FROM lineitem GROUP BY l_orderkey) t ON l_orderkey = o_orderkey WHERE o_orderkey IN (712, 77)")
def bill_detail(spark, d):
    """Two lookups through the plan, one by id and one by number, each with the bill's text (here its number of lines) if there is one."""
    t = read(spark, d, "orders").select(F.concat(F.lit("PRC_"), F.col("o_orderkey").cast("string")).alias("bill_id"), F.col("o_orderkey").cast("string").alias("bill_no"), F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("ppsl_dt"))
    texts = read(spark, d, "lineitem").groupBy(F.concat(F.lit("PRC_"), F.col("l_orderkey").cast("string")).alias("bill_id")).agg(F.count(F.lit(1)).cast("string").alias("propose_reason"))
    return bill_plans.bill_detail(t, texts, "PRC_712").unionByName(bill_plans.bill_detail(t, texts, "77"))


@query(f"WITH {BILLS}, {COMMITTEE} SELECT bill_id, term AS age, committee AS committee_nm, {_case({'F': '원안가결', 'P': '대안반영폐기'}, 'bills.status')} AS status FROM bills JOIN committee USING (sponsor) WHERE committee = 'BUILDING' AND term = 1996 AND bills.status IN ('F', 'P') AND bill_kind = '2-HIGH'")
def export_bills(spark, d):
    """What fits all of the export's filters."""
    t = bills(spark, d).join(committee(spark, d).select("sponsor", F.col("committee").alias("committee_nm")), "sponsor")
    t = t.withColumns({"age": F.col("term"), "status": _coded({"F": "원안가결", "P": "대안반영폐기", "O": "계류중"}, "status")})
    return bill_plans.export_bills(t, 1996, "BUILDING", "passed", "2-HIGH").select("bill_id", "age", "committee_nm", "status")


@query("""WITH a AS (SELECT DISTINCT o_custkey AS code FROM orders), b AS (SELECT c_custkey AS code, c_name AS name FROM customer WHERE c_acctbal > 0), c AS (SELECT s_suppkey AS code, s_name AS name FROM supplier),
every AS (SELECT code FROM a UNION SELECT code FROM b UNION SELECT code FROM c)
SELECT 'mapping' AS part, code::VARCHAR AS key, coalesce(b.name, c.name) AS name, (code IN (SELECT code FROM a))::INT + 2 * (b.code IS NOT NULL)::INT + 4 * (c.code IS NOT NULL)::INT AS n, NULL::DOUBLE AS percent FROM every LEFT JOIN b USING (code) LEFT JOIN c USING (code)
UNION ALL SELECT 'coverage', s, NULL, n, round(100.0 * n / (SELECT count(*) FROM every), 6) FROM (SELECT 'a' AS s, count(*) AS n FROM a UNION ALL SELECT 'b', count(*) FROM b UNION ALL SELECT 'c', count(*) FROM c)""")
def id_mapping(spark, d):
    """Codes of three sources through the linkage plan: each code once, flags of its sources, the first name, and how much each source covers."""
    none = F.lit(None).cast("string").alias("name")
    sources = {
        "a": read(spark, d, "orders").select(F.col("o_custkey").alias("code"), none),
        "b": read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name")),
        "c": read(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("code"), F.col("s_name").alias("name")),
    }
    found = vote_plans.id_mapping(sources, "code", "name")
    flags = sum((F.col(f"in_{s}").cast("int") * 2**i for i, s in enumerate(sources)), F.lit(0)).cast("long")
    out = found["mapping"].select(F.lit("mapping").alias("part"), F.col("code").cast("string").alias("key"), "name", flags.alias("n"), F.lit(None).cast("double").alias("percent"))
    return rounded(out.unionByName(found["coverage"].select(F.lit("coverage").alias("part"), F.col("source").alias("key"), none, F.col("n").cast("long").alias("n"), "percent")))


@query(f"WITH {LIFE} SELECT bill_id, term, status, s1 AS committee_dt, s7 AS proc_dt FROM life")
def bucketed_master(spark, d):
    """Bills and their stages in saved tables, bucketed and sorted by bill, that join without a shuffle."""
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"master_{uuid.uuid4().hex}"
    left = sinks.bucketed(bills(spark, d), f"{name}_bills", ["bill_id"], n, kept_path(spark, "bucketed"))
    right = sinks.bucketed(stages(spark, d), f"{name}_stages", ["bill_id"], n, kept_path(spark, "bucketed"))
    return tables.left_enrich(left, right, "bill_id", {"s1": "committee_dt", "s7": "proc_dt"}).select("bill_id", "term", "status", "committee_dt", "proc_dt")


@query(f"WITH {BILLS} SELECT term AS age, count(*) AS n, min(ppsl_dt) AS first, max(CASE WHEN term = 1998 THEN 'rewritten' ELSE status END) AS status FROM bills GROUP BY term")
def rewritten_terms(spark, d):
    """The table of bills written by terms, one of them rewritten alone, and scanned by the declared schema."""
    root = kept_path(spark, "data")
    t = bills(spark, d).select(F.col("bill_id").cast("string").alias("bill_id"), F.col("term").alias("age"), "status", "ppsl_dt")
    sinks.write_table(scan.conformed(t, scan.SCHEMAS["bills"]), root, "bills")
    again = t.where("age = 1998").withColumn("status", F.lit("rewritten"))
    sinks.write_table(scan.conformed(again, scan.SCHEMAS["bills"]), root, "bills")
    found = scan.scan(spark, root, "bills", columns=["bill_id", "age", "status", "ppsl_dt"])
    return found.groupBy("age").agg(F.count(F.lit(1)).alias("n"), F.min("ppsl_dt").alias("first"), F.max("status").alias("status"))


@query(f"WITH {VOTES} SELECT 'votes' AS endpoint, count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT item, line, member FROM votes)) AS n_after FROM votes")
def written_accounting(spark, d):
    """Rows before and after repeats went, counted while the votes were written: one pass over them."""
    t = votes(spark, d)
    found = sinks.write_deduplicated(t, ["item", "line", "member"], ["date", "part", "price", "vote", "source"], kept_path(spark, "votes"))
    return found.select(F.lit("votes").alias("endpoint"), F.col("n_before").alias("n_rows"), "n_after")


@query(f"WITH {BILLS} SELECT term, count(DISTINCT sponsor) AS n_sponsors, true AS is_near FROM bills GROUP BY term")
def sketched_sponsors(spark, d):
    """Distinct sponsors of each term, exactly and by sketches that could be kept: all lie within five standard errors."""
    t = bills(spark, d)
    exact = t.groupBy("term").agg(F.countDistinct("sponsor").alias("n_sponsors"))
    about = stats.distinct_estimates(stats.distinct_sketches(t, ["term"], "sponsor"), ["term"])
    near = F.abs(F.col("n_distinct") - F.col("n_sponsors")) <= 5 * stats.sketch_error() * F.col("n_sponsors")
    return ranks.joined(exact, about, ["term"]).select("term", "n_sponsors", near.alias("is_near"))


@query()
def ideal_points(spark, d):
    """Votes of three years through the plan, a month's lines of a number as one roll call: contested items, active members, one scaling run, alignment.

    Tested on planted positions and against numpy instead of SQL.
    """
    t = votes(spark, d).select("term", F.concat_ws("_", F.month("date"), "line").alias("bill_id"), F.col("member").cast("string").alias("member_id"), _coded(CAST, "vote").alias("vote"))
    out = vote_plans.ideal_points(t, [1996, 1997, 1998], 1998, iters=12)
    return rounded(out.select("term", "member_id", "score", "rounds", "aligned"), 4)


@query(f"WITH {SCORES} SELECT member, term, party, aligned, rank() OVER (PARTITION BY term ORDER BY aligned DESC) + (count(*) OVER (PARTITION BY term, aligned) - 1) // 2 AS rank, count(*) OVER (PARTITION BY term) AS group_size FROM scores QUALIFY contains(lower(party), '_1') AND term >= 1997")
def ideology_rows(spark, d):
    """Rows of the ideology table's plan, found by part of a party's name, of two terms."""
    points = scores(spark, d).select(F.col("member").alias("member_id"), F.col("member").cast("string").alias("member_name"), "term", "party", "aligned")
    out = vote_plans.ideology_table(points, party="_1")
    return out.where("term >= 1997").select(F.col("member_id").alias("member"), "term", "party", "aligned", "rank", "group_size")


@query("SELECT c_mktsegment AS party, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment)::INT AS shown FROM customer GROUP BY c_mktsegment UNION ALL SELECT '무소속', count(*), 0 FROM supplier")
def party_legend(spark, d):
    """Parties in display order through the plan: a known family before the segments, these by number and name."""
    points = read(spark, d, "customer").select(F.col("c_mktsegment").alias("party")).unionByName(read(spark, d, "supplier").select(F.lit("무소속").alias("party")))
    return ranks.numbered(vote_plans.party_legend(points), ["place", F.desc("n"), "party"]).select("party", "n", (F.col("number") - 1).cast("int").alias("shown"))


@query("""WITH s AS (SELECT event_id, user_id AS meeting_id, month(ts)::INT AS term, event_type, ts::DATE AS date FROM events), m AS (SELECT DISTINCT month(o_orderdate)::INT AS term, o_orderdate::DATE + INTERVAL 8766 DAY AS date FROM orders),
b AS (SELECT term, date::DATE AS date FROM m)
SELECT 'speeches' AS part, term, event_type AS kind, count(DISTINCT meeting_id) AS a, count(*) AS b FROM s GROUP BY term, event_type
UNION ALL SELECT 'hearings', term, NULL, count(DISTINCT (meeting_id, date)), count(*) FROM s GROUP BY term
UNION ALL SELECT 'overlap', term, NULL, count(x), count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) FROM (SELECT DISTINCT term, date, 1 AS x FROM s) FULL JOIN (SELECT DISTINCT term, date, 1 AS y FROM b) USING (term, date) GROUP BY term""")
def speech_linkage(spark, d):
    """Events as speeches through the linkage plan: per term and kind, hearings, and dates shared with committee meetings (orders' dates, moved)."""
    s = read(spark, d, "events").select(F.col("user_id").alias("meeting_id"), F.month("ts").alias("term"), F.to_date("ts").alias("date"), F.lit("c").alias("committee"), F.col("event_type").alias("hearing_type"), F.col("event_id").alias("speaker"), F.lit("p").alias("party"))
    meetings = read(spark, d, "orders").select(F.month("o_orderdate").alias("age"), F.date_add(F.to_date("o_orderdate"), 8766).alias("jrcmit_conf_dt"))
    found = vote_plans.link_speeches(s, meetings)
    row = lambda part, t, kind, a, b: t.select(F.lit(part).alias("part"), "term", kind.cast("string").alias("kind"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    hearings = found["hearings"].groupBy("term").agg(F.count_distinct("meeting_id", "date").alias("a"), F.sum("n_speeches").alias("b"))
    out = row("speeches", found["speeches"], F.col("hearing_type"), F.col("n_meetings"), F.col("n_speeches"))
    return out.unionByName(row("hearings", hearings, F.lit(None), F.col("a"), F.col("b"))).unionByName(row("overlap", found["overlap"], F.lit(None), F.col("n_left"), F.col("n_both")))


@query(f"""WITH {VOTES}, seats AS (SELECT member, list_sort(list(DISTINCT term)) AS terms FROM votes GROUP BY member)
SELECT member::VARCHAR AS mona_cd, '{{}}' || member AS member_name, 1997 AS age, 'p' || (list_position(terms, 1997) - 1 + member) AS party FROM seats WHERE list_contains(terms, 1997)""".replace("'{}' || member", "'M' || member"))
def members_of_term(spark, d):
    """Members of one term out of a feed with lists of terms and parties, through the plan."""
    seats = votes(spark, d).groupBy("member").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    label = F.array_join(F.transform("terms", lambda t: F.concat(F.lit("제"), t.cast("string"), F.lit("대"))), ", ")
    party = F.array_join(F.transform("terms", lambda t, i: F.concat(F.lit("p"), (i + F.col("member")).cast("string"))), "/")
    blank = [F.lit("").alias(c) for c in (*V.MEMBER_FEED, *V.MEMBER_LISTS) if c not in ("NAAS_CD", "NAAS_NM", "PLPT_NM")]
    feed = seats.select(F.col("member").cast("string").alias("NAAS_CD"), F.concat(F.lit("M"), F.col("member").cast("string")).alias("NAAS_NM"), label.alias(V.MEMBER_TERMS), party.alias("PLPT_NM"), *blank)
    return vote_plans.members_of_term(feed, 1997).select("mona_cd", "member_name", "age", "party")


@query(f"""WITH {VOTES}, s AS (SELECT item, term, vote, {NAMED} AS name FROM votes)
SELECT item AS meeting_id, dense_rank() OVER (PARTITION BY item ORDER BY term)::INT AS vote_event, {_case(CAST, "vote")} AS vote, name AS member_name, '1.제' || term || '호 결의안' AS bill_context FROM s""")
def appendix_votes(spark, d):
    """Each meeting's votes as an appendix, headers spaced and in wide brackets, an event for each year; parsed in the style of appendices."""
    spaced = {k: " ".join(h) for k, h in HEADER.items()}
    groups = dealt(votes(spark, d), "item").groupBy("item", "term").agg(*listed(HEADER, "vote", named()))
    speech = groups.select("item", "term", _lines(spaced, " （", " 인）\n").alias("body"))
    head = F.concat(F.lit("1.제"), F.col("term").cast("string"), F.lit("호 결의안\n"))
    speech = speech.select(F.col("item").alias("meeting_id"), "term", F.make_date("term", F.lit(1), F.lit(1)).alias("date"), F.col("term").alias("speech_order"), F.lit(V.PLENARY).alias("hearing_type"), F.concat(head, "body").alias("speech_text"))
    return vote_plans.parse_speeches(speech, "appendix", []).select("meeting_id", "vote_event", "vote", "member_name", "bill_context")


@query(f"WITH {SCORES} SELECT 'csv' AS source, member::VARCHAR AS member_id, term, round(aligned, 6) AS aligned FROM scores UNION ALL SELECT 'json', o_orderkey::VARCHAR, year(o_orderdate)::INT, round(o_totalprice, 6) FROM orders")
def files_read_back(spark, d):
    """Scores as CSV, one folder for all terms, and bills as an array in JSON, written and read back by the scans; the sign is turned twice."""
    root = kept_path(spark, "files")
    points = scores(spark, d).select(F.col("member").cast("string").alias("member_id"), "term", (-F.col("aligned")).alias("coord1D"), F.lit(None).cast("double").alias("se1D"), F.lit(None).cast("string").alias("member_name"), "party")
    sinks.score_files(points, root, "term", [1998])
    csv = scan.scores(spark, f"{root}/ideal_points_all").select(F.lit("csv").alias("source"), "member_id", "term", "aligned")
    t = bills(spark, d).select(F.col("bill_id").cast("string").alias("bill_id"), F.col("term").cast("string").alias("age"), "price")
    sinks.charts({"proposals": t}, root)
    lines = spark.read.schema("bill_id string, age string, price double").json(f"{root}/proposals")
    json = lines.select(F.lit("json").alias("source"), F.col("bill_id").alias("member_id"), F.col("age").try_cast("int").alias("term"), F.col("price").alias("aligned"))
    return rounded(csv.unionByName(json))
