"""Queries on bills and their lives."""

from __future__ import annotations

from pyspark.sql import functions as F

from legispark.functions import vocabulary as V
from legispark.operators import checks, models, stats, tables
from legispark.plans.bills import lite_summary, timeline
from legispark.plans.bindings import BILLS, COMMITTEE, LAW, LIFE, SCORES, bills, committee, lifecycle, query, read, rounded, scores
from legispark.sources.kept import kept

KINDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUS = ["F", "O", "P"]
STAGE_COLS = ["ppsl_dt", *[f"s{k}" for k in range(1, 8)]]
RATES = "count(*) AS n, sum(passed)::BIGINT AS n_passed, sum(enacted)::BIGINT AS n_enacted, round(avg(passed), 6) AS passed_rate, round(avg(enacted), 6) AS enacted_rate"


@query(f"WITH {BILLS} SELECT term, {RATES} FROM bills WHERE bill_kind = '{LAW}' GROUP BY term")
def passage_rate_by_term(spark, d):
    return rounded(stats.rate_table(bills(spark, d).where(F.col("bill_kind") == LAW), ["term"], ["passed", "enacted"]))


@query(f"WITH {BILLS} SELECT term, grouping(term)::INT AS is_total, {RATES} FROM bills GROUP BY ROLLUP (term)")
def term_summary_rollup(spark, d):
    return rounded(stats.rollup_counts(bills(spark, d), "term", ["passed", "enacted"]))


def _funnel_sql(parts: list[str], rows: str) -> str:
    union = " UNION ALL ".join(f"SELECT {i} AS stage, 'stage {i}' AS label, count({p}) AS n FROM {rows}" for i, p in enumerate(parts))
    return f"SELECT stage, label, n, round(n / first_value(n) OVER (ORDER BY stage), 6) AS share_of_base, round(n / nullif(lag(n) OVER (ORDER BY stage), 0), 6) AS survival, lag(n) OVER (ORDER BY stage) - n AS loss FROM ({union})"


@query(f"WITH {LIFE}, laws AS (SELECT * FROM life WHERE bill_kind = '{LAW}'), c AS (SELECT s7 AS d, count(*) AS n FROM laws WHERE s7 IS NOT NULL GROUP BY s7), e AS (SELECT CASE WHEN (SELECT max(n) FROM c) > 0.3 * (SELECT sum(n) FROM c) THEN (SELECT d FROM c ORDER BY n DESC, d LIMIT 1) END AS d), kept AS (SELECT laws.* REPLACE (CASE WHEN e.d IS NULL OR s7 <> e.d THEN s7 END AS s7) FROM laws, e) " + _funnel_sql(STAGE_COLS, "kept"))
def funnel_stages(spark, d):
    laws = lifecycle(spark, d).where(F.col("bill_kind") == LAW)
    return rounded(stats.funnel(laws, [(f"stage {i}", [c]) for i, c in enumerate(STAGE_COLS)], exclude_mode_of="s7"))


@query(f"WITH {LIFE} " + _funnel_sql(["ppsl_dt", "coalesce(s1, s2)", "coalesce(s3, s4)", "coalesce(s5, s6)", "s7"], "life"))
def funnel_any_of(spark, d):
    parts = [["ppsl_dt"], ["s1", "s2"], ["s3", "s4"], ["s5", "s6"], ["s7"]]
    return rounded(stats.funnel(lifecycle(spark, d), [(f"stage {i}", c) for i, c in enumerate(parts)]))


@query(f"WITH {LIFE} SELECT term, n, share, lag(n) OVER (PARTITION BY term ORDER BY stage) - n AS loss, stage FROM (SELECT term, stage, n, round(n / max(n) OVER (PARTITION BY term), 6) AS share FROM (SELECT term, unnest(range(0, 8))::INT AS stage, unnest([count(ppsl_dt), count(s1), count(s2), count(s3), count(s4), count(s5), count(s6), count(s7)]) AS n FROM life GROUP BY term))")
def funnel_lag(spark, d):
    from pyspark.sql import Window

    rows = stats.coverage_profile(lifecycle(spark, d), STAGE_COLS, ["term"])
    stage = F.array_position(F.array(*map(F.lit, STAGE_COLS)), F.col("column_name")).cast("int") - 1
    w = Window.partitionBy("term")
    rows = rows.withColumn("stage", stage)
    return rounded(rows.select("term", "stage", "n", (F.col("n") / F.max("n").over(w)).alias("share"), (F.lag("n").over(w.orderBy("stage")) - F.col("n")).alias("loss")))


@query(f"WITH {LIFE} SELECT * FROM (" + " UNION ALL ".join(f"SELECT count(*) AS total, '{c}' AS column_name, count({c}) AS n, round(100.0 * count({c}) / count(*), 6)::DOUBLE AS percent FROM life" for c in STAGE_COLS) + ")")
def coverage_by_stage(spark, d):
    return rounded(stats.coverage_profile(lifecycle(spark, d), STAGE_COLS))


@query(f"WITH {LIFE} SELECT term, " + ", ".join(f"count({c}) AS n_{c}, CASE WHEN count({c}) > 0 THEN 'O' ELSE '-' END AS has_{c}" for c in STAGE_COLS[1:]) + ", CASE WHEN count(s7) > 0 THEN 'full' ELSE 'lite' END AS level FROM life GROUP BY term")
def availability_matrix(spark, d):
    cols = STAGE_COLS[1:]
    out = lifecycle(spark, d).groupBy("term").agg(*[F.count(c).alias(f"n_{c}") for c in cols])
    return out.withColumns({f"has_{c}": F.when(F.col(f"n_{c}") > 0, "O").otherwise("-") for c in cols} | {"level": F.when(F.col("n_s7") > 0, "full").otherwise("lite")})


@query(f"WITH {BILLS} SELECT term, " + ", ".join(f"count(*) FILTER (bill_kind = '{k}') AS \"{k}\"" for k in KINDS) + " FROM bills GROUP BY term")
def kind_composition_pivot(spark, d):
    return stats.pivot_counts(bills(spark, d), ["term"], "bill_kind", KINDS)


@query(f"WITH {BILLS}, {COMMITTEE}, x AS (SELECT party, " + ", ".join(f"count(*) FILTER (status = '{k}') AS \"{k}\"" for k in STATUS) + ", count(*) AS total FROM bills JOIN committee USING (sponsor) GROUP BY party) SELECT * FROM x ORDER BY total DESC, party LIMIT 12")
def committee_status_pivot(spark, d):
    rows = bills(spark, d).join(committee(spark, d), "sponsor")
    out = stats.pivot_counts(rows, ["party"], "status", STATUS).withColumn("total", F.col("F") + F.col("O") + F.col("P"))
    return tables.topk(out, 12, [F.desc("total"), "party"])


@query(f"WITH {LIFE}, {COMMITTEE} SELECT party, {RATES}, round(avg(days_to_proc), 6) AS mean_days_to_proc FROM life JOIN committee USING (sponsor) GROUP BY party HAVING count(*) >= 50")
def committee_passage_rate(spark, d):
    rows = lifecycle(spark, d).join(committee(spark, d), "sponsor")
    return rounded(stats.rate_table(rows, ["party"], ["passed", "enacted"], min_n=50, means=["days_to_proc"]))


@query(f"WITH {BILLS}, {COMMITTEE} SELECT term, committee, {RATES} FROM bills JOIN committee USING (sponsor) GROUP BY ALL HAVING count(*) >= 10")
def proposer_rate_matrix(spark, d):
    return rounded(stats.rate_table(bills(spark, d).join(committee(spark, d), "sponsor"), ["term", "committee"], ["passed", "enacted"], min_n=10))


@query("SELECT p_size AS size, count(p_name) AS n_titles, count(DISTINCT p_name) AS n_distinct, round(count(DISTINCT p_name) / count(p_name), 6) AS distinct_share FROM part GROUP BY p_size")
def title_inflation(spark, d):
    out = read(spark, d, "part").groupBy(F.col("p_size").alias("size")).agg(F.count("p_name").alias("n_titles"), F.countDistinct("p_name").alias("n_distinct"))
    return rounded(out.withColumn("distinct_share", F.col("n_distinct") / F.col("n_titles")))


@query("SELECT p_name AS title, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_name)::INT AS place FROM part GROUP BY p_name HAVING count(*) > 1 ORDER BY n DESC, title LIMIT 15")
def top_duplicate_titles(spark, d):
    from pyspark.sql import Window

    out = read(spark, d, "part").groupBy(F.col("p_name").alias("title")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    order = [F.desc("n"), "title"]
    return tables.topk(out, 15, order).withColumn("place", F.row_number().over(Window.orderBy(*order)))


@query(f"WITH {BILLS} SELECT 'bill_kind' AS column_name, bill_kind AS value, count(*) AS n FROM bills GROUP BY ALL UNION ALL SELECT 'status', status, count(*) FROM bills GROUP BY ALL UNION ALL SELECT 'term', term::VARCHAR, count(*) FROM bills GROUP BY ALL")
def value_counts(spark, d):
    return stats.value_counts(bills(spark, d), ["bill_kind", "status", "term"])


PERCENTILES = "round(quantile_cont(days_to_proc, 0.25), 6) AS p25, round(quantile_cont(days_to_proc, 0.5), 6) AS p50, round(quantile_cont(days_to_proc, 0.75), 6) AS p75"


@query(f"WITH {LIFE} SELECT count(days_to_proc) AS n, min(days_to_proc)::INT AS min_days, max(days_to_proc)::INT AS max_days, round(avg(days_to_proc), 6) AS mean_days, {PERCENTILES} FROM life")
def duration_summary(spark, d):
    return rounded(stats.duration_stats(lifecycle(spark, d), [], "days_to_proc"))


@query(f"WITH {LIFE} SELECT bill_kind, count(days_to_proc) AS n, min(days_to_proc)::INT AS min_days, max(days_to_proc)::INT AS max_days, round(avg(days_to_proc), 6) AS mean_days, {PERCENTILES} FROM life WHERE days_to_proc IS NOT NULL GROUP BY bill_kind")
def duration_percentiles(spark, d):
    return rounded(stats.duration_stats(lifecycle(spark, d), ["bill_kind"], "days_to_proc"))


@query(f"WITH {LIFE} SELECT term, count(*) AS n, count(*) FILTER (bill_kind = '{LAW}') AS n_laws, round(avg(passed), 6) AS passed_rate, round(avg(enacted), 6) AS enacted_rate, round(median(days_to_proc), 6) AS median_days, min(year(ppsl_dt))::INT AS first_year, max(year(ppsl_dt))::INT AS last_year FROM life GROUP BY term")
def term_summary(spark, d):
    rows = lifecycle(spark, d)
    out = rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("bill_kind") == LAW).alias("n_laws"), F.avg("passed").alias("passed_rate"), F.avg("enacted").alias("enacted_rate"), F.min(F.year("ppsl_dt")).alias("first_year"), F.max(F.year("ppsl_dt")).alias("last_year"))
    return rounded(stats.with_median(out, rows, ["term"], "days_to_proc", "median_days"))


@query(f"WITH {BILLS} SELECT date_trunc('month', ppsl_dt)::DATE AS period, count(*) AS n FROM bills GROUP BY ALL")
def monthly_counts(spark, d):
    return stats.period_counts(bills(spark, d), "ppsl_dt", "month")


@query(f"WITH {BILLS}, c AS (SELECT sponsor % 7 AS grp, date_trunc('month', ppsl_dt)::DATE AS period, count(*) AS n FROM bills GROUP BY ALL), g AS (SELECT grp, unnest(generate_series(min(period)::TIMESTAMP, max(period)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS period FROM c GROUP BY grp) SELECT grp, period, coalesce(n, 0)::BIGINT AS n, ((year(period) - year(min(period) OVER (PARTITION BY grp))) * 12 + month(period) - month(min(period) OVER (PARTITION BY grp)))::INT AS month_index FROM g LEFT JOIN c USING (grp, period)")
def monthly_gapfilled(spark, d):
    from pyspark.sql import Window

    from legispark.functions.scalar import months_from

    rows = bills(spark, d).withColumn("grp", F.col("sponsor") % 7)
    first = F.min("period").over(Window.partitionBy("grp"))
    out = stats.period_counts(rows, "ppsl_dt", "month", ["grp"], fill=True).withColumn("_first", first)
    return out.withColumn("month_index", months_from(F.year("_first"), F.month("_first"), "period")).drop("_first")


@query(f"WITH {BILLS} SELECT month::INT AS month, round(avg(coalesce(n, 0)), 6) AS mean_n FROM (SELECT term, month FROM (SELECT DISTINCT term FROM bills), range(1, 13) AS m(month)) LEFT JOIN (SELECT term, month(ppsl_dt) AS month, count(*) AS n FROM bills GROUP BY ALL) USING (term, month) GROUP BY month")
def month_of_year_mean(spark, d):
    return rounded(stats.month_means(bills(spark, d), "ppsl_dt", "term"))


@query(f"WITH {BILLS} SELECT (isodow(ppsl_dt) - 1)::INT AS weekday, count(*) AS n FROM bills GROUP BY ALL")
def weekday_counts(spark, d):
    return bills(spark, d).groupBy(F.weekday("ppsl_dt").alias("weekday")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {BILLS} SELECT sponsor, {RATES} FROM bills GROUP BY sponsor ORDER BY n DESC, sponsor LIMIT 20")
def top_sponsors(spark, d):
    return tables.topk(rounded(stats.rate_table(bills(spark, d), ["sponsor"], ["passed", "enacted"])), 20, [F.desc("n"), "sponsor"])


@query(f"WITH {BILLS}, hit AS (SELECT bill_id, term, ppsl_dt, status FROM bills JOIN customer ON c_custkey = sponsor WHERE regexp_matches(bill_kind, '(?i)urg|high') AND status IN ('F', 'P') AND ppsl_dt BETWEEN DATE '1996-03-01' AND DATE '1999-10-31' AND c_mktsegment = 'BUILDING') SELECT *, (SELECT count(*) FROM hit) AS total FROM hit ORDER BY ppsl_dt DESC, bill_id LIMIT 20")
def search_topk(spark, d):
    rows = bills(spark, d).join(committee(spark, d).select("sponsor", "committee"), "sponsor")
    top, total = tables.search(rows, {"bill_kind": "urg|high"}, {"committee": "BUILDING"}, ("status", ["F", "P"]), ("ppsl_dt", "1996-03-01", "1999-10-31"), 20, [F.desc_nulls_last("ppsl_dt"), "bill_id"])
    return top.select("bill_id", "term", "ppsl_dt", "status").crossJoin(F.broadcast(total))  # one row


@query(f"WITH {BILLS}, hit AS (SELECT bill_id, ppsl_dt, lang FROM bills JOIN documents ON doc_id = bill_id WHERE regexp_matches(text, '(?i)than+d|tion')) SELECT *, (SELECT count(*) FROM hit) AS total FROM hit ORDER BY ppsl_dt DESC, bill_id LIMIT 20")
def text_search_join(spark, d):
    texts = read(spark, d, "documents").select(F.col("doc_id").alias("bill_id"), "lang", "text")
    top, total = tables.search(bills(spark, d).join(texts, "bill_id"), {"text": "than+d|tion"}, {}, limit=20, order=[F.desc_nulls_last("ppsl_dt"), "bill_id"])
    return top.select("bill_id", "ppsl_dt", "lang").crossJoin(F.broadcast(total))  # one row


@query(f"WITH {LIFE} SELECT bill_id, stage, label, date, date_diff('day', ppsl_dt, date)::INT AS days FROM (SELECT bill_id, ppsl_dt, unnest(range(0, 8))::INT AS stage, unnest(['proposed', 'stage 1', 'stage 2', 'stage 3', 'stage 4', 'stage 5', 'stage 6', 'stage 7']) AS label, unnest([ppsl_dt, s1, s2, s3, s4, s5, s6, s7]) AS date FROM life) WHERE date IS NOT NULL")
def bill_lookup_timeline(spark, d):
    return timeline(lifecycle(spark, d), "bill_id", [("proposed", "ppsl_dt"), *[(f"stage {k}", f"s{k}") for k in range(1, 8)]])


@query("SELECT CASE WHEN id LIKE 'PRC_%' THEN 'PRC' WHEN id LIKE 'ARC_%' THEN 'ARC' WHEN regexp_matches(id, '^[0-9]+$') THEN 'numeric' ELSE 'other' END AS id_format, count(*) AS n FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'PRC_' || o_orderkey WHEN 'P' THEN 'ARC_' || o_orderkey ELSE o_orderkey::VARCHAR END AS id FROM orders) GROUP BY ALL")
def id_formats(spark, d):
    from legispark.functions.scalar import id_format

    key = F.col("o_orderkey").cast("string")
    ids = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("PRC_"), key)).when(F.col("o_orderstatus") == "P", F.concat(F.lit("ARC_"), key)).otherwise(key)
    return read(spark, d, "orders").groupBy(id_format(ids).alias("id_format")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {LIFE}, x AS (SELECT bill_kind, days_to_proc AS duration, (status <> 'O')::INT AS event FROM life WHERE days_to_proc >= 0), t AS (SELECT bill_kind, duration, count(*) AS n, sum(event)::BIGINT AS events FROM x GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY bill_kind ORDER BY duration ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS at_risk FROM t), s AS (SELECT *, CASE WHEN bool_or(events = at_risk) OVER w THEN 0.0 ELSE exp(sum(CASE WHEN events < at_risk THEN ln(1 - events / at_risk) END) OVER w) END AS survival FROM r WINDOW w AS (PARTITION BY bill_kind ORDER BY duration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT bill_kind, duration::INT AS duration, at_risk, events, round(survival, 6)::DOUBLE AS survival FROM s WHERE events > 0")
def kaplan_meier(spark, d):
    rows = lifecycle(spark, d).where("days_to_proc >= 0").withColumn("event", (F.col("status") != "O").cast("int"))
    return rounded(models.kaplan_meier(rows, "bill_kind", "days_to_proc", "event").withColumnRenamed("days_to_proc", "duration"))


@query(f"WITH {BILLS}, {COMMITTEE}, x AS (SELECT party, enacted::DOUBLE AS y, (price / 100000)::DOUBLE AS x FROM bills JOIN committee USING (sponsor)), m AS (SELECT y - avg(y) OVER (PARTITION BY party) AS y, x - avg(x) OVER (PARTITION BY party) AS x FROM x), b AS (SELECT sum(x * y) / sum(x * x) AS slope FROM m) SELECT count(*) AS n, round(max(slope), 6) AS slope, round(sqrt(sum(x * x * (y - slope * x) * (y - slope * x))) / sum(x * x), 6) AS robust_se FROM m, b")
def fe_linear_model(spark, d):
    rows = bills(spark, d).join(committee(spark, d), "sponsor").withColumn("x", F.col("price") / 100000)
    return rounded(models.fe_slope(rows, "enacted", "x", "party"))


@query(f"WITH {LIFE} SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null, round(count(*) FILTER ({c} IS NULL) / count(*), 6) AS null_share FROM life" for c in [*STAGE_COLS, "days_to_proc"]) + ") WHERE null_share > 0.05")
def quality_null_profile(spark, d):
    return rounded(checks.null_profile(lifecycle(spark, d), [*STAGE_COLS, "days_to_proc"]))


EXPECTED = {"orders": 15_000, "customer": 1_500, "part": 20_000, "nation": 25}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n, {n}::BIGINT AS expected, CASE WHEN count(*) = 0 THEN 'MISSING' WHEN abs(count(*) - {n}) <= 0.1 * {n} THEN 'OK' ELSE 'CHECK' END AS verdict FROM {t}" for t, n in EXPECTED.items()))
def expected_counts(spark, d):
    return checks.expected_counts({t: read(spark, d, t) for t in EXPECTED}, EXPECTED)


@query("SELECT count(*) AS n, 0::BIGINT AS n_null, count(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_repeated FROM lineitem")
def key_profile(spark, d):
    return checks.key_profile(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {LIFE} SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}/{b}' AS pair, count(*) FILTER ({a} = {b}) AS n_equal, count(*) FILTER ({a} <> {b}) AS n_different, count(*) FILTER ({a} IS NOT NULL AND {b} IS NULL) AS n_left_only, count(*) FILTER ({a} IS NULL AND {b} IS NOT NULL) AS n_right_only FROM life" for a, b in (("s1", "s2"), ("s6", "s7"), ("ppsl_dt", "s1"))) + ")")
def date_agreement(spark, d):
    return checks.agreement(lifecycle(spark, d), [("s1", "s2"), ("s6", "s7"), ("ppsl_dt", "s1")])


OVERVIEW = ["orders", "lineitem", "customer", "documents", "conversations"]


@query(" UNION ALL ".join([*(f"SELECT '{t}' AS table_name, count(*) AS n, NULL::DATE AS latest FROM {t}" for t in OVERVIEW), "SELECT 'latest o_orderdate', count(o_orderdate), max(o_orderdate)::DATE FROM orders"]))
def db_overview(spark, d):
    return stats.overview({t: read(spark, d, t) for t in OVERVIEW}, (read(spark, d, "orders"), "o_orderdate"))


@query(f"WITH {BILLS}, x AS (SELECT term, round(avg(passed), 6) AS passed_rate, round(avg(enacted), 6) AS enacted_rate FROM bills GROUP BY term) SELECT term, 'passed_rate' AS measure, passed_rate AS value FROM x UNION ALL SELECT term, 'enacted_rate', enacted_rate FROM x")
def rates_unpivot(spark, d):
    return stats.unpivoted(rounded(stats.rate_table(bills(spark, d), ["term"], ["passed", "enacted"])), ["term"], ["passed_rate", "enacted_rate"])


@query(f"WITH {BILLS}, {COMMITTEE}, x AS (SELECT score, enacted FROM bills JOIN committee USING (sponsor)), e AS (SELECT list_distinct(list_transform(range(0, 11), lambda i: CASE i " + " ".join(f"WHEN {i} THEN q[{i + 1}]" for i in range(11)) + " END)) AS edges FROM (SELECT quantile_cont(score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM x)) SELECT greatest(len(list_filter(edges, lambda v: v < score)) - 1, 0)::INT AS bin, count(*) AS n, round(avg(enacted), 6) AS enacted_rate, round(avg(score), 4) AS mean_score FROM x, e GROUP BY ALL")
def extremism_deciles(spark, d):
    rows = bills(spark, d).join(committee(spark, d), "sponsor")
    out = stats.quantile_bins(rows, "score", 10).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("enacted"), 6).alias("enacted_rate"), F.round(F.avg("score"), 4).alias("mean_score"))
    return out


@query(f"WITH {BILLS}, x AS (SELECT term, avg(enacted) AS y FROM bills GROUP BY term) SELECT count(*) AS n, round(regr_slope(y, term), 6) AS slope, round(regr_intercept(y, term), 4) AS intercept FROM x")
def trend_line(spark, d):
    rows = bills(spark, d).groupBy("term").agg(F.avg("enacted").alias("y"))
    out = stats.trend(rows, "term", "y")
    return out.select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query(f"WITH {BILLS}, {COMMITTEE} SELECT bloc, {RATES} FROM bills JOIN committee USING (sponsor) GROUP BY bloc HAVING count(*) >= 50")
def bloc_performance(spark, d):
    return rounded(stats.rate_table(bills(spark, d).join(committee(spark, d), "sponsor"), ["bloc"], ["passed", "enacted"], min_n=50))


@query(f"WITH {BILLS}, {COMMITTEE} SELECT party, 'all' AS scope, {RATES} FROM bills JOIN committee USING (sponsor) GROUP BY party")
def adhoc_sql(spark, d):
    from legispark.sources.sinks import register, sql

    register({"legis_bills": bills(spark, d), "legis_committee": committee(spark, d)})
    return sql(spark, "SELECT party, 'all' AS scope, count(*) AS n, sum(passed) AS n_passed, sum(enacted) AS n_enacted, round(avg(passed), 6) AS passed_rate, round(avg(enacted), 6) AS enacted_rate FROM legis_bills JOIN legis_committee USING (sponsor) GROUP BY party")


@query(f"WITH {LIFE} SELECT *, floor(n::DOUBLE / first_value(n) OVER (ORDER BY stage) * 30)::INT AS bar FROM (" + _funnel_sql(STAGE_COLS, "life") + ")")
def funnel_bars(spark, d):
    return rounded(stats.funnel(lifecycle(spark, d), [(f"stage {i}", [c]) for i, c in enumerate(STAGE_COLS)], bar=30))


@query(f"WITH {BILLS} SELECT count(*) AS n, string_agg(DISTINCT term::VARCHAR, ',' ORDER BY term::VARCHAR) AS terms, min(ppsl_dt) AS first_date, max(ppsl_dt) AS last_date FROM bills")
def combined_overview(spark, d):
    return stats.span(bills(spark, d), "term", "ppsl_dt").withColumn("terms", F.array_join(F.col("terms").cast("array<string>"), ","))


@query(f"WITH {BILLS}, {COMMITTEE} SELECT committee, {RATES}, (SELECT round(avg(passed), 6) FROM bills) AS overall_passed, (SELECT round(avg(enacted), 6) FROM bills) AS overall_enacted FROM bills JOIN committee USING (sponsor) GROUP BY committee")
def rates_with_overall(spark, d):
    t = bills(spark, d)
    groups = stats.rate_table(t.join(committee(spark, d), "sponsor"), ["committee"], ["passed", "enacted"])
    return rounded(stats.with_overall(groups, t, ["passed", "enacted"]))


@query(f"WITH {BILLS} SELECT term AS age, count(*) AS total, count(*) FILTER (bill_kind = '1-URGENT') AS member, count(*) FILTER (bill_kind = '2-HIGH') AS govt, sum(passed)::BIGINT AS passed, sum(enacted)::BIGINT AS enacted, round(100.0::DOUBLE * sum(passed) / count(*), 6) AS passed_percent FROM bills GROUP BY term")
def lite_term_summary(spark, d):
    kind = F.when(F.col("bill_kind") == "1-URGENT", V.MEMBER_KIND).when(F.col("bill_kind") == "2-HIGH", V.GOVERNMENT_KIND)
    return rounded(lite_summary(bills(spark, d).withColumns({"age": F.col("term"), "ppsr_kind": kind})))


@query(f"WITH {LIFE}, {SCORES}, x AS (SELECT abs(aligned - 5) AS extremism, enacted, days_to_proc FROM life JOIN scores ON scores.member = life.sponsor AND scores.term = life.term), e AS (SELECT list_distinct(list_transform(range(0, 11), lambda i: CASE i " + " ".join(f"WHEN {i} THEN q[{i + 1}]" for i in range(11)) + " END)) AS edges FROM (SELECT quantile_cont(extremism, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM x)) SELECT greatest(len(list_filter(edges, lambda v: v < extremism)) - 1, 0)::INT AS bin, count(*) AS n, round(avg(extremism), 6) AS mean_extremism, round(avg(enacted), 6) AS enacted_rate, round(median(days_to_proc), 6) AS median_days FROM x, e GROUP BY ALL")
def sponsor_extremism(spark, d):
    """Bills with their sponsor's score of the same term, by how far it is from the middle."""
    points = scores(spark, d).select(F.col("member").alias("sponsor"), "term", F.abs(F.col("aligned") - 5).alias("extremism"))
    rows = lifecycle(spark, d).join(points, ["sponsor", "term"])
    rows = stats.quantile_bins(kept(rows.select("extremism", "enacted", "days_to_proc"), "extremism"), "extremism", 10)  # read thrice
    out = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("extremism").alias("mean_extremism"), F.avg("enacted").alias("enacted_rate"))
    return rounded(stats.with_median(out, rows, ["bin"], "days_to_proc", "median_days"))


@query(f"WITH {BILLS} SELECT count(*) AS led, sum(enacted)::BIGINT AS enacted, (sum(passed) - sum(enacted))::BIGINT AS reflected, sponsor::VARCHAR AS mona_cd, round(100.0::DOUBLE * sum(enacted) / count(*), 6) AS enacted_rate FROM bills WHERE sponsor = 37 GROUP BY sponsor")
def legislator_record(spark, d):
    """The record of the profile's plan, of the sponsor with this name."""
    from legispark.plans.votes import legislator_profile

    code = F.col("sponsor").cast("string")
    t = lifecycle(spark, d).withColumns({"rst_proposer": F.concat(F.lit("M"), code), "rst_mona_cd": code, "age": F.col("term"), "proc_dt": F.col("s7")})
    points = scores(spark, d).withColumn("member_id", F.col("member").cast("string"))
    people_ = committee(spark, d).select(F.col("sponsor").cast("string").alias("mona_cd"), F.concat(F.lit("M"), F.col("sponsor").cast("string")).alias("member_name"), F.lit(1).alias("age"))
    return rounded(legislator_profile(t, points, people_, "M37")["record"].select("led", "enacted", "reflected", "mona_cd", "enacted_rate"))


@query("SELECT 'lineitem' AS table_name, 'rows' AS \"check\", NULL::VARCHAR AS column_name, count(*) AS n, 1.0::DOUBLE AS share, CASE WHEN abs(count(*) - 60000) < 6000 THEN 'OK' ELSE 'CHECK' END AS verdict FROM lineitem UNION ALL SELECT 'lineitem', 'key repeats', 'l_orderkey', count(*) - count(DISTINCT l_orderkey), round((count(*) - count(DISTINCT l_orderkey)) / count(*), 6), 'CHECK' FROM lineitem UNION ALL SELECT 'orders', 'rows', NULL, count(*), 1.0, 'OK' FROM orders")
def validation(spark, d):
    lines, orders = read(spark, d, "lineitem"), read(spark, d, "orders")
    both = [checks.validate({"lineitem": lines}, {"lineitem": 60_000}, "L_ORDERKEY"), checks.validate({"orders": orders}, {}, "o_orderkey")]
    return rounded(both[0].unionByName(both[1]))
