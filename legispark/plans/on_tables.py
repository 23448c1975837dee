"""Queries of the integration steps: joins, unions, repeated rows, feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from legispark.operators import people, tables
from legispark.plans.bindings import BILLS, STAGES, bills, query, read, rounded, stages
from legispark.sources.scan import flatten_envelope


@query("SELECT DISTINCT o_custkey AS key, NULL AS name, 'sponsor' AS segment FROM orders UNION ALL SELECT c_custkey, c_name, NULL FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def antijoin_append(spark, d):
    base = read(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.lit("sponsor").alias("segment")).distinct()
    extra = read(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return tables.append_missing(base, extra, "key")


OUTCOME = "CASE WHEN result IS NOT NULL THEN result WHEN term IN (1995, 1996) THEN 'expired' ELSE 'pending' END"


@query(f"WITH {BILLS}, {STAGES}, r AS (SELECT bill_id, nullif(status, 'O') AS result, term FROM bills) SELECT bill_id, term, {OUTCOME} AS status, coalesce({OUTCOME} IN ('F', 'P'), false)::INT AS passed, ({OUTCOME} = 'F')::INT AS enacted, s1 AS committee_dt, s7 AS proc_dt, date_diff('day', ppsl_dt, s7)::INT AS days_to_proc FROM r JOIN bills USING (bill_id, term) LEFT JOIN stages USING (bill_id)")
def master_left_joins(spark, d):
    base = bills(spark, d).select("bill_id", "term", "ppsl_dt", F.nullif("status", F.lit("O")).alias("result"))
    out = tables.left_enrich(base, stages(spark, d), "bill_id", {"s1": "committee_dt", "s7": "proc_dt"})
    out = tables.derive_outcome(out, "result", "term", ["F", "P"], ["F"], "pending", "expired", [1995, 1996])
    return out.select("bill_id", "term", "status", "passed", "enacted", "committee_dt", "proc_dt", F.datediff("proc_dt", "ppsl_dt").alias("days_to_proc"))


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END, m) AS kind FROM orders LEFT JOIN (SELECT l_orderkey, max_by(l_returnflag || l_linestatus, (l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_linestatus)) AS m FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey")
def lookup_fill(spark, d):
    base = read(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("kind"))
    right = read(spark, d, "lineitem").withColumns({"o_orderkey": F.col("l_orderkey"), "m": F.concat("l_returnflag", "l_linestatus")})
    last = [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus")]
    return tables.fill_from(base, right, "o_orderkey", "kind", "m", last)


@query("SELECT lang, count(*) AS total, count(l.doc_id) AS covered, round(count(l.doc_id) / count(*), 6) AS share FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY lang")
def semi_join_coverage(spark, d):
    return rounded(tables.coverage(read(spark, d, "documents"), read(spark, d, "labels"), "doc_id", ["lang"]))


KEYS = {"orders": "o_custkey", "events": "user_id", "supplier": "s_suppkey"}


@query("SELECT key, " + ", ".join(f"bool_or(s = '{t}') AS in_{t}" for t in KEYS) + " FROM (" + " UNION ALL ".join(f"SELECT {c}::BIGINT AS key, '{t}' AS s FROM {t}" for t, c in KEYS.items()) + ") GROUP BY key")
def membership_flags(spark, d):
    return tables.flag_membership({t: read(spark, d, t).select(F.col(c).cast("long").alias("key")) for t, c in KEYS.items()}, "key")


@query("SELECT s AS source, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM (" + " UNION ".join(f"SELECT {c}::BIGINT AS key FROM {t}" for t, c in KEYS.items()) + ")), 6)::DOUBLE AS percent FROM (" + " UNION ".join(f"SELECT {c}::BIGINT AS key, '{t}' AS s FROM {t}" for t, c in KEYS.items()) + ") GROUP BY s")
def source_coverage(spark, d):
    from legispark.plans.votes import id_mapping

    sources = {t: read(spark, d, t).select(F.col(c).cast("long").alias("key"), F.col(c).cast("string").alias("name")) for t, c in KEYS.items()}
    return rounded(id_mapping(sources, "key", "name")["coverage"].select("source", "n", "percent"))


@query("WITH a AS (SELECT DISTINCT year(o_orderdate) AS term, o_orderdate::DATE AS dt FROM orders), b AS (SELECT DISTINCT year(l_shipdate) AS term, l_shipdate::DATE AS dt FROM lineitem WHERE l_returnflag = 'R') SELECT term::INT AS term, count(a.dt) AS n_left, count(b.dt) AS n_right, count(*) FILTER (a.dt IS NOT NULL AND b.dt IS NOT NULL) AS n_both FROM a FULL JOIN b USING (term, dt) GROUP BY term")
def date_overlap(spark, d):
    a = read(spark, d, "orders").select(F.year("o_orderdate").alias("term"), F.to_date("o_orderdate").alias("dt"))
    b = read(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.year("l_shipdate").alias("term"), F.to_date("l_shipdate").alias("dt"))
    return tables.date_overlap(a, b, "term", "dt")


@query("SELECT c_custkey AS code, c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS event, 'customer' AS source FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, NULL, 'supplier' FROM supplier UNION ALL SELECT user_id, NULL, NULL, event_id, 'events' FROM events")
def union_align(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("source"))
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"), F.lit("supplier").alias("source"))
    e = read(spark, d, "events").select(F.col("user_id").alias("code"), F.col("event_id").alias("event"), F.lit("events").alias("source"))
    return tables.align_union(c, s, e, cols=["code", "name", "segment", "event", "source"])


@query("WITH x AS (SELECT DISTINCT 0 AS r, 'orders' AS source, o_custkey AS id FROM orders UNION ALL SELECT DISTINCT 1, 'events', user_id FROM events UNION ALL SELECT DISTINCT 2, 'customer', c_custkey FROM customer) SELECT source, count(*) AS n_ids, count(*) FILTER (r = m) AS n_new FROM x JOIN (SELECT id, min(r) AS m FROM x GROUP BY id) USING (id) GROUP BY source")
def id_union_new_counts(spark, d):
    ids = lambda t, c: read(spark, d, t).select(F.col(c).alias("id"))
    return tables.new_ids([("orders", ids("orders", "o_custkey")), ("events", ids("events", "user_id")), ("customer", ids("customer", "c_custkey"))], "id")


@query("SELECT code, min_by(name, r) AS name FROM (SELECT 0 AS r, s_suppkey AS code, s_name AS name FROM supplier UNION ALL SELECT 1, c_custkey, c_name FROM customer) GROUP BY code")
def first_known_names(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"))
    return tables.first_name([("supplier", s), ("customer", c)], "code", "name")


@query("SELECT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def remaining_keys(spark, d):
    return tables.remaining(read(spark, d, "orders").select("o_custkey"), read(spark, d, "events").select(F.col("user_id").alias("o_custkey")), "o_custkey")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' ELSE 'Other' END AS kind, coalesce(CASE o_orderstatus WHEN 'F' THEN 'final' END, o_orderstatus) AS status FROM orders")
def recode_values(spark, d):
    t = read(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("status"))
    return tables.recode(tables.recode(t, "kind", {"1-URGENT": "urgent", "2-HIGH": "high"}, default="Other"), "status", {"F": "final"})


@query("WITH o AS (SELECT o_custkey, year(o_orderdate) AS y, min(o_orderpriority) AS p, max(o_orderstatus) AS s FROM orders GROUP BY ALL), l AS (SELECT o_custkey AS member, list(y ORDER BY y) AS terms, list(p ORDER BY y) AS parties, list(s ORDER BY y) AS states FROM o GROUP BY o_custkey) SELECT member, t::VARCHAR AS term_label, parties[i] AS party, CASE WHEN len(states) = 1 THEN states[1] ELSE states[least(i, 2)] END AS state FROM (SELECT *, unnest(terms) AS t, unnest(range(1, len(terms) + 1)) AS i FROM l)")
def member_history_split(spark, d):
    per = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("member"), F.year("o_orderdate").alias("y")).agg(F.min("o_orderpriority").alias("p"), F.max("o_orderstatus").alias("s"))
    rows = per.groupBy("member").agg(F.array_sort(F.collect_list(F.struct("y", "p", "s"))).alias("r"))
    texts = rows.select("member", F.array_join(F.col("r.y").cast("array<string>"), ", ").alias("terms"), F.array_join("r.p", "/").alias("parties"), F.array_join(F.slice("r.s", 1, 2), "/").alias("states"))
    return people.member_history(texts, "terms", {"party": "parties", "state": "states"}).select("member", "term_label", "party", "state")


@query("SELECT event_id, event_type AS kind, (user_id)::VARCHAR AS user, json_extract_string(props, '$.k') AS k FROM events WHERE event_id % 11 <> 0")
def envelope_flatten(spark, d):
    """Pages of an API are made of the events, with a failure code for every eleventh, and flattened back."""
    e = read(spark, d, "events")
    body = F.format_string('{"FEED":[{"head":[{"list_total_count":1},{"RESULT":{"CODE":"%s","MESSAGE":"m"}}]},{"row":[{"KIND":"%s","USER":"%s","PROPS":%s}]}]}', F.when(F.col("event_id") % 11 == 0, "INFO-200").otherwise("INFO-000"), F.col("event_type"), F.col("user_id").cast("string"), F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"))))
    rows = flatten_envelope(e.select("event_id", body.alias("body")), "body", "FEED", ["event_id"], ["KIND", "USER", "PROPS"])
    return rows.select("event_id", F.col("KIND").alias("kind"), F.col("USER").alias("user"), F.get_json_object("PROPS", "$.k").alias("k"))


@query("SELECT event_id, coalesce(try_cast(substr(s, 1, 10) AS DATE), NULL) AS day FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS s FROM events)")
def safe_dates(spark, d):
    from legispark.functions.scalar import safe_date

    k = F.col("event_id") % 4
    text = F.when(k == 0, "0").when(k == 1, "").when(k == 2, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyyMMdd"))
    return read(spark, d, "events").select("event_id", safe_date(text).alias("day"))
