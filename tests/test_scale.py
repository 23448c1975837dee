"""What has to hold at any size: ranks, percentiles, saved tables, lookups, scaling of all terms, single passes."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from legispark.functions import vocabulary as V
from legispark.operators import ranks, rollcall, stats, tables, textvotes
from legispark.plans import votes as P
from legispark.sources import scan, sinks
from legispark.sources.kept import kept


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def many(spark):
    """Several range partitions, whatever the size."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def measured(seed=1, n=3000):
    """Groups of all sizes: one of two thirds, one of one row, a null one; ties and nulls among the values."""
    rng = random.Random(seed)
    out = [("hot", float(rng.randrange(400)) / 4) for _ in range(2 * n // 3)] + [("one", 1.5), (None, 2.0), (None, None), ("none", None)]
    return out + [(rng.choice("abc"), rng.gauss(0, 1)) for _ in range(n // 3)]


# ranks and percentiles


def test_numbers_along_a_total_order(many):
    values = list(range(5000))
    random.Random(2).shuffle(values)
    got = rows(ranks.numbered(many.createDataFrame([(v,) for v in values], "v int"), [F.desc("v")]))
    assert sorted(got) == [(v, 5000 - v) for v in range(5000)]
    assert rows(ranks.numbered(many.createDataFrame([], "v int"), ["v"])) == []


def test_running_sums(many):
    t = [(g, i, s) for g in ("a", "b", None) for i, s in enumerate([3, None, 0, 5, 2])]
    got = {(g, i): b for g, i, s, b in rows(ranks.running(many.createDataFrame(t, "g string, i int, s int"), ["g"], ["i"], "s"))}
    assert got == {(g, i): sum(x or 0 for g2, j, x in t if g2 == g and j < i) for g, i, _ in t}


@pytest.mark.parametrize("ascending", [True, False])
def test_ranks_have_no_window_over_a_group(many, ascending):
    data = measured()
    got = rows(stats.rank_avg_trunc(many.createDataFrame(data, "g string, v double"), ["g"], "v", ascending))
    for g, v, rank, size in got:
        own = sorted((x for h, x in data if h == g and x is not None), reverse=not ascending)
        assert size == len(own)
        places = [i + 1 for i, x in enumerate(own) if x == v]
        assert rank == (int(sum(places) / len(places)) if places else None)
    assert len(got) == len(data)


@pytest.mark.parametrize("by", [["g"], []])
def test_exact_percentiles(many, by):
    data, probs = measured(3), [0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1]
    got = ranks.distribution(many.createDataFrame(data, "g string, v double"), by, "v", probs).collect()
    groups = {g for g, v in data if v is not None} if by else {"all"}
    assert len(got) == len(groups)
    for r in got:
        own = [v for g, v in data if v is not None and (not by or g == r["g"])]
        assert r["n"] == len(own) and r["least"] == min(own) and r["greatest"] == max(own)
        assert np.allclose(r["percentiles"], np.quantile(own, probs)) and r["mean"] == pytest.approx(np.mean(own))
        assert r["sd"] == (pytest.approx(np.std(own, ddof=1)) if len(own) > 1 else None)


def test_percentiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, v int")
    assert rows(stats.duration_stats(none, ["g"], "v")) == []
    assert rows(stats.duration_stats(none, [], "v")) == [(0, None, None, None, None, None, None)]
    assert rows(stats.quantile_bins(spark.createDataFrame([("a", None)], "g string, v int"), "v")) == [("a", None, None)]


# repeated rows


def test_keep_first_is_an_aggregate(spark):
    rng = random.Random(4)
    data = [(rng.randrange(20), rng.choice([None, "x", "y", "z"]), rng.choice([None, 1, 2, 3]), i) for i in range(600)]
    t = spark.createDataFrame(data, "k int, s string, n int, i int")
    orders = [["n", "i"], [F.col("s").asc_nulls_last(), F.col("n").asc_nulls_last(), "i"], [F.desc("s"), F.desc("n"), F.desc("i")], [F.col("s").desc_nulls_first(), F.desc("i")], [F.when(F.col("s") == "x", 0).otherwise(1), "i"], [F.desc("s"), "i"]]
    for order in orders:
        got = tables.keep_first(t, ["k"], order)
        steps = plan(got)
        w = rows(t.withColumn("_n", F.row_number().over(Window.partitionBy("k").orderBy(*order))).where("_n = 1").drop("_n"))
        assert sorted(rows(got), key=str) == sorted(w, key=str)
        mixed = order is orders[-1]
        assert ("Window" in steps) == mixed and steps.count("Exchange") == 1
    assert sorted(rows(tables.keep_first(spark.createDataFrame([(1, "a.b", 1), (1, "c", 0)], "k int, `s.t` string, o int"), ["k"], ["o"]))) == [(1, "c", 0)]


# saved tables


def test_writing_a_term_leaves_the_others(spark, tmp_path):
    root = str(tmp_path)
    bill = lambda i, age: (i, age)
    write = lambda data, **how: sinks.write_table(scan.conformed(spark.createDataFrame(data, "bill_id string, age int"), scan.SCHEMAS["bills"]), root, "bills", **how)
    write([bill("a", 21), bill("b", 22)])
    write([bill("c", 22)])
    assert sorted(rows(scan.scan(spark, root, "bills", columns=["bill_id", "age"]))) == [("a", 21), ("c", 22)]
    write([bill("d", 20)], mode="append")
    assert scan.scan(spark, root, "bills").count() == 3
    write([bill("e", 19)], whole=True)
    assert rows(scan.scan(spark, root, "bills", columns=["bill_id", "age"])) == [("e", 19)]


def test_scans_open_no_file_to_plan(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_table(scan.conformed(spark.createDataFrame([("1", 21), ("2", 22)], "bill_id string, age int"), scan.SCHEMAS["bills"]), root, "bills")
    spark.createDataFrame([("3", 20.0)], "BILL_ID string, passed double").write.parquet(f"{root}/other/bills/age=23")
    sc, seen = spark.sparkContext, spark.sparkContext.statusTracker()
    sc.setJobGroup("planning", "")
    df = scan.scan(spark, root, "bills", [22])
    sc.setJobGroup("reading", "")
    assert not seen.getJobIdsForGroup("planning") and [r["bill_id"] for r in df.collect()] == ["2"]
    other = scan.scan(spark, f"{root}/other", "bills", foreign=True)
    assert rows(other.select("bill_id", "age", "passed", "status")) == [("3", 23, 20, None)]
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bills = sinks.bucketed(spark.range(500).select(F.col("id").cast("string").alias("bill_id"), (F.col("id") % 7).alias("age")), "bucketed_bills", ["bill_id"], 4, f"{tmp_path}/bills")
        detail = sinks.bucketed(spark.range(0, 500, 2).select(F.col("id").cast("string").alias("bill_id"), F.col("id").alias("law_proc_dt"), F.lit(1).alias("o")), "bucketed_details", ["bill_id"], 4, f"{tmp_path}/details")
        for order in (None, ["o"]):
            out = tables.left_enrich(bills, detail, "bill_id", {"law_proc_dt": "dt"}, order=order)
            assert "Exchange" not in plan(out) and out.where("dt is not null").count() == 250
        assert "Exchange" not in plan(tables.append_missing(bills, detail, "bill_id")) and tables.append_missing(bills, detail, "bill_id").count() == 500
        assert spark.sql("SELECT count(*) FROM bucketed_bills JOIN bucketed_details USING (bill_id)").first()[0] == 250
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("bucketed_bills", "bucketed_details"):
            sinks.dropped(spark, name)


def scanned(df):
    """Rows that the scans handed on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_skip_row_groups(spark, tmp_path):
    bills = spark.range(40_000).select(F.concat(F.lit("PRC_"), F.md5(F.col("id").cast("string"))).alias("bill_id"), F.format_string("%07d", F.col("id") * 7919 % 40_000).alias("bill_no"), F.lit(22).alias("age"))
    conf, before = spark.sparkContext._jsc.hadoopConfiguration(), None
    before = conf.get("parquet.block.size")
    conf.set("parquet.block.size", str(64 << 10))
    try:
        sinks.write_table(scan.conformed(bills, scan.SCHEMAS["bills"]), str(tmp_path), "bills")
    finally:
        conf.set("parquet.block.size", before or str(128 << 20))
    t = scan.scan(spark, str(tmp_path), "bills", columns=["bill_id", "bill_no"])
    some = t.where(F.col("bill_no") == "0012345")
    assert some.count() == 1 and scanned(t.where(F.col("bill_no") == "0012345")) < 10_000  # by the order of bill_no
    wanted = t.where(F.col("bill_no") == "0012345").first()["bill_id"]
    found = t.where(F.col("bill_id") == wanted)
    assert [r["bill_no"] for r in found.collect()] == ["0012345"] and scanned(t.where(F.col("bill_id") == wanted)) < 10_000  # by Bloom filters
    assert scanned(t.where(F.col("bill_id") == "PRC_none")) == 0 and scanned(t) == 40_000


def test_counts_while_writing(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 1)], "k int, v string, o int")
    got = sinks.write_observed({"one": t, "two": t.limit(0)}, str(tmp_path))
    assert rows(got) == [("one", 3, 3, ["k", "v", "o"]), ("two", 0, 3, ["k", "v", "o"])]
    assert spark.read.parquet(f"{tmp_path}/one").count() == 3
    assert rows(sinks.write_deduplicated(t, ["k"], ["o"], f"{tmp_path}/first")) == [(3, 2, 1)]
    assert sorted(rows(spark.read.parquet(f"{tmp_path}/first"))) == [(1, "b", 1), (2, "c", 1)]


# sketches


def test_sketches_merge_within_their_error(spark):
    t = spark.range(60_000).select((F.col("id") % 3).alias("term"), (F.col("id") % 25_000).cast("string").alias("title"))
    sketches = kept(stats.distinct_sketches(t.where("term < 2"), ["term"], "title"))
    both = sketches.unionByName(stats.distinct_sketches(t.where("term = 2"), ["term"], "title"))
    exact = {r[0]: r[1] for r in t.groupBy("term").agg(F.countDistinct("title")).collect()}
    bound = 4 * stats.sketch_error()
    for term, n in rows(stats.distinct_estimates(both, ["term"])):
        assert abs(n - exact[term]) <= bound * exact[term]
    (n,) = rows(stats.distinct_estimates(both, []))[0]
    assert abs(n - 25_000) <= bound * 25_000
    a, b = spark.range(20_000).select(F.col("id").cast("string").alias("k")), spark.range(10_000, 40_000).select(F.col("id").cast("string").alias("k"))
    got = {s: (n, new) for s, n, new in rows(stats.new_id_estimates([("a", a), ("b", b)], "k"))}
    want = {s: (n, new) for s, n, new in rows(tables.new_ids([("a", a), ("b", b)], "k"))}
    assert all(abs(x - y) <= bound * 40_000 for s in want for x, y in zip(got[s], want[s], strict=True))


# roll calls


def leading(cells, members):
    """The leading left singular vector of the item-centred votes, missing ones 0, each member's sum divided by their votes."""
    items = sorted({i for _, i, _ in cells})
    v, seen = np.zeros((len(members), len(items))), np.zeros((len(members), len(items)))
    for m, i, y in cells:
        v[members.index(m), items.index(i)], seen[members.index(m), items.index(i)] = 2 * y - 1, 1
    v = (v - (v * seen).sum(0) / np.maximum(1, seen.sum(0))) * seen
    both = (v / seen.sum(1)[:, None]) @ (v / np.maximum(1, seen.sum(0))).T
    s = np.random.default_rng(0).normal(size=len(members))
    for _ in range(500):
        s = both @ s
        s = (s - s.mean()) / s.std()
    return s


def test_all_terms_are_scaled_at_once(spark):
    rng, place, cells = random.Random(7), {}, []
    for term in (20, 21, 22):
        for m in range(40):
            place[term, f"m{m}"] = rng.uniform(-1, 1)
        for item in range(30 + 30 * (term - 20)):
            cut, way = rng.uniform(-0.7, 0.7), rng.choice([-1, 1])
            cells += [(term, f"m{m}", f"{term}_{item}", int(way * (place[term, f"m{m}"] - cut) + rng.gauss(0, 0.3) > 0)) for m in range(40) if rng.random() < 0.9]
    t = spark.createDataFrame([*cells, (23, "x", "23_1", 1), (23, "y", "23_1", 1), (22, None, "22_1", 1), (22, "m1", "22_2", None)], "term int, m string, item string, yes int")
    got = rollcall.scale_terms(t, "term", "m", "item", "yes", tol=1e-9, most_rounds=100).collect()
    for term in (20, 21, 22):
        own = {r["m"]: r["score"] for r in got if r["term"] == term}
        members = sorted(own)
        want = leading([(m, i, y) for g, m, i, y in cells if g == term], members)
        score = np.array([own[m] for m in members])
        assert abs(np.corrcoef(score, want)[0, 1]) > 0.99999 and abs(score.mean()) < 1e-9 and score.std() == pytest.approx(1)
        assert abs(np.corrcoef(score, [place[term, m] for m in members])[0, 1]) > 0.9
        rounds = {r["rounds"] for r in got if r["term"] == term}
        assert len(rounds) == 1 and 3 <= rounds.pop() < 100
        votes = {m: sum(g == term and w == m for g, w, _, _ in cells) for m in members}
        first = min(members, key=lambda m: (-votes[m], m))
        assert own[first] > 0
    assert {(r["m"], r["score"]) for r in got if r["term"] == 23} == {("x", 0.0), ("y", 0.0)}
    few = rollcall.scale_terms(t, "term", "m", "item", "yes", tol=1e-9, most_rounds=2).where("term < 23")
    assert few.where("rounds is not null").count() == 0 and few.count() == 120
    assert spark.catalog.listTables() == [] or not [x for x in spark.catalog.listTables() if x.name.startswith("cells_")]


def test_cells_are_prepared_in_one_pass(spark, tmp_path):
    """The votes are read once, and shuffled once by item and once by member."""
    rng = random.Random(11)
    data = [(rng.choice(["a", "b", None]), rng.choice([*range(12), None]), rng.choice([*range(40), None]), rng.choice([0, 1, 1, 1, None])) for _ in range(1500)]
    spark.createDataFrame(data, "term string, m int, item int, yes int").write.parquet(f"{tmp_path}/cells")
    got = rollcall.prepared(spark.read.parquet(f"{tmp_path}/cells"), "m", "item", "yes", 0.2, 15, ["term"])
    assert plan(got).count("FileScan") == 1 and plan(got).count("Exchange hashpartitioning") == 2
    own = {i: [y for _, _, j, y in data if j == i and y is not None] for i in range(40)}
    cells = [r for r in data if r[2] is not None and min(x := sum(own[r[2]]) / len(own[r[2]]), 1 - x) >= 0.2]
    votes = Counter((t, m) for t, m, _, y in cells if y is not None)
    assert Counter(rows(got)) == Counter(r for r in cells if None not in r[:2] and votes[r[:2]] >= 15)
    assert 0 < got.count() < len(cells) < len(data)


def test_parts_of_the_scaling_follow_the_cells(spark, monkeypatch):
    """Buckets and shuffles of the rounds have as many parts as 600 cells need, a whole number to each core; the session's settings stay."""
    cells = [(m, i, int((m * 7 + i * 3) % 11 > 4)) for m in range(30) for i in range(20)]
    t = spark.createDataFrame(cells, "m int, item int, yes int")
    want, buckets, given = dict(rows(rollcall.scale_1d(t, "m", "item", "yes", 3))), [], rollcall.bucketed
    monkeypatch.setattr(rollcall, "PART_CELLS", 100)
    monkeypatch.setattr(rollcall, "bucketed", lambda df, name, keys, n, *a, **k: buckets.append((n, df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) or given(df, name, keys, n, *a, **k))
    got = dict(rows(rollcall.scale_1d(t, "m", "item", "yes", 3)))
    assert buckets == [(8, "8")] * 2 and spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert got.keys() == want.keys() and all(abs(got[m] - want[m]) < 1e-9 for m in want)


def test_terms_align_along_chains(spark):
    rng = random.Random(8)
    true = {m: rng.uniform(-1, 1) for m in range(60)}
    line = {20: (2.0, 1.0), 21: (-0.5, 0.3), 22: (1.0, 0.0), 19: (-3.0, 2.0), 10: (5.0, 5.0)}
    sat = {22: range(0, 20), 21: range(15, 35), 20: range(30, 45), 19: range(40, 55), 10: range(55, 60)}
    data = [(f"m{m}", t, (true[m] - line[t][1]) / line[t][0]) for t, own in sat.items() for m in own]
    got = {(r["m"], r["t"]): r["aligned"] for r in rollcall.align_terms(spark.createDataFrame(data, "m string, t int, x double"), "m", "t", "x", 22).collect()}
    for m, t, x in data:
        assert got[m, t] == pytest.approx(true[int(m[1:])] if t != 10 else x, abs=1e-6)
    noisy = [(m, t, x + rng.gauss(0, 0.02)) for m, t, x in data if t != 10]
    got = {(r["m"], r["t"]): r["aligned"] for r in rollcall.align_terms(spark.createDataFrame(noisy, "m string, t int, x double"), "m", "t", "x", 22).collect()}
    for t in (19, 20, 21):
        own = [m for m, t_, _ in noisy if t_ == t]
        assert np.corrcoef([got[m, t] for m in own], [true[int(m[1:])] for m in own])[0, 1] > 0.98


def test_ideal_points_along_a_chain(spark):
    """Three terms, of which the last shares no member with the base: one scaling run, all terms on the base's line."""
    rng, place, cells = random.Random(9), {m: random.Random(m).uniform(-1, 1) for m in range(90)}, []
    for term, own in ((20, range(50, 90)), (21, range(25, 65)), (22, range(0, 40))):
        for item in range(90):
            cut, way = rng.uniform(-0.7, 0.7), rng.choice([-1, 1])
            cells += [(term, f"b{item}", f"m{m:02}", V.YES if way * (place[m] - cut) + rng.gauss(0, 0.2) > 0 else V.NO) for m in own]
    got = P.ideal_points(spark.createDataFrame(cells, "term int, bill_id string, member_id string, vote string"), [20, 21, 22], 22).collect()
    assert len({(r["term"], r["member_id"]) for r in got}) == 120 and all(r["rounds"] for r in got)
    both = [np.corrcoef([r["aligned"] for r in got if r["term"] == t], [place[int(r["member_id"][1:])] for r in got if r["term"] == t])[0, 1] for t in (20, 21, 22)]
    assert min(abs(c) for c in both) > 0.95 and len({c > 0 for c in both}) == 1


# texts


def test_texts_are_not_shuffled(spark):
    text = "머리말\n3. 어떤 법률안\n재석 5인 중 찬성 2인\n찬성의원(2인)\n김가나 이다라\n반대의원(1인)\n박마바\n" + "-" * 1600 + "\n4. 다른 법률안\n찬성의원(1인)\n최사아"
    t = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "찬성의원"), (5, text)], "id int, t string")
    out = textvotes.parse_votes(t, ["id"], "t")
    assert "Exchange" not in plan(out)
    got = rows(out.where("id = 1").select("event", "section", "vote", "member_name", "bill_context", "agg_total", "agg_yes"))
    assert [(e, s, m, c, n, y) for e, s, _, m, c, n, y in got] == [(1, 1, "김가나", "어떤 법률안", 5, 2), (1, 1, "이다라", "어떤 법률안", 5, 2), (1, 2, "박마바", "어떤 법률안", 5, 2), (2, 3, "최사아", "다른 법률안", None, None)]
    assert out.groupBy("id").count().count() == 2


def test_a_text_of_many_headers(spark):
    text = "\n".join(f"찬성의원(2인)\n가나{'다' if i % 2 else ''} 라마바" for i in range(3000))
    t = spark.createDataFrame([(1, text)], "id int, t string")
    got = textvotes.sections(t, ["id"], "t", "inline").agg(F.max("section"), F.max("event"), F.max("begin")).first()
    assert tuple(got) == (3000, 1, text.rindex("찬성의원"))
