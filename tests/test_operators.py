"""Operators on hand-made tables: nulls, ties, repeated keys, empty input, and each trap of the data's semantics."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from legispark.functions import scalar as S
from legispark.functions import vocabulary as V
from legispark.operators import checks, models, people, rollcall, stats, tables, textvotes
from legispark.plans import bills as B
from legispark.plans import votes as P
from legispark.sources import scan, sinks
from legispark.streaming import landing


def rows(df):
    return [tuple(r) for r in df.collect()]


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


# scalar functions


def test_safe_date(spark):
    df = spark.createDataFrame([("0",), ("",), (" ",), ("2024-05-30",), ("2024-13-01",), (None,), ("20240530",), ("x",)], "d string")
    day = dt.date(2024, 5, 30)
    assert values(df.select(S.safe_date("d").alias("d")), "d") == [None, None, None, day, None, None, day, None]


def test_text_functions(spark):
    df = spark.createDataFrame([("홍길동의원 등 12인",), ("정부",), ("3인 외",), (None,)], "p string")
    assert values(df.select(S.sponsor_count("p").alias("n")), "n") == [12, None, 3, None]
    one = spark.range(1)
    assert rows(one.select(S.term_label(F.lit(22)), S.term_number(F.lit("제22대")), S.squeezed(F.lit("찬성\n의원")), S.shortened(F.lit("abcdef"), 4), S.padded(F.lit(7), 3), S.padded(F.lit(1234), 3))) == [("제22대", 22, "찬성의원", "abc…", "007", "1234")]
    nums = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 11, 12, 13, 21, 22, 111)], "n int")
    assert values(nums.select(S.ordinal("n").alias("o")), "o") == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "22nd", "111th"]
    ids = spark.createDataFrame([("PRC_1",), ("ARC_2",), ("220",), ("x1",), (None,)], "i string")
    assert values(ids.select(S.id_format("i").alias("f")), "f") == ["PRC", "ARC", "numeric", "other", "other"]


def test_shares_and_codes(spark):
    one = spark.range(1)
    assert rows(one.select(S.share(F.lit(1), F.lit(0)), S.percent(F.lit(1), F.lit(4)))) == [(0.0, 25.0)]
    votes = spark.createDataFrame([("찬성",), ("반대",), ("기권",), ("불참",), (None,)], "v string")
    assert values(votes.select(S.coded("v", V.VOTE_CODES).alias("c")), "c") == [1, 6, 9, None, None]
    assert values(votes.select(S.in_group("v", ["찬성"]).alias("c")), "c") == [1, 0, 0, 0, 0]
    assert values(votes.select(S.matches("v", "찬|반").alias("c")), "c") == [True, True, False, False, False]
    assert values(votes.select(S.recoded("v", {"찬성": "yes"}).alias("c")), "c") == ["yes", "반대", "기권", "불참", None]
    assert values(votes.select(S.recoded("v", {"찬성": "yes"}, "other").alias("c")), "c") == ["yes", "other", "other", "other", "other"]


# joins, unions, repeated rows


def test_keep_first_needs_a_total_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (None, "c", 1), (None, "d", 0)], "k int, v string, o int")
    assert sorted(rows(tables.keep_first(df, ["k"], ["o"])), key=str) == [(1, "a", 1), (None, "d", 0)]


def test_append_and_enrich(spark):
    base = spark.createDataFrame([("1", "x", None), ("2", "y", "old")], "id string, nm string, dt string")
    extra = spark.createDataFrame([("2", "z", 5), ("3", "w", 6)], "id string, nm string, age int")
    assert sorted(rows(tables.append_missing(base, extra, "id").select("id", "nm", "age"))) == [("1", "x", None), ("2", "y", None), ("3", "w", 6)]
    right = spark.createDataFrame([("1", "n1", 2), ("1", "n0", 1), ("2", "n2", 1)], "id string, new string, o int")
    fan = tables.left_enrich(base, right, "id", {"new": "extra"})
    assert fan.count() == 3
    once = tables.left_enrich(base, right, "id", {"new": "dt"}, on_clash="coalesce", order=["o"])
    assert sorted(rows(once.select("id", "dt"))) == [("1", "n0"), ("2", "old")]
    assert sorted(rows(tables.left_enrich(base, right, "id", {"new": "dt"}, order=["o"]).select("id", "dt"))) == [("1", None), ("2", "old")]
    assert sorted(rows(tables.left_enrich(base, right, "id", {"new": "dt"}, on_clash="right", order=["o"]).select("id", "dt"))) == [("1", "n0"), ("2", "n2")]
    assert sorted(rows(tables.fill_from(base, right, "id", "dt", "new", [F.desc("o")]).select("id", "dt"))) == [("1", "n1"), ("2", "old")]


def test_ids_and_flags(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, None), (None, "n")], "id int, name string"), spark.createDataFrame([(2, "y"), (3, "z"), (3, "q")], "id int, name string")
    assert sorted(rows(tables.flag_membership({"a": a, "b": b}, "id"))) == [(1, True, False), (2, True, True), (3, False, True)]
    assert sorted(rows(tables.new_ids([("a", a), ("b", b)], "id"))) == [("a", 2, 2), ("b", 2, 1)]
    assert sorted(rows(tables.first_name([("a", a), ("b", b)], "id", "name"))) == [(1, "x"), (2, "y"), (3, "q")]
    assert sorted(rows(tables.remaining(a, b, "id").select("id")), key=str) == [(1,), (None,)]


def test_outcomes(spark):
    df = spark.createDataFrame([("원안가결", 20), ("대안반영폐기", 20), (None, 20), (None, 22), ("폐기", 20)], "r string, age int")
    got = rows(tables.derive_outcome(df, "r", "age", V.PASSED, V.ENACTED, V.STILL_PENDING, V.EXPIRED, [20]).select("status", "passed", "enacted"))
    assert got == [("원안가결", 1, 1), ("대안반영폐기", 1, 0), ("임기만료폐기", 0, 0), ("계류중", 0, 0), ("폐기", 0, 0)]


# statistics


def test_rates_and_rollup(spark):
    df = spark.createDataFrame([(20, 1, 1.0), (20, 0, None), (21, 1, 2.0), (None, 1, 1.0)], "age int, passed int, d double")
    assert sorted(rows(stats.rate_table(df, ["age"], ["passed"], means=["d"]))) == [(20, 2, 1, 1.0, 0.5), (21, 1, 1, 2.0, 1.0)]
    assert rows(stats.rate_table(df, ["age"], ["passed"], min_n=2))[0][0] == 20
    assert sorted(rows(stats.rollup_counts(df, "age", ["passed"])), key=str) == [(20, 0, 2, 1, 0.5), (21, 0, 1, 1, 1.0), (None, 1, 3, 2, 2 / 3)]
    assert rows(stats.rate_table(df.limit(0), [], ["passed"])) == [(0, 0, 0.0)]


@pytest.mark.parametrize(("times", "kept"), [(3, 10), (4, 6)])
def test_funnel_leaves_out_the_end_of_a_term(spark, times, kept):
    day = dt.date(2024, 5, 29)
    df = spark.createDataFrame([(dt.date(2020, 1, 1), day if i < times else dt.date(2021, 1, 1 + i)) for i in range(10)], "a date, z date")
    got = rows(stats.funnel(df, [("start", ["a"]), ("end", ["z"])], exclude_mode_of="z"))
    assert [r[2] for r in got] == [10, kept]  # a share of just 0.3 isn't enough
    assert got[0][3:] == (1.0, None, None) and got[1][5] == 10 - kept


def test_rank_truncates_means_of_ties(spark):
    df = spark.createDataFrame([(1, x) for x in (1.0, 1.0, 2.0, 3.0, 3.0, 3.0, None)], "t int, x double")
    got = sorted(rows(stats.rank_avg_trunc(df, ["t"], "x").select("x", "rank", "group_size")), key=str)
    assert got == [(1.0, 1, 6), (1.0, 1, 6), (2.0, 3, 6), (3.0, 5, 6), (3.0, 5, 6), (3.0, 5, 6), (None, None, 6)]
    assert max(values(stats.rank_avg_trunc(df.dropna(), ["t"], "x", False), "rank")) == 5


def test_quantile_bins_merge_edges(spark):
    import pandas as pd

    for data in ([1.0] * 30 + [2.0, 3.0, 4.0], [float(i) for i in range(37)], [5.0, 5.0, 5.0]):
        got = values(stats.quantile_bins(spark.createDataFrame([(x,) for x in data], "x double").coalesce(1), "x"), "bin")
        want = pd.qcut(data, 10, labels=False, duplicates="drop")
        assert got == [0 if math.isnan(w) else int(w) for w in want]


def test_months_with_and_without_gaps(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5),), (dt.date(2020, 3, 9),), (None,)], "d date")
    assert [r[1] for r in sorted(rows(stats.period_counts(df, "d", "month")))] == [1, 1]
    assert [r[1] for r in sorted(rows(stats.period_counts(df, "d", "month", fill=True)))] == [1, 0, 1]


def test_pivot_profile_shift(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, None)], "t int, s string")
    assert sorted(rows(stats.pivot_counts(df, ["t"], "s", ["a", "b", "c"]))) == [(1, 1, 1, 0), (2, 1, 0, 0)]
    assert sorted(rows(stats.pivot_counts(df, ["t"], "s", ["a", "b"], normalise=True))) == [(1, 0.5, 0.5), (2, 1.0, 0.0)]
    assert sorted(rows(stats.coverage_profile(df, ["t", "s"]))) == [(4, "s", 3, 75.0), (4, "t", 4, 100.0)]
    scores = spark.createDataFrame([("m", 1, 0.0), ("m", 2, 0.5), ("n", 1, 1.0)], "m string, t int, x double")
    assert rows(stats.shift_summary(scores, "m", "t", "x")) == [(2, 1, 0.5, 0.5)]


# roll calls


def test_contested_and_active(spark):
    cells = [(f"m{i}", "all", 1) for i in range(40)] + [(f"m{i}", "edge", int(i > 0)) for i in range(40)] + [(f"m{i}", "none", None) for i in range(40)]
    df = spark.createDataFrame(cells, "m string, item string, yes int")
    got = {r[0]: r[-1] for r in rows(rollcall.contested(df, "item", "yes"))}
    assert got == {"all": False, "edge": True, "none": False}  # one in forty is 2.5 %
    many = spark.createDataFrame([("a", i, 1) for i in range(20)] + [("b", i, 1) for i in range(19)], "m string, item int, yes int")
    assert rows(rollcall.active(many, "m", "yes")) == [("a", 20)]


def test_bridging_members(spark):
    df = spark.createDataFrame([("one", 20), ("one", 20), ("two", 21), ("two", 20), ("none", None), (None, 20), (None, 21)], "m string, term int")
    assert sorted(rows(rollcall.bridging(df, "m", "term"))) == [("one", [20], 1, False), ("two", [20, 21], 2, True)]
    assert rows(rollcall.bridging(df.limit(0), "m", "term")) == []


def test_scaling_recovers_planted_positions(spark):
    rng = random.Random(3)
    place = {m: rng.uniform(-1, 1) for m in range(50)}
    cells = []
    for item in range(150):
        cut, way = rng.uniform(-0.7, 0.7), rng.choice([-1, 1])
        cells += [(m, item, int(way * (x - cut) + rng.gauss(0, 0.2) > 0)) for m, x in place.items()]
    df = spark.createDataFrame(cells, "m int, item int, yes int")
    right = max(place, key=place.get)
    got = dict(rows(rollcall.scale_1d(df, "m", "item", "yes", 5, spark.createDataFrame([(right,)], "m int"))))
    order = sorted(got, key=got.get)
    want = sorted(place, key=place.get)
    d = sum((order.index(m) - want.index(m)) ** 2 for m in place)
    assert 1 - 6 * d / (50 * (50**2 - 1)) > 0.95


def test_alignment(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("b", 1, 1.0), ("c", 1, 2.0), ("a", 2, 1.0), ("b", 2, -1.0), ("d", 3, 9.0)], "m string, t int, x double")
    got = {(r[0], r[1]): r[3] for r in rows(rollcall.align_terms(df, "m", "t", "x", 1).select("m", "t", "x", "aligned"))}
    assert got["a", 2] == pytest.approx(0.0) and got["b", 2] == pytest.approx(1.0) and got["c", 1] == pytest.approx(2.0) and got["d", 3] == 9.0


# texts


def test_inline_votes(spark):
    gap = lambda n: "가" * n
    first = "1. 예산안\n2. 도로법 일부개정법률안\n재석 5인 중 찬성 3인\n찬성의원(3인)\n홍길동 김철수 이영희\n반대의원(1인)\n박민수\n투표의원(2인)\n최고수\n"
    text = first + "." * 1500 + "\n찬성의원 (1인)\n남궁민\n" + "." * 2100 + "정약용"
    df = spark.createDataFrame([(1, text), (2, None), (3, "no votes"), (4, gap(3))], "id int, t string")
    got = sorted(rows(textvotes.parse_votes(df, ["id"], "t", "inline", noise=["이영희"]).select("id", "event", "vote", "member_name", "bill_context", "agg_total", "agg_yes")))
    about = ("도로법 일부개정법률안", 5, 3)
    assert got == [(1, 1, "반대", "박민수", *about), (1, 1, "찬성", "김철수", *about), (1, 1, "찬성", "홍길동", *about), (1, 2, "찬성", "남궁민", None, None, None)]


def test_sections_offsets_and_gaps(spark):
    import re

    for distance, events in ((1499, 1), (1500, 2)):
        head = "찬성의원(1인)"
        text = "x" * 10 + head + "y" * (distance - len(head)) + "반대의원(2인)" + "z"
        got = rows(textvotes.sections(spark.createDataFrame([(1, text)], "id int, t string"), ["id"], "t", "inline").select("begin", "event"))
        assert [g[0] for g in sorted(got)] == [m.start() for m in re.finditer("(?:찬성|반대)의원", text)] and max(g[1] for g in got) == events


def test_contexts_of_events(spark):
    far = "1. 먼 동의안\n" + "x" * 500
    near = "\n2. 가까운 동의안\n재석 9인 중 찬성 5인\n"
    text = far + "찬성의원(1인) 김가나\n반대의원(1인) 이다라\n" + "y" * 1500 + near + "찬성의원(1인) 박마바"
    df = spark.createDataFrame([(1, text), (2, "찬성의원(1인) 김가나"), (3, None), (4, "")], "id int, t string")
    got = sorted(rows(textvotes.parse_votes(df, ["id"], "t").select("id", "event", "member_name", "bill_context", "agg_total", "agg_yes")), key=repr)
    second = (1, 2, "박마바", "가까운 동의안", 9, 5)
    assert got == [(1, 1, "김가나", None, None, None), (1, 1, "이다라", None, None, None), second, (2, 1, "김가나", None, None, None)]


def test_appendix_votes(spark):
    names = " ".join(f"가나{c}" for c in "다라마바사아자차카타")
    text = f"3. 세법 일부개정법률안\n찬 성 의 원 （5 인）\n{names}\n기권의원 2인\n하나로 두나로"
    df = spark.createDataFrame([(1, text)], "id int, t string")
    got = rows(textvotes.parse_votes(df, ["id"], "t", "appendix").select("vote", "member_name", "bill_context"))
    assert sum(g[0] == "찬성" for g in got) == 5 and sum(g[0] == "기권" for g in got) == 2 and {g[2] for g in got} == {"3. 세법 일부개정법률안"}
    assert textvotes.mismatches(df, ["id"], "t", "appendix").count() == 0


def test_speeches_number_events_by_meeting(spark):
    rows_ = [("m1", 22, "2024-01-01", 2, "찬성의원(1인)\n홍길동", V.PLENARY), ("m1", 22, "2024-01-01", 5, "찬성의원(1인)\n김철수", V.PLENARY), ("m2", 22, "2024-01-02", 1, "반대의원(1인)\n이영희", V.PLENARY), ("m3", 22, "2024-01-02", 1, "반대의원(1인)\n이영희", "소위")]
    df = spark.createDataFrame(rows_, "meeting_id string, term int, date string, speech_order int, speech_text string, hearing_type string")
    got = sorted(rows(P.parse_speeches(df, "inline", []).select("meeting_id", "vote_event", "member_name")))
    assert got == [("m1", 1, "홍길동"), ("m1", 2, "김철수"), ("m2", 1, "이영희")]


def test_events_without_names_do_not_count(spark):
    """Events are numbered over speeches, by those that have names; a speech's row that lacks its place goes."""
    far = "-" * 1600
    first = f"찬성의원(0인)\n{far}\n반대의원(1인)\n홍길동\n찬성의원(1인)\n김철수{far}\n기권의원(1인)\n이영희"
    rows_ = [("m1", 22, "2024-01-01", 2, first, V.PLENARY), ("m1", 22, "2024-01-01", 7, "찬성의원(1인)\n박민수", V.PLENARY), ("m1", 22, "2024-01-01", None, "찬성의원(1인)\n최유리", V.PLENARY)]
    df = spark.createDataFrame(rows_, "meeting_id string, term int, date string, speech_order int, speech_text string, hearing_type string")
    got = sorted(rows(P.parse_speeches(df, "inline", []).select("vote_event", "member_name")))
    assert got == [(1, "김철수"), (1, "홍길동"), (2, "이영희"), (3, "박민수")]


def test_speeches_are_parsed_once(spark):
    """Neither the numbering of events nor the rows of names parse texts again; votes aren't shuffled."""
    df = spark.createDataFrame([("m1", 22, "2024-01-01", 2, "찬성의원(1인)\n홍길동", V.PLENARY)], "meeting_id string, term int, date string, speech_order int, speech_text string, hearing_type string")
    plan = P.parse_speeches(df, "inline", [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[가-힣]{2,4}") == 1 and plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("style", ["inline", "appendix"])
def test_sections_of_long_texts(spark, style):
    """Thousands of headers, near and far, against a plain search: the time grows with the text."""
    import re

    deal = random.Random(5)
    text = "".join(f"{deal.choice(['찬성의원', '반대의원'])}({i}인)\n가나다" + "x" * deal.choice([0, 5, 1480, 3000]) for i in range(2000))
    found = [m.start() for m in re.finditer(r"(?:찬성|반대)의원\(\d+인\)", text)]
    far = [i == 0 or found[i] - found[i - 1] >= textvotes.GAPS[style] for i in range(len(found))]
    expected = [(i + 1, b, sum(far[: i + 1]), i) for i, b in enumerate(found)]
    df = spark.createDataFrame([(1, text)], "id int, t string")
    assert sorted(rows(textvotes.sections(df, ["id"], "t", style).select("section", "begin", "event", "expected"))) == expected


# people


def test_member_history(spark):
    df = spark.createDataFrame([("a", "제20대, 제21대, 제22대", "x/y", "p"), ("b", "제22대", "", "q/r"), ("c", None, "z", "s")], "m string, terms string, party string, area string")
    got = sorted(rows(people.member_history(df, "terms", {"own_party": "party", "own_area": "area"}).select("m", "term_label", "own_party", "own_area")))
    assert got == [("a", "제20대", "x", "p"), ("a", "제21대", "y", "p"), ("a", "제22대", "y", "p"), ("b", "제22대", "", "q")]
    assert people.member_history(df, "terms", {"own": "party"}, "제22대").count() == 2


def test_edges(spark):
    df = spark.createDataFrame([("a", "b, c,a"), ("a", None), (None, "b"), ("b", "")], "lead string, co string")
    e = people.edges(df, "lead", "co")
    assert sorted(rows(e)) == [("a", "b"), ("a", "c")]
    assert sorted(rows(people.degrees(e))) == [("a", 2, 0), ("b", 0, 1), ("c", 0, 1)]


# models and checks


def test_kaplan_meier(spark):
    df = spark.createDataFrame([("g", 1, 1), ("g", 1, 0), ("g", 2, 1), ("g", 3, 0), ("h", 2, 1), ("h", 2, 1)], "g string, d int, e int")
    got = {(r[0], r[1]): (r[2], r[3], round(r[4], 6)) for r in rows(models.kaplan_meier(df, "g", "d", "e"))}
    assert got == {("g", 1): (4, 1, 0.75), ("g", 2): (2, 1, 0.375), ("h", 2): (2, 2, 0.0)}
    life = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 1, 11)), (dt.date(2020, 1, 1), None), (dt.date(2022, 1, 1), None)], "a date, z date")
    assert sorted(rows(models.survival_rows(life, "a", "z", "2020-01-31").select("event", "duration"))) == [(0, 30), (1, 10)]


def test_fixed_effects_slope(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    g, x = rng.integers(0, 4, 200), rng.normal(size=200)
    y = 2 * x + g + rng.normal(size=200) * (1 + np.abs(x))
    got = rows(models.fe_slope(spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(y, x, g, strict=True)], "y double, x double, g int"), "y", "x", "g"))[0]
    dx, dy = x - np.array([x[g == k].mean() for k in g]), y - np.array([y[g == k].mean() for k in g])
    b = (dx * dy).sum() / (dx * dx).sum()
    assert got[1] == pytest.approx(b) and got[2] == pytest.approx(np.sqrt((dx**2 * (dy - b * dx) ** 2).sum()) / (dx**2).sum())


def test_checks(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b")], "k int, v string")
    assert rows(checks.key_profile(df, ["k"])) == [(3, 1, 1, 1)]
    assert sorted(r[:2] for r in rows(checks.null_profile(df, ["k", "v"]))) == [("k", 1), ("v", 1)]
    got = {r[0]: r[3] for r in rows(checks.expected_counts({"a": df, "b": df, "c": df.limit(0)}, {"a": 3, "b": 5, "c": 1}))}
    assert got == {"a": "OK", "b": "CHECK", "c": "MISSING"}
    assert rows(checks.key_profile(df.limit(0), ["k"])) == [(0, 0, 0, 0)]


# plans


def test_build_master(spark):
    text = lambda data, names: spark.createDataFrame(data, ", ".join(f"{n} string" for n in names.split()))
    members = text([("PRC_1", "1", "가법", "2024-06-01", "원안가결", "2024-08-01", "old")], "BILL_ID BILL_NO BILL_NAME PROPOSE_DT PROC_RESULT PROC_DT LAW_PROC_DT")
    receipts = text([("제22대", "PRC_1", "1", "가법"), ("제22대", "PRC_2", "2", "나법"), ("제21대", "PRC_3", "3", "다법")], "ERACO BILL_ID BILL_NO BILL_NM")
    reviews = text([("제22대", "PRC_1", "법사위", "0"), ("제22대", "PRC_1", "행안위", "2024-07-01")], "ERACO BILL_ID JRCMIT_NM BDG_CMMT_DT")
    votes = text([("PRC_1", "300", "250")], "BILL_ID MEMBER_TCNT YES_TCNT")
    processed = text([("PRC_2", "위원장"), ("PRC_2", "정부")], "BILL_ID PROPOSER_KIND")
    details = text([("PRC_1", "2024-07-15", "2024-07-20"), ("PRC_1", "2024-07-16", "2024-07-20")], "BILL_ID LAW_PROC_DT RGS_RSLN_DT")
    got = {r.bill_id: r for r in B.build_master(22, members, receipts, reviews, votes, processed, details, expired_terms=[21]).collect()}
    assert set(got) == {"PRC_1", "PRC_2"}
    one, two = got["PRC_1"], got["PRC_2"]
    assert (one.days_to_proc, one.enacted, one.vote_yes, one.jrcmit_nm, one.rgs_rsln_dt, one.law_proc_dt) == (61, 1, 250, "법사위", dt.date(2024, 7, 20), None)
    assert (two.status, two.passed, two.ppsr_kind, two.days_to_proc) == ("계류중", 0, "정부", None)
    fan = B.build_master(22, members, receipts, reviews, votes, processed, details, dedup=False)
    assert fan.where("bill_id = 'PRC_1'").count() == 4


def bills(spark):
    df = spark.createDataFrame([("PRC_1", "1", 22, "법률안", "도로법", "2024-06-01", "원안가결", 1, 1, "홍", "c1", 10), ("PRC_2", "2", 22, "법률안", "하천법", "2024-06-01", "계류중", 0, 0, "홍", "c2", None), ("ARC_3", "3", 21, "동의안", "도로 건", None, "폐기", 0, 0, "김", "c3", 5)], "bill_id string, bill_no string, age int, bill_kind string, bill_nm string, d string, status string, passed int, enacted int, rst_proposer string, rst_mona_cd string, days_to_proc int")
    return df.withColumns({"ppsl_dt": F.to_date("d"), "committee_nm": F.lit(None).cast("string"), "proposer_text": F.col("rst_proposer"), "proc_dt": F.to_date("d")})


def test_searches(spark):
    t = bills(spark)
    top, total = B.search_bills(t, keyword="도로")
    assert values(top, "bill_id") == ["PRC_1", "ARC_3"] and rows(total) == [(2,)]
    assert values(B.search_bills(t, age=22, status="enacted")[0], "bill_id") == ["PRC_1"]
    assert values(B.search_bills(t, date_from="2024-06-01", date_to="2024-06-01", limit=1)[0], "bill_id") == ["PRC_1"]
    texts = spark.createDataFrame([("PRC_2", "물을 다스린다")], "bill_id string, propose_reason string")
    assert values(B.search_bill_texts(t, texts, "물")[0], "bill_id") == ["PRC_2"]
    assert values(B.bill_detail(t, texts, "3"), "bill_id") == ["ARC_3"] and values(B.bill_detail(t, texts, "PRC_2"), "propose_reason") == ["물을 다스린다"]
    assert B.export_bills(t, status="rejected").count() == 1 and sorted(rows(B.passage_rates(t).select("age", "n", "enacted_rate"))) == [(22, 2, 0.5)]
    steps = rows(B.timeline(t, "bill_id", [("a", "ppsl_dt"), ("b", "proc_dt")]))
    assert len(steps) == 4 and {s[-1] for s in steps} == {0}


def test_profile(spark):
    points = spark.createDataFrame([("c1", 22, 0.5), ("c2", 22, 0.1)], "member_id string, term int, aligned double")
    members = spark.createDataFrame([("c1", "홍", 22)], "mona_cd string, member_name string, age int")
    got = P.legislator_profile(bills(spark), points, members, "홍")
    r = got["record"].first()
    assert (r.led, r.enacted, r.reflected, r.mona_cd, r.enacted_rate) == (2, 1, 0, "c1", 50.0)
    assert values(got["ranks"], "rank") == [2] and values(got["top"], "bill_id") == ["PRC_1"] and got["person"].count() == 1


def test_consolidate(spark):
    api = spark.createDataFrame([(22, "b1", "김철수", "c1", "찬성", "2024-01-01 10:00"), (22, "b1", "김철수", "c2", "반대", "2024-01-01 10:00"), (22, "b1", "김철수", "c1", "찬성", "2024-01-02")], "AGE int, BILL_ID string, HG_NM string, MONA_CD string, RESULT_VOTE_MOD string, VOTE_DATE string")
    text = "term int, meeting_id int, date string, member_name string, vote string, vote_event int"
    inline = spark.createDataFrame([(22, 7, "2024-01-01", "이영희", "찬성\n의원", 1), (22, 7, "2024-01-01", "박민수", "기권", None)], text)
    appendix = spark.createDataFrame([(22, 7, "2024-01-01", "이영희", "반대의원", 1)], text)
    got = sorted(rows(P.consolidate(api, inline, appendix).select("source", "member_name", "member_id", "vote", "vote_event")), key=str)
    assert got == [("api", "김철수", "c1", "찬성", None), ("api", "김철수", "c2", "반대", None), ("appendix", "이영희", None, "반대", 1), ("inline", "박민수", None, "기권", None)]
    assert P.consolidate(api, inline, appendix, by_name=True).where("source = 'api'").count() == 1


def test_linkage(spark):
    sponsors = spark.createDataFrame([("PRC_1", "홍", "c1", "p", "대표발의"), ("PRC_1", "김", "c2", "q", "공동발의")], "BILL_ID string, PPSR_NM string, NASS_CD string, PPSR_POLY_NM string, REP_DIV string")
    texts = spark.createDataFrame([("PRC_1", "x")], "bill_id string, propose_reason string")
    got = P.link_bill_texts(bills(spark), texts, sponsors)
    assert sorted(values(got["edges"], "role")) == ["co", "lead"] and sorted(rows(got["coverage"])) == [(21, 1, 0, 0.0), (22, 2, 1, 0.5)]
    a, b = spark.createDataFrame([("c1", "홍")], "code string, name string"), spark.createDataFrame([("c1", "洪"), ("c2", None)], "code string, name string")
    ids = P.id_mapping({"a": a, "b": b}, "code", "name")
    assert sorted(rows(ids["mapping"].select("code", "name", "in_a", "in_b"))) == [("c1", "홍", True, True), ("c2", None, False, True)]
    assert sorted(rows(ids["coverage"].select("source", "n", "percent"))) == [("a", 1, 50.0), ("b", 2, 100.0)]


def test_small_plans(spark):
    text = "meeting_id string, term int, date string, session string, hearing_type string, speech_order int, speech_text string"
    said = spark.createDataFrame([("m", 22, "d1", "s", V.PLENARY, 2, "성명은 끝에 실음. 성명은 끝에"), ("m", 22, "d0", "s", V.PLENARY, 1, "성명은 끝에"), ("n", 22, "d", "s", "소위", 1, "성명은 끝에")], text)
    assert rows(P.appendix_meetings(said, 22)) == [("m", "d0", 3, "s")]
    points = spark.createDataFrame([("국민의힘",), ("x",), ("더불어민주당",), ("x",), (None,)], "party string")
    assert values(P.party_legend(points), "party") == ["더불어민주당", "국민의힘", "x"]
    assert values(P.with_blocs(points), "party_bloc") == ["conservative", "other", "liberal", "other", "other"]
    assert values(B.harmonised(spark.createDataFrame([("여성가족위원회",), ("법사위",)], "committee_nm string")), "committee_nm") == ["성평등가족위원회", "법사위"]
    months = sorted(rows(B.months_of_term(bills(spark).withColumn("ppsl_dt", F.when(F.col("bill_id") == "PRC_2", F.to_date(F.lit("2024-08-09"))).otherwise(F.col("ppsl_dt")))).select("period", "n", "month_of_term")))
    assert [m[1:] for m in months] == [(1, 1), (0, 2), (1, 3)]


def test_ideology_table(spark):
    points = spark.createDataFrame([("a", 22, 0.5, "Kim", "Red"), ("b", 22, -0.5, "Lee", "Blue"), ("c", 21, 0.1, "Kim", None)], "member_id string, term int, aligned double, member_name string, party string")
    assert values(P.ideology_table(points, name="kim", term=22), "rank") == [1] and values(P.ideology_table(points, party="blue"), "member_id") == ["b"]


# sources, sinks, streaming


def test_tables_round_trip(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = scan.conformed(spark.createDataFrame([("1", 21, "x"), ("2", 22, "y")], "BILL_ID string, AGE int, extra string"), scan.SCHEMAS["bills"])
    sinks.write_table(df, root, "bills")
    assert values(scan.scan(spark, root, "bills", [22], ["bill_id", "age", "unknown"]), "bill_id") == ["2"]
    assert scan.scan(spark, root, "bills").count() == 2 and scan.scan(spark, root, "members").count() == 0
    plan = scan.scan(spark, root, "bills", [22], ["bill_id"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(age" in plan and "ReadSchema: struct<bill_id:string>" in plan
    for end in ("csv", "tsv", "parquet"):
        sinks.export(df, f"{root}/out.{end}")
    assert spark.read.option("header", True).option("sep", "\t").csv(f"{root}/out.tsv").count() == 2
    sinks.register({"own_bills": df})
    assert rows(sinks.sql(spark, "SELECT count(*) FROM own_bills")) == [(2,)]
    assert rows(sinks.ingest_metadata({"bills": df}).select("endpoint", "n_rows"))[0] == ("bills", 2)
    sinks.charts({"x": df.select("bill_id")}, root)
    points = spark.createDataFrame([("m", 20, 0.5, None, "n", "p")], scan.SCHEMAS["ideal_points"])
    sinks.score_files(points, root, "term", [20])
    assert rows(scan.scores(spark, f"{root}/ideal_points_20").select("aligned", "se1D")) == [(-0.5, None)]
    (tmp_path / "p.json").write_text('[{"id": "a", "AGE": "22"}, {"id": "b", "AGE": "x"}]')
    assert sorted(rows(scan.proposals(spark, f"{root}/p.json", {"id": "string", "AGE": "string"}, "AGE"))) == [("a", 22), ("b", None)]


PAGE = '{"F":[{"head":[{"list_total_count":1},{"RESULT":{"CODE":"%s","MESSAGE":"m"}}]},{"row":[{"A":"%s","B":null}]}]}'


def test_envelopes(spark):
    df = spark.createDataFrame([("1", PAGE % ("INFO-000", "x")), ("2", PAGE % ("INFO-200", "y")), ("3", "broken"), ("4", None)], "k string, body string")
    assert rows(scan.flatten_envelope(df, "body", "F", ["k"], ["A", "B"])) == [("1", "x", None)]


def test_landing_goes_on_where_it_stopped(spark, tmp_path):
    import json

    (tmp_path / "in").mkdir()
    put = lambda name, key, a: (tmp_path / "in" / name).write_text(json.dumps({"bill_id": key, "fetched_at": "2024-01-01T00:00:00", "body": PAGE % ("INFO-000", a)}) + "\n")
    run = lambda: landing.land(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp", "F", ["A", "B"], ["bill_id", "A"]).awaitTermination()
    put("a.json", "1", "x")
    run()
    put("b.json", "1", "x")
    put("c.json", "2", "y")
    run()
    run()
    assert sorted(rows(spark.read.parquet(f"{tmp_path}/out").select("bill_id", "A"))) == [("1", "x"), ("2", "y")]


# whole plans


def test_build_term(spark):
    """Ordered columns without helpers, both kinds of meetings, a bill's meetings all kept."""
    text = lambda data, names: spark.createDataFrame(data, ", ".join(f"{n} string" for n in names.split()))
    feeds = {
        "member_bills": text([("PRC_1", "1", "가법", "2024-06-01", "원안가결", "2024-08-01", "extra")], "BILL_ID BILL_NO BILL_NAME PROPOSE_DT PROC_RESULT PROC_DT MORE"),
        "receipts": text([("제22대", "PRC_2", "2", "나법", "x")], "ERACO BILL_ID BILL_NO BILL_NM BILL_KIND_CD"),
        "reviews": text([("제22대", "PRC_1", "법사위")], "ERACO BILL_ID JRCMIT_NM"),
        "votes": text([("PRC_1", "300", "250")], "BILL_ID MEMBER_TCNT YES_TCNT"),
        "processed": text([("PRC_2", "정부")], "BILL_ID PROPOSER_KIND"),
        "details": text([("PRC_1", "2024-07-20")], "BILL_ID RGS_RSLN_DT"),
    }
    own = text([("PRC_1", "m1", "2024-06-05"), ("PRC_1", "m2", "0")], "_BILL_ID JRCMIT_CONF_NM JRCMIT_CONF_DT")
    both = text([("PRC_1", "tag", "j")], "BILL_ID _BILL_ID LWCMIT_CONF_NM")
    got = B.build_term(22, feeds, own, both)
    names = got["bills"].columns
    known = [c for c in scan.SCHEMAS["bills"].names if c in names]
    assert names[: len(known)] == known and names[len(known) :] == ["more"]
    assert sorted(rows(got["committee_meetings"].select("bill_id", "jrcmit_conf_dt", "age")), key=str) == [("PRC_1", None, 22), ("PRC_1", dt.date(2024, 6, 5), 22)]
    assert rows(got["judiciary_meetings"].select("bill_id", "bill_id_tagged")) == [("PRC_1", "tag")]
    assert rows(B.lite_summary(got["bills"])) == [(22, 2, 1, 1, 1, 1, 50.0)]


def test_members_of_term(spark):
    names = [*V.MEMBER_FEED, *V.MEMBER_LISTS, V.MEMBER_TERMS]
    feed = [("c1", "나", *[None] * 8, "x/y", "p", "", "k1/k2/k3", "제20대, 제22대"), ("c2", "가", *["t"] * 8, "y", "q/r", "z", "k", "제22대"), ("c3", "다", *["t"] * 8, "y", "q", "z", "k", "제21대"), ("c4", None, *["t"] * 8, None, "q", "z", "k", None)]
    got = rows(P.members_of_term(spark.createDataFrame(feed, ", ".join(f"{n} string" for n in names)), 22).select("mona_cd", "member_name", "sex", "party", "district", "committee", "age"))
    assert got == [("c2", "가", "t", "y", "q", "k", 22), ("c1", "나", "", "y", "p", "k2", 22)]


def test_validation(spark):
    t = spark.createDataFrame([("a", None), ("a", 1), (None, None), ("b", 2)], "Bill_ID string, x int")
    got = sorted(rows(checks.validate({"one": t, "none": t.limit(0), "many": t}, {"one": 40, "many": 4}, "BILL_ID", many=["many"])), key=str)
    assert [(r[0], r[1], r[2], r[3], r[5]) for r in got] == [
        ("many", "key nulls", "Bill_ID", 1, "CHECK"), ("many", "nulls", "Bill_ID", 1, "CHECK"), ("many", "nulls", "x", 2, "CHECK"), ("many", "rows", None, 4, "OK"), ("none", "rows", None, 0, "MISSING"),
        ("one", "key nulls", "Bill_ID", 1, "CHECK"), ("one", "key repeats", "Bill_ID", 2, "CHECK"), ("one", "nulls", "Bill_ID", 1, "CHECK"), ("one", "nulls", "x", 2, "CHECK"), ("one", "rows", None, 4, "CHECK"),
    ]


def test_scores_with_parties(spark):
    points = spark.createDataFrame([("a", 21, 0.1), ("a", 22, 0.2), ("b", 22, 0.3), ("c", 22, 0.4)], "m string, t int, x double")
    sat = spark.createDataFrame([("a", 21, "q"), ("a", 21, "q"), ("a", 20, "p"), ("b", 22, "r"), ("b", 22, None)], "m string, t int, p string")
    got = sorted(rows(rollcall.with_parties(points, sat, "m", "t", "p").select("m", "t", "parties", "terms", "p")))
    assert got == [("a", 21, "p/q", "20,21", "q"), ("a", 22, "p/q", "20,21", "p/q"), ("b", 22, "r", "22", "r"), ("c", 22, None, None, None)]
    own = rollcall.with_parties(points.withColumn("p", F.lit("own")), sat, "m", "t", "p")
    assert sorted(rows(own.select("m", "t", "p"))) == [("a", 21, "q"), ("a", 22, "own"), ("b", 22, "r"), ("c", 22, "own")]


def test_ideal_points_of_terms(spark):
    """Planted places come back in order in each term, and the terms line up by the members they share."""
    rng = random.Random(9)
    place = {m: rng.uniform(-1, 1) for m in range(40)}
    cells = []
    for term in (21, 22):
        for item in range(60):
            cut, way = rng.uniform(-0.7, 0.7), rng.choice([-1, 1])
            cells += [(term, f"b{item}", f"m{m}", V.YES if way * (x - cut) + rng.gauss(0, 0.2) > 0 else V.NO) for m, x in place.items() if (m + term) % 8]
    t = spark.createDataFrame(cells, "term int, bill_id string, member_id string, vote string")
    got = rows(P.ideal_points(t, [21, 22], 22, 5).select("member_id", "term", "aligned"))
    for term in (21, 22):
        own = {int(m[1:]): x for m, t_, x in got if t_ == term}
        order, want = sorted(own, key=own.get), sorted(own, key=place.get)
        d = sum((order.index(m) - want.index(m)) ** 2 for m in own)
        n = len(own)
        assert abs(1 - 6 * d / (n * (n**2 - 1))) > 0.9
    both = {m: [x for m_, _, x in got if m_ == m] for m, _, _ in got}
    pairs = [v for v in both.values() if len(v) == 2]
    assert len(pairs) > 20 and sum(abs(a - b) for a, b in pairs) / len(pairs) < 0.5


def test_open_tables(spark, tmp_path):
    """Wealth variables and source flags are given as they are; a table that isn't there is empty."""
    root = str(tmp_path)
    spark.createDataFrame([("c1", 2020, 21, 5.0, 7.0), ("c2", 2016, 20, 6.0, None)], "MONA_CD string, year int, assembly int, net_worth double, Jewels double").write.parquet(f"{root}/assets")
    got = scan.scan(spark, root, "assets", [21])
    assert rows(got.select("mona_cd", "net_worth", "total_stocks", "jewels")) == [("c1", 5.0, None, 7.0)]
    assert scan.scan(spark, root, "legislator_map").columns == ["mona_cd", "member_name"] and scan.scan(spark, root, "legislator_map").count() == 0
    spark.createDataFrame([("c1", "n", True)], "mona_cd string, member_name string, in_bills boolean").write.parquet(f"{root}/legislator_map")
    assert rows(scan.scan(spark, root, "legislator_map")) == [("c1", "n", True)]


def test_texts_take_one_shuffle(spark):
    """Texts of votes are made, parsed and counted in one shuffle, whose parts grow in number with the rows."""
    from legispark.plans import bindings, on_plans, on_votes

    data = "/root/testdata/sf0.001"
    for f in (on_votes.vote_text_roundtrip, on_votes.vote_text_events, on_votes.vote_text_mismatches, on_plans.plenary_votes, on_plans.appendix_votes):
        assert f(spark, data)._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1, f.__name__
    parts = bindings.dealt(spark.range(5 * bindings.PART_ROWS), "id").rdd.getNumPartitions()
    assert parts == 5


def test_written_files_are_bounded(spark, tmp_path, monkeypatch):
    """A term of many rows goes to several tasks, each with a range of its lookups' values, however small its rows are on disk."""
    monkeypatch.setattr(sinks, "FILE_ROWS", 1000, raising=False)
    t = spark.range(5000).select(F.col("id").cast("string").alias("bill_id"), F.col("id").cast("string").alias("bill_no"), F.lit(22).alias("age"))
    sinks.write_table(scan.conformed(t, scan.SCHEMAS["bills"]), str(tmp_path), "bills")
    per = scan.scan(spark, str(tmp_path), "bills").groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("bill_no").alias("a"), F.max("bill_no").alias("z")).orderBy("a").collect()
    assert len(per) == 5 and sum(p["n"] for p in per) == 5000 and max(p["n"] for p in per) < 1500
    assert all(x["z"] < y["a"] for x, y in zip(per, per[1:]))
