"""Importance resampling, the filter audit and substring dedup against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from legispark.llm import audit, resample, substring
from tests.llm.test_text_operators import ALNUM, DOCS, WORD, lower, prose, rows

LABELS = "doc_id long, quality int, toxic int, text string"
BENCH = "item_id string, text string, score string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


def collected(df):
    return [r.asDict() for r in df.collect()]


# resampling


def features(text):
    words = ALNUM.findall(lower(text))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def drawn(documents, target, percent=5):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    source, wanted = [0] * 10_000, [0] * 10_000
    for texts, counts in ((documents, source), (target, wanted)):
        for text in texts:
            for f in features(text[1] if isinstance(text, tuple) else text)[1]:
                counts[bucket(f)] += 1
    s_all, t_all = sum(source), sum(wanted)
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + 10_000) / ((s + 1) * (t_all + 10_000)))) for s, t in zip(source, wanted, strict=True)]
    out = []
    for id_, text in documents:
        words, fs = features(text)
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        out.append([id_, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


ORDER = ("doc_id", "n_features", "weight", "score", "rank")


def test_resampling(spark, docs):
    bench = [("b1", prose(random.Random(1), 60), "x"), ("b1", "W1 w2-w3", "x"), (None, None, None), ("b2", "", "")]
    for percent in (40, 100):
        got = resample.resampled(spark, docs, spark.createDataFrame(bench, BENCH), percent=percent)
        assert sorted((tuple(r[c] for c in ORDER) for r in collected(got)), key=str) == drawn([(r[0], r[1]) for r in rows()], [t for _, t, _ in bench], percent)


def test_resampling_of_nothing_and_towards_nothing(spark, docs):
    none = docs.limit(0)
    bench = spark.createDataFrame([], BENCH)
    assert collected(resample.resampled(spark, none, bench)) == []
    got = collected(resample.resampled(spark, docs, bench, percent=50))
    assert sorted((tuple(r[c] for c in ORDER) for r in got), key=str) == drawn([(r[0], r[1]) for r in rows()], [], 50)
    short = spark.createDataFrame([(1, "few words")], "doc_id long, text string")
    assert [r["rank"] for r in collected(resample.resampled(spark, short, bench, percent=100))] == [None]


def test_buckets_of_long_and_odd_words():
    rng = random.Random(3)
    texts = ["", "a", "é ß́ 日本 " + "y" * 5000 + " z " + "q" * 33, " ".join("x" * rng.randrange(1, 80) for _ in range(300)), "A-b_c9", "\x00\x7f"]
    bucket, row, words = resample.buckets(pa.array(texts))
    for i, text in enumerate(texts):
        found, fs = features(text)
        assert words[i] == len(found) and sorted(bucket[row == i].tolist()) == sorted(zlib.crc32(f.encode()) % 10_000 for f in fs)


def test_the_cutoff_goes_through_ties(spark):
    rng = random.Random(4)
    data = [(rng.choice([-5, 0, 0, 0, 7, 10**12]), rng.choice([1, 2, 2, 2, resample.NO_ID]), i) for i in range(200)]
    t = spark.createDataFrame(data, "_score long, _order long, _row long").cache()
    want = sorted(data, key=lambda r: (-r[0], r[1], r[2]))
    for k in (0, 1, 3, 57, 120, 199, 200):
        assert sorted(tuple(r) for r in resample.highest(t, k).collect()) == sorted(want[:k])
    t.unpersist()


# filters


def failing(text):
    text = text or ""
    words = WORD.findall(text)
    return "".join(letter for letter, bad in zip("ABCD", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text))), strict=True) if bad)


def audited(documents, labels):
    """documents: (doc_id, text, lang)."""
    known = {}
    for id_, quality, toxic, _ in labels:
        good, bad = known.get(id_, (False, False))
        known[id_] = (good or quality == 1, bad or toxic == 1)
    known.pop(None, None)
    out, parts = {}, sorted({lang or "" for _, _, lang in documents})
    own = []
    for id_, text, lang in documents:
        repeat = id_ is not None and any(i is not None and i < id_ and (t or "") == (text or "") for i, t, _ in documents)
        own.append((lang or "", failing(text) + ("E" if repeat else ""), *known.get(id_, (False, False))))
    for part in parts:
        mine, credit = [x for x in own if x[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            at = [min((order.index(f) + 1 for f in x[1]), default=6) for x in mine]
            for step, f in enumerate(order, 1):
                here = [x for x, s in zip(mine, at, strict=True) if s == step]
                credit[f] += len(here)
                out[part, "".join(order), step] = [sum(s > step for s in at), len(here), sum(f in x[1] and s < step for x, s in zip(mine, at, strict=True)), sum(x[1] == f for x in mine), sum(x[2] for x in here), sum(x[3] for x in here)]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(credit[f])
    return out


def test_audit(spark, docs):
    rng = random.Random(6)
    extra = [(100 + i, rng.choice([prose(rng, 250, 400), "A B C " * 90, "# " + prose(rng, 210, 300), "same text", ""]), rng.choice(["en", "", None, "fr"]), "s", 1, "", "", "") for i in range(60)]
    extra += [(120, "same text", "en", "s", 1, "", "", ""), (None, "same text", "en", "s", 1, "", "", "")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "clash") for i in range(0, 160, 2)] + [(100, 1, 0, "again"), (100, 0, 1, "again"), (None, 1, 1, "")]
    t = docs.unionByName(spark.createDataFrame(extra, DOCS))
    got = collected(audit.interactions(t, spark.createDataFrame(labels, LABELS)))
    want = audited([(r[0], r[1], r[2]) for r in [*rows(), *extra]], labels)
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in audit.COUNTS] for r in got} == want and len(got) == len(want)


def test_audit_of_nothing_and_of_other_filters(spark, docs):
    labels = spark.createDataFrame([], LABELS)
    assert collected(audit.interactions(docs.limit(0), labels)) == []
    got = collected(audit.interactions(docs, labels, {"X": F.length("text") > 100}))
    assert {r["filter_order"] for r in got} == {"XE", "EX"}
    for part in {r["part"] for r in got}:
        n = sum((r[2] or "") == part for r in rows())
        assert all(r["kept"] + r["removed"] == (n if r["step"] == 1 else next(x["kept"] for x in got if (x["part"], x["filter_order"], x["step"]) == (part, r["filter_order"], 1))) for r in got if r["part"] == part)


def test_removal_steps_are_a_min_plus_product():
    orders, steps = audit.removal_steps(4)
    for mask in range(16):
        for o, order in enumerate(orders):
            assert steps[mask, o] == min((order.index(f) + 1 for f in range(4) if mask >> f & 1), default=5)


def test_a_text_that_many_share_is_few_rows(spark):
    """Copies are counted before they meet: the repeats' window has a row per text, part and class, whatever their number."""
    t = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text"), F.lit("en").alias("lang"))
    got = collected(audit.interactions(t, spark.createDataFrame([(0, 1, 0, "")], LABELS)))
    first = next(r for r in got if r["filter_order"] == "EABCD" and r["step"] == 1)
    assert [first[c] for c in ("kept", "removed", "good_lost")] == [1, 2999, 0]


# substrings


def removed_words(documents, window=50):
    least, texts = {}, [WORD.findall(t or "") for _, t in documents]
    for (id_, _), words in zip(documents, texts, strict=True):
        for i in range(len(words) - window + 1 if id_ is not None else 0):
            key = tuple(words[i : i + window])
            least[key] = min(least.get(key, id_), id_)
    out = []
    for (id_, _), words in zip(documents, texts, strict=True):
        gone = set()
        for i in range(len(words) - window + 1 if id_ is not None else 0):
            if least[tuple(words[i : i + window])] < id_:
                gone |= set(range(i, i + window))
        out.append((id_, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def planted(seed=11):
    """Passages over the window's length in many documents, copies, repeats within a document, the window's exact length, one word less."""
    rng = random.Random(seed)
    passages = [prose(rng, n, 3000) for n in (50, 51, 70, 49, 200)]
    out = [(i, " ".join(prose(rng, rng.randrange(0, 90), 3000) + f" {rng.choice(passages)} " for _ in range(rng.randrange(0, 4))) + prose(rng, rng.randrange(0, 120), 3000)) for i in range(80)]
    out += [(200 + i, out[i][1]) for i in range(0, 40, 3)] + [(7, out[7][1]), (7, out[9][1]), (None, out[7][1]), (300, "x " * 400), (301, "x " * 120), (-5, "x " * 60), (302, passages[0] + "\n" + passages[0])]
    return out


@pytest.mark.parametrize("sizes", [{}, {"slice_bytes": 2000, "range_bytes": 1500}, {"slice_bytes": 1, "range_bytes": 1 << 30}])
def test_substrings(spark, sizes):
    data = planted()
    t = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in collected(substring.deduplicated(spark, t, **sizes))), key=str)
    assert got == removed_words(data)


def test_substrings_of_odd_rows(spark, docs):
    t = docs.withColumns({"n_words": F.lit("x"), "SPANS": F.lit("y"), "id": F.lit("z")})
    out = substring.deduplicated(spark, t, window=5)
    assert out.columns == [*docs.columns, "id", "n_words", "n_removed", "spans"]
    got = collected(out)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got), key=str) == removed_words([(r[0], r[1]) for r in rows()], 5)
    assert {r["id"] for r in got} == {"z"} and {r["kept"] for r in got} == {r[6] for r in rows()}
    for r in got:
        spans = [(s["start"], s["stop"]) for s in r["spans"] or []]
        assert sum(b - a for a, b in spans) == r["n_removed"] and all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
    assert collected(substring.deduplicated(spark, docs.limit(0))) == []


def test_hashes_of_windows():
    code = np.random.default_rng(2).integers(0, 2**63, 400).astype(np.uint64)
    code[200:300] = code[50:150]
    found = substring.windows(code, 50)
    assert len(found) == 351 and (found[200:251] == found[50:101]).all() and len(set(found.tolist())) == 300
    assert len(substring.windows(code[:49], 50)) == 0 and len(substring.windows(code[:50], 50)) == 1


def test_unlike_windows_of_one_hash_stay_apart():
    rng = np.random.default_rng(5)
    hashes, checks, ids = (rng.integers(0, n, 500).astype(t) for n, t in ((20, np.uint64), (3, np.uint32), (40, np.int64)))
    got = substring._later(hashes, checks, ids)
    least = {}
    for key in zip(hashes.tolist(), checks.tolist(), ids.tolist(), strict=True):
        least[key[:2]] = min(least.get(key[:2], key[2]), key[2])
    assert got.tolist() == [i > least[h, c] for h, c, i in zip(hashes.tolist(), checks.tolist(), ids.tolist(), strict=True)]
    assert not substring._later(hashes[:0], checks[:0], ids[:0]).any()


def test_a_passage_that_many_share_travels_once_a_slice(spark):
    passage = prose(random.Random(1), 80, 3000)
    t = spark.range(0, 600, 1, 2).select(F.col("id").alias("doc_id"), F.lit(passage).alias("text"))
    dealt = t.select(F.col("doc_id").alias("id"), "text").mapInArrow(substring._dealt(4, 50, 1 << 20), substring._DEALT)
    assert dealt.agg(F.sum(F.octet_length("hashes") / 8)).first()[0] == 2 * 31
    got = collected(substring.deduplicated(spark, t))
    assert sum(r["n_removed"] for r in got) == 599 * 80 and next(r["text"] for r in got if r["doc_id"] == 0) == passage
