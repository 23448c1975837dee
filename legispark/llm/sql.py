"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from legispark.llm.audit import REPEAT
from legispark.llm.mixing import HEX_DIGITS, LEAST_WEIGHT, MOST, WEIGHTS
from legispark.llm.repetition import MAX_COVERED, MAX_LONGEST, MAX_REPEATED, MIN_REPEAT, MIN_WORDS, REPEAT_WORDS
from legispark.llm.resample import BUCKETS, LONGEST, MIN_WORDS as DRAWN_WORDS, PERCENT, POLYNOMIAL, SEED
from legispark.llm.substring import WINDOW

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _repeats(m: int) -> str:
    return f"""win{m} AS (SELECT rid, unnest(range(1, len(ws) - {m - 2})) AS i, unnest(list_transform(range(1, len(ws) - {m - 2}), lambda i: array_to_string(ws[i : i + {m - 1}], ' '))) AS win FROM w),
rep{m} AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win{m}) WHERE c > 1),
cov{m} AS (SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest(range(i, i + {m})) AS pos FROM rep{m}) GROUP BY rid)"""


OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, {WORDS} AS ws FROM d),
{_repeats(REPEAT_WORDS)}, {_repeats(MIN_REPEAT)}, {_repeats(MAX_LONGEST + 1)},
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT w.rid, doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(c.n, 0)::BIGINT AS n_covered, l.rid IS NOT NULL AS long
  FROM w LEFT JOIN lines ON lines.rid = w.rid LEFT JOIN cov{REPEAT_WORDS} r ON r.rid = w.rid LEFT JOIN cov{MIN_REPEAT} c ON c.rid = w.rid LEFT JOIN cov{MAX_LONGEST + 1} l ON l.rid = w.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AND n_covered <= {MAX_COVERED} * n_words AND NOT long AS kept
FROM m"""

OP5 = rf"""
WITH iw AS (SELECT item_id, {ALNUM} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, m, array_to_string(ws[s : s + m - 1], ' ') AS w FROM (SELECT item_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS s FROM (SELECT *, least(10, len(ws)) AS m FROM iw WHERE len(ws) > 0))),
d AS (SELECT row_number() OVER () AS rid, doc_id, {ALNUM} AS ws FROM documents),
spot AS (SELECT rid, m, i, array_to_string(ws[i : i + m - 1], ' ') AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d), (SELECT DISTINCT m FROM win) WHERE i + m - 1 <= len(ws)),
hit AS (SELECT rid, i, m, item_id FROM spot JOIN win USING (m, w)),
words AS (SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest(range(i, i + m)) AS pos FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(len({WORDS}), 0)::BIGINT AS size, md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS print,
  coalesce(greatest({LEAST_WEIGHT}::DOUBLE, 1 - (10 * (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))) / nullif(length(text), 0)), 1.0::DOUBLE) AS own FROM documents),
k AS (SELECT *, -ln((('0x' || substr(print, 1, {HEX_DIGITS}))::BIGINT + 0.5::DOUBLE) / {float(16**HEX_DIGITS)!r}::DOUBLE) / own AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
c AS (SELECT *, ({list(WEIGHTS)})[((r - 1) % {len(WEIGHTS)} + 1)::INT]::BIGINT AS weight, {MOST} * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM c),
f AS (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(cap::DOUBLE, f.level * weight) AS target, coalesce(floor(least(cap::DOUBLE, f.level * weight) / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM l, f),
g AS (SELECT k.*, source_size, target, epochs, target - epochs * source_size AS rest, coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, print ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS running
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN running < rest AND running + size - rest <= rest - running THEN 1 ELSE 0 END))::BIGINT AS taken FROM g"""

OP9 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT rid, array_to_string(ws[i : i + 3], ' ') AS s FROM (SELECT rid, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
e AS (SELECT da.doc_id AS a, db.doc_id AS b FROM p JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b JOIN d da ON da.rid = a JOIN d db ON db.rid = b WHERE 100 * shared >= 80 * (na.n + nb.n - shared) AND da.doc_id <> db.doc_id),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT r.node, x.b FROM reach r JOIN both_ways x ON x.a = r.seen),
c AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least, doc_id)::BIGINT AS component_id, coalesce(doc_id = coalesce(least, doc_id), true) AS kept
FROM d LEFT JOIN n USING (rid) LEFT JOIN c ON c.node = doc_id"""


def _crc_step(n: int) -> int:
    for _ in range(4):
        n = (n >> 1) ^ (POLYNOMIAL if n & 1 else 0)
    return n


_NIBBLES = f"({[_crc_step(n) for n in range(16)]}::BIGINT[])"
_ONE = f"xor(c // 16, {_NIBBLES}[(c & 15) + 1])"
#: CRC-32 of a string, half a byte a step.
CRC32 = f"""xor(4294967295, list_reduce(list_transform(range(0, octet_length(encode(gram))), lambda i: ('0x' || substr(hex(encode(gram)), 2 * i + 1, 2))::BIGINT), lambda a, b: list_reduce([xor(a, b), 0, 0], lambda c, z: {_ONE}), 4294967295::BIGINT))"""


def _grams(table: str) -> str:
    runs = " UNION ALL ".join(f"SELECT rid, unnest(list_transform(range(1, len(ws) - {m - 2}), lambda i: array_to_string(ws[i : i + {m - 1}], ' '))) AS gram FROM {table} WHERE len(ws) >= {m}" for m in range(1, LONGEST + 1))
    return f"SELECT rid, gram, count(*) AS n FROM ({runs}) GROUP BY rid, gram"


OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({ALNUM}, []) AS ws FROM documents),
b AS (SELECT row_number() OVER () AS rid, coalesce({ALNUM}, []) AS ws FROM benchmark),
dg AS ({_grams("d")}), bg AS ({_grams("b")}),
code AS (SELECT gram, {CRC32} % {BUCKETS} AS bucket FROM (SELECT gram FROM dg UNION SELECT gram FROM bg)),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM dg JOIN code USING (gram) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS t FROM bg JOIN code USING (gram) GROUP BY bucket),
whole AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + {BUCKETS} AS src, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + {BUCKETS} AS tgt),
g AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * src) / ((s + 1)::DOUBLE * tgt)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), whole),
w AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM dg JOIN code USING (gram) JOIN g USING (bucket) GROUP BY rid),
x AS (SELECT rid, doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM d LEFT JOIN w USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS able FROM x WHERE n_words >= {DRAWN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * able // 100 THEN rank END AS rank FROM x LEFT JOIN r USING (rid)"""

_LETTERS = "ABCD" + REPEAT
_AT = "coalesce(list_min(list_transform(failing, lambda f: instr(filter_order, f))), 6)"
_HERE = "substr(filter_order, step, 1)"
OP12 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, coalesce({WORDS}, []) AS ws FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id),
least AS (SELECT text, min(doc_id) AS first_id FROM d GROUP BY text),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad, list_filter([
    CASE WHEN len(ws) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' END, CASE WHEN 100 * len(regexp_extract_all(d.text, '[A-Z]')) > 3 * length(d.text) THEN 'C' END,
    CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' END, CASE WHEN d.doc_id > first_id THEN 'E' END], lambda x: x IS NOT NULL) AS failing
  FROM d JOIN least USING (text) LEFT JOIN l USING (doc_id)),
cells AS (SELECT part, good, bad, failing, count(*) AS n FROM f GROUP BY ALL),
letter AS (SELECT unnest(string_split('{_LETTERS}', '')) AS x),
orders AS (SELECT a.x || b.x || c.x || e.x || g.x AS filter_order FROM letter a, letter b, letter c, letter e, letter g WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
r AS (SELECT part, filter_order, step::INT AS step,
  coalesce(sum(n) FILTER ({_AT} > step), 0)::BIGINT AS kept, coalesce(sum(n) FILTER ({_AT} = step), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER ({_AT} < step AND list_contains(failing, {_HERE})), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (failing = [{_HERE}]), 0)::BIGINT AS unique_fails,
  coalesce(sum(n) FILTER ({_AT} = step AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER ({_AT} = step AND bad), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step)
SELECT *, sum(removed) OVER (PARTITION BY part, {_HERE})::BIGINT AS shapley FROM r"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({WORDS}, []) AS ws FROM documents),
win AS (SELECT rid, doc_id, unnest(range(1, len(ws) - {WINDOW - 2})) AS i, unnest(list_transform(range(1, len(ws) - {WINDOW - 2}), lambda i: array_to_string(ws[i : i + {WINDOW - 1}], ' '))) AS win FROM d WHERE len(ws) >= {WINDOW}),
gone AS (SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY win) AS least FROM win) WHERE doc_id > least),
pos AS (SELECT rid, list(DISTINCT p) AS gone FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM gone) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda x: NOT list_contains(coalesce(gone, []), x[2])), lambda x: x[1]), ' ')) AS kept_sha256
FROM d LEFT JOIN pos USING (rid)"""

ORACLES = {"op3_repetition": OP3, "op5_decontam": OP5, "op8_mix": OP8, "op9_neardup": OP9, "op11_resample": OP11, "op12_audit": OP12, "op13_substring": OP13}
