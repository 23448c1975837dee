"""Rules on a text's quality; the last is on repeats within it, found by a suffix array over its words.

A slice of documents gets one suffix array: ranks of prefixes are doubled, each time only for suffixes that still tie,
and the ranks of every doubling give the longest common prefix of neighbours. A word that lies inside a maximal
repeated run of `min_words` words or more is covered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from legispark.llm import text as T

MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 6, 0.4, 50
#: Fewest words, most percent of words in repeated windows of REPEAT_WORDS words, symbol characters.
MIN_WORDS, MAX_REPEATED, REPEAT_WORDS, SYMBOLS = 50, 50, 3, "[#*$%&|<>]"
SLICE = 2 << 20


def longest_repeats(code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each word, the longest run that starts there and occurs again in its text (possibly overlapping)."""
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    sizes = np.diff(at)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(at[1:], sizes) - np.arange(n)  # words from here to the text's end
    _, first, inverse, count = np.unique(doc * (int(code.max()) + 1) + code, return_index=True, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - count)[inverse]
    ranks, open_ = [rank], np.flatnonzero(count[inverse] > 1)
    step = 1
    while len(open_):
        rank = ranks[-1].copy()
        own = rank[open_]
        after = np.where(left[open_] > step, ranks[-1][np.minimum(open_ + step, n - 1)] + 1, 0)
        order = np.lexsort((after, own))
        open_, own, after = open_[order], own[order], after[order]
        new = np.ones(len(open_), bool)
        new[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        group = np.ones(len(open_), bool)
        group[1:] = own[1:] != own[:-1]
        place = np.arange(len(open_))
        begin = np.maximum.accumulate(np.where(group, place, 0))
        start = np.maximum.accumulate(np.where(new, place, 0))
        rank[open_] = own + start - begin
        size = np.diff(np.append(np.flatnonzero(new), len(open_)))
        open_ = open_[np.repeat(size, size) > 1]
        ranks.append(rank)
        step *= 2
    order = np.argsort(ranks[-1], kind="stable")
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    live = np.flatnonzero(ranks[0][a] == ranks[0][b]) if n > 1 else np.zeros(0, np.int64)
    a, b, run = a[live], b[live], np.zeros(len(live), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        fits = (left[a] - run >= 1) & (left[b] - run >= 1)
        x, y = np.minimum(a + run, n - 1), np.minimum(b + run, n - 1)
        same = fits & (ranks[k][x] == ranks[k][y]) & (x != y)
        run = run + np.where(same, 1 << k, 0)
    common[live] = run
    out = np.zeros(n, np.int64)
    out[order[:-1]] = common
    out[order[1:]] = np.maximum(out[order[1:]], common)
    return out


def covered(repeat: np.ndarray, least: int, exact: bool = False) -> np.ndarray:
    """Words in the union of the runs of `least` words or more; with exact, of windows of just `least` words."""
    n = len(repeat)
    long = np.flatnonzero(repeat >= least)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, long, 1)
    np.add.at(edge, long + (least if exact else repeat[long]), -1)
    return np.cumsum(edge[:-1]) > 0


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def rules(docs: DataFrame, text_col: str = "text", min_words: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """docs' columns but for the text, and what the rules count.

    n_words, word_chars (code points), n_symbols, n_dup_lines (lines with a word that equal an earlier one),
    n_repeat_words (in 3-word windows found twice or more), n_covered (words in repeats of `min_words` or more),
    longest_repeat; base_failed, and kept: not base_failed, covered fraction and longest repeat within the limits.
    Null and wordless texts count 0 everywhere and fail by their few words. Rows that repeat are each judged alone.
    New columns take the place of docs' columns of that name.
    """

    def count(text: pa.Array) -> list:
        flat, at = T.split(text)
        code, words = T.coded(flat)
        repeat = longest_repeats(code, at)
        chars = pc.utf8_length(words).to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, np.int64)
        lines = [_dup_lines(x) if "\n" in x else 0 for x in text.to_pylist()]
        top = np.zeros(len(text), np.int64)
        full = np.flatnonzero(np.diff(at))
        if len(full):
            top[full] = np.maximum.reduceat(repeat, at[full])
        values = [np.diff(at), T.sums(chars, at), pc.count_substring_regex(text, SYMBOLS), lines, T.sums(covered(repeat, REPEAT_WORDS, True).astype(np.int64), at), T.sums(covered(repeat, min_words).astype(np.int64), at)]
        n = values[0]
        failed = (n < MIN_WORDS) | (100 * values[4] > MAX_REPEATED * n)
        kept = ~failed & (values[5] <= max_covered * n) & (top <= max_longest)
        return [*(pa.array(v, pa.int64()) if not isinstance(v, pa.Array) else v.cast(pa.int64()) for v in [*values, top]), pa.array(failed), pa.array(kept)]

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]
    return T.annotated(docs, text_col, {**dict.fromkeys(names, "bigint"), "base_failed": "boolean", "kept": "boolean"}, count, limit=SLICE)
