"""Column expressions; all built of Spark's own functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_date(c: str | Column, formats: Sequence[str] = ("yyyy-MM-dd", "yyyyMMdd", "yyyy.MM.dd")) -> Column:
    """A date by the first format that fits; '', '0' and what no format reads are null."""
    text = F.trim(column(c))
    text = F.when(~text.isin("", "0"), text)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(column(end), column(start))


def months_from(origin_year: Column, origin_month: Column, c: str | Column) -> Column:
    """Whole months since the origin's month, 0 within it."""
    return (F.year(column(c)) - origin_year) * 12 + F.month(column(c)) - origin_month


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0 or null."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return share(part * 100.0, whole)


def recoded(c: str | Column, mapping: Mapping[str, str], default: str | None = None, keep: bool = True) -> Column:
    """The mapped value; others stay as they are, or get the default."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    value = F.element_at(F.create_map(*pairs), column(c)) if pairs else F.lit(None)
    return F.coalesce(value, F.lit(default) if default is not None else column(c) if keep else F.lit(None))


def coded(c: str | Column, codes: Mapping[str, int]) -> Column:
    """A number for each value, null for others."""
    out = F.lit(None).cast("int")
    for value, code in codes.items():
        out = F.when(column(c) == value, code).otherwise(out)
    return out


def in_group(c: str | Column, values: Sequence[str]) -> Column:
    """1 where c is among the values, else 0, null included."""
    return F.coalesce(column(c).isin(*values), F.lit(False)).cast("int")


def matches(c: str | Column, pattern: str) -> Column:
    """Whether the pattern occurs, upper or lower case; null: it doesn't."""
    return F.coalesce(column(c).rlike("(?i)" + pattern), F.lit(False))


def split_list(c: str | Column, mark: str = ",") -> Column:
    """Trimmed items; null stays null, empty items go."""
    return F.filter(F.transform(F.split(column(c), mark), lambda x: F.trim(x)), lambda x: x != "")


def pick(values: Column, place: Column) -> Column:
    """Of parallel values, the one at `place` (from 0): the only one if there is one, the last if there are too few; '' if none."""
    n = F.size(values)
    at = F.when(n == 1, 0).otherwise(F.least(place, n - 1))
    return F.when(n > 0, F.get(values, at)).otherwise(F.lit(""))


def term_label(term: Column) -> Column:
    return F.concat(F.lit("제"), term.cast("string"), F.lit("대"))


def term_number(label: str | Column) -> Column:
    return F.regexp_extract(column(label), r"(\d+)", 1).try_cast("int")


def sponsor_count(c: str | Column) -> Column:
    """The number before 인 at the end, else the first number, else null."""
    last = F.nullif(F.regexp_extract(column(c), r"(\d+)인$", 1), F.lit(""))
    first = F.nullif(F.regexp_extract(column(c), r"(\d+)", 1), F.lit(""))
    return F.coalesce(last, first).try_cast("int")


def squeezed(c: str | Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(column(c), r"\s+", "")


def shortened(c: str | Column, most: int) -> Column:
    text = column(c)
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit("…"))).otherwise(text)


def padded(c: str | Column, width: int, fill: str = "0") -> Column:
    text = column(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, fill))


def id_format(c: str | Column) -> Column:
    """What kind of id it is, by its beginning."""
    text = column(c)
    return F.when(text.startswith("PRC_"), "PRC").when(text.startswith("ARC_"), "ARC").when(text.rlike(r"^\d+$"), "numeric").otherwise("other")


def ordinal(c: str | Column) -> Column:
    """1st, 2nd, 3rd, 4th, 11th, ..."""
    n = column(c)
    end = F.when((n % 100).between(11, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), end)
