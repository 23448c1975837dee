"""The master table of bills, its satellites, and the questions asked of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legispark.functions import scalar as S
from legispark.functions import vocabulary as V
from legispark.operators import stats, tables
from legispark.sources.scan import SCHEMAS

DETAIL = {"jrcmit_cmmt_dt": "jrcmit_cmmt_dt", "law_cmmt_dt": "law_cmmt_dt", "law_prsnt_dt": "law_prsnt_dt", "law_proc_dt": "law_proc_dt", "law_proc_rslt": "law_proc_rslt", "rgs_prsnt_dt": "rgs_prsnt_dt", "rgs_rsln_dt": "rgs_rsln_dt", "rgs_conf_nm": "rgs_conf_nm", "rgs_conf_rslt": "rgs_conf_rslt", "gvrn_trsf_dt": "gvrn_trsf_dt", "prom_dt": "prom_dt", "prom_no": "prom_no", "prom_law_nm": "prom_law_nm"}
REVIEW = {"jrcmit_nm": "jrcmit_nm", "bdg_cmmt_dt": "bdg_cmmt_dt", "jrcmit_prsnt_dt": "jrcmit_prsnt_dt", "jrcmit_proc_dt": "jrcmit_proc_dt", "jrcmit_proc_rslt": "jrcmit_proc_rslt"}
TALLY = {"proc_result_cd": "vote_result_cd", "member_tcnt": "vote_member_total", "vote_tcnt": "vote_total", "yes_tcnt": "vote_yes", "no_tcnt": "vote_no", "blank_tcnt": "vote_abstain"}
#: Columns of the feeds that the bills' table doesn't keep.
HELPERS = {"eraco", "bill_kind_cd"}


def lower(t: DataFrame) -> DataFrame:
    return t.toDF(*[c.lower() for c in t.columns])


def build_master(age: int, member_bills: DataFrame, receipts: DataFrame, reviews: DataFrame, votes: DataFrame, processed: DataFrame, details: DataFrame, expired_terms: Sequence[int] = (), dedup: bool = True, on_clash: str = "coalesce", lite: bool = False) -> DataFrame:
    """One row per bill of a term out of the raw feeds; every step is keyed by bill_id.

    dedup keeps the first row a bill has in reviews, votes and details (without it, repeated rows repeat the bill);
    on_clash says what the detail's column does to one that is there already. lite leaves the details out.
    """
    label = F.col("eraco") == f"제{age}대"
    base = lower(member_bills).withColumnsRenamed({"bill_name": "bill_nm", "propose_dt": "ppsl_dt", "proc_result": "proc_rslt", "proposer": "proposer_text", "committee": "committee_nm", "detail_link": "link_url"})
    base = base.withColumns({"bill_kind": F.lit(V.LAW_KIND), "ppsr_kind": F.lit(V.MEMBER_KIND), "age": F.lit(age)})
    extra = lower(receipts).where(label).drop("eraco").withColumn("age", F.lit(age))
    out = tables.append_missing(base, extra, "bill_id")
    order = lambda t: sorted(c for c in t.columns if c != "bill_id") if dedup else None
    review, tally, detail = lower(reviews).where(label), lower(votes), lower(details)
    out = tables.left_enrich(out, review, "bill_id", {k: v for k, v in REVIEW.items() if k in review.columns}, order=order(review))
    out = tables.left_enrich(out, tally, "bill_id", {k: v for k, v in TALLY.items() if k in tally.columns}, order=order(tally))
    kinds = lower(processed)
    out = tables.fill_from(out, kinds, "bill_id", "ppsr_kind", "proposer_kind", [F.col(c).desc() for c in sorted(kinds.columns) if c != "bill_id"])
    if not lite:
        out = tables.left_enrich(out, detail, "bill_id", {k: v for k, v in DETAIL.items() if k in detail.columns}, on_clash=on_clash, order=order(detail))
    dates = [c for c in out.columns if c.endswith("_dt")]
    out = out.withColumns({c: S.safe_date(F.col(c).cast("string")) for c in dates})
    for c in ("vote_member_total", "vote_total", "vote_yes", "vote_no", "vote_abstain"):
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("string").try_cast("int"))
    out = tables.derive_outcome(out, "proc_rslt", "age", V.PASSED, V.ENACTED, V.STILL_PENDING, V.EXPIRED, expired_terms)
    for c in ("proc_dt", "committee_dt"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("date"))
    return out.withColumns({"days_to_proc": S.days_between("ppsl_dt", "proc_dt"), "days_to_committee": S.days_between("ppsl_dt", "committee_dt")})


def build_term(age: int, feeds: Mapping[str, DataFrame], committee_meetings: DataFrame, judiciary_meetings: DataFrame, **how: object) -> dict[str, DataFrame]:
    """bills, committee_meetings and judiciary_meetings of a term; feeds and how are those of build_master.

    Bills have their known columns in the order of the tables' schema, others behind them, without helper columns. The
    meetings' tagged key becomes bill_id where they have none of their own; a bill has as many meetings as the feed has.
    """
    master = build_master(age, **feeds, **how)
    known = [c for c in SCHEMAS["bills"].names if c in master.columns]
    rest = [c for c in master.columns if c not in known and c not in HELPERS and not c.endswith(("_judge", "_detail"))]
    out = {"bills": master.select(*known, *rest)}
    for name, meetings in (("committee_meetings", committee_meetings), ("judiciary_meetings", judiciary_meetings)):
        t = lower(meetings)
        t = t.withColumnRenamed("_bill_id", "bill_id_tagged" if "bill_id" in t.columns else "bill_id")
        dates = {c: S.safe_date(F.col(c).cast("string")) for c in t.columns if c.endswith("_dt")}
        out[name] = t.withColumns({**dates, "age": F.lit(age)})
    return out


def lite_summary(bills: DataFrame) -> DataFrame:
    """Per term: total, bills of members and of the government, passed, enacted, and the percent passed."""
    kind = lambda k: F.count_if(F.col("ppsr_kind") == k)
    flag = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    out = bills.groupBy("age").agg(F.count(F.lit(1)).alias("total"), kind(V.MEMBER_KIND).alias("member"), kind(V.GOVERNMENT_KIND).alias("govt"), flag("passed").alias("passed"), flag("enacted").alias("enacted"))
    return out.withColumn("passed_percent", S.percent(F.col("passed"), F.col("total")))


def harmonised(t: DataFrame, committee: str = "committee_nm") -> DataFrame:
    """Committees under the names they have now."""
    return tables.recode(t, committee, V.COMMITTEE_NAMES)


def months_of_term(bills: DataFrame, kind: str = V.LAW_KIND) -> DataFrame:
    """Per term: bills in each month from its first bill's to its last one's, empty ones too, and the month's number in the term."""
    counts = stats.period_counts(bills.where(F.col("bill_kind") == kind), "ppsl_dt", "month", ["age"], fill=True)
    start = S.recoded(F.col("age").cast("string"), {str(k): v for k, v in V.TERM_STARTS.items()}, keep=False).cast("date")
    return counts.withColumn("month_of_term", S.months_from(F.year(start), F.month(start), "period"))


def search_bills(bills: DataFrame, keyword: str | None = None, age: int | None = None, committee: str | None = None, proposer: str | None = None, status: str | None = None, kind: str | None = None, date_from: str | None = None, date_to: str | None = None, limit: int = 20) -> tuple[DataFrame, DataFrame]:
    """The newest bills that fit, and how many do; words are patterns without regard to case."""
    return tables.search(bills, {"bill_nm": keyword, "committee_nm": committee, "proposer_text": proposer}, {"age": age, "bill_kind": kind}, ("status", V.STATUS_GROUPS[status]) if status else None, ("ppsl_dt", date_from, date_to), limit, [F.desc_nulls_last("ppsl_dt"), "bill_id"])


def search_bill_texts(bills: DataFrame, texts: DataFrame, keyword: str, age: int | None = None, limit: int = 20) -> tuple[DataFrame, DataFrame]:
    return tables.search(bills.join(texts, "bill_id"), {"propose_reason": keyword}, {"age": age}, limit=limit, order=[F.desc_nulls_last("ppsl_dt"), "bill_id"])


def bill_detail(bills: DataFrame, texts: DataFrame, ref: str) -> DataFrame:
    """The bill of an id (PRC_, ARC_) or else of a number, the first by id, with its text if there is one."""
    col = "bill_id" if ref.startswith(("PRC_", "ARC_")) else "bill_no"
    return bills.where(F.col(col) == ref).orderBy("bill_id").limit(1).join(texts, "bill_id", "left")


def timeline(bills: DataFrame, key: str, stages: Sequence[tuple[str, str]] = V.STAGES) -> DataFrame:
    """A row per bill and stage that has a date: its number, label, date and days since the first stage."""
    first = F.col(stages[0][1])
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("stage"), F.lit(label).alias("label"), F.col(c).alias("date")) for i, (label, c) in enumerate(stages)]))
    out = bills.select(key, first.alias("_first"), rows.alias("_r")).where("_r.date is not null")
    return out.select(key, "_r.*", F.datediff("_r.date", "_first").alias("days"))


def passage_rates(bills: DataFrame) -> DataFrame:
    """Per term, of bills on laws: how many, passed and enacted with their rates."""
    return stats.rate_table(bills.where(F.col("bill_kind") == V.LAW_KIND), ["age"], ["passed", "enacted"])


def funnel_stats(bills: DataFrame, age: int | None = None) -> DataFrame:
    laws = bills.where(F.col("bill_kind") == V.LAW_KIND)
    laws = laws if age is None else laws.where(F.col("age") == age)
    return stats.funnel(laws, [(label, [c]) for label, c in V.STAGES], exclude_mode_of="rgs_rsln_dt")


def export_bills(bills: DataFrame, age: int | None = None, committee: str | None = None, status: str | None = None, kind: str | None = None) -> DataFrame:
    """What fits, whole; write it with sources.sinks.export."""
    t = tables.keyword_filter(bills, "committee_nm", committee)
    t = t if age is None else t.where(F.col("age") == age)
    t = t if status is None else t.where(F.col("status").isin(*V.STATUS_GROUPS[status]))
    return t if kind is None else t.where(F.col("bill_kind") == kind)


def db_info(data: Mapping[str, DataFrame]) -> DataFrame:
    return stats.overview(data, (data["bills"], "ppsl_dt") if "bills" in data else None)
