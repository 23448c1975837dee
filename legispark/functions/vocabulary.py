"""Words and codes of the legislative data. They must equal those in the published data."""

from __future__ import annotations

LAW_KIND = "법률안"
MEMBER_KIND, GOVERNMENT_KIND = "의원", "정부"
PASSED = ["원안가결", "수정가결", "대안반영폐기"]
ENACTED = ["원안가결", "수정가결"]
PENDING = ["계류중"]
REJECTED = ["부결", "폐기", "철회"]
STATUS_GROUPS = {"passed": PASSED, "enacted": ENACTED, "pending": PENDING, "rejected": REJECTED}
STILL_PENDING, EXPIRED = "계류중", "임기만료폐기"

YES, NO, ABSTAIN, ABSENT = "찬성", "반대", "기권", "불참"
VOTE_LABELS = {"찬성의원": YES, "반대의원": NO, "기권의원": ABSTAIN, "불참의원": ABSENT}
VOTE_CODES = {YES: 1, NO: 6, ABSTAIN: 9}

#: Life of a bill: label and date column, in order.
STAGES = [("발의", "ppsl_dt"), ("소관위 회부", "committee_dt"), ("소관위 상정", "cmt_present_dt"), ("소관위 처리", "cmt_proc_dt"), ("법사위 회부", "law_submit_dt"), ("본회의 의결", "rgs_rsln_dt"), ("공포", "prom_dt")]

#: What ends an agenda item's title.
AGENDA_ENDS = ["의건", "법률안", "동의안", "결의안"]
VOTE_HEADERS = ["찬성의원", "반대의원", "기권의원", "투표의원", "불참의원"]
SKIPPED_HEADER = "투표의원"
PLENARY = "국회본회의"
SUCCESS_CODES = ["INFO-000"]

#: Columns of a member's vote, common and optional.
VOTE_COMMON = ["term", "meeting_id", "date", "member_name", "vote", "source"]
VOTE_OPTIONAL = ["bill_id", "bill_context", "party", "district", "member_id", "vote_event", "agg_total", "agg_yes"]

#: Names in the vote feed and ours.
VOTE_FEED = {"HG_NM": "member_name", "POLY_NM": "party", "ORIG_NM": "district", "MONA_CD": "member_id", "RESULT_VOTE_MOD": "vote", "BILL_ID": "bill_id", "VOTE_DATE": "date", "AGE": "term"}

#: Party to broad bloc.
BLOCS = {
    "국민의힘": "conservative", "미래통합당": "conservative", "미래한국당": "conservative", "자유한국당": "conservative", "우리공화당": "conservative", "친박신당": "conservative", "바른미래당": "conservative",
    "더불어민주당": "liberal", "열린민주당": "liberal", "민생당": "liberal", "민주평화당": "liberal", "새로운미래": "liberal",
    "정의당": "progressive", "조국혁신당": "progressive", "진보당": "progressive", "민중당": "progressive", "기본소득당": "progressive", "사회민주당": "progressive",
    "개혁신당": "centrist", "무소속": "independent", "국민의당": "centrist", "자유통일당": "conservative",
}
OTHER_BLOC = "other"

#: Party to display family.
FAMILIES = {
    "더불어민주당": "더불어민주당", "열린민주당": "더불어민주당 계열", "국민의힘": "국민의힘", "미래통합당": "국민의힘 계열", "미래한국당": "국민의힘 계열", "자유한국당": "국민의힘 계열",
    "정의당": "정의당", "조국혁신당": "조국혁신당", "진보당": "진보당", "개혁신당": "개혁신당", "무소속": "무소속",
}

#: Words that aren't names, in transcripts and in appendices.
NOISE_INLINE = ["의원", "의장", "부의장", "위원", "위원장", "국회", "선포", "가결", "부결", "투표", "재석", "결과", "성명", "본회의", "한나라당", "민주당", "열린우리당", "자유선진당", "민주노동당", "창조한국당", "진보신당", "무소속", "국민의힘", "더불어민주당", "새누리당", "바른미래당", "정의당", "국민의당"]
NOISE_APPENDIX = ["의원", "의장", "부의장", "위원", "위원장", "국회", "선포", "가결", "부결", "투표", "재석", "결과", "성명", "본회의", "한나라당", "민주당", "열린우리당", "자유선진당", "민주노동당", "새누리당", "통합민주당", "민주통합당", "새정치민주연합", "바른미래당", "정의당", "국민의당", "무소속", "진보신당", "창조한국당", "선진통일당", "자유한국당", "친박연대"]

#: What a meeting says when its votes are in the appendix.
APPENDIX_PHRASE = "성명은 끝에"

#: Committees' former names and what they are called now.
COMMITTEE_NAMES = {"환경노동위원회": "기후에너지환경노동위원회", "기획재정위원회": "재정경제기획위원회", "여성가족위원회": "성평등가족위원회"}

#: The month in which each term begins.
TERM_STARTS = {17: "2004-05-01", 18: "2008-05-01", 19: "2012-05-01", 20: "2016-05-01", 21: "2020-05-01", 22: "2024-05-01"}

# Columns of the feed of all members, under our names; the second group holds lists, one entry for each term.
MEMBER_FEED = {"NAAS_CD": "mona_cd", "NAAS_NM": "member_name", "NAAS_CH_NM": "member_name_hanja", "NAAS_EN_NM": "member_name_eng", "NTR_DIV": "sex", "BIRDY_DT": "birth_date", "RLCT_DIV_NM": "reelection", "NAAS_EMAIL_ADDR": "email", "NAAS_HP_URL": "homepage", "NAAS_PIC": "photo_url"}
MEMBER_LISTS = {"PLPT_NM": "party", "ELECD_NM": "district", "ELECD_DIV_NM": "election_type", "BLNG_CMIT_NM": "committee"}
MEMBER_TERMS = "GTELT_ERACO"
