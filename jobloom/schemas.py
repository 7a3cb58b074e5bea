"""Tables of the engine. Column order is that of the delimited sources."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _names(text: str) -> list[str]:
    return text.split()


# Column names and their order in the sources.
JK = _names("pst_id pst_title co_nm loc snr rnk pr_item pr_maj edu typ sal time pst_strt pst_end co_ind co_hr pst_detail corp_addr")
JKHD = _names("pst_id typ cl_info wc qual co_hr co_nm pst_detail")
SRM = _names("pst_id pst_title co_nm loc snr rnk pr_item edu typ sal time pst_strt pst_end pst_detail rep corp_addr")
COMPANY = _names("bzno title address phone region bonid bon_add bon_address bon_phone bon_title bon_info ksic ksic9")
SKILL = _names("skill_code code0 code1 code2 code3 main sub detail skill_name softskill ext_key")
MERGED = _names(
    "pst_id pst_title co_nm loc snr rnk edu typ sal time pst_strt pst_end pst_detail pr_maj co_ind co_hr cl_info wc qual pr_item rep corp_addr source year month"
)
EXPORT = _names(
    "pst_id snr rnk edu typ sal time co_nm pr_maj co_ind qual source year month matched_company_name bzno skill_code keco_4 keco_t skill_name main sub detail code0 code1 code2 code3 softskill ksic ksic9"
)

SOURCES = {"jk": JK, "jkhd": JKHD, "srm": SRM}
#: A posting in several sources is kept from the first of these.
PRECEDENCE = ("jk", "jkhd", "srm")

_TYPES = {"year": T.IntegerType(), "month": T.IntegerType(), "pst_strt": T.TimestampNTZType(), "pst_end": T.TimestampNTZType(), "softskill": T.IntegerType()}


def merged() -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES.get(n, T.StringType())) for n in MERGED])


def skills() -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES.get(n, T.StringType())) for n in SKILL])


OCCUPATION = T.StructType([T.StructField("target", T.IntegerType()), T.StructField("keco_4", T.StringType()), T.StructField("keco_t", T.StringType())])
LEDGER = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("table_name", T.StringType()), T.StructField("processed_at", T.TimestampType()), T.StructField("status", T.StringType())])
#: States of a file in the ledger.
PROCESSING, COMPLETED, FAILED = "PROCESSING", "COMPLETED", "FAILED"
