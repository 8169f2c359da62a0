"""Registries described as data: which header feeds which column of the unified schema.

A rule names a target and alternatives; an alternative is the parts a header
must all contain. A header takes the first rule that fits; of several headers
with one target the first keeps it. New sources need a ``SourceSpec`` only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators.master import keep_first, with_ordinal


@dataclass(frozen=True)
class Rule:
    """Headers that contain all parts of one alternative (``exact``: that are one of them) feed ``target``."""

    target: str
    alternatives: Sequence[Sequence[str]]
    exact: bool = False
    upper: bool = False

    def fits(self, header: str) -> bool:
        h = header.strip()
        if self.exact:
            return any(h == a[0] for a in self.alternatives)
        u = h.upper()
        return any(all(p in (u if self.upper and p.isascii() else h) for p in a) for a in self.alternatives)


def named(target: str, *headers: str) -> Rule:
    return Rule(target, [(h,) for h in headers], exact=True)


def containing(target: str, *alternatives: str | tuple[str, ...], upper: bool = False) -> Rule:
    return Rule(target, [(a,) if isinstance(a, str) else a for a in alternatives], upper=upper)


@dataclass(frozen=True)
class SourceSpec:
    source_id: str
    page_url: str
    rules: Sequence[Rule]
    region_from_address: bool = True
    map_status: bool = False
    kind: str = "table"


# --- fixed values: pages and header words of the nine registries ---
_DATA = "https://www.data.go.kr/data/{}/{}.do"
_HOMEPAGE = containing("homepage", "홈페이지", "URL", upper=True)
_PHONE = containing("phone", "전화", "연락")
_NUMBER = containing("biz_reg_no", ("사업자", "번호"))

SPECS = {
    s.source_id: s
    for s in [
        SourceSpec("15105482", _DATA.format("15105482", "fileData"), [
            containing("biz_reg_no", ("사업자", "번호"), ("사업자", "등록")),
            containing("company_name_raw", "회사", "업체", "기업"),
            containing("representative", "대표"),
            containing("industry_code", ("업종", "코드")),
            containing("industry_name", "업종"),
            containing("road_address", ("도로명", "주소")),
            containing("lot_address", ("지번", "주소")),
            containing("road_address", "주소"),
            _PHONE,
            containing("employees", "종업원", "직원", "인원"),
            containing("capital", "자본금"),
            containing("operating_status", "가동", "상태"),
            containing("registered_on", "설립", "등록일", "인가"),
            containing("industry_name", "생산", "품목"),
            _HOMEPAGE,
        ]),
        SourceSpec("15057023", _DATA.format("15057023", "openapi"), [
            named("company_name_raw", "COMPNY_GRP_NM", "CMPNY_NM"),
            named("road_address", "REFINE_ROADNM_ADDR"),
            named("lot_address", "REFINE_LOTNO_ADDR"),
            named("phone", "TELNO"),
            named("industry_name", "PRDT_INFO", "INDUTYPE_DESC_DTCONT"),
            named("industry_code", "INDUTYPE_CD_INFO"),
            named("employees", "EMPLY_CNT"),
            named("registered_on", "FACTRY_REGIST_DE"),
            named("", "LOT_AR"),
            named("company_name_raw", "업체명", "회사명", "기업체명"),
            containing("biz_reg_no", ("사업자", "번호"), ("사업자", "등록")),
            containing("representative", "대표자", "REPRSNT", upper=True),
            containing("operating_status", "가동", "OPERTN", upper=True),
        ], kind="json"),
        SourceSpec("15052274", _DATA.format("15052274", "fileData"), [
            _NUMBER,
            containing("company_name_raw", "업체", "회사", "기업"),
            containing("representative", ("대표", "자")),
            containing("industry_name", "업종"),
            containing("road_address", "주소"),
            _PHONE,
            _HOMEPAGE,
            containing("employees", "종업원", "직원"),
        ]),
        SourceSpec("innobiz", "https://www.innobiz.net/company/company2_list.asp", [
            named("company_name_raw", "회사명"),
            named("industry_name", "업종"),
            named("province", "지역"),
            named("registered_on", "인증일"),
        ], region_from_address=False),
        SourceSpec("15118569", _DATA.format("15118569", "fileData"), [
            containing("biz_reg_no", "사업자"),
            containing("company_name_raw", "업체", "회사", "기업", "상호"),
            containing("representative", "대표"),
            containing("road_address", "주소"),
            _PHONE,
            containing("registered_on", ("등록", "일")),
        ]),
        SourceSpec("15086381", _DATA.format("15086381", "openapi"), [
            containing("company_name_raw", "기업", "회사", "업체"),
            containing("representative", "대표"),
            containing("road_address", "주소", "소재"),
            _PHONE,
            containing("industry_name", "분류", "분야"),
            containing("employees", "인력", "직원"),
            _HOMEPAGE,
        ], kind="json"),
        SourceSpec("15099307", _DATA.format("15099307", "fileData"), [
            _NUMBER,
            containing("company_name_raw", "업체", "회사", "기업"),
            containing("representative", "대표"),
            containing("road_address", "소재", "주소"),
            _PHONE,
            containing("industry_name", "업종", "분야"),
            containing("registered_on", "승인", ("신고", "일")),
        ]),
        SourceSpec("15065485", _DATA.format("15065485", "standard"), [
            named("company_name_raw", "ncrGsKname"),
            named("representative", "ncrGsMaster"),
            named("road_address", "ncrGsAddr"),
            named("registered_on", "ncrGsRegdate"),
            named("industry_name", "ncrItemName"),
            named("biz_reg_no", "ncrMasterNum"),
            named("phone", "ncrOffTel"),
            _NUMBER,
            containing("company_name_raw", "업체", "회사", "상호"),
            containing("representative", ("대표", "자")),
            containing("road_address", ("도로명", "주소")),
            containing("lot_address", "지번"),
            containing("road_address", "소재", "주소"),
            _PHONE,
            containing("industry_name", "업종"),
            containing("registered_on", "면허", ("등록", "일")),
            containing("capital", "자본금"),
        ], kind="envelope"),
        SourceSpec("15071341", _DATA.format("15071341", "fileData"), [
            named("company_name_raw", "사업장명", "업소명"),
            named("phone", "전화번호", "소재지전화번호"),
            named("lot_address", "지번주소", "소재지지번주소"),
            named("road_address", "도로명주소", "소재지도로명주소"),
            named("operating_status", "영업상태명"),
            named("registered_on", "인허가일자"),
        ], map_status=True),
    ]
}


def header_map(headers: Sequence[str], rules: Sequence[Rule]) -> dict[str, str]:
    """target -> header, by the first fitting rule of each header; the first header of a target keeps it."""
    out: dict[str, str] = {}
    for header in headers:
        target = next((r.target for r in rules if r.fits(header)), None)
        if target and target not in out:
            out[target] = header
    return out


def detect_column(headers: Sequence[str], aliases: Sequence[str]) -> str | None:
    """The header that fits the earliest alias: equal up to case and outer blanks, else containing it."""
    low = [(h, h.strip().lower()) for h in headers]
    for alias in aliases:
        a = alias.lower()
        for fits in (lambda x: x == a, lambda x: a in x):  # noqa: B023
            if hit := next((h for h, x in low if fits(x)), None):
                return hit
    return None


def conform(df: DataFrame) -> DataFrame:
    """The unified columns in order and type; missing ones are NULL, others dropped."""
    return df.select(*(F.col(n).cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, _, t in C.UNIFIED))


def empty_unified(spark) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, _, t in C.UNIFIED))


def normalize_source(df: DataFrame, spec: SourceSpec, collected_on: str) -> DataFrame:
    """A registry's raw table in the unified schema, one row per company_key (the first in file order).

    A column that the source lacks is NULL, a value it leaves empty ''. The clock
    is a parameter. ``row_ordinal`` may give the file order; else the scan does.
    """
    raw = df if "row_ordinal" in df.columns else with_ordinal(df)
    given = header_map([c for c in raw.columns if c != "row_ordinal"], spec.rules)
    at = lambda c: F.col(f"`{c.replace('`', '``')}`")
    rows = raw.select("row_ordinal", *(F.coalesce(at(h).cast("string"), F.lit("")).alias(t) for t, h in given.items()))
    if "company_name_raw" not in given:
        rows = rows.withColumn("company_name_raw", F.lit(""))
    rows = rows.withColumn("company_name", T.strip("company_name_raw"))
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    if spec.region_from_address:
        # The column decides, not the row: lot addresses count only where the source has no road addresses.
        address = have("road_address" if "road_address" in rows.columns else "lot_address")
        rows = rows.withColumns({"province": T.province_of(address), "district": T.district_of(address)})
    for c in ("employees", "capital", "revenue"):
        if c in rows.columns:
            rows = rows.withColumn(c, T.number(c))
    if spec.map_status and "operating_status" in rows.columns:
        rows = rows.withColumn("operating_status", T.status_name("operating_status"))
    rows = rows.withColumn("company_key", T.company_key(have("biz_reg_no"), "company_name", have("province"), have("district")))
    lineage = {"source_dataset_id": spec.source_id, "source_page_url": spec.page_url, "source_ids": spec.source_id, "category": "", "collected_on": collected_on}
    rows = rows.withColumns({k: F.lit(v) for k, v in lineage.items()})
    return conform(keep_first(rows, ["company_key"]))
