"""Names, keys, regions, numbers and industry codes as Spark columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Outer white space of any kind removed; NULL stays NULL."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def filled(c: str | Column) -> Column:
    """True where a value is neither NULL nor blank, never NULL."""
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def _alternatives(words: Iterable[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def normalized_name(c: str | Column, square_form: bool = False) -> Column:
    """A company's name without legal forms, marks, white space and case; NULL gives ''.

    ``square_form`` also takes the one-character legal form off, as the flow
    for user spreadsheets does.
    """
    forms = [*C.LEGAL_FORMS, *([C.SQUARE_LEGAL_FORM] if square_form else [])]
    s = F.regexp_replace(F.coalesce(col(c), F.lit("")), _alternatives(forms), "")
    s = F.regexp_replace(s, "[" + re.escape(C.NAME_MARKS) + "]", "")
    return F.lower(F.regexp_replace(s, r"(?U)\s+", ""))


def digits(c: str | Column) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def company_key(reg_no: str | Column, name: str | Column, province: str | Column, district: str | Column) -> Column:
    """The ten digits of a registration number, else 16 hex digits over name and region.

    Never NULL: missing parts count as ''.
    """
    number = digits(F.coalesce(col(reg_no), F.lit("")))
    parts = [normalized_name(name), *(strip(F.coalesce(col(c), F.lit(""))) for c in (province, district))]
    hashed = F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)
    return F.when(F.length(number) == 10, number).otherwise(hashed)


def province_of(address: str | Column, extended: bool = False) -> Column:
    """The official province an address starts with, or NULL.

    Full spellings such as 충청북도 are only known with ``extended``.
    """
    a, out = strip(address), None
    for start, name in {**C.PROVINCES, **(C.PROVINCE_SPELLINGS if extended else {})}.items():
        out = (F if out is None else out).when(a.startswith(start), F.lit(name))
    return out


def district_of(address: str | Column) -> Column:
    """The second word of an address if it ends in 시, 군 or 구, or NULL."""
    word = F.get(F.split(strip(address), r"(?U)\s+"), F.lit(1))
    return F.when(word.rlike("[시군구]$"), word)


def number(c: str | Column) -> Column:
    """A decimal number without thousands separators, or NULL; never fails."""
    s = strip(F.replace(col(c), F.lit(","), F.lit("")))
    return F.when(s.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), s.try_cast("double"))


def status_name(c: str | Column) -> Column:
    """Operating states under their common name; others unchanged, NULL stays NULL."""
    s, out = strip(c), None
    for source, target in C.STATUS_NAMES.items():
        out = (F if out is None else out).when(s == source, F.lit(target))
    return out.otherwise(s)


def industry_category(code: str | Column, ranges=None) -> Column:
    """The category of an industry code by its first two characters, or NULL.

    Ranges are spelled out as equalities on text: 'C1' or '1' match nothing.
    """
    prefix, out = F.substring(strip(code), 1, 2), None
    for first, last, category in C.INDUSTRY_RANGES if ranges is None else ranges:
        out = (F if out is None else out).when(prefix.isin([f"{i:02d}" for i in range(first, last + 1)]), F.lit(category))
    return out


def literal_map(pairs: dict, key: Column) -> Column:
    """A small constant lookup; NULL for an unknown or NULL key."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), F.coalesce(key, F.lit("")))


def source_category(source: str | Column, mapping=None) -> Column:
    return literal_map(C.SOURCE_CATEGORY if mapping is None else mapping, col(source))


def source_priority(source: str | Column, mapping=None) -> Column:
    return F.coalesce(literal_map(C.SOURCE_PRIORITY if mapping is None else mapping, col(source)), F.lit(C.UNKNOWN_PRIORITY))


def category_of(source: str | Column, code: str | Column) -> Column:
    """Industry code before registry before the services category; never NULL."""
    return F.coalesce(industry_category(code), source_category(source), F.lit(C.SERVICES))


def real_date(c: str | Column) -> Column:
    """A date in any of the usual notations, or NULL if it can't be one.

    Year-first notations with -, ., /, spaces or 년/월/일 between the parts, eight
    plain digits, and any of them followed by a time of day.
    """
    m = r"^\s*(\d{4})\s*[-./년]?\s*(\d{1,2})\s*[-./월]?\s*(\d{1,2})\s*[.일]?(?:[\sT].*)?$"
    s = F.coalesce(strip(c), F.lit(""))
    plain = F.when(s.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2)))
    spaced = F.when(
        s.rlike(m) & s.rlike(r"^\d{4}\D"),
        F.concat_ws("-", F.regexp_extract(s, m, 1), F.lpad(F.regexp_extract(s, m, 2), 2, "0"), F.lpad(F.regexp_extract(s, m, 3), 2, "0")),
    )
    return F.coalesce(plain, spaced).try_cast("date")


def seeded_order(seed: int, *keys: str | Column) -> Column:
    """A random but reproducible order: the same in any engine with SHA-256."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(col(k).cast("string"), F.lit("")) for k in keys)), 256)
