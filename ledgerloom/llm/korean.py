"""Korean names, addresses and numbers in one comparable form, whatever script and notation they came in.

Syllables are romanized letter by letter, so that Korean and English writings of
one name meet. In names of companies, vowels that are taken for each other (one
stroke, one key or one sound apart) fall together, so that the usual typing
errors vanish before names are scored. The parts of addresses are kept as they
are spelled: two streets may differ in one vowel.
"""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

# --- fixed values: romanization of leading consonants, vowels and final consonants, in Unicode order ---
LEADS = ["g", "kk", "n", "d", "tt", "r", "m", "b", "pp", "s", "ss", "", "j", "jj", "ch", "k", "t", "p", "h"]
VOWELS = ["a", "ae", "ya", "yae", "eo", "e", "yeo", "ye", "o", "wa", "wae", "oe", "yo", "u", "wo", "we", "wi", "yu", "eu", "ui", "i"]
FINALS = ["", "k", "k", "k", "n", "n", "n", "t", "l", "k", "m", "l", "l", "l", "p", "l", "m", "p", "p", "t", "t", "ng", "t", "t", "k", "t", "p", "t"]

# --- fixed values: spellings of the provinces beside the official one ---
PROVINCE_FORMS = {
    "서울특별시": ["서울시", "서울", "seoul"],
    "부산광역시": ["부산시", "부산", "busan"],
    "대구광역시": ["대구시", "대구", "daegu"],
    "인천광역시": ["인천시", "인천", "incheon"],
    "광주광역시": ["광주시", "광주", "gwangju"],
    "대전광역시": ["대전시", "대전", "daejeon"],
    "울산광역시": ["울산시", "울산", "ulsan"],
    "세종특별자치시": ["세종시", "세종", "sejong"],
    "경기도": ["경기", "gyeonggi-do", "gyeonggi"],
    "강원특별자치도": ["강원도", "강원", "gangwon-do", "gangwon"],
    "충청북도": ["충북도", "충북", "chungcheongbuk-do", "chungbuk-do", "chungbuk"],
    "충청남도": ["충남도", "충남", "chungcheongnam-do", "chungnam-do", "chungnam"],
    "전북특별자치도": ["전라북도", "전북도", "전북", "jeonbuk-do", "jeollabuk-do", "jeonbuk"],
    "전라남도": ["전남도", "전남", "jeollanam-do", "jeonnam-do", "jeonnam"],
    "경상북도": ["경북도", "경북", "gyeongsangbuk-do", "gyeongbuk-do", "gyeongbuk"],
    "경상남도": ["경남도", "경남", "gyeongsangnam-do", "gyeongnam-do", "gyeongnam"],
    "제주특별자치도": ["제주도", "제주시", "제주", "jeju-do", "jeju"],
}
PROVINCE_OF = {form: name for name, forms in PROVINCE_FORMS.items() for form in [name, *forms]}

# --- fixed values: lines of business as Korean names end in them, and in English ---
BUSINESS = {
    "산업": "industry", "테크": "tech", "전자": "electronics", "푸드": "food", "화학": "chemical", "금속": "metal",
    "기계": "machinery", "정밀": "precision", "시스템": "system", "소프트": "soft", "데이터": "data", "클라우드": "cloud",
    "정보기술": "infotech", "랩스": "labs", "연구소": "institute", "디자인": "design", "미디어": "media", "기획": "planning",
    "상사": "trading", "컨설팅": "consulting", "물류": "logistics", "종합건설": "builders", "건설": "construction",
    "조경": "landscape", "환경": "environment", "시설관리": "facility", "패키지": "package", "엔지니어링": "engineering",
}
_LEGAL = re.compile(r"\((?:주|유|사|재|합|株|有)\)|㈜|주식회사|유한회사|유한책임회사|합자회사|합명회사|사단법인|재단법인|株式會社|有限會社|株式会社")
_ENGLISH_LEGAL = re.compile(r"(?i)[\s,]*\b(?:co\.?\s*,?\s*ltd\.?|co\.?|ltd\.?|inc\.?|corp\.?|corporation|company|llc)\s*$")
_NOTE = re.compile(r"(?:\s*(?:\([^()]*(?:상호|변경|이전|폐업|휴업|본사|지점|지사|공장)[^()]*\)|\s(?:본사|본점|지점|지사|영업소|출장소|사업장|사업소|제?\s?\d*\s?공장|제?\s?\d*\s?지점)))+\s*$")


def plain(text: str | None) -> str:
    """One width, single blanks, no outer ones."""
    return " ".join(unicodedata.normalize("NFKC", text or "").split())


def romanized(text: str) -> str:
    out = []
    for ch in text:
        c = ord(ch) - 0xAC00
        out.append(LEADS[c // 588] + VOWELS[c % 588 // 28] + FINALS[c % 28] if 0 <= c < 11172 else ch.lower())
    return "".join(out)


_VOWEL_CLASSES = [(re.compile("yae|ya|ae"), "a"), (re.compile("yeo|eo|ye"), "e"), (re.compile("wae|wa|oe|yo"), "o"), (re.compile("we|wo|yu"), "u"), (re.compile("wi|ui"), "i")]


def sound(text: str) -> str:
    """Letters and digits in Latin script with like vowels made equal."""
    s = re.sub(r"[\W_]+", "", romanized(text))
    for pattern, to in _VOWEL_CLASSES:
        s = pattern.sub(to, s)
    return s


_BUSINESS_SOUNDS = sorted(((sound(k), v) for k, v in BUSINESS.items()), key=lambda kv: -len(kv[0]))
_ENGLISH_BUSINESS = sorted(set(BUSINESS.values()), key=len, reverse=True)


def company(name: str | None) -> tuple[str, str]:
    """(core, line of business) of a company's name; '' for what is missing. Legal forms and notes are left out."""
    s = plain(name)
    s = _NOTE.sub("", " " + s)
    s = _LEGAL.sub(" ", s).strip()
    s = _NOTE.sub("", " " + s).strip()
    while (t := _ENGLISH_LEGAL.sub("", s)) != s:
        s = t.strip()
    words = s.split()
    if len(words) > 1 and words[-1].lower() in _ENGLISH_BUSINESS:
        return sound("".join(words[:-1])), words[-1].lower()
    core = sound(s)
    for ending, line in _BUSINESS_SOUNDS:
        if core.endswith(ending) and len(core) > len(ending) + 1:
            return core[: -len(ending)], line
    return core, ""


#: Stands before a word that is a district only if other addresses have it.
MAYBE = "?"


class Address(NamedTuple):
    """The parts that tell where a building stands, as they are spelled; '' for what isn't given."""

    province: str
    district: str  # without its ending, unless only one syllable would be left
    road: str  # road, or neighbourhood of a lot; Korean, or Latin in lower case
    side: str  # number of a side road
    number: str  # building number, or lot number (s: mountain lot)
    area: str  # neighbourhood given with a road address


_POSTAL = re.compile(r"^\s*(?:[\[(]\s*\d{5}\s*[\])]|우?\s?\d{5}(?=\s))\s*")
_ROAD = re.compile(r"(?:^|\s)([가-힣]+(?:로|길|대로))\s*(?:(\d+)\s*번?\s*길\s*)?(\d+)(?:\s*(?:-|의|–|—)\s*(\d+))?(?!\d)")
_LOT = re.compile(r"([가-힣]+(?:동|읍|면|리|가))\s*(산)?\s*(\d+)\s*(?:번지)?\s*(?:(?:-|의)?\s*(\d+)\s*호?)?(?=[\s,(]|$)")
_DISTRICT = re.compile(r"^[가-힣]+[시군구]$")
_ENGLISH_ROAD = re.compile(r"^([a-z]+)-(ro|gil|daero)(?:\s+(\d+)(?:beon)?-gil)?$")


_SPELLED, _AREA = re.compile(r"[가-힣]+"), re.compile(r"[가-힣]+(?:동|읍|면|리)")
_NOTES, _IN_LATIN = re.compile(r"\(([^)]*)\)"), re.compile(r"(?i)[a-z]-(?:ro|gil|daero)\b")
_LATIN_NUMBER, _LATIN_DISTRICT = re.compile(r"(\d+)(?:-(\d+))?"), re.compile(r"([a-z]+)-(si|gun|gu)")


def _region(words: list[str]) -> tuple[str, str]:
    province = district = ""
    for w in words:
        if not province and w in PROVINCE_OF:
            province = PROVINCE_OF[w]
        elif not district and _SPELLED.fullmatch(w):
            district = w[:-1] if len(w) > 2 and w[-1] in "시군구" else w
    return province, district


def _number(first: str, second: str | None, before: str = "") -> str:
    return f"{before}{int(first)}-{int(second)}" if second else f"{before}{int(first)}"


def road_address(text: str | None) -> Address | None:
    """The parts of a road address in either script and any order, or None."""
    s = _POSTAL.sub("", plain(text))
    area, body = "", s
    if "(" in s:
        area = next((x.strip() for n in _NOTES.findall(s) for x in n.split(",") if _AREA.fullmatch(x.strip())), "")
        body = _NOTES.sub(" ", s)
    if _IN_LATIN.search(body):
        return _english(body, area)
    m = _ROAD.search(body)
    if not m:
        return None
    road, side, first, second = m.groups()
    after = [w for w in body[m.end() :].split() if w in PROVINCE_OF or _DISTRICT.match(w)]
    province, district = _region(body[: m.start()].split() + after)
    if not district and not body[: m.start()].strip():
        # The region may follow without its ending; whether the word is a district the table tells.
        words = body[m.end() :].split()
        district = MAYBE + words[-1] if words and words[-1] not in PROVINCE_OF and _SPELLED.fullmatch(words[-1]) else ""
    return Address(province, district, road, str(int(side)) if side else "", _number(first, second), area)


def _english(body: str, area: str) -> Address | None:
    province = district = road = side = number = ""
    for part in body.lower().split(","):
        part = part.strip()
        if m := _ENGLISH_ROAD.match(part):
            road, side = m.group(1) + m.group(2), str(int(m.group(3))) if m.group(3) else ""
        elif m := _LATIN_NUMBER.fullmatch(part):
            number = _number(*m.groups())
        elif part in PROVINCE_OF:
            province = PROVINCE_OF[part]
        elif not district and (m := _LATIN_DISTRICT.fullmatch(part)):
            # Of a name of one syllable the ending is a part, as it is in Korean.
            district = m.group(1) + (m.group(2) if len(re.findall("[aeiouwy]+", m.group(1))) == 1 else "")
    return Address(province, district, road, side, number, area) if road and number else None


def lot_address(text: str | None) -> Address | None:
    """The parts of a lot address, or None."""
    s = _POSTAL.sub("", plain(text))
    s = _NOTES.sub(" ", s) if "(" in s else s
    m = _LOT.search(s)
    if not m:
        return None
    place, mountain, first, second = m.groups()
    province, district = _region(s[: m.start()].split())
    return Address(province, district, place, "", _number(first, second, "s" if mountain else ""), "")


def phone(text: str | None) -> str:
    """The national digits of a telephone number without extension and range, '' if there is none."""
    s = plain(text)
    s = re.sub(r"(?i)(?:내선|ext\.?|교환|~).*$", "", s)
    s = re.sub(r"\+\s*82", "0", s)
    d = re.sub(r"\D", "", s)
    d = re.sub(r"^00", "0", d)
    return d if len(d) >= 8 and len(set(d)) > 2 else ""


def registration(text: str | None) -> str:
    """The digits of a registration number, complete or not; '' for fillers."""
    d = re.sub(r"\D", "", unicodedata.normalize("NFKC", text or ""))
    return d if 4 <= len(d) <= 10 and len(set(d)) > 1 else ""
