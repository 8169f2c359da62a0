import pytest
from pyspark.sql import functions as F

from ledgerloom import constants as C
from ledgerloom.functions import contact, text
from tests.conftest import rows


def one(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v")).alias("x")).collect()]


def test_company_names(spark):
    given = ["(주)삼성전자", "주식회사 엘지", "(주식회사)현대", "삼 성 전 자", "삼성.전자(주)", "'삼성전자'", "Samsung Electronics", "", None, "(주) SK하이닉스.", "삼성　전자", "㈜삼성"]
    want = ["삼성전자", "엘지", "현대", "삼성전자", "삼성전자", "삼성전자", "samsungelectronics", "", "", "sk하이닉스", "삼성전자", "㈜삼성"]
    assert one(spark, given, text.normalized_name) == want
    assert one(spark, ["㈜삼성"], lambda c: text.normalized_name(c, True)) == ["삼성"]


def test_company_keys(spark):
    df = spark.createDataFrame([("123-45-67890", "테스트회사", None, None), ("12345", "테스트회사", "서울특별시", "강남구"), (None, "테스트회사", "서울특별시", "강남구"), ("", "테스트회사", "부산광역시", "강남구")], "a string, b string, c string, d string")
    keys = [r[0] for r in df.select(text.company_key("a", "b", "c", "d")).collect()]
    assert keys[0] == "1234567890"
    assert keys[1] == keys[2] == "ccc556ac1bf2cf60"
    assert keys[3] != keys[1] and len(keys[3]) == 16


def test_regions(spark):
    given = ["서울 강남구 x", "경기도 성남시 y", "충청북도 청주시", None, "", "　부산 해운대구", "강남구"]
    assert one(spark, given, text.province_of) == ["서울특별시", "경기도", None, None, None, "부산광역시", None]
    assert one(spark, given, lambda c: text.province_of(c, extended=True))[2] == "충청북도"
    assert one(spark, given, text.district_of) == ["강남구", "성남시", "청주시", None, None, "해운대구", None]


def test_numbers(spark):
    assert one(spark, ["1,234", " 5 ", "1d", "", None, "-3.5", "x", "1e3"], text.number) == [1234.0, 5.0, None, None, None, -3.5, None, 1000.0]


@pytest.mark.parametrize(("code", "want"), [("10", C.MANUFACTURING), ("29000", C.MANUFACTURING), ("33101", C.MANUFACTURING), ("58", C.IT), ("62010", C.IT), ("41", C.CONSTRUCTION), ("49", C.CONSTRUCTION), ("70", C.SERVICES), ("72100", C.SERVICES), ("99", None), ("", None), (None, None), ("C1", None), ("1", None)])
def test_industry_codes(spark, code, want):
    assert one(spark, [code], text.industry_category) == [want]


def test_dates(spark):
    given = ["2021-02-30", "20210228", "2021.2.3", "2021년 1월 4일", "2021/03/04", "2021-01-02 00:00:00", "0000-00-00", "미상", None, ""]
    got = one(spark, given, lambda c: text.real_date(c).cast("string"))
    assert got == [None, "2021-02-28", "2021-02-03", "2021-01-04", "2021-03-04", "2021-01-02", None, None, None, None]


def test_status_and_strip(spark):
    assert one(spark, ["영업중", " 영업/정상 ", "폐업", "기타", None], text.status_name) == ["가동중", "가동중", "폐업", "기타", None]
    assert one(spark, ["　a\t", None], text.strip) == ["a", None]


def test_email_extraction(spark):
    given = ["a@firm.kr, b@firm.kr; a@firm.kr", "x@example.com noreply@firm.kr", "logo@2x.png", None, "", "q@mail.sentry.io z@dailynews.kr w@uni.ac.kr ok@firm.co.kr."]
    assert one(spark, given, contact.extract_emails) == [["a@firm.kr", "b@firm.kr"], [], [], [], [], ["ok@firm.co.kr"]]


def test_outer_marks_of_found_addresses(spark):
    text = ".info@firm.kr -x@firm.kr sales_@firm.kr %a@firm.kr b+@firm.kr in.fo@firm.kr"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(contact.extract_emails("t")).first()[0] == ["in.fo@firm.kr"]


def test_email_validity(spark):
    given = ["a@firm.kr", "A@FIRM.KR.", "a@x", "-a@firm.kr", "admin@firm.kr", "a@b.zip", None, "a" * 90 + "@firm.kr", "a@sub.kakao.com"]
    assert one(spark, given, contact.valid_email) == [True, True, False, False, False, False, False, False, False]


def test_hosts_and_bases(spark):
    assert one(spark, ["https://www.firm.co.kr:80/x?y", "firm.kr", None, "HTTP://WWW.F.KR"], contact.url_host) == ["firm.co.kr:80", "", "", "f.kr"]
    assert one(spark, ["company.co.kr", "firm.com", "a.net", ""], contact.domain_base) == ["pany", "firm", "a", ""]


def test_relations(spark):
    df = spark.createDataFrame([("ad@lons.co.kr", "http://other.kr"), ("s@firm.com", "http://firm.co.kr"), ("x@naver.com", "http://other.kr"), ("x@firm.kr", ""), ("x@firm.kr", "http://blog.naver.com/1"), (None, None)], "e string, u string")
    assert [r[0] for r in df.select(contact.cross_domain_noise("e", "u")).collect()] == [True, False, False, False, False, False]


def test_verdicts(spark):
    df = spark.createDataFrame([("a@firm.kr", "see https://zdnet.co.kr/1"), ("a@firm.kr", "Homepage: http://firm.com"), ("a@naver.com", "http://firm.kr"), ("a@firm.kr", "text"), ("a@firm.kr", None)], "e string, s string")
    assert [r[0] for r in df.select(contact.rule_verdict("e", "s")).collect()] == [False, True, None, None, None]
    assert [r[0] for r in df.select(contact.accepted_email("e", "s", F.lit(False))).collect()] == [False, True, False, False, False]


def test_scores(spark):
    df = spark.createDataFrame([("info@firm.kr", "http://firm.kr", "homepage", False), ("kim@naver.com", "http://firm.kr", "naver_snippet", None), ("x", "", "", None), ("info@firm.kr", "http://firm.kr", C.FLAG_PREFIX + "homepage", None), ("a.b@z.kr", None, None, True), (None, None, None, None)], "e string, u string, m string, f boolean")
    assert [r[0] for r in df.select(contact.score_email("e", "u", "m", "f")).collect()] == [100, 5, -999, 0, -100, -999]


def test_domains_below(spark):
    df = spark.createDataFrame([("a.b.kr",), ("b.kr",), ("xb.kr",), (None,)], "d string")
    assert rows(df.select(contact.in_domains("d", ["b.kr"]))) == [(False,), (False,), (True,), (True,)]
    assert rows(df.select(contact.in_domains("d", []))) == [(False,)] * 4
