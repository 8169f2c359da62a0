import pytest
from pyspark.sql import functions as F

from ledgerloom import constants as C
from ledgerloom.plans import discovery, table_flow
from tests.conftest import rows

RESULTS = "query string, engine string, rank int, url string, title string, snippet string, address string"


def companies(spark, *data):
    return spark.createDataFrame(list(data), "company_key string, company_name string, homepage string")


def pages(spark, *data):
    return spark.createDataFrame(list(data), "url string, html string")


def results(spark, *data):
    return spark.createDataFrame(list(data), RESULTS)


def test_queries(spark):
    got = rows(discovery.search_queries(companies(spark, ("a", "가나", "http://www.wonik.com/x"), ("b", None, ""))).where("company_key = 'a'").select("query"))
    assert got == sorted([("가나 이메일",), ("가나 공식 홈페이지",), ('"가나" "@"',), ("site:wonik.com 이메일",), ("site:wonik.com contact",)])


def test_phases_and_order(spark):
    c = companies(spark, ("a", "A", "http://a.kr"), ("b", "B", None), ("z", "Z", "http://"))
    r = results(
        spark,
        ("B 이메일", "naver_webkr", 1, "http://b.kr", "t", "s info@b.kr", None),
        ("B 이메일", "naver_webkr", 2, "http://facebook.com/b", "t", "x@b2.kr", None),
        ("B 공식 홈페이지", "duckduckgo", 1, "http://b.kr", "t", "again kim@b.kr", None),
        ("B 이메일", "naver_local", 1, "http://b.kr/file.PDF", "t", "", "주소 ceo@b.kr"),
        ("A 이메일", "naver_webkr", 1, "http://a.kr", "t", "never@a.kr", None),
        ("B 이메일", "naver_webkr", 11, "http://deep.kr", "t", "deep@b.kr", None),
    )
    p = pages(spark, ("http://a.kr", '<a href="/contact">c</a> info@a.kr third@zzz.net'), ("http://a.kr/contact", "sales@a.kr info@a.kr"), ("http://b.kr", "lee@b.kr info@b.kr"), ("http://b.kr/file.PDF", "pdf@b.kr"))
    out = discovery.discover(c, r, p)
    assert rows(out.select("company_key", "place", "email", "method")) == [
        ("a", 1, "info@a.kr", "homepage_direct"), ("a", 2, "sales@a.kr", "homepage_direct"),
        ("b", 1, "info@b.kr", "naver_webkr_snippet"), ("b", 2, "ceo@b.kr", "naver_local_snippet"), ("b", 3, "lee@b.kr", "homepage"),
    ]
    assert out.where("flagged").count() == 0
    no = discovery.discover(c, r, p, classifier=lambda name, email, text: F.lit(False))
    assert rows(no.where("flagged").select("email")) == [("ceo@b.kr",), ("info@b.kr",)]


def test_cap(spark):
    c = companies(spark, ("a", "A", None))
    many = " ".join(f"m{i}@a.kr" for i in range(15))
    r = results(spark, ("A 이메일", "naver_webkr", 1, "http://a.kr", "", many, None), ("A 이메일", "naver_webkr", 2, "http://a.kr/2", "", "", None))
    p = pages(spark, ("http://a.kr", "p1@a.kr p2@a.kr"), ("http://a.kr/2", "p3@a.kr"))
    got = [r_[0] for r_ in discovery.discover(c, r, p).orderBy("place").select("email").collect()]
    assert len(got) == 16 and got[-1] == "p1@a.kr"
    # The one page still visited has no address: no other is visited for one.
    bare = pages(spark, ("http://a.kr", "none here"), ("http://a.kr/2", "p3@a.kr"))
    assert discovery.discover(c, r, bare).count() == discovery.discover(c, r, bare.where("url != 'http://a.kr'")).count() == 15
    few = discovery.discover(c, results(spark, ("A 이메일", "naver_webkr", 1, "http://a.kr", "", "m@a.kr", None)), p, most_emails=2)
    assert [x[0] for x in few.orderBy("place").select("email").collect()] == ["m@a.kr", "p1@a.kr"]


def test_first_hit(spark):
    c = companies(spark, ("a", "A", "http://a.kr"), ("b", "B", None), ("c", "C", None))
    r = results(spark, ("B 이메일", "naver_local", 1, "http://b.kr", "", "local@b.kr", None), ("B 이메일", "duckduckgo", 1, None, "", "ddg@b.kr", None), ("B 공식 홈페이지", "naver_webkr", 1, "u", "", "late@b.kr", None))
    p = pages(spark, ("http://a.kr", "admin@a.kr kim@a.kr"))
    assert rows(discovery.first_hit(c, r, p).select("company_key", "email", "method")) == [("a", "kim@a.kr", "homepage_direct"), ("b", "ddg@b.kr", "duckduckgo_snippet")]


def test_table_flow(spark):
    df = spark.createDataFrame([(1, "㈜가나", ""), (2, "", ""), (3, "새회사", "http://n.kr"), (4, "실패", ""), (5, "없음", ""), (6, "빈칸", ""), (7, "건너뜀", "")], "no int, `업체명` string, `홈페이지` string").coalesce(1)
    state = spark.createDataFrame(
        [("가나", "x@g.kr", "u", "m", "collected"), ("(주)가나", "y@g.kr", "u", "m", "collected"), ("실패", "", None, None, "failed"), ("빈칸", "", None, None, "collected"), ("건너뜀", "", None, None, "skipped")],
        "company_name string, email string, source_url string, method string, status string",
    )
    p = pages(spark, ("http://n.kr", "info@n.kr"))
    r = results(spark)
    out = table_flow.enrich_table(df, state, r, p, table_flow.Options(collected_on="2025-01-01"))
    assert rows(out.select("no", "email", "outcome")) == [
        (1, "x@g.kr", "reused"), (1, "y@g.kr", "reused"), (2, "", "no_name"), (3, "info@n.kr", "collected"),
        (4, "", "failed"), (5, "", "not_found"), (6, "", "known_empty"), (7, "", "reused_other"),
    ]
    assert table_flow.table_summary(out).first().input_rows == 7
    skip = table_flow.enrich_table(df, state, r, p, table_flow.Options(skip_existing=True))
    assert rows(skip.select("no")) == [(3,), (5,)]
    forced = table_flow.enrich_table(df, state, r, p, table_flow.Options(force=True, quick=True, limit=3))
    assert rows(forced.select("no", "outcome")) == [(1, "not_found"), (2, "no_name"), (3, "collected")]
    assert [r_[0] for r_ in out.select("`No.`").distinct().orderBy("`No.`").collect()] == list(range(1, 8))
    with pytest.raises(ValueError, match="no rows"):
        table_flow.enrich_table(df.limit(0), state, r, p)
    with pytest.raises(ValueError, match="name"):
        table_flow.columns_of(df.drop("업체명"))
    with pytest.raises(ValueError, match="spreadsheet"):
        table_flow.read_table(spark, "x.txt")


def test_rendered_method(spark):
    df = spark.createDataFrame([("homepage", True), ("homepage", None)], "method string, flagged boolean")
    assert rows(df.select(discovery.rendered_method())) == [(C.FLAG_PREFIX + "homepage",), ("homepage",)]


def test_search_address(spark):
    df = spark.createDataFrame([("r", "l"), (" ", "l"), (None, None)], "road_address string, lot_address string")
    assert [r[0] for r in df.select(discovery.search_address()).collect()] == ["r", "l", ""]
