import json
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import discovery
from ledgerloom.sources import fetch, html, readers, xlsx
from ledgerloom.sources.spec import SPECS
from ledgerloom.streaming import state as S
from tests.conftest import rows

FAKE = "tests.fake_registry:"


def test_download(spark, tmp_path):
    get = lambda url, **k: fetch.download(spark, url, str(tmp_path), "s", "2025-01-01", "a.csv", FAKE + "stream", **k)
    assert "cut off" in get("http://broken") and not (tmp_path / "s/2025-01-01/a.csv").exists()
    assert "cut off" in (tmp_path / "s/2025-01-01" / fetch.FAILED_MARK).read_text()
    assert get("http://x") == "written" and (tmp_path / "s/2025-01-01/a.csv").read_bytes() == b"a" * 10_000 + b"b"
    assert get("http://broken") == "kept" and "cut off" in get("http://broken", force=True)
    assert (tmp_path / "s/2025-01-01/a.csv").stat().st_size == 10_001
    with pytest.raises(OSError):
        get("http://broken", force=True, required=True)


def test_listing(spark, tmp_path):
    columns = ["회사명", "업종", "지역", "인증일"]
    out = fetch.crawl_listing(spark, "http://l", FAKE + "listing", columns)
    assert rows(out.select("page", "회사명")) == [(1, "c10"), (1, "c11"), (2, "c20"), (2, "c21")]
    folder = fetch.land_listing(spark, "http://l", FAKE + "listing", str(tmp_path), "innobiz", "2025-01-01", columns)
    assert readers.read_source(spark, SPECS["innobiz"], str(tmp_path), "2025-01-01").count() == 4 and folder.endswith("2025-01-01")


def test_pages(spark):
    urls = spark.createDataFrame([("http://korean.kr/",), ("http://bare.kr/",), ("http://utf.kr/",), ("http://down.kr/",), ("http://utf.kr/",), (None,)], "url string")
    got = {r.url: r for r in fetch.fetch_pages(urls, FAKE + "site").collect()}
    assert len(got) == 4 and all("문의" in got[f"http://{h}.kr/"].html for h in ("korean", "bare", "utf")) and "no answer" in got["http://down.kr/"].error_message
    assert fetch.decoded("가".encode() + b"\xff") and fetch.decoded(b'<meta charset="no-such">\xb0\xa1').endswith("가")


def test_search_and_failures(spark):
    companies = spark.createDataFrame([("a", "A", None), ("b", "B", "http://down.kr/")], "company_key string, company_name string, homepage string")
    found = fetch.search(discovery.search_queries(companies), FAKE + "engine", [("naver_webkr", 2), ("google_cse", 10)])
    assert found.where("engine = 'naver_webkr' and query = 'A 이메일'").count() == 2
    pages = fetch.fetch_pages(companies.select(F.col("homepage").alias("url")), FAKE + "site")
    errors = dict(rows(discovery.failures(companies, found, pages)))
    assert set(errors) == {"a", "b"}
    none = found.where("error_message is null")
    only = discovery.failures(companies, none, pages)
    assert [k for k, _ in rows(only)] == ["b"] and discovery.failures(companies, none.drop("error_message"), pages.drop("error_message")).count() == 0
    out = S.outcome_rows(companies, found.limit(0).select(F.lit("").alias("company_key"), F.lit("").alias("email"), F.lit("").alias("source_url"), F.lit("").alias("method")), "2025-01-01T00:00:00", only)
    assert rows(out.select("company_key", "status")) == [("a", "not_found"), ("b", "failed")]


def test_services(spark, tmp_path):
    one = fetch.read_service(spark, fetch.Service("s", 5, pages=1), "u", FAKE + "paged", "k")
    assert one.where("record is not null").count() == 5 and fetch.read_service(spark, fetch.SERVICES["15086381"], "u", FAKE + "paged", "").count() == 0
    fetch.land_json(spark.createDataFrame([("가", 1), (None, 2)], "a string, b int"), str(tmp_path / "x.json"))
    assert json.loads((tmp_path / "x.json").read_text()) == [{"a": "가", "b": 1}, {"b": 2}]


def test_files_of_different_encodings_and_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_bytes("회사명,주소\n가나,서울\n".encode())
    (tmp_path / "2.csv").write_bytes("주소,회사명\n부산,다라\n".encode("cp949"))
    (tmp_path / "3.csv").write_bytes("회사명,전화\n\"마\n바\",02\n".encode("utf-8-sig"))
    (tmp_path / "4.csv").write_bytes("전화,회사명,x\n03,사아\n".encode("cp949"))
    out = readers.read_csv(spark, str(tmp_path / "*.csv"))
    assert rows(out.select("회사명", "주소", "전화")) == [("가나", "서울", ""), ("다라", "부산", ""), ("마\n바", "", "02"), ("사아", "", "03")]


def test_many_parquets_in_one_scan(spark, tmp_path):
    spark.range(300).select(F.col("id"), F.format_string("%03d", F.col("id") % 100).alias("f")).repartition(4).write.partitionBy("f").parquet(str(tmp_path / "p"))
    flat = tmp_path / "flat"
    flat.mkdir()
    for n, f in enumerate(sorted((tmp_path / "p").rglob("part-*.parquet"))):
        shutil.copy(f, flat / f"{n:04d}.parquet")
    out = readers.read_parquets(spark, str(flat))
    ordered = out.orderBy("row_ordinal").select(F.col("row_ordinal.file").alias("file")).collect()
    assert out.count() == 300 and [r.file for r in ordered] == sorted(r.file for r in ordered)
    assert str(out._jdf.queryExecution().executedPlan()).count("FileScan") == 1


def test_old_spreadsheets_are_refused(spark, tmp_path):
    (tmp_path / "a.xls").write_bytes(b"\xd0\xcf\x11\xe0")
    with pytest.raises(ValueError, match="xlsx"):
        xlsx.read_xlsx(spark, str(tmp_path / "a.xls"))


def test_contact_links_of_a_landed_page(spark):
    pages = spark.createDataFrame([("http://a.kr/x", '<a href="/contact">c</a>')], "url string, html string")
    assert rows(html.contact_links(pages)) == [("http://a.kr/x", 1, "http://a.kr/contact")]


def test_compaction_keeps_retries(spark):
    log = spark.createDataFrame([("a", "", "failed", n) for n in range(4)] + [("b", "x", "failed", 9), ("c", "", "failed", 10)], "company_key string, email string, status string, seq bigint")
    candidates = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "company_key string")
    later = spark.createDataFrame([("b", "x", "failed", 20), ("b", "x", "failed", 21)], log.schema)
    for full, kept in ((log, S.compacted(log)), (log.unionAll(later), S.compacted(log).unionByName(later, allowMissingColumns=True)), (log, S.compacted(S.compacted(log)))):
        assert rows(S.state_view(full)) == rows(S.state_view(kept).select(*S.state_view(full).columns))
        assert rows(S.worklist(candidates, S.state_view(full))) == rows(S.worklist(candidates, S.state_view(kept)))


def test_shared_folder_is_never_local_on_a_cluster(monkeypatch):
    from ledgerloom import session

    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda key, default=None: {"spark.master": "spark://x"}.get(key, default))}))

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_folder(Fake)


def test_settled_tables_are_removed(spark):
    from pathlib import Path

    from ledgerloom import session

    df = session.settled(spark.range(5))
    path = Path(session._settled[spark.sparkContext.applicationId][-1].removeprefix("file:"))
    assert df.count() == 5 and path.exists()
    session.forget(spark)
    assert not path.exists()
