import json

import pytest

from ledgerloom import constants as C
from ledgerloom.sources import html, readers, rest, xlsx
from ledgerloom.sources.spec import SPECS, detect_column, header_map, normalize_source
from tests.conftest import rows


@pytest.mark.parametrize(("source", "headers", "want"), [
    ("15105482", ["사업자등록번호", "회사명", "대표자주소", "업종코드", "업종명", "도로명주소", "지번주소", "전화번호", "종업원수", "자본금", "가동상태", "설립일", "생산품", "홈페이지"],
     {"biz_reg_no": "사업자등록번호", "company_name_raw": "회사명", "representative": "대표자주소", "industry_code": "업종코드", "industry_name": "업종명", "road_address": "도로명주소", "lot_address": "지번주소", "phone": "전화번호", "employees": "종업원수", "capital": "자본금", "operating_status": "가동상태", "registered_on": "설립일", "homepage": "홈페이지"}),
    ("15057023", ["COMPNY_GRP_NM", "CMPNY_NM", "REFINE_ROADNM_ADDR", "LOT_AR", "PRDT_INFO", "INDUTYPE_DESC_DTCONT", "EMPLY_CNT"],
     {"company_name_raw": "COMPNY_GRP_NM", "road_address": "REFINE_ROADNM_ADDR", "industry_name": "PRDT_INFO", "employees": "EMPLY_CNT"}),
    ("15052274", ["사업자 번호", "기업명", "대표자", "업종", "주소", "연락처", "URL", "직원수"], {"biz_reg_no": "사업자 번호", "company_name_raw": "기업명", "representative": "대표자", "industry_name": "업종", "road_address": "주소", "phone": "연락처", "homepage": "URL", "employees": "직원수"}),
    ("innobiz", ["회사명", "업종", "지역", "인증일"], {"company_name_raw": "회사명", "industry_name": "업종", "province": "지역", "registered_on": "인증일"}),
    ("15118569", ["사업자", "상호", "대표", "주소", "전화", "등록일"], {"biz_reg_no": "사업자", "company_name_raw": "상호", "representative": "대표", "road_address": "주소", "phone": "전화", "registered_on": "등록일"}),
    ("15086381", ["기업명", "소재지", "분야", "인력"], {"company_name_raw": "기업명", "road_address": "소재지", "industry_name": "분야", "employees": "인력"}),
    ("15099307", ["업체명", "소재지", "승인번호", "신고일"], {"company_name_raw": "업체명", "road_address": "소재지", "registered_on": "승인번호"}),
    ("15065485", ["ncrGsKname", "ncrGsMaster", "ncrGsAddr", "면허일"], {"company_name_raw": "ncrGsKname", "representative": "ncrGsMaster", "road_address": "ncrGsAddr", "registered_on": "면허일"}),
    ("15071341", ["사업장명", "업소명", "영업상태명", "인허가일자", "회사"], {"company_name_raw": "사업장명", "operating_status": "영업상태명", "registered_on": "인허가일자"}),
])
def test_headers(source, headers, want):
    assert header_map(headers, SPECS[source].rules) == want


def test_column_detection():
    assert detect_column(["번호", " 업체명 ", "회사명(원본)"], C.NAME_ALIASES) == "회사명(원본)"
    assert detect_column(["Company", "URL"], C.NAME_ALIASES) == "Company"
    assert detect_column(["x"], C.NAME_ALIASES) is None


def test_normalize(spark):
    df = spark.createDataFrame([("123-45-67890", "(주)가나 ", "경기도 성남시 1", "1,200"), ("1234567890", "둘째", None, "x"), ("", "셋째", "서울 강남구", "")], "`사업자번호` string, `업체명` string, `주소` string, `종업원` string").coalesce(1)
    out = normalize_source(df, SPECS["15052274"], "2025-01-01")
    assert out.columns == C.UNIFIED_COLUMNS
    got = {r.company_key: r for r in out.collect()}
    assert len(got) == 2
    first = got["1234567890"]
    assert (first.company_name, first.province, first.district, first.employees, first.capital, first.collected_on) == ("(주)가나", "경기도", "성남시", 1200.0, None, "2025-01-01")
    assert first.representative is None and first.category == ""


def test_csv_encodings(spark, tmp_path):
    text = "회사명,주소\n(주)가나,\"서울 강남구, 1\"\n다라,\n"
    for name, encoding in (("utf8", "utf-8-sig"), ("korean", "cp949")):
        (tmp_path / f"{name}.csv").write_bytes(text.encode(encoding))
        df = readers.read_csv(spark, str(tmp_path / f"{name}.csv"))
        assert df.columns == ["회사명", "주소"], name
        assert rows(df) == [("(주)가나", "서울 강남구, 1"), ("다라", "")]
    (tmp_path / "empty.csv").write_bytes(b"")
    assert readers.read_csv(spark, str(tmp_path / "empty.csv")).columns == []


def test_json_and_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1, "b": None}, {"a": "x", "b": True}]))
    assert rows(readers.read_json_records(spark, str(tmp_path / "a.json"))) == [("1", ""), ("x", "true")]
    item = {"ncrGsKname": "가나", "ncrGsAddr": None}
    for n, items in (("one", item), ("many", [item, item]), ("none", None)):
        (tmp_path / f"{n}.json").write_text(json.dumps({"response": {"body": {"items": {"item": items}}}}, ensure_ascii=False))
    read = lambda n: rows(readers.read_envelope(spark, str(tmp_path / f"{n}.json"), ["ncrGsKname", "ncrGsAddr"]))
    assert read("one") == [("가나", "None")] and read("many") == [("가나", "None")] * 2 and read("none") == []


def test_snapshots_and_pipeline(spark, tmp_path):
    from ledgerloom.plans.pipeline import Store

    raw = tmp_path / "raw"
    for day, name in (("2024-01-01", "old"), ("2024-02-01", "new")):
        (raw / "15052274" / day).mkdir(parents=True)
        (raw / "15052274" / day / "a.csv").write_text(f"업체명,주소\n{name},서울 강남구\n")
    (raw / "15071341" / "2024-01-01").mkdir(parents=True)
    (raw / "15071341" / "2024-01-01" / "b.csv").write_text("사업장명,영업상태명,도로명주소\n청소,영업중,서울 강남구 1\n")
    store = Store(spark, str(tmp_path))
    out = store.normalize("2025-01-01", ["15052274", "15071341", "innobiz", "nope"])
    assert (out["15052274"], out["15071341"], out["nope"]) == ("written", "written", "unknown") and "FileNotFoundError" in out["innobiz"]
    assert store.normalize("2025-01-01", ["15052274"])["15052274"] == "kept"
    assert rows(store.master().select("company_name", "category", "operating_status")) == [("new", C.IT, None), ("청소", C.CONSTRUCTION, "가동중")]
    assert store.sample().count() == 2
    results = spark.createDataFrame([("new 이메일", "duckduckgo", 1, "http://new.kr", "t", "mail info@new.kr now", "")], "query string, engine string, rank int, url string, title string, snippet string, address string")
    pages = spark.createDataFrame([], "url string, html string")
    state = store.enrich(results, pages, "2025-01-01T00:00:00")
    assert rows(state.select("company_name", "email", "status")) == [("new", "info@new.kr", "collected"), ("청소", "", "not_found")]
    assert store.enrich(results, pages, "2025-01-02T00:00:00").count() == 2
    sheets = store.export(str(tmp_path / "r.xlsx"))
    assert sheets["picks"].count() == 1
    assert xlsx.rows_of((tmp_path / "r.xlsx").read_bytes(), "picks")[1][1] == "new"
    assert store.status()["progress"].first().progress_pct == 100.0
    with pytest.raises(FileNotFoundError):
        readers.read_parquets(spark, str(tmp_path / "raw"))


def test_landing(spark, tmp_path):
    df = spark.createDataFrame([(f"회사{i}", f'서울 강남구 "{i}", x') for i in range(40)], "`업체명` string, `주소` string").repartition(3)
    readers.land(df, str(tmp_path), "15052274", "2025-01-01")
    out = readers.read_source(spark, SPECS["15052274"], str(tmp_path), "2025-01-02")
    assert rows(out.select("company_name", "road_address")) == rows(df)


def test_cli(spark, tmp_path, capsys):
    from ledgerloom.cli import main

    (tmp_path / "raw" / "15052274" / "2024-01-01").mkdir(parents=True)
    (tmp_path / "raw" / "15052274" / "2024-01-01" / "a.csv").write_text("업체명,주소\n가나,서울 강남구\n")
    assert main(["--root", str(tmp_path), "--now", "2025-01-01T00:00:00", "all", "--sources", "15052274", "--out", str(tmp_path / "o.xlsx")]) == 0
    said = capsys.readouterr().out
    assert "15052274 written" in said and "companies 1" in said and (tmp_path / "o.xlsx").exists()


def test_partitioned_write(spark, tmp_path):
    df = spark.createDataFrame([("a", "s1"), ("b", "s2")], "company_key string, source_dataset_id string")
    readers.write_partitioned(df, str(tmp_path / "u"))
    readers.write_partitioned(spark.createDataFrame([("c", "s2")], df.schema), str(tmp_path / "u"))
    assert rows(spark.read.parquet(str(tmp_path / "u")).select("company_key")) == [("a",), ("c",)]


def test_xlsx_round_trip(spark, tmp_path):
    path = tmp_path / "x.xlsx"
    path.write_bytes(xlsx.workbook({"하나": (["회사명", "n"], [("가 & <나>", 1), (None, 2.5)]), "two": (["a"], [])}))
    assert xlsx.rows_of(path.read_bytes()) == [["회사명", "n"], ["가 & <나>", "1"], ["", "2.5"]]
    df = xlsx.read_xlsx(spark, str(path))
    assert df.columns == ["회사명", "n"] and rows(df) == [("", "2.5"), ("가 & <나>", "1")]


def test_rest(spark):
    df = rest.read_rest(spark, "http://x", "tests.fake_registry:paged", page_size="10", retries="1")
    got = rows(df)
    assert len([r for r in got if r[1]]) == 20 and (3, None) in got
    assert rest.read_rest(spark, "http://x", "tests.fake_registry:down", key="").count() == 0
    assert rows(rest.read_rest(spark, "http://x", "tests.fake_registry:down", retries="1")) == [(1, None)]


@pytest.mark.parametrize("service", ["bare", "zero_total", "no_head", "xml", "few_a_page", "uneven", "unpaged"])
def test_rest_reads_every_page(spark, service):
    got = rest.read_rest(spark, "http://x", f"tests.fake_registry:{service}", page_size="10", retries="1").collect()
    assert sorted(int(json.loads(r.record)["n"]) for r in got) == list(range(25))


def test_rest_goes_on_after_a_broken_first_page(spark):
    got = rest.read_rest(spark, "http://x", "tests.fake_registry:first_broken", page_size="10", retries="1").collect()
    assert sorted(json.loads(r.record)["n"] for r in got if r.record) == list(range(10, 25))
    assert [r.page for r in got if r.record is None] == [1]


def test_response_shapes():
    assert rest.items_of('{"response": {"body": {"items": {"item": {"a": 1}}, "totalCount": "7"}}}') == ([{"a": 1}], 7)
    assert rest.items_of('{"Svc": [{"head": [{"list_total_count": 3}]}, {"row": [{"a": 1}]}]}') == ([{"a": 1}], 3)
    assert rest.items_of("<r><totalCount>2</totalCount><item><a> 1 </a></item></r>") == ([{"a": "1"}], 2)
    assert rest.items_of("[]") == ([], None) and rest.items_of("{}") == ([], 0)


def test_html(spark):
    page = '<a href="/contact">x</a><a href="http://other.kr/about">y</a><a href="/c2">회사소개</a><a href="/privacy/contact">p</a><a href="/contact">again</a>' + "".join(f'<a href="/about{i}">z</a>' for i in range(9))
    assert html.contact_urls(page, "http://a.kr/") == ["http://a.kr/contact", "http://a.kr/c2", "http://a.kr/about0", "http://a.kr/about1", "http://a.kr/about2"]
    table = '<table class="table_list"><tbody><tr><td>1</td><td>가</td><td>업</td><td>서울</td><td>2020</td></tr><tr><td>x</td></tr></tbody></table>'
    df = spark.createDataFrame([(1, table), (2, table), (3, None)], "page int, html string")
    assert rows(html.table_rows(df, ["name", "line", "region", "date"])) == [(1, 1, "가", "업", "서울", "2020"), (2, 1, "가", "업", "서울", "2020")]
    with pytest.raises(Exception, match="table_list"):
        html.table_rows(df.limit(1).withColumn("html", df.html.substr(1, 3)), ["name"]).collect()
