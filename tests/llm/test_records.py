"""Entities and locations."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import entities, korean, locations
from tests.conftest import rows

SCHEMA = "row_id bigint, company_key string, source_dataset_id string, company_name string, company_name_raw string, road_address string, lot_address string, phone string, biz_reg_no string, unit int, building string"


def companies(spark, *data):
    """(row_id, key, source, name, road, lot, phone, number)"""
    return spark.createDataFrame([(i, k, s, n, n, r, lot, p, b, 0, "clash") for i, k, s, n, r, lot, p, b in data], SCHEMA)


def test_names():
    same = ["(주)가나다전자", "가나다 전자 주식회사", "㈜ 가 나 다 전 자", "Ganada Electronics Co., Ltd.", "가나다전자(주) 제2공장", "가나다 ELECTRONICS", "갸나다전자(구 상호변경)", "가나댜전자 본사"]
    assert {korean.company(n) for n in same} == {("ganada", "electronics")}
    assert korean.company("랩스") == ("rabsu", "") or korean.company("랩스")[1] == ""
    assert korean.company(None) == ("", "") == korean.company("")


@pytest.mark.parametrize("text", [
    "서울특별시 강남구 가나로12번길 3-4, 5층 (다라동)", "서울 강남구 가나로 12번길 3의4", "[12345] 서울시 강남구 가나로 １２번길 ３－４ 501호", "가나로12번길 3-4 (다라동) 서울특별시 강남구",
    "501-ho, 3-4, Gana-ro 12beon-gil, Gangnam-gu, Seoul", "우12345 서울 강남 갸나로12번길3 - 4 마바빌딩 5F 501", "강남구 가나로12번길 3-4번, 5층",
])
def test_road_addresses(text):
    a = korean.road_address(text)
    assert (korean.sound(a.road), a.side, a.number) == ("ganaro", "12", "3-4")
    assert a.district in ("강남", "gangnam")
    assert a.province in ("서울특별시", "")


def test_lot_addresses():
    texts = ["경기도 가나시 다라동 12번지 3호", "경기 가나시 다라동 12-3", "가나시 다라동12의 3", "경기도 가나시 다랴동 12번지3 마바빌딩"]
    assert {(a.district, korean.sound(a.road), a.number) for a in map(korean.lot_address, texts)} == {("가나", "daradong", "12-3")}
    assert korean.lot_address("경기도 가나시 다라동 산 12-3").number == "s12-3"
    assert korean.lot_address("") is korean.lot_address(None) is korean.road_address("없음") is None


def test_numbers():
    assert {korean.phone(p) for p in ["02-0824-6995", "(02)0824-6995 내선 101", "+82-2-0824-6995", "02.0824.6995~3", "02 0824 6995 (대표)"]} == {"0208246995"}
    assert korean.phone("없음") == korean.phone(None) == korean.phone("000-0000-0000") == ""
    assert korean.registration("123-45-67890") == "1234567890" and korean.registration("0000") == korean.registration("***") == ""


def test_same_location(spark):
    df = companies(
        spark,
        (1, "a", "s", "x", "서울특별시 강남구 가나로 12 (다라동)", None, None, None),
        (2, "b", "s", "x", "강남구 가나로 12, 3층", "", None, None),
        (3, "c", "s", "x", "가나로 12 서울", " ", None, None),
        (4, "d", "s", "x", "서울특별시 강남구 가나로 12 (다라동)", None, None, None),
        (5, "e", "s", "x", "부산광역시 해운구 가나로 12", None, None, None),
        (6, "f", "s", "x", None, "서울 강남구 다라동 7-1", None, None),
        (7, "g", "s", "x", "12, Gana-ro, Gangnam-gu, Seoul", "강남구 다라동 7번지 1호", None, None),
        (8, "h", "s", "x", "서울특별시 강남구 가나로 12-1", "서울 강남구 다라동 산 7-1", None, None),
        (9, "i", "s", "x", "", "", None, None),
        (10, "j", "s", "x", "가" * 50_000, "나" * 50_000, None, None),
    )
    got = set(rows(locations.same_location(df)))
    assert {(1, 2), (1, 7), (2, 4), (2, 7), (4, 7), (6, 7)} <= got
    assert not {p for p in got if 5 in p and p != (3, 5) or 8 in p or 9 in p or 10 in p or p == (1, 4)}
    assert locations.same_location(df.limit(0)).count() == 0
    assert locations.same_location(df.select("row_id", F.lit(None).cast("string").alias("road_address"), F.lit(None).cast("string").alias("lot_address"))).count() == 0


def located(spark, *texts, field="road"):
    data = [(i, f"k{i}", "s", "x", t if field == "road" else None, t if field == "lot" else None, None, None) for i, t in enumerate(texts)]
    return set(rows(locations.same_location(companies(spark, *data))))


def test_namesake_districts(spark):
    got = located(spark, "서울특별시 중구 중앙로 1", "부산광역시 중구 중앙로 1, 2층", "서울 중구 중앙로 1 301호", "중구 중앙로 1", "중구 중앙로 1 (다라동)", "1, Jungang-ro, Jung-gu, Busan")
    # Without a province the place is open: such rows are only like each other.
    assert got == {(0, 2), (1, 5), (3, 4)}
    assert located(spark, "서울 중구 가동 1", "부산 중구 가동 1-0", "부산 중구 가동 1번지", field="lot") == set()


def test_near_streets(spark):
    many = [f"경기도 가나시 {road} {n}" for road in ("대동로", "다동로") for n in (5, 6, 7, 8, 9)]
    got = located(spark, *many, "경기 가나시 대동로 5, 1층", "경기 가나시 다동로 5, 1층", "경기 가나시 댜동로 6", "경기 가나시 냐동로 5")
    assert got == {(0, 10), (5, 11)}, "two streets of one sound, each named often; a name near both is its own"
    got = located(spark, *many[:5], "경기도 가나시 댜동로 6", "댸동로 7 경기 가나", "경기도 다라시 댜동로 6", "8, Daedong-ro, Gana-si, Gyeonggi-do", "5, Daetong-ro, Gana-si, Gyeonggi-do")
    assert got == {(1, 5), (2, 6), (3, 8)}
    assert located(spark, "경기도 가나시 대동로 5", "경기도 가나시 다동로 5") == set(), "nothing tells which of the two is right"


def test_missing_parts(spark):
    full = "충청남도 가나시 다라로 5 (마바동)"
    got = located(spark, full, "가나시 다라로 5", "다라로 5", "충남 다라로 5", "가나시 다라로 5-1", "다라로 5 가나", "충남 사아시 다라로 5", "충남 사아시 자차로 5")
    assert got == {(0, 1), (0, 5), (1, 5)}, "a road and number of two districts stand for neither"


def test_buildings_are_a_membership(spark):
    df = companies(spark, (1, "a", "s", "x", "경기도 가나시 다라로 5", "경기도 가나시 마바동 7", None, None), (2, "b", "s", "x", "가나시 다라로 5, 2층", "", None, None), (3, "c", "s", "x", None, "?", None, None))
    got = {(r.row_id, r.field): r.building for r in locations.buildings(df.unionAll(df.where("row_id = 2"))).collect()}
    assert set(got) == {(1, "road_address"), (1, "lot_address"), (2, "road_address")} and got[1, "road_address"] == got[2, "road_address"]


def test_same_entities(spark):
    df = companies(
        spark,
        (1, "k1", "s1", "(주)가나다전자", "서울특별시 강남구 가나로 12", None, "02-0824-6995", "123-81-67890"),
        (2, "k2", "s2", "가나다 전자 주식회사", "강남구 가나로 12, 3층", None, "없음", None),
        (3, "k3", "s3", "Ganada Electronics Inc.", None, None, "+82-2-0824-6995", "12381"),
        (4, "k4", "s2", "가나다전자", "부산광역시 해운구 다라로 5", None, "051-0111-2222", None),
        (5, "k5", "s3", "마바사화학(주)", "서울특별시 강남구 가나로 12", None, "02-0824-6995", None),
        (6, "k1", "s4", "가나다전자", "서울 강남구 가나로 12", None, "02-0824-6995", "1238167890"),
        (7, "k7", "s1", "가나다전자", "서울 강남구 가나로 12", None, None, None),
        (8, "k8", "s5", None, None, None, None, None),
        (9, "k9", "s6", "", "", "", "", ""),
        (10, "ka", "s5", "가나다전자 지점", None, None, None, "123-81-67891"),
        (7, "k7", "s1", "가나다전자", "서울 강남구 가나로 12", None, None, None),
        (11, "kb", "s7", "길" * 30_000, "로" * 30_000, None, "0" * 30_000, "1" * 30_000),
    )
    got = {(r.row_id_a, r.row_id_b) for r in entities.same_companies(df).collect()}
    assert got >= {(1, 2), (1, 3), (2, 6), (2, 7), (3, 6), (6, 7), (1, 10), (6, 10)}
    assert not {p for p in got if {4, 5, 8, 9, 11} & set(p)} and (1, 6) not in got and (2, 3) not in got
    assert all(0.5 <= r.confidence <= 1 for r in entities.same_companies(df).collect())
    assert entities.same_companies(df.limit(0)).count() == 0


def test_close_pairs_are_exact(spark, monkeypatch):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(12)]
    data = []
    for unit in range(400):
        v = rng.choice(base)
        for _ in range(rng.randint(0, 5)):
            v ^= 1 << rng.randrange(64)
        data.append((unit, f"g{unit % 3}" if unit < 360 else f"s{unit % 20}", v - (1 << 64) if v >> 63 else v))
    data.append((999, None, 5))
    df = spark.createDataFrame(data, "unit bigint, exact string, bits bigint")
    mask = (1 << 64) - 1
    want = {(a[0], b[0]) for a, b in combinations(data, 2) if a[1] and a[1] == b[1] and bin((a[2] ^ b[2]) & mask).count("1") <= entities.RADIUS}
    for direct in (1, 48, 10_000):
        monkeypatch.setattr(entities, "DIRECT", direct)
        out = entities.close_pairs(df, [(F.col("exact"), F.col("bits"))])
        got = list(map(tuple, out.collect()))
        assert len(got) == len(set(got)) and set(got) == want


def test_confidences_are_shares_of_matches(spark):
    rng = random.Random(12)
    data = []
    for i in range(4000):
        name = rng.random()
        data.append((i, i + 10_000, "equal" if rng.random() < name**2 else "far", name, 0.0, 0.0, 1.0, 0.0, 1.0))
    pairs = spark.createDataFrame(data, "unit_a bigint, unit_b bigint, number string, name double, line_differs double, phone double, phone_missing double, place double, place_missing double")
    w = entities.fitted(pairs)
    said = pairs.select((1 / (1 + F.exp(-entities._odds(w)))).alias("p"), (F.col("number") == "equal").cast("double").alias("y")).toPandas()
    for low in (0.0, 0.25, 0.5, 0.75):
        own = said[(said.p >= low) & (said.p < low + 0.25)]
        assert len(own) < 50 or abs(own.p.mean() - own.y.mean()) < 0.08
