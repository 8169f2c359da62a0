"""Top n, proportions, survivors."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import constants as C
from ledgerloom.llm import proportions, survivor, topn
from tests.conftest import rows

EMAILS = "seq bigint, company_key string, email string, source_url string, method string, flagged boolean, status string, rank int, address string"


def emails(spark, *data):
    return spark.createDataFrame([(i, k, e, u, m, f, s, 0, "clash") for i, k, e, u, m, f, s in data], EMAILS)


def test_best_addresses(spark):
    df = emails(
        spark,
        (1, "a", " INFO@a.kr ", "http://a.kr", "homepage", False, "failed"),
        (2, "a", "info@A.kr", "http://a.kr", "homepage", False, "collected"),
        (3, "a", "x@b.kr", None, None, None, "collected"),
        (4, "a", "x@b.kr", None, None, None, "skipped"),
        (5, "a", "y@b.kr", "", "m", True, "collected"),
        (6, "a", "", None, None, None, "collected"),
        (7, "a", None, None, None, None, "collected"),
        (8, "a", "kim@c.kr", None, "m", None, "collected"),
        (9, "a", "lee@d.kr", None, "m", None, "collected"),
        (10, "a", "pak@e.kr", None, "m", None, "collected"),
        (11, None, "kim@freemail.example", None, "m", None, "collected"),
        (12, "b", "nodomain", None, "m", None, "collected"),
    )
    out = topn.best_addresses(df)
    assert rows(out.select("company_key", "seq", "score")) == sorted([("a", 2, 100), ("a", 8, 10), ("a", 9, 10), (None, 11, 5)], key=repr)
    assert topn.best_addresses(df.limit(0)).count() == 0
    assert topn.best_addresses(df.unionAll(df)).count() == 4


def test_top_n_prunes_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    out = topn.top_n(df, ["g"], [F.desc("id")], 2)
    assert rows(out.select("id", "rank")) == [(996, 2), (997, 2), (998, 1), (999, 1)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_long_address(spark):
    df = emails(spark, (1, "a", "x" * 100_000 + "@b.kr", "http://" + "b" * 100_000, "m", None, "collected"))
    assert topn.best_addresses(df).count() == 1


COMPANY = "row_id bigint, company_key string, province string, category string, rank int, plan_id int"
PLAN = "plan_id int, province string, sample_size bigint, category string, target_pct int, min_rows bigint, rank int"


def people(spark, n, category, province="경기도", at=0):
    return [(at + i, f"{category[:2]}{i}", province, category, 1, 1) for i in range(n)]


def plan(spark, size, shares, floor, province=None):
    return spark.createDataFrame([(1, province, size, c, p, floor, 0) for c, p in zip(C.CATEGORIES, shares, strict=True)], PLAN)


def test_category_spellings(spark):
    import unicodedata

    given = ["제조", " 제조\t", unicodedata.normalize("NFD", "제조"), "ｉｔ＿ＳＷ＿벤처", "it_sw_벤처", "　건설＿물류＿시설", "NEW kind", "기타", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "id int, category string")
    plans = spark.createDataFrame([(c,) for c in [*C.CATEGORIES, "new KIND"]], "category string")
    got = dict(rows(proportions.named(df, plans)))
    assert got == {0: C.MANUFACTURING, 1: C.MANUFACTURING, 2: C.MANUFACTURING, 3: C.IT, 4: C.IT, 5: C.CONSTRUCTION, 6: "new KIND"}


def seats(supply, shares, size, floor):
    """Brute force: floors first, then one seat after the other to the smallest (k - 0.5) / share."""
    got = {c: min(floor, supply[c]) for c in supply}
    while sum(got.values()) < size:
        options = [((got[c] + 0.5) / s, c) for c, s in shares.items() if s and got[c] < supply[c]]
        if not options:
            break
        got[min(options)[1]] += 1
    return got


@pytest.mark.parametrize(("sizes", "shares", "size", "floor"), [((300, 200, 100, 50), (40, 30, 20, 10), 100, 0), ((300, 20, 100, 5), (10, 50, 20, 20), 120, 10), ((30, 20, 10, 5), (25, 25, 25, 25), 500, 3), ((50, 50, 50, 50), (100, 0, 0, 0), 60, 2)])
def test_divisor_method(spark, sizes, shares, size, floor):
    data = [r for n, c in zip(sizes, C.CATEGORIES, strict=True) for r in people(spark, n, c)]
    df = spark.createDataFrame(data + data[:7], COMPANY)
    got = dict(rows(proportions.sample(df, plan(spark, size, shares, floor)).groupBy("category").count()))
    want = seats(dict(zip(C.CATEGORIES, sizes, strict=True)), dict(zip(C.CATEGORIES, shares, strict=True)), size, floor)
    assert got == {c: n for c, n in want.items() if n}


def test_ranks_are_a_row_number(spark, monkeypatch):
    members = spark.createDataFrame([(f"k{i}", g) for i in range(500) for g in ("a", None)], "k string, g string").withColumn("most", F.lit(120))
    by_hash = sorted((__import__("hashlib").sha256(f"42|k{i}".encode()).hexdigest()[:15], f"k{i}") for i in range(500))
    for per_slice in (proportions.PER_SLICE, 30):
        monkeypatch.setattr(proportions, "PER_SLICE", per_slice)
        placed, sizes = proportions.ranked(members, ["g"], "k", 42)
        out = placed.collect()
        for g in ("a", None):
            assert [r.k for r in sorted((r for r in out if r.g == g), key=lambda r: r["rank"])] == [k for _, k in by_hash]
            assert sorted(r["rank"] for r in out if r.g == g) == list(range(1, 501))
        assert rows(sizes) == [("a", 500), (None, 500)]
        first = proportions.ranked(members, ["g"], "k", 42, "most")[0].where("rank <= 120 and g = 'a'").collect()
        assert {r.k for r in first} == {k for _, k in by_hash[:120]}


def test_unmet_targets(spark):
    df = spark.createDataFrame([*people(spark, 100, C.MANUFACTURING), *people(spark, 9, C.IT), (999, None, "경기도", C.SERVICES, 1, 1), (998, "x", None, C.SERVICES, 1, 1), (997, "y", "경기도", None, 1, 1)], COMPANY)
    out = {r.category: r for r in proportions.report(df, plan(spark, 100, (50, 10, 20, 20), 0)).collect()}
    assert {c for c, r in out.items() if r.unmet} == {C.IT, C.SERVICES, C.CONSTRUCTION}
    assert (out[C.SERVICES].supply, out[C.IT].supply, out[C.CONSTRUCTION].supply) == (1, 9, 0)
    local = {r.category: r.supply for r in proportions.report(df, plan(spark, 100, (50, 10, 20, 20), 0, "경기도")).collect()}
    assert local[C.SERVICES] == 0 and local[C.MANUFACTURING] == 100
    assert proportions.report(df.limit(0), plan(spark, 10, (25, 25, 25, 25), 0)).where("unmet").count() == 4
    assert proportions.sample(df.limit(0), plan(spark, 10, (25, 25, 25, 25), 0)).count() == 0
    assert proportions.sample(df, plan(spark, 10, (25, 25, 25, 25), 0).limit(0)).count() == 0


def test_slices_of_priorities_change_nothing(spark):
    data = [(1, c, f"k{c}{i}", i, 50, 5.0, (i - 0.5) / t, i <= 2) for c, t in zip("abcd", (40, 30, 20, 10), strict=True) for i in range(1, 51)]
    df = spark.createDataFrame(data, "plan_id int, category string, company_key string, rank bigint, sample_size bigint, _top double, priority double, is_floor boolean")
    want = rows(proportions._smallest(df).select("company_key"))
    assert len(want) == 50 and all(rows(proportions._smallest(df, n).select("company_key")) == want for n in (1, 7, 60))


def test_usable_homepages(spark):
    good = ["a.example", "http://www.a.kr", "HTTPS://WWW.a-b.co.kr/x?y", " a.kr:80/ ", "한글.한국", "www.a.kr"]
    bad = ["", None, "www.", "http://", "http://www.", "www.a", "없음", "N/A", ".", "info@a.kr", "http://없음", "-", "a", "준비중", "02.123.4567"]
    df = spark.createDataFrame([(v,) for v in good + bad], "h string")
    assert [r[0] is not None for r in df.select(survivor.usable_homepage("h")).collect()] == [True] * len(good) + [False] * len(bad)


def test_election_follows_dominance():
    rng = random.Random(3)
    for _ in range(300):
        values = list({".".join(rng.choices("abcd", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 8))})
        assert survivor.elect(values, [rng.randint(1, 9) for _ in values], True) == 0


def test_election_by_support():
    assert survivor.elect(["www.firm.kr/x", "firm.kr", "firm.kr/", "other.com"], [1, 5, 3, 1], False) == 1
    # No value has most rows, but most rows agree on every token of the second.
    assert survivor.elect(["a b x d", "a b c d", "y b c d", "a b c z"], [1, 1, 1, 1], False) == 1
    assert survivor.elect(["firm", "firm co kr", "firm co"], [2, 2, 2], False) in (1, 2)


def test_alignment_keeps_every_token():
    rng = random.Random(4)
    for _ in range(300):
        centre, seq = (rng.choices("abc", k=rng.randint(0, 7)) for _ in range(2))
        votes = survivor.align(centre, seq)
        assert [t for _, _, t in sorted(votes) if t] == seq and sorted(i for i, j, _ in votes if not j) == list(range(len(centre)))


@pytest.mark.parametrize("dominance", [True, False])
def test_groups_of_any_size_are_elected_alike(spark, dominance):
    rng = random.Random(6)
    words = ["firm", "co", "kr", "www", "shop", "x", "/", "."]
    data = [(f"g{g}", "f", " ".join(rng.choices(words, k=rng.randint(1, 6))), f"{rng.random():.12f}", i, 0) for i in range(600) for g in [rng.randrange(25)]]
    df = spark.createDataFrame(data, "group_key string, field_name string, value string, trust string, row_id bigint, centre int")
    together, apart = (rows(survivor.consensus_survivors(df, dominance, n)) for n in (10_000, 1))
    assert together == apart == rows(survivor.consensus_survivors(df, dominance, 12)) and len(together) == 25


COMPANIES = "row_id bigint, company_key string, source_dataset_id string, homepage string, employees double, registered_on string, collected_on string, value string, trust string"


def test_survivors_against_rule(spark):
    rng = random.Random(11)
    sources = ["s1", "s2", "s3", "unknown"]
    dates = ["2020-01-01", "20210101", "2020.05.05", "", None, "2099-01-01", "0000-00-00", "2022년 3월 4일"]
    real = {"2020-01-01": 1, "20210101": 3, "2020.05.05": 2, "2022년 3월 4일": 4}
    pages = ["http://a.kr", "a.kr", "www.", None, "", "b.kr/x", "info@a.kr", "http://www.c.co.kr"]
    data = [(i, f"k{rng.randrange(60)}" if i else None, rng.choice(sources), rng.choice(pages), rng.choice([None, 0.0, 5.0, 7.0, 99999.0, -1.0]), rng.choice(dates), "2025-01-01", "v", "t") for i in range(300)]
    df = spark.createDataFrame(data, COMPANIES)
    registries = spark.createDataFrame([("s1", 2), ("s2", 1), ("s3", 3)], "source_dataset_id string, priority int")
    out = survivor.consensus_survivors(survivor.field_values(df, registries))
    rank = {"s1": 2, "s2": 1, "s3": 3, "unknown": 99}
    want = set()
    keys = [r[1] for r in data]
    usable = {"http://a.kr", "a.kr", "b.kr/x", "http://www.c.co.kr"}
    for k in set(keys) - {None}:
        own = [r for r in data if r[1] == k]
        if len(own) < 2:
            continue
        order = lambda r: (rank[r[2]], -real.get(r[5], 0), r[0])
        for field, ok in (("homepage", lambda r: r[3] in usable), ("employees", lambda r: r[4] is not None and 1 <= r[4] <= 50_000)):
            if good := [r for r in own if ok(r)]:
                want.add((k, field, min(good, key=order)[0]))
    assert set(map(tuple, out.select("group_key", "field_name", "row_id").collect())) == want
    assert survivor.consensus_survivors(survivor.field_values(df.limit(0), registries)).count() == 0


def test_large_group_is_spread(spark):
    df = spark.range(5000).select(F.lit("g").alias("group_key"), F.lit("f").alias("field_name"), F.concat(F.lit("v"), F.col("id")).alias("value"), F.format_string("%010d", 4999 - F.col("id")).alias("trust"), F.col("id").alias("row_id"))
    assert rows(survivor.consensus_survivors(df).select("row_id", "support")) == [(4999, 5000)]
    assert survivor.consensus_survivors(df.limit(300).unionAll(df.where("row_id = 17")), dominance=False).first().row_id == 17
    assert survivor.consensus_survivors(df.withColumn("value", F.lit("same")), dominance=False).first().support == 5000
    assert survivor.consensus_survivors(df.withColumn("value", F.lit(" "))).count() == 0
