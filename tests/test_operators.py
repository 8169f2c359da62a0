import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import constants as C
from ledgerloom.operators import drift, picks, sampling
from ledgerloom.operators import master as M
from ledgerloom.operators.category import categorize
from ledgerloom.plans import report
from ledgerloom.sources.spec import empty_unified
from ledgerloom.streaming import state as S
from tests.conftest import rows


def unified(spark, records):
    """Records as dicts over the unified schema; missing columns are ''."""
    data = [tuple(r.get(n, None if t == "double" else "") for n, _, t in C.UNIFIED) for r in records]
    return spark.createDataFrame(data, ", ".join(f"{n} {t}" for n, _, t in C.UNIFIED))


def test_master_priority_and_lineage(spark):
    a = {"company_key": "key001", "source_dataset_id": "15105482", "registered_on": "2024-01-15"}
    b = {"company_key": "key001", "source_dataset_id": "15057023", "registered_on": "2024-06-01"}
    rest = [{"company_key": k, "source_dataset_id": s} for k, s in (("key002", "15105482"), ("key003", "15105482"), ("key004", "15057023"))]
    df = M.with_ordinal(unified(spark, [a, *rest[:2], b, rest[2]]))
    out = {r.company_key: r for r in M.build_master(df).collect()}
    assert len(out) == 4
    assert out["key001"].source_dataset_id == "15105482" and out["key001"].source_ids == "15057023,15105482"
    assert out["key004"].source_ids == "15057023"


def test_master_ties(spark):
    base = {"company_key": "k", "source_dataset_id": "innobiz"}
    df = unified(spark, [base | {"registered_on": "", "company_name": "first"}, base | {"registered_on": "2020", "company_name": "longer"}, base | {"registered_on": "2021", "representative": None, "company_name": "null"}, {"company_key": None}])
    df = df.coalesce(1)
    assert [r.company_name for r in M.build_master(M.with_ordinal(df)).collect()] == ["longer"]
    newest = unified(spark, [base | {"registered_on": "2020년 1월 1일", "company_name": "old"}, base | {"registered_on": "2024-01-01", "company_name": "new"}])
    assert [r.company_name for r in M.build_master(M.with_ordinal(newest.coalesce(1)), mode="newest").collect()] == ["new"]
    assert M.build_master(M.with_ordinal(empty_unified(spark))).count() == 0


def test_counts(spark):
    df = unified(spark, [{"company_key": "a", "source_ids": "x,y"}, {"company_key": "a", "source_ids": "x"}])
    assert rows(M.dedup_ratio(df)) == [(2, 1, 1, 50.0)]
    assert rows(M.dedup_ratio(df.limit(0))) == [(0, 0, 0, 0.0)]
    assert rows(M.multi_source_count(df)) == [(2, 1)]
    assert dict(rows(M.empty_counts(df, ["company_key", "phone", "employees"]))) == {"company_key": 0, "phone": 2, "employees": 2}


def test_keep_first_and_numbers(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 4, "w")], "k string, n int, v string")
    assert rows(M.keep_first(df, ["k"], "n").select("v")) == [("y",), ("z",)]
    many = spark.range(1000).withColumn("x", F.lit(1000) - F.col("id"))
    assert M.numbered(many, [F.asc("x")]).where("no != x").count() == 0


def test_categories(spark):
    df = unified(spark, [{"source_dataset_id": s, "industry_code": c} for s, c in (("15105482", ""), ("15052274", ""), ("15065485", ""), ("15105482", "62010"), ("15052274", "29000"), ("other", ""), ("innobiz", None))])
    assert [r.category for r in categorize(df).collect()] == [C.MANUFACTURING, C.IT, C.CONSTRUCTION, C.IT, C.MANUFACTURING, C.SERVICES, C.IT]


def test_active_and_decile(spark):
    df = spark.createDataFrame([("가동중",), ("폐업",), ("",), (None,)], "operating_status string")
    assert rows(sampling.active_first(df)) == [("", False), ("가동중", True), (None, False)]
    nums = spark.createDataFrame([(float(i),) for i in range(1, 12)] + [(None,)], "employees double")
    assert sampling.without_bottom_decile(nums, "employees").count() == 10
    assert sampling.without_bottom_decile(nums.where("employees <= 10 or employees is null"), "employees").count() == 11


def test_industry_cap(spark):
    df = spark.createDataFrame([(f"k{i}", "10") for i in range(40)] + [(f"e{i}", "") for i in range(10)] + [(f"n{i}", None) for i in range(50)], "company_key string, industry_code string")
    out = dict(rows(sampling.industry_capped(df).groupBy(F.coalesce("industry_code", F.lit("NULL"))).count()))
    assert out == {"10": 5, "": 5, "NULL": 50}


def test_strata(spark):
    records = [{"company_key": f"m{i}", "province": "경기도", "category": C.IT, "registered_on": f"20{i % 20:02d}"} for i in range(300)] + [{"company_key": f"r{i}", "province": None, "category": C.IT} for i in range(20)]
    out = sampling.stratified(sampling.active_first(unified(spark, records)), {C.IT: 100}, 1.5)
    assert dict(rows(out.groupBy((F.col("province") == "경기도").alias("m")).count())) == {True: 90, None: 20}
    nowhere = sampling.stratified(sampling.active_first(unified(spark, [r | {"province": None} for r in records])), {C.IT: 100}, 1.5)
    assert nowhere.count() == 150
    assert sampling.sample_candidates(empty_unified(spark)).count() == 0
    a = sampling.sample_candidates(unified(spark, records), {C.IT: 100}).select("company_key")
    assert rows(a) == rows(sampling.sample_candidates(unified(spark, records[::-1]), {C.IT: 100}).select("company_key"))


def greedy(rows_, free, most=2):
    picked, domains = [], set()
    for r in sorted(rows_, key=lambda r: (-r["score"], r["seq"])):
        if r["score"] <= -100 or len(picked) == most:
            continue
        if r["domain"] in domains and r["domain"] not in free:
            continue
        domains.add(r["domain"])
        picked.append(r["seq"])
    return picked


def test_picks_are_greedy(spark):
    rng = random.Random(7)
    data = []
    for seq in range(400):
        local, domain = rng.choice(["info", "kim", "a.b"]), rng.choice(["naver.com", "firm.kr", "x.kr", "y.net"])
        data.append((f"c{rng.randrange(40)}", f"{local}{seq}@{domain}" if local != "info" else f"info@{domain}", rng.choice(["http://firm.kr", "", None]), rng.choice(["homepage", "snippet", C.FLAG_PREFIX + "homepage"]), "collected", seq))
    df = spark.createDataFrame(data, "company_key string, email string, source_url string, method string, status string, seq bigint")
    out = picks.best_picks(df)
    from ledgerloom.functions import contact

    scored = [r.asDict() for r in df.withColumn("score", contact.score_email("email", "source_url", "method")).withColumn("domain", contact.domain_part("email")).collect()]
    want = {k: greedy([r for r in scored if r["company_key"] == k], set(C.FREE_MAIL_DOMAINS)) for k in {r["company_key"] for r in scored}}
    got = {}
    for r in out.orderBy("company_key", "rank").collect():
        got.setdefault(r.company_key, []).append(r.seq)
    assert got == {k: v for k, v in want.items() if v}
    assert picks.best_picks(df, strict_flagged=True).where(F.col("method").startswith(C.FLAG_PREFIX)).count() == 0


def attempts(spark, data):
    return spark.createDataFrame([(k, e, "n", "u", "m", s, "t", i) for i, (k, e, s) in enumerate(data)], "company_key string, email string, company_name string, source_url string, method string, status string, checked_at string, seq bigint")


def test_state(spark):
    log = attempts(spark, [("a", "", "failed"), ("b", "", "failed"), ("b", "", "failed"), ("b", "", "failed"), ("b", "", "failed"), ("c", "x@y.kr", "collected"), ("c", "z@y.kr", "collected"), ("d", "", "not_found"), ("e", "", "failed"), ("e", "q@y.kr", "collected"), ("f", None, "skipped")])
    state = S.state_view(log)
    assert {(r.company_key, r.email): r.retry_count for r in state.collect()}["b", ""] == 3
    keys = spark.createDataFrame([(k,) for k in "abcdefg"], "company_key string")
    assert rows(S.worklist(keys, state)) == [("a",), ("g",)]
    assert rows(S.worklist(keys, state, retry_failed=True)) == [("a",), ("b",), ("g",)]
    assert {r.company_key: r.status for r in S.company_status(state).collect()}["e"] == "collected"
    assert dict(rows(S.status_counts(state))) == {"failed": 3, "collected": 2, "not_found": 1, "skipped": 1}
    assert rows(S.total_processed(state)) == [(6,)]
    r = S.hit_rates(state).first()
    assert (r.found, r.companies, r.status_sum) == (2, 6, 7)
    assert S.hit_rates(state.limit(0)).first().rate_of_companies == 0.0


def test_outcomes(spark):
    companies = spark.createDataFrame([("a", "A"), ("b", ""), ("c", "C"), ("d", None), ("e", "E")], "company_key string, company_name string")
    hits = spark.createDataFrame([("a", "x@y.kr", "u", "m"), ("a", "z@y.kr", "u", "m")], "company_key string, email string, source_url string, method string")
    errors = spark.createDataFrame([("c", "boom")], "company_key string, error_message string")
    out = S.outcome_rows(companies, hits, "2025-01-01T00:00:00", errors).select("company_key", "email", "status")
    assert rows(out) == [("a", "x@y.kr", "collected"), ("a", "z@y.kr", "collected"), ("b", "", "skipped"), ("c", "", "failed"), ("d", "", "skipped"), ("e", "", "not_found")]


def test_state_stream(spark, tmp_path):
    log = attempts(spark, [("a", "", "failed"), ("a", "", "failed"), ("b", "x@y.kr", "collected")])
    S.append_batches(str(tmp_path / "log"))(log, 0)
    S.append_batches(str(tmp_path / "log"))(attempts(spark, [("a", "", "collected")]).withColumn("seq", F.lit(9).cast("bigint")), 1)
    stream = spark.readStream.schema(log.schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "log"))
    q = S.stream_state(stream).writeStream.outputMode("update").format("memory").queryName("st").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    last = spark.table("st").groupBy("company_key", "email").agg(F.max_by(F.struct("status", "retry_count"), "retry_count").alias("s")).select("company_key", "s.*")
    assert rows(last) == [("a", "collected", 2), ("b", "collected", 0)]


def test_report(spark):
    master = unified(spark, [{"company_key": k, "company_name": n, "category": c, "source_ids": s} for k, n, c, s in (("a", "A", C.IT, "x,y"), ("b", "B", C.MANUFACTURING, "x"), ("c", "A", C.IT, "y"))])
    state = S.state_view(attempts(spark, [("a", "info@a.kr", "collected"), ("a", "kim@b.kr", "collected"), ("c", "x@c.kr", "collected"), ("b", "", "not_found")]))
    out = report.report(master, state, {C.IT: 1, C.MANUFACTURING: 2})
    assert [r.no for r in out[C.IT].collect()] == [1, 1, 1]
    assert rows(out["summary"].where("part = 1").select("category", "quota", "pick_rows", "companies", "delta")) == sorted([(C.IT, 1, 3, 1, 0), (C.MANUFACTURING, 2, 0, 0, -2)], key=repr)
    rest = out["summary"].where("part > 1").collect()
    assert [(r.part, r.hit_rate_text, r.pick_companies, r.emails) for r in rest] == [(2, "66.7%", None, None), (3, None, 2, 3)]
    empty = report.report(master, state.limit(0), {C.IT: 1})
    assert empty["detail"].count() == 0 and "email" in empty["detail"].columns
    assert report.status_report(master, master, state)["progress"].first().processed == 3


def payloads(spark, files):
    data = [(n, "s", seq, p) for n, (seq, p) in enumerate((seq, p) for seq, ps in files.items() for p in ps)]
    return spark.createDataFrame(data, "rec_id bigint, source_dataset_id string, file_seq int, payload string")


def test_drift(spark):
    import json

    people = [{"name": f"company number {i}", "n": i, "tags": "a, b", "ok": bool(i % 2)} for i in range(40)]
    dump = lambda rs: [json.dumps(r) for r in rs]
    renamed = [{"title" if k == "name" else k: v for k, v in p.items()} for p in people]
    retyped = [p | {"tags": p["tags"].split(", ")} for p in renamed]
    nulls = [p | {"n": None} for p in retyped]
    dropped = [{k: v for k, v in p.items() if k != "ok"} | {"other": i * 7.5} for i, p in enumerate(nulls)]
    back = [p | {"n": str(i)} for i, p in enumerate(dropped)]
    df = payloads(spark, {1: dump(people), 2: [*dump(renamed), "{broken", None, "[]", ""], 3: dump(retyped), 4: dump(nulls), 5: dump(dropped), 6: dump(back), 8: dump(people)})
    got = rows(drift.schema_changes(df.withColumn("field", F.lit(1))).drop("source_dataset_id"))
    assert got == sorted([(2, "renamed", "name", "title"), (3, "retyped", "tags", ""), (5, "removed", "ok", ""), (5, "added", "other", ""), (6, "retyped", "n", "")], key=repr)
    wide = drift.unified_records(df)
    assert wide.count() == 280 and "title" not in wide.columns and dict(wide.dtypes)["name"] == "string"
    assert wide.where("name is null").count() == 0
    assert drift.schema_changes(df.limit(0)).count() == 0
    assert drift.unified_records(df.limit(0)).count() == 0


def test_drift_names_differing_in_case(spark):
    df = payloads(spark, {1: ['{"a": 1, "A": "x", "rec_id": 5}'], 2: ['{"a": 2, "A": "y", "a.b": null}']})
    wide = drift.unified_records(df)
    assert len(set(c.lower() for c in wide.columns)) == len(wide.columns)
    assert rows(drift.schema_changes(df).select("change_kind", "field_name")) == [("added", "a.b"), ("removed", "rec_id")]


def test_unified_records_keep_every_value(spark):
    texts = ['{"n": 1, "z": 5, "b": true, "m": 2}', '{"n": 2, "z": 6, "b": false, "m": 3}', '{"n": "unknown", "z": "007", "b": "unclear", "m": ""}', "{}", "{broken", "[]"]
    wide = drift.unified_records(payloads(spark, {1: texts}))
    assert dict(wide.dtypes) == {"rec_id": "bigint", "source_dataset_id": "string", "file_seq": "int", "b": "string", "m": "double", "n": "string", "z": "string"}
    assert rows(wide.select("rec_id", "n", "z", "b", "m")) == [(0, "1", "5", "true", 2.0), (1, "2", "6", "false", 3.0), (2, "unknown", "007", "unclear", None), (3, None, None, None, None)]


class Field:
    """A field's profile: type, nested type, sketch."""

    def __init__(self, held, values, shape="STRING"):
        self.held = self.kind = held
        self.shape, self.values = shape, len(values)
        self.seen = self.placed = [v * 1.0 for v in values]


def test_renames_come_from_the_settled_scores(monkeypatch):
    ids = list(range(32))
    old = {"id": Field("number", ids, "BIGINT"), "phone": Field("string", [i + 100 for i in ids])}
    new = {"id": Field("number", ids, "BIGINT"), "tel": Field("string", [i + 100 if i < 8 else -1 for i in ids]), "phone_2": Field("string", [i + 900 for i in ids])}
    assert drift.renames(old, new) == {"phone": "tel"}
    monkeypatch.setattr(drift, "flood", lambda a, b: {(x, y): 0.0 for x in a for y in b})
    assert drift.renames(old, new) == {}


def test_flooding_uses_nesting_and_types():
    some = [i if i < 5 else -1 for i in range(32)]
    old = {"id": Field("number", list(range(32)), "BIGINT"), "a": Field("object", range(32), "OBJECT<code: STRING, name: STRING>")}
    new = {"id": Field("number", list(range(32)), "BIGINT"), "b": Field("object", some, "OBJECT<code: BIGINT, name: STRING>"), "c": Field("object", some, "OBJECT<x: STRING, y: STRING>"), "d": Field("string", some)}
    score = drift.flood(old, new)
    assert score["a", "b"] > score["a", "c"] > score["a", "d"] and score["id", "id"] > 1.0


def test_nested_types():
    assert drift.nested("OBJECT<`a: b`: ARRAY<OBJECT<x: DECIMAL(3,1), y: STRING>>, c: BIGINT>") == ("object", [("a: b", " ARRAY<OBJECT<x: DECIMAL(3,1), y: STRING>>"), ("c", " BIGINT")])
    assert drift.nested("ARRAY<STRING>") == ("array", [("[]", "STRING")]) and drift.nested(None) == ("null", []) and drift.nested("DECIMAL(3,1)") == ("number", [])


def test_too_many_fields_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(drift, "MOST_FIELDS", 3)
    with pytest.raises(ValueError, match="names are data"):
        drift.unified_records(payloads(spark, {1: ['{"a": 1, "b": 2, "c": 3, "d": 4}']}))
