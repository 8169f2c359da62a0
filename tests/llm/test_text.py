"""Wrong encodings, tokens, leaks, truncation."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import encoding, leakage, mojibake, truncation
from tests.conftest import rows

RNG = random.Random(5)
SYLLABLES = "가나다라마바사아자차카타파하거너더러머버서어저처커터퍼허고노도로모보소오조초코토포호"


def word(n=3):
    return "".join(RNG.choices(SYLLABLES, k=n))


# --- wrong encodings ---

CLEAN = [f"주식회사 {word()}전자" for _ in range(300)] + [f"경기도 {word(2)}시 {word()}로{RNG.randint(1, 99)}번길 {RNG.randint(1, 300)} ({word(2)}동)" for _ in range(300)]
MISTAKES = [("utf-8", "latin-1"), ("cp949", "latin-1"), ("cp949", "mac_roman"), ("cp949", "gb18030")]


def garble(text, right, wrong):
    return text.encode(right).decode(wrong, "replace")


@pytest.fixture(scope="module")
def garbled(spark):
    data, bad = [], {}
    for i, t in enumerate(CLEAN):
        if i % 25 == 0:
            right, wrong = MISTAKES[i // 25 % len(MISTAKES)]
            bad[i] = t
            t = garble(t, right, wrong)
        data.append((i, t, 1))
    decoys = ["가나 Köln 상사", "Atelier Ø 나다", "株式會社 라마", "바사 ½카운티", "아자 µ-센서", "차카 Señor & Côte", "뷁뷁 전자", "사아?", "카페 カフェ", "  ", "", None]
    data += [(1000 + i, t, 1) for i, t in enumerate(decoys)]
    lost = ["��ȸ��", "가나 ����", "\x84\x9c다라"]
    data += [(2000 + i, t, 1) for i, t in enumerate(lost)]
    data.append((3000, "긴 " + CLEAN[1] * 4000, 1))
    data.append((3001, garble(CLEAN[2] * 200, "utf-8", "latin-1"), 1))
    return spark.createDataFrame(data, "row_id bigint, name string, value int"), bad


def test_garbled_values(spark, garbled):
    df, bad = garbled
    out = {r.row_id: r for r in mojibake.garbled_values(df, ["name"]).collect()}
    assert set(out) == set(bad) | {2000, 2001, 2002, 3001}
    assert {i: out[i].restored for i in bad} == bad
    assert out[2000].restored is None and out[3001].restored == CLEAN[2] * 200


def test_twice_garbled_and_parts(spark, garbled):
    df, _ = garbled
    twice = garble(garble("주식회사 가나전자", "utf-8", "latin-1"), "utf-8", "latin-1")
    part = "주식회사 " + garble("가나전자", "cp949", "latin-1")
    both = df.select("row_id", "name", "value").unionAll(spark.createDataFrame([(5000, twice, 1), (5001, part, 1), (5001, part, 1)], df.schema))
    out = [(r.row_id, r.restored) for r in mojibake.garbled_values(both, ["name"]).where("row_id >= 5000").collect()]
    assert sorted(out) == [(5000, "주식회사 가나전자"), (5001, "주식회사 가나전자"), (5001, "주식회사 가나전자")]


def test_garbled_latin_text(spark, garbled):
    df, _ = garbled
    bad = {"KÃ¶ln GmbH": "Köln GmbH", "CafÃ© de la GarÃ§on": "Café de la Garçon", "Ã…ngstrÃ¶m AB": "Ångström AB", "ÅÃ³dÅº": None}
    clean = ["Köln GmbH", "CAFÉ»", "«Ça»", "Müller & Söhne", "São Paulo", "5Ä°", "N°5 É°"]
    both = df.select("row_id", "name").unionAll(spark.createDataFrame([(6000 + i, t) for i, t in enumerate([*bad, *clean])], "row_id bigint, name string"))
    out = {r.value: r.restored for r in mojibake.garbled_values(both, ["name"]).where("row_id >= 6000").collect()}
    assert {k: v for k, v in bad.items() if v} == {k: out.get(k) for k, v in bad.items() if v}
    assert not set(clean) & set(out)


def test_segments_against_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        w = [rng.randint(-4, 4) for _ in range(rng.randint(0, 14))]
        got = mojibake.heaviest(w)
        assert all(s == sum(w[a:b]) > 0 for a, b, s in got) and all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))
        # By definition: the heaviest segment (the shortest of equals), then those of what is left on both sides.
        want = []

        def split(lo, hi, w=w, want=want):
            best = max(((sum(w[a:b]), a - b, -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
            if best[0] > 0:
                want.append((best[3], best[4], best[0]))
                split(lo, best[3])
                split(best[4], hi)

        split(0, len(w))
        assert sum(s for *_, s in got) == sum(s for *_, s in want) and max((s for *_, s in got), default=0) == max((s for *_, s in want), default=0)


def test_no_values(spark, garbled):
    df, _ = garbled
    assert mojibake.garbled_values(df.limit(0), ["name"]).count() == 0
    assert mojibake.garbled_values(df.withColumn("name", F.lit(None).cast("string")), ["name"]).count() == 0


def test_segments():
    assert [(a, b) for a, b, _ in mojibake.heaviest([-1, 2, 3, -1, 2, -9, 1, -5])] == [(1, 5), (6, 7)]
    assert mojibake.heaviest([]) == [] and mojibake.heaviest([-1.0, -2.0]) == []


# --- tokens ---


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


PIECES = ["a", "b", " ", "  ", "'", "'s", "'ll", "1", "23", "가", "나다", "\n", "\t", "!", "?!", " .", "’", "　", "é", "🏭", "<|endoftext|>", "don't", "\x00", "ㅋ", "́"]


@pytest.mark.parametrize("leaf", [1, 3, 7, 20])
def test_joined_halves(leaf):
    want, codec = library(), encoding.Codec(encoding.default_path(), leaf)
    for _ in range(400):
        s = "".join(RNG.choices(PIECES, k=RNG.randint(0, 50)))
        assert codec.encode(s) == want(s), repr(s)
        assert codec.decode(codec.encode(s)) == s


def test_encoded_documents(spark):
    texts = ["Hello 세상", "", None, " \n ", "<|endoftext|>", "a" * 50_000, "가나 " * 30_000, "x1" * 20_000]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(0, texts[0], 0)], "doc_id bigint, text string, ids int")
    out = encoding.encode_documents(df)
    got = sorted((r.doc_id, r.ids) for r in out.collect())
    want = library()
    assert got == sorted([(i, want(t) if t else []) for i, t in enumerate(texts)] + [(0, want(texts[0]))])
    assert sorted((r.doc_id, r.ids) for r in encoding.encode_documents(df, most=10).collect()) == got
    assert dict(rows(encoding.decode_documents(out))) == {i: t or "" for i, t in enumerate(texts)}
    assert encoding.encode_documents(df.limit(0)).count() == 0


def test_ordinary_texts_are_joined(spark, monkeypatch):
    joins = []
    whole = encoding.Codec(encoding.default_path(), encoding.LEAF)
    monkeypatch.setattr(whole, "join", lambda *a: joins.append(1) or encoding.Codec.join(whole, *a))
    text = "경기도 가나시 다라로에 자리한 회사로 Industrial pumps 12,000 units를 만듭니다. " * 8
    assert whole.encode(text) == library()(text) and len(joins) >= 1


# --- leaks ---


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    for _ in range(1000):
        a, b = ("".join(RNG.choices("abc", k=RNG.randint(0, 14))) for _ in range(2))
        assert leakage.edit_distance(a, b) == levenshtein(a, b)


VOCABULARY = [word(RNG.randint(2, 4)) for _ in range(400)]


def passage(n):
    return RNG.sample(VOCABULARY, n)


def test_leaks(spark):
    items = [(i, passage(40)) for i in range(12)]
    fill = lambda: " ".join(passage(30))
    docs, want = [], set()

    def add(text, *leaked):
        docs.append((len(docs), text, 0))
        want.update((len(docs) - 1, i) for i in leaked)

    for i, w in items:
        changed = [x if k % 9 else "바뀜" for k, x in enumerate(w, 1)]
        add(fill() + " ".join(w) + fill(), i)
        add(fill() + "".join(w[3:36]).upper() + fill(), i)
        add(f"{fill()} {', '.join(changed)}. {fill()}", i)
        add(" ".join(w[:14]) + f"\n{fill()}\n" + "\n".join(w[20:36]), i)
        add(fill() + " ".join(w[:15]) + fill())
        add(fill() + " ".join(RNG.sample(w, 40)) + fill())
        add(" ".join(w[20:36]) + fill() + " ".join(w[:14]))
    a, b = items[0][1], items[1][1]
    add("　".join(a) + " " + " ".join(b), 0, 1)
    docs += [(9000, None, 0), (9001, "", 0), (9002, " \n", 0), (9003, " ".join(passage(20)) * 300, 0)]
    docs.append(docs[0])
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    held = spark.createDataFrame([(i, " ".join(w), "ko") for i, w in items] + [(900, None, ""), (901, "", ""), (902, "?", "")], "item_id bigint, text string, doc_id string")
    assert set(rows(leakage.leaks(df, held))) == want
    assert leakage.leaks(df, held.limit(0)).count() == 0 and leakage.leaks(df.limit(0), held).count() == 0


def brute_runs(item, text):
    """All (first word, last word, start, end) by the definition of a run, over every way the words may stand."""
    t = leakage.Text(text)
    places = {k: [m for m in range(len(t.s)) if t.s.startswith(w, m)] for k, w in enumerate(item)}
    out = set()

    def balanced(marks):
        return all(marks[:i].count("-") <= marks[:i].count("+") for i in range(len(marks) + 1))

    def go(k0, p0, k, p, marks):
        end = p + len(item[k])
        own = "".join(item[k0 : k + 1])
        if marks.count("-") <= leakage.budget(k - k0 + 1) and balanced(marks) and balanced(marks[::-1]) and levenshtein(own, t.s[p0:end]) <= leakage.CHANGED * len(own) and (k > k0 or t.is_word(p0, end)):
            out.add((k0, k, p0, end))
        skipped = 0
        for j in range(k + 1, len(item)):
            for q in places[j]:
                if end <= q <= end + 2 * skipped + leakage.SLACK:
                    more = marks + "-" * (0 if j == k + 1 and q == end else max(1, j - k - 1)) + "+"
                    if more.count("-") <= leakage.budget(len(item)):
                        go(k0, p0, j, q, more)
            skipped += len(item[j])

    for k in range(len(item)):
        for p in places[k]:
            go(k, p, k, p, "+")
    return out


def brute_covered(item, text):
    runs, need = brute_runs(item, text), leakage.needed(len(item))
    span = lambda r: r[1] - r[0] + 1
    return any(span(r) >= need for r in runs) or any(span(r) + span(x) >= need for r in runs for x in runs if r[1] < x[0] and r[3] <= x[2])


def test_runs_against_brute_force():
    rng = random.Random(17)
    vocabulary = [word(3) for _ in range(60)]
    agreed = {True: 0, False: 0}
    for _ in range(250):
        n = rng.randint(1, 18)
        item = rng.sample(vocabulary, n)
        cut = sorted(rng.sample(range(n + 1), min(n + 1, 4))) if n > 3 else [0, n, n, n]
        parts = [item[cut[0] : cut[1]], item[cut[2] : cut[3]]] if rng.random() < 0.7 else [item[cut[0] :]]
        changed = [[w if rng.random() < 0.88 else rng.choice(["바뀜", "", w[:2] + "뀨"]) for w in p] for p in parts]
        fill = lambda: " ".join(rng.choices(["사이", "다른말", "그리고"], k=rng.randint(1, 6)))  # noqa: B023, E731
        text = f"{fill()} " + f" {fill()} ".join(" ".join(p) for p in changed) + f" {fill()}"
        want = brute_covered(item, text)
        assert (leakage.Items([(1, " ".join(item))]).found(text) == [1]) == want, (item, text)
        agreed[want] += 1
    assert min(agreed.values()) > 40


def test_short_items(spark):
    held = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "Solo!"), (3, "one two"), (4, "..."), (5, "a b c d e f")], "item_id int, text string")
    texts = {1: "zz alpha BETA yy kk", 2: "zz beta alpha yy", 3: "he sang solo.", 4: "soloist", 5: "two more", 6: "alpha, then delta", 7: "xa bx c", 8: "a-b\nC"}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for most in (leakage.MOST_BROADCAST, 0):
        assert rows(leakage.leaks(df, held, most_broadcast=most)) == [(1, 1), (3, 2), (5, 3), (6, 1), (7, 5), (8, 5)]


def test_clustered_changes():
    item = passage(48)
    two_together = [w if k not in (5, 6) else "바뀜" for k, w in enumerate(item[:24])]
    at_the_ends = [w if k not in (1, 22) else "바뀜" for k, w in enumerate(item[:24])]
    find = leakage.Items([(1, " ".join(item))]).found
    assert find(" ".join(two_together)) == find(" ".join(at_the_ends)) == [1]
    assert find("말 " + " ".join(item[:22])) == [] == find(" ".join(w if k % 3 else "바뀜" for k, w in enumerate(item[:24])))
    # A second run of one word, and one with letters between it and the text's end.
    assert find(" ".join(item[:23]) + " 사이 " + item[40] + " 끝") == [1] == find(item[0] + " 사이 " + " ".join(item[20:43]))


def test_many_items_are_joined(spark):
    items = [(i, passage(20)) for i in range(60)]
    docs = [(i, " ".join(passage(5) + w[i % 9 : 20] + passage(5)), 0) for i, w in items] + [(100, None, 0), (101, "", 0), (102, " ".join(items[0][1] + items[1][1]), 0)]
    df = spark.createDataFrame(docs + docs[:5], "doc_id bigint, text string, probes int")
    held = spark.createDataFrame([(f"i{i}", " ".join(w)) for i, w in items] + [(None, "하나 둘"), ("x", None)], "item_id string, text string")
    direct, joined = leakage.leaks(df, held), leakage.leaks(df, held, most_broadcast=0)
    assert rows(joined) == rows(direct) and {(102, "i0"), (102, "i1"), (5, "i5")} <= set(rows(joined))
    assert leakage.leaks(df.limit(0), held, most_broadcast=0).count() == 0


# --- truncation ---

SENTENCES = ["{} 제품은 {} 현장에서 오래 사용되며 품질을 확인받았습니다.", "{} 공장은 {} 전용 설비를 갖추고 있습니다.", "채용 분야는 {}이며 {} 경력을 우대합니다.", "{} 시장의 수요가 늘면서 {} 주문은 크게 증가했습니다."]


def article(n):
    return " ".join(RNG.choice(SENTENCES).format(RNG.choice(VOCABULARY[:40]), RNG.choice(VOCABULARY[:40])) for _ in range(n))


@pytest.fixture(scope="module")
def texts(spark):
    data, cut = [], set()
    closings = ["담당자 영업팀", "TEL 02-0000-{}", "주소 가나로 {}", "info@{}.example", "http://{}.example", "끝", "가나{} 드림"]
    for i in range(1500):
        t = article(RNG.randint(1, 9))
        kind = i % 10
        if kind == 3:
            t += "\n" + RNG.choice(closings).format(RNG.randint(1000, 9999))
        if kind == 4 and len(t) > 200:
            t = t[:200]
            if not t.rstrip().endswith("."):
                cut.add(i)
        if kind == 5:
            t = t[: RNG.randint(20, len(t) - 5)].rstrip() + RNG.choice(["�", "&nb", "\\u", " <"])
            cut.add(i)
        if kind == 6:
            t = t[:-1] + "..."
        data.append((i, t, "limited" if kind < 5 else "free", 0))
    data += [(9000, None, "free", 0), (9001, "", "limited", 0), (9002, " \n", None, 0), (9003, article(3000), "free", 0), (9004, "짧음", None, 0)]
    return spark.createDataFrame(data, "doc_id bigint, text string, source string, limit int"), cut


def test_truncated(texts):
    df, cut = texts
    found = {r.doc_id for r in truncation.truncated(df).collect()}
    assert len(found & cut) >= 0.95 * len(cut)
    assert len(found - cut) <= 0.05 * len(cut)


def test_limits_and_rates(texts):
    df, cut = texts
    limits = [(r.source, r.unit, r["limit"]) for r in truncation.field_limits(df).collect()]
    assert limits == [("limited", "chars", 200)]
    rates = {r.source: r for r in truncation.cut_rates(df).collect()}
    assert rates["limited"].texts == 750 and rates["free"].cut >= 140


def test_several_limits(spark):
    rng = random.Random(8)
    data = []
    for i in range(3000):
        t = article(rng.randint(1, 12))
        top = 200 if i % 2 else 330
        data.append((i, t[:top] if i % 3 else t, "changed"))
    one = article(7)[:-1]
    data += [(9000 + i, one, "copies") for i in range(400)] + [(20000 + i, article(rng.randint(1, 9)), "copies") for i in range(600)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    assert sorted((r.source, r.unit, r["limit"]) for r in truncation.field_limits(df).collect()) == [("changed", "chars", 200), ("changed", "chars", 330)]


def test_marks_at_the_end():
    rng = random.Random(3)
    for _ in range(2000):
        t = "".join(rng.choices(["가", " ", "…", "...", "(계속)", "[…]", "더보기", "\n", ".", "»"], k=rng.randint(0, 60)))
        assert truncation._unmarked(t) == truncation._MARKER.sub("", t)


def test_counts_beyond_32_bits():
    import xxhash

    cell = lambda table, w: table * truncation.CELLS + xxhash.xxh64_intdigest(w) % truncation.CELLS
    cells = [cell(truncation.STARTS, "가"), cell(truncation.INNER, "나"), cell(truncation.ENDS, "다"), cell(truncation.OPEN_STARTS, "가")]
    model = truncation.Endings(__import__("numpy").array(cells), __import__("numpy").array([3 * 10**9, 5 * 10**9, 3 * 10**9, 10**9]))
    assert model.n(truncation.STARTS, "가") == 3 * 10**9 and model.rate > 0
    assert model.log_odds("가 나 나") > 0


def test_nothing_truncated(texts):
    df, _ = texts
    assert truncation.truncated(df.limit(0)).count() == 0
    assert truncation.truncated(df.where("doc_id between 9000 and 9002")).count() == 0
    copies = df.where("doc_id = 5")
    assert truncation.truncated(df.unionAll(copies)).where("doc_id = 5").count() == 2
