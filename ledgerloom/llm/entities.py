"""Matching companies across registries that share no identifier.

Every attribute of a record is encoded as a 64-bit vector of its q-grams. Two
records are compared if they agree exactly in one attribute (telephone,
building, name) and are close in another; close pairs are found exactly by
multi-index Hamming hashing. Dice scores of the vectors, weighted by field,
give a score that a logistic fit turns into a confidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settled
from . import korean
from .locations import _small, buildings, corpus_model, readable
from .spread import spread

BITS, Q = 64, 2
#: Hamming radius within which vectors are close: one changed letter changes two q-grams, so up to four bits.
RADIUS = 4
#: Vectors are cut into RADIUS + KEYED chunks; close ones agree in at least KEYED of them.
KEYED = 2
#: A group of records with one exact attribute is compared pair by pair up to this size, by the multi-index beyond it.
DIRECT = 48
#: Pairs the confidence is fitted on, at most: labelled by complete registration numbers.
SAMPLE = 40_000
#: Confidence from which two records are the same company.
MATCH = 0.5
#: Digits in which registration numbers of one company differ at most: each changes two of their bits.
TYPO_DIGITS = RADIUS // 2
#: Log-odds that registration numbers add: equal, off by a typing error, one a part of the other, different. A number in
#: fifty has a typing error or is a part; unrelated ones, which share their middle digits, are near by a chance of about 5e-5.
NUMBER_ODDS = {"equal": 6.0, "near": 6.0, "part": 3.0, "far": -3.0, "notpart": -2.0}

#: Telephone numbers of one area are alike in most digits; only a high Dice score says something.
STEEP = 8.0

FEATURES = ["bias", "name", "line_differs", "phone", "phone_missing", "place", "place_missing"]
#: Log-odds before any label is seen, in the order of FEATURES; the fit is drawn towards them.
START = np.array([-22.0, 16.0, -6.0, 8.0, 4.0, 10.0, 5.0])


def _grams(text: str) -> int:
    """The q-grams of a text, padded, as bits of a signed 64-bit vector."""
    import xxhash

    if not text:
        return 0
    s = f"^{text}$"
    v = 0
    for i in range(len(s) - Q + 1):
        v |= 1 << (xxhash.xxh64_intdigest(s[i : i + Q]) % BITS)
    return v - (1 << BITS) if v >> (BITS - 1) else v


def _placed(text: str) -> int:
    """Digits with their place as bits: numbers differ in as many places as they differ in digits."""
    import xxhash

    v = 0
    for i, c in enumerate(text):
        v |= 1 << (xxhash.xxh64_intdigest(f"{i}{c}") % BITS)
    return v - (1 << BITS) if v >> (BITS - 1) else v


def records(companies: DataFrame) -> DataFrame:
    """One row per company row: ids, comparable attributes (NULL or '' where missing), hashed where only equality counts, and their vectors."""
    model = corpus_model(companies, ["company_name_raw", "road_address", "lot_address"])
    rows = companies.select("row_id", *(F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(n) for c, n in (("company_key", "key"), ("source_dataset_id", "source"))), F.coalesce("company_name_raw", "company_name").alias("name"), "phone", "biz_reg_no")
    new = [("core", "string"), ("line", "string"), ("phone", "string"), ("number", "string"), ("core_bits", "bigint"), ("phone_bits", "bigint"), ("number_bits", "bigint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            names = [korean.company(readable(t, m)) for t in batch.column(3).to_pylist()]
            phones = [korean.phone(t) for t in batch.column(4).to_pylist()]
            numbers = [korean.registration(t) for t in batch.column(5).to_pylist()]
            strings = [[n[0] for n in names], [n[1] for n in names], phones, numbers]
            bits = [[_grams(n[0]) for n in names], [_placed(p) for p in phones], [_placed(n) if len(n) == 10 else 0 for n in numbers]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(x, pa.string()) for x in strings), *(pa.array(x, pa.int64()) for x in bits)], names=["row_id", "key", "source", *(n for n, _ in new)])

    schema = ", ".join([f"row_id {rows.schema['row_id'].dataType.simpleString()}", "key bigint", "source bigint", *(f"{n} {k}" for n, k in new)])
    number = lambda c: F.when(F.col(c) != "", F.xxhash64(c)).alias(c)
    named = spread(rows).mapInArrow(run, schema).select("row_id", "key", "source", "line", "number", number("core"), number("phone"), "core_bits", "phone_bits", "number_bits")
    of_field = [("road_address", "road"), ("lot_address", "lot")]
    places = buildings(companies, model).groupBy("row_id").agg(*(F.max(F.when(F.col("field") == f, F.xxhash64("building"))).alias(n) for f, n in of_field))
    return named.join(places, "row_id", "left")


def with_units(rows: DataFrame) -> DataFrame:
    """Rows of one source and key with the same attributes are one ``unit``: a hash of all of them."""
    return rows.withColumn("unit", F.xxhash64(*(c for c in rows.columns if c != "row_id")))


def _chunks(bits: Column, n: int) -> list[Column]:
    width = -(-BITS // n)
    return [F.shiftrightunsigned(bits, i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(n)]


def close_pairs(df: DataFrame, views: list[tuple[Column, Column]], radius: int = RADIUS) -> DataFrame:
    """(unit_a, unit_b), unit_a < unit_b, of all rows that agree exactly in the first column of a view and whose bits in its second differ in at most ``radius`` places.

    Each pair comes once per view. NULL agrees with nothing. Only numbers are
    shuffled: a hash of view and value, the bits, the unit. Groups of up to
    DIRECT rows are compared directly. In larger groups the vectors are cut into
    radius + KEYED chunks and joined on every combination of KEYED of them: at
    most ``radius`` chunks can differ, so close vectors agree in one combination
    at least, and nothing is lost. A pair counts at the first combination it
    agrees in.
    """
    seen = F.explode(F.array(*(F.struct(F.when(value.isNotNull(), F.xxhash64(F.lit(k), value)).alias("_exact"), bits.alias("_bits")) for k, (value, bits) in enumerate(views)))).alias("_v")
    rows = df.select("unit", seen).select("unit", "_v.*").where("_exact is not null")
    hot = _small(settled(rows.groupBy("_exact").agg(F.count("*").alias("_n")).where(F.col("_n") > DIRECT).select("_exact")))
    n = radius + KEYED
    combos = list(combinations(range(n), KEYED))
    in_order = F.col("a.unit") < F.col("b.unit")
    near = F.bit_count(F.col("a._bits").bitwiseXOR(F.col("b._bits"))) <= radius
    out = [F.col("a.unit").alias("unit_a"), F.col("b.unit").alias("unit_b")]
    few = rows.join(hot, "_exact", "left_anti")
    direct = few.alias("a").join(few.alias("b"), (F.col("a._exact") == F.col("b._exact")) & in_order & near).select(*out)
    keys = F.explode(F.array(*(F.struct(F.lit(k).alias("_combo"), F.xxhash64("_exact", *(_chunks(F.col("_bits"), n)[i] for i in c)).alias("_key")) for k, c in enumerate(combos)))).alias("_k")
    many = rows.join(hot, "_exact", "left_semi").select("unit", "_exact", "_bits", keys).select("unit", "_exact", "_bits", "_k.*")
    a, b = (_chunks(F.col(f"{side}._bits"), n) for side in "ab")
    agrees = [reduce(lambda x, y: x & y, (a[i] == b[i] for i in c)) for c in combos]
    first = reduce(lambda rest, ke: F.when(ke[1], F.lit(ke[0])).otherwise(rest), reversed(list(enumerate(agrees))), F.lit(-1))
    on = (F.col("a._key") == F.col("b._key")) & (F.col("a._combo") == F.col("b._combo")) & (F.col("a._exact") == F.col("b._exact"))
    indexed = many.alias("a").join(many.alias("b"), on & in_order & near & (first == F.col("a._combo"))).select(*out)
    return direct.unionByName(indexed)


def candidates(rows: DataFrame) -> DataFrame:
    """(a, b): records close in name with the same telephone or building, or of the same name with close registration numbers."""
    rows = rows.where("core is not null")
    name, full = F.col("core_bits"), F.when(F.col("number_bits") != 0, F.col("core"))
    pairs = close_pairs(rows, [(F.col("phone"), name), (F.col("road"), name), (F.col("lot"), name), (full, F.col("number_bits"))]).distinct()
    of = F.struct("unit", "key", "source", "line", "number", "road", "lot", "core_bits", "phone_bits", "number_bits")
    side = lambda n: rows.select(F.col("unit").alias(f"unit_{n}"), of.alias(n))
    return pairs.join(side("a"), "unit_a").join(side("b"), "unit_b").select("a", "b")


def _dice(x: str) -> Column:
    a, b = F.col(f"a.{x}"), F.col(f"b.{x}")
    both = F.bit_count(a) + F.bit_count(b)
    return F.when((a != 0) & (b != 0), 2.0 * F.bit_count(a.bitwiseAND(b)) / both)


def compared(pairs: DataFrame) -> DataFrame:
    """The features of each pair, and what the registration numbers say."""
    phone = _dice("phone_bits")
    same = lambda f: F.when((F.col(f"a.{f}").isNotNull()) & (F.col(f"b.{f}").isNotNull()), (F.col(f"a.{f}") == F.col(f"b.{f}")).cast("double"))
    place = F.greatest(same("road"), same("lot"))
    lines = (F.col("a.line") != "") & (F.col("b.line") != "") & (F.col("a.line") != F.col("b.line"))
    x, y = F.col("a.number"), F.col("b.number")
    full = (F.length(x) == 10) & (F.length(y) == 10)
    off = sum(((F.substring(x, i, 1) != F.substring(y, i, 1)).cast("int") for i in range(1, 11)), F.lit(0))
    part = F.when(F.length(x) < F.length(y), y.startswith(x)).otherwise(x.startswith(y))
    number = (
        F.when((x == "") | (y == ""), "missing")
        .when(full & (x == y), "equal").when(full & (off <= TYPO_DIGITS), "near").when(full, "far")
        .when(part, "part").otherwise("notpart")
    )
    return pairs.select(
        F.col("a.unit").alias("unit_a"), F.col("b.unit").alias("unit_b"),
        ((F.col("a.key") != F.col("b.key")) & (F.col("a.source") != F.col("b.source"))).alias("wanted"),
        number.alias("number"), F.coalesce(_dice("core_bits"), F.lit(0.0)).alias("name"), lines.cast("double").alias("line_differs"),
        F.pow(F.coalesce(phone, F.lit(0.0)), F.lit(STEEP)).alias("phone"), phone.isNull().cast("double").alias("phone_missing"),
        F.coalesce(place, F.lit(0.0)).alias("place"), place.isNull().cast("double").alias("place_missing"),
    )


def _features() -> list[Column]:
    return [F.lit(1.0).alias("bias"), *map(F.col, FEATURES[1:])]


def _odds(w: np.ndarray) -> Column:
    return sum((F.col(f) * float(v) for f, v in zip(FEATURES[1:], w[1:], strict=True)), F.lit(float(w[0])))


def fitted(pairs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights of FEATURES by ridge logistic regression on at most ``sample`` pairs with complete registration numbers.

    Equal numbers mean the same company, far ones different ones; near ones are
    left out. The ridge pulls towards START, which decides where there are no
    labels. Half of the pairs give the weights, the others then scale and shift
    the log-odds, so that confidences are the shares of true matches (``reliability``).
    """
    labelled = pairs.where("number in ('equal', 'far')").select("unit_a", "unit_b", *_features(), (F.col("number") == "equal").cast("double").alias("y"))
    data = labelled.orderBy(F.xxhash64("unit_a", "unit_b")).limit(sample).toPandas()
    if len(data) < 50 or data["y"].nunique() < 2:
        return START.copy()
    x, y = data[FEATURES].to_numpy(float), data["y"].to_numpy(float)
    # The rows come in random order: weights from the even ones, calibrated on the odd ones.
    w = _logistic(x[::2], y[::2], START, 0.02 * len(x[::2]))
    odds = x[1::2] @ w
    slope = _logistic(np.column_stack([np.ones(len(odds)), odds]), y[1::2], np.array([0.0, 1.0]), 1.0)
    w = slope[1] * w
    w[0] += slope[0]
    return w


def _logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray, ridge: float) -> np.ndarray:
    """Weights by Newton's method with step halving, drawn towards ``start``."""
    loss = lambda w: (np.logaddexp(0.0, x @ w) - y * (x @ w)).sum() + ridge / 2 * ((w - start) ** 2).sum()
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * (w - start)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def matched_units(pairs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(unit_a, unit_b, confidence) of compared pairs that are the same company."""
    w = START if weights is None else weights
    odds = _odds(w)
    says = F.coalesce(reduce(lambda c, kv: c.when(F.col("number") == kv[0], F.lit(kv[1])), NUMBER_ODDS.items(), F.when(F.lit(False), F.lit(0.0))), F.lit(0.0))
    confidence = 1 / (1 + F.exp(-(odds + says)))
    return pairs.where("wanted").select("unit_a", "unit_b", confidence.alias("confidence")).where(F.col("confidence") >= MATCH).groupBy("unit_a", "unit_b").agg(F.max("confidence").alias("confidence"))


def same_companies(companies: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b, confidence) of rows of different sources and keys that are the same company.

    Input: row_id, company_key, source_dataset_id, company_name_raw,
    company_name, road_address, lot_address, phone, biz_reg_no; other columns are
    ignored. Missing attributes (NULL, blank, fillers) say nothing; a record with
    a name only, or without one, matches nothing, nor does one without key or
    source. Repeated rows are compared once and come out
    each. An empty table gives an empty result.
    """
    rows, pairs = _compared(companies)
    found = matched_units(pairs, fitted(pairs))
    of = rows.select("unit", "row_id")
    a = of.select(F.col("unit").alias("unit_a"), F.col("row_id").alias("x"))
    b = of.select(F.col("unit").alias("unit_b"), F.col("row_id").alias("y"))
    each = found.join(a, "unit_a").join(b, "unit_b").where("x != y")
    return each.select(F.least("x", "y").alias("row_id_a"), F.greatest("x", "y").alias("row_id_b"), "confidence")


def _compared(companies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their units, and the compared pairs of different units."""
    rows = settled(with_units(records(companies)))
    unique = settled(rows.drop("row_id").dropDuplicates(["unit"]))
    return rows, settled(compared(candidates(unique)))


def reliability(companies: DataFrame, bins: int = 10) -> DataFrame:
    """bin, pairs, confidence, matches: mean confidence, without what registration numbers add, and share of equal numbers among all labelled pairs, by confidence."""
    _, pairs = _compared(companies)
    confidence = 1 / (1 + F.exp(-_odds(fitted(pairs))))
    labelled = pairs.where("number in ('equal', 'far')").select(confidence.alias("confidence"), (F.col("number") == "equal").cast("double").alias("match"))
    return labelled.groupBy(F.least(F.lit(bins - 1), F.floor(F.col("confidence") * bins)).cast("int").alias("bin")).agg(F.count("*").alias("pairs"), F.avg("confidence").alias("confidence"), F.avg("match").alias("matches")).orderBy("bin")


def p5_found(spark, sf_dir: str) -> DataFrame:
    return same_companies(spark.read.parquet(f"{sf_dir}/companies.parquet")).select("row_id_a", "row_id_b").distinct()


def p5_reliability(spark, sf_dir: str) -> DataFrame:
    return reliability(spark.read.parquet(f"{sf_dir}/companies.parquet"))
