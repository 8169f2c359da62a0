"""Address records that denote the same building, however they are written.

1. Every filled address is parsed into province, district, road (or
   neighbourhood of a lot), side road and number, as they are spelled.
2. Spellings: a road in Latin script is the Korean one that is romanized so. A
   road that differs in one syllable, by a vowel taken for another, from a road
   of its district that is named ESTABLISHED times as often is a typing error.
   Two roads that are both established stay two, and a name near both its own.
3. Set-containment join for missing parts: each different address is indexed by
   its rarest token; fuller addresses probe the index with each of their tokens;
   a candidate counts if the tokens found in it hold CONTAINED of the address'
   own token weight (weight: log of how rare a token is), and no part that both
   give contradicts. An address then stands for the fullest address that
   contains it, unless those contradict each other in province or district.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled
from ..session import settled
from . import korean
from .mojibake import Model, _values, examine, pair_counts
from .spread import spread

#: Share of an address' token weight that the fuller address must hold.
CONTAINED = 0.8
#: How many times as often as a misspelling the road it stands for is named in its district.
ESTABLISHED = 4
FIELDS = {"road_address": korean.road_address, "lot_address": korean.lot_address}
#: Rows up to which a table of spellings is broadcast (some 60 bytes each).
MOST_BROADCAST = 200_000
#: The parts that contradict each other where both addresses give them. A neighbourhood in brackets is only a note.
TOKENS = ["province", "district", "street", "number"]
PARSED = ["province", "district", "road", "side", "number", "area"]

_READABLE = regex.compile(r"[\x00-\x7f가-힣]*")


def corpus_model(df: DataFrame, fields: list[str], id_col: str = "row_id"):
    """The broadcast character model with which garbled values are restored before they are read; of fixed size."""
    counts = pair_counts(_values(df, id_col, fields)).toArrow()
    return df.sparkSession.sparkContext.broadcast(Model(counts.column("cell").to_numpy(), counts.column("n").to_numpy()))


def readable(text: str | None, model: Model) -> str:
    """The text, restored if it is garbled and can be restored."""
    if not text or _READABLE.fullmatch(text):
        return text or ""
    return examine(text, model)[1] or text


def parsed(companies: DataFrame, model=None) -> DataFrame:
    """One row per filled address: row_id, field, text (a hash of it) and its parts as they are spelled, NULL if it can't be read."""
    model = corpus_model(companies, list(FIELDS)) if model is None else model
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in FIELDS)))
    rows = companies.select("row_id", each.alias("x")).select("row_id", "x.*").where(filled("text")).withColumn("hash", F.xxhash64("text"))
    nothing = (None,) * len(PARSED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            parts = [FIELDS[field](readable(text, m)) or nothing for field, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *(pa.array([p[i] for p in parts], pa.string()) for i in range(len(PARSED)))], names=["row_id", "field", "text", *PARSED])

    kind = rows.schema["row_id"].dataType.simpleString()
    return spread(rows).mapInArrow(run, f"row_id {kind}, field string, text bigint, " + ", ".join(f"{p} string" for p in PARSED))


def _heard(names: DataFrame, name: str) -> DataFrame:
    """Names with how they are romanized (``roman``), how they sound with like vowels made equal (``heard``), and whether they are in Latin script."""

    at, columns = names.columns.index(name), [*names.columns, "roman", "heard", "latin"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [pa.array([korean.romanized(t) for t in texts], pa.string()), pa.array([korean.sound(t) for t in texts], pa.string()), pa.array([t.isascii() for t in texts], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=columns)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names.schema)
    return names.mapInArrow(run, f"{kinds}, roman string, heard string, latin boolean")


def _small(df: DataFrame) -> DataFrame:
    """A settled table to be broadcast if it has few rows; else Spark shuffles."""
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def spelled(addresses: DataFrame) -> DataFrame:
    """Addresses with district and road as their place usually spells them; see the module's second point."""
    districts = settled(_heard(addresses.where("district != ''").groupBy("district").agg(F.count("*").alias("n")), "district"))
    maybe = F.col("district").startswith(korean.MAYBE)
    sure = districts.where("not latin").where(~maybe).select("roman", F.col("district").alias("_district"), "n")
    of_latin = districts.where("latin").join(sure.groupBy("roman").agg(F.max_by("_district", F.struct("n", "_district")).alias("_district")), "roman")
    of_maybe = districts.where(maybe).withColumn("_word", F.substring("district", 2, 1_000)).join(sure, F.col("_word") == F.col("_district"), "left").select("district", F.coalesce("_district", F.lit("")).alias("_district"))
    to = of_latin.select("district", "_district").unionByName(of_maybe)
    rows = addresses.join(_small(to), "district", "left").withColumn("district", F.coalesce("_district", "district")).drop("_district")
    roads = settled(_heard(rows.groupBy("field", "district", "road").agg(F.count("*").alias("n")), "road"))
    # Where no district is given, the roads of all districts count.
    everywhere = roads.where("district != ''").groupBy("field", "road", "roman", "heard", "latin").agg(F.sum("n").alias("n")).withColumn("district", F.lit(""))
    known = roads.where("district != ''").unionByName(everywhere).where("not latin").select("field", "district", "heard", F.col("road").alias("_road"), F.col("roman").alias("_roman"), F.col("n").alias("_n"))
    near = roads.join(known, ["field", "district", "heard"])
    twin = F.max((F.col("road") == F.col("_road")).cast("int"))
    same_letters = F.col("latin") & (F.col("road") == F.col("_roman"))
    often = F.col("_n") >= ESTABLISHED * F.col("n")
    one_off = F.col("latin") | (F.levenshtein("road", "_road") == 1) & (F.length("road") == F.length("_road"))
    fits = (F.col("road") != F.col("_road")) & (same_letters | often & one_off)
    # Spellings of one sound in one district are few; the two best tell whether one of them clearly is the road.
    options = F.slice(F.sort_array(F.collect_list(F.when(fits, F.struct(same_letters.alias("s"), "_n", "_road"))), asc=False), 1, 2).alias("o")
    to = near.groupBy("field", "district", "road").agg(options, twin.alias("_twin")).where("size(o) > 0 and (district != '' or _twin = 0)")
    first, second = F.col("o")[0], F.get("o", F.lit(1))
    clear = second.isNull() | (first["s"] != second["s"]) | (first["_n"] >= ESTABLISHED * second["_n"])
    to = to.where(clear).select("field", "district", "road", first["_road"].alias("_road"))
    # The road a misspelling stands for may itself be one of a road named still more often.
    again = to.select("field", "district", F.col("road").alias("_road"), F.col("_road").alias("_last"))
    to = to.join(again, ["field", "district", "_road"], "left").select("field", "district", "road", F.coalesce("_last", "_road").alias("_road"))
    named = rows.join(_small(settled(to)), ["field", "district", "road"], "left").withColumn("road", F.coalesce("_road", "road"))
    return named.withColumn("street", F.concat_ws("|", "road", F.nullif("side", F.lit("")))).drop("_road", "road", "side")


def _token(part: str) -> Column:
    """The number of a token: a hash of part, field and value; NULL where the address doesn't give the part."""
    return F.when(F.col(part) != "", F.xxhash64(F.lit(part), "field", part))


def _complete() -> Column:
    """Does an address give every part? Then no other one can be fuller."""
    return (F.col("province") != "") & (F.col("district") != "")


def resolved(addresses: DataFrame) -> DataFrame:
    """For every different address that lacks a part: address, and the building that the fullest address containing it denotes.

    Every address gives street and number, and unequal numbers contradict, so
    index and probe meet by token and number. Weights are counted over all
    different addresses of either kind.
    """
    key = ["field", *TOKENS]
    different = settled(addresses.groupBy("address", *key).agg(F.count("*").alias("n"), F.max(F.length("area")).alias("noted")))
    often = different.select(F.explode(F.array_compact(F.array(*map(_token, TOKENS)))).alias("token")).groupBy("token").agg(F.count("*").alias("often"))
    total = F.broadcast(different.agg(F.count("*").alias("total")))
    short = different.where(~_complete())
    parts = F.explode(F.array_compact(F.array(*(F.when(_token(p).isNotNull(), F.struct(F.lit(p).alias("part"), _token(p).alias("token"))) for p in TOKENS)))).alias("t")
    weight = (F.log(F.col("total") + 1) - F.log("often") + 0.01).alias("weight")
    weighed = short.select("address", "number", parts).select("address", "number", "t.*").join(often, "token").crossJoin(total).select("address", "number", "part", "token", weight)
    rarest = F.max_by("token", F.when(F.col("part") != "number", F.struct("weight", "token"))).alias("rarest")
    own = weighed.groupBy("address", "number").agg(rarest, F.sum("weight").alias("own"), *(F.sum(F.when(F.col("part") == p, F.col("weight"))).alias(f"w_{p}") for p in TOKENS))
    short = short.select("address", *key).join(own.drop("number"), "address").withColumn("_key", F.xxhash64("number", "rarest"))
    probes = different.select(F.col("address").alias("full"), F.explode(F.array_compact(F.array(*(F.xxhash64("number", _token(p)) for p in TOKENS if p != "number")))).alias("_key"))
    near = probes.join(short.select("address", "_key"), "_key").select("address", "full")
    full = different.select(F.col("address").alias("full"), "n", "noted", *(F.col(p).alias(f"f_{p}") for p in TOKENS))
    rows = near.join(full, "full").join(short.drop("_key", "rarest"), "address")
    agree, held, given, f_given = F.lit(True), F.lit(0.0), F.lit(0), F.lit(0)
    for p in TOKENS:
        agree = agree & ((F.col(p) == "") | (F.col(f"f_{p}") == "") | (F.col(p) == F.col(f"f_{p}")))
        held = held + F.when((F.col(p) != "") & (F.col(p) == F.col(f"f_{p}")), F.col(f"w_{p}")).otherwise(0.0)
        given, f_given = given + (F.col(p) != "").cast("int"), f_given + (F.col(f"f_{p}") != "").cast("int")
    fuller = rows.where(agree & (held >= CONTAINED * F.col("own")) & (f_given >= given)).withColumn("_given", f_given)
    several = lambda p: F.count_distinct(F.when(F.col(f"f_{p}") != "", F.col(f"f_{p}"))) > 1
    best = fuller.groupBy("address", *key).agg(
        F.max_by(F.struct(*(F.col(f"f_{p}").alias(p) for p in TOKENS)), F.struct("_given", "n", "noted", "full")).alias("b"),
        (several("district") | several("province")).alias("alone"),
    )
    alone = _building(*TOKENS, F.when(F.col("district") == "", F.col("address").cast("string")).otherwise(F.lit("")))
    return best.select("address", F.when(F.col("alone"), alone).otherwise(_building(*(f"b.{p}" for p in TOKENS))).alias("building"))


def _building(*parts: str | Column) -> Column:
    return F.concat_ws("#", "field", *parts)


def _placed(companies: DataFrame, model=None) -> DataFrame:
    """row_id, field, text and building (NULL for an unreadable address) of each filled address."""
    rows = settled(parsed(companies, model))
    addresses = spelled(rows.where("road is not null")).withColumn("address", F.xxhash64("field", *TOKENS))
    whole = addresses.where(_complete()).select("row_id", "field", "text", _building(*TOKENS).alias("building"))
    partly = addresses.where(~_complete()).join(_small(settled(resolved(addresses))), "address").select("row_id", "field", "text", "building")
    unreadable = rows.where("road is null").select("row_id", "field", "text", F.lit(None).cast("string").alias("building"))
    return whole.unionByName(partly).unionByName(unreadable)


def buildings(companies: DataFrame, model=None) -> DataFrame:
    """(row_id, field, building) of each readable address: rows of one building are the same location.

    This membership is as long as the table, whatever the size of a building.
    Repeated rows come out again. NULL, blank and unreadable addresses have none.
    """
    return _placed(companies, model).where("building is not null").select("row_id", "field", "building")


def same_location(companies: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b) of rows at the same building, the smaller id first.

    Input: row_id (unique), road_address, lot_address; other columns are ignored.
    Both rows fill road_address or both fill lot_address, and no field that both
    fill has exactly the same text (such pairs are copies, not writings). NULL
    and blank addresses match nothing; repeated rows give one result. Pairs are
    made within one building only and each comes out once: by its lot only where
    the roads' buildings differ. Spark splits the join of a hot building (adaptive skew join).
    """
    at = lambda f, c, n: F.max(F.when(F.col("field") == f, c)).alias(n)
    building = F.xxhash64("building")
    of_field = [(f, n) for f, n in zip(FIELDS, ("road", "lot"), strict=True)]
    columns = [x for f, n in of_field for x in (at(f, F.when(F.col("building").isNotNull(), building), n), at(f, F.col("text"), f"{n}_text"))]
    rows = settled(_placed(companies).groupBy("row_id").agg(*columns))
    keys = F.explode(F.array(F.struct(F.lit(True).alias("is_road"), F.col("road").alias("place")), F.struct(F.lit(False).alias("is_road"), F.col("lot").alias("place"))))
    each = rows.select("row_id", "road", "road_text", "lot_text", keys.alias("k")).select("row_id", "road", "road_text", "lot_text", "k.*").where("place is not null")
    a, b = each.alias("a"), each.alias("b")
    equal = lambda c: F.coalesce(F.col(f"a.{c}") == F.col(f"b.{c}"), F.lit(False))
    on = (F.col("a.place") == F.col("b.place")) & (F.col("a.is_road") == F.col("b.is_road")) & (F.col("a.row_id") < F.col("b.row_id"))
    once = F.col("a.is_road") | ~equal("road")
    return a.join(b, on & once & ~equal("road_text") & ~equal("lot_text")).select(F.col("a.row_id").alias("row_id_a"), F.col("b.row_id").alias("row_id_b"))


def p6_found(spark, sf_dir: str) -> DataFrame:
    return same_location(spark.read.parquet(f"{sf_dir}/companies.parquet"))


def p6_buildings(spark, sf_dir: str) -> DataFrame:
    return buildings(spark.read.parquet(f"{sf_dir}/companies.parquet"))
