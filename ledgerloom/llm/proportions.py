"""Samples whose category shares match given proportions, with a minimum of each category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import strip
from ..session import settled

#: Rows that one range of the random order holds, about; numbering a category takes as many tasks as it has ranges.
PER_SLICE, MOST_BITS = 20_000, 20


def named(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows with ``category`` as the plans spell it; rows of other categories are left out.

    Categories are the same if they differ only in case, width, outer blanks or
    Unicode form. The comparison is Unicode collation at its second level.
    """
    level = lambda c: F.collate(strip(c), "UNICODE_CI")
    names = plans.select(F.col("category").alias("_name"), level("category").alias("_same")).distinct()
    return rows.join(names, level("category") == F.col("_same")).withColumn("category", F.col("_name")).drop("_name", "_same")


def population(companies: DataFrame, plans: DataFrame) -> DataFrame:
    """The members plans may draw: distinct (company_key, category, province), province NULL for the whole country; and ``most``, the places that matter.

    One scan. Rows without a key, of categories no plan has, or in provinces no
    plan names are left out.
    """
    rows = named(companies.select("company_key", "category", "province").where("company_key is not null"), plans)
    each = rows.select("company_key", "category", F.explode(F.array_distinct(F.array("province", F.lit(None).cast("string")))).alias("province"))
    asked = plans.groupBy(F.col("category").alias("_category"), F.col("province").alias("_province")).agg(F.max(F.greatest("sample_size", "min_rows")).alias("most"))
    wanted = each.join(asked, (F.col("category") == F.col("_category")) & F.col("province").eqNullSafe(F.col("_province")))
    return wanted.select("company_key", "category", "province", "most").distinct()


def _bits(n: int) -> int:
    return min(MOST_BITS, max(0, n // PER_SLICE).bit_length())


def ranked(members: DataFrame, group: list[str], item: str, seed: int, most: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Each member's place ``rank`` in the seeded random order of its group, counted from 1; and every group's size ``n``.

    The order is that of a hash, which is uniform: the hash range is cut into
    slices, rows are numbered within (group, slice) and the sizes of the slices
    before are added. So a group with a third of all rows is numbered by many
    tasks, and the result is that of one row_number over the group. Only slices
    that begin before place ``most`` of their group (a column) are numbered.
    """
    # A fixed shape of 15 hex digits keeps the hash a positive BIGINT.
    place = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), item), 256), 1, 15), 16, 10).cast("bigint")
    rows = settled(members.withColumn("_at", place))
    rows = rows.withColumn("_slice", F.shiftright("_at", 60 - _bits(rows.count())))
    sizes = rows.groupBy(*group, "_slice").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    sizes = settled(sizes.withColumn("_before", F.coalesce(before, F.lit(0))))
    within = F.row_number().over(W.partitionBy(*group, "_slice").orderBy("_at", item))
    on = [F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}")) for g in group] + [F.col("r._slice") == F.col("s._slice")]
    joined = rows.alias("r").join(sizes.alias("s"), on).select("r.*", "_before")
    joined = joined.where(F.col("_before") < F.col(most)) if most else joined
    placed = joined.withColumn("rank", F.col("_before") + within).drop("_at", "_slice", "_before")
    return placed, sizes.groupBy(*group).agg(F.sum("_n").alias("n"))


def sample(companies: DataFrame, plans: DataFrame, seed: int = C.SEED) -> DataFrame:
    """The members drawn for each plan: plan_id, category, company_key, rank, priority, is_floor.

    Divisor method of odd numbers: the member at place k of its category has
    priority (k - 0.5) / target. The first min_rows of every category come first,
    then the smallest priorities until sample_size is reached; a category that
    runs out has no more priorities, so its seats go to the others. Ties go to
    the category that sorts first. Fewer members than sample_size: all are
    drawn. Categories with target 0 get their floor only. Plans name a category once.
    """
    return _draw(companies, plans, seed)[0]


def _draw(companies: DataFrame, plans: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    order, sizes = ranked(population(companies, plans), ["province", "category"], "company_key", seed, "most")
    # No category gets more than the whole sample (or its floor), and no priority is greater than that of the last place with the least target.
    least = F.min(F.when(F.col("target_pct") > 0, F.col("target_pct"))).over(W.partitionBy("plan_id"))
    plan = plans.select("plan_id", "category", "province", "sample_size", "target_pct", "min_rows", (F.col("sample_size") / least).alias("_top"))
    o, p = order.alias("o"), plan.alias("p")
    rows = p.join(o, (F.col("p.category") == F.col("o.category")) & F.col("p.province").eqNullSafe(F.col("o.province")))
    is_floor = F.col("rank") <= F.col("min_rows")
    priority = F.when(F.col("target_pct") > 0, (F.col("rank") - 0.5) / F.col("target_pct"))
    rows = rows.select("plan_id", "p.category", "company_key", "rank", "sample_size", "_top", priority.alias("priority"), is_floor.alias("is_floor"))
    rows = rows.where("is_floor or rank <= sample_size and priority is not null")
    return _smallest(rows), sizes


def _smallest(rows: DataFrame, per_slice: int = PER_SLICE) -> DataFrame:
    """Per plan the ``sample_size`` rows that come first by (floor, priority, category), by slices of the priority range, so that no task sorts a plan."""
    rows = settled(rows)
    slices = max(1, rows.count() // per_slice)
    cut = F.when(F.col("is_floor"), F.lit(-1)).otherwise(F.least(F.lit(slices - 1), (F.col("priority") / F.col("_top") * slices).cast("int")))
    sliced = rows.withColumn("_slice", cut)
    sizes = sliced.groupBy("plan_id", "_slice").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("plan_id").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("plan_id", "_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("plan_id", "_slice").orderBy("priority", "category", "rank"))
    numbered = sliced.join(sizes, ["plan_id", "_slice"]).where("_slice = -1 or _before < sample_size").withColumn("_place", F.col("_before") + place)
    return numbered.where("is_floor or _place <= sample_size").select("plan_id", "category", "company_key", "rank", "priority", "is_floor")


def report(companies: DataFrame, plans: DataFrame, seed: int = C.SEED) -> DataFrame:
    """Per plan and category: drawn, supply, need, and whether the target can't be reached.

    need is the greater of min_rows and sample_size x target_pct / 100 (kept in
    hundredths, so it is exact). A category whose draw stays below its need is
    ``unmet`` if its whole supply does; others only gave way to floors or fractions.
    """
    drawn, sizes = _draw(companies, plans, seed)
    drawn = drawn.groupBy("plan_id", "category").agg(F.count("*").alias("drawn"))
    p, s, d = plans.alias("p"), sizes.alias("s"), drawn.alias("d")
    joined = p.join(d, (F.col("p.plan_id") == F.col("d.plan_id")) & (F.col("p.category") == F.col("d.category")), "left")
    joined = joined.join(s, (F.col("p.category") == F.col("s.category")) & F.col("p.province").eqNullSafe(F.col("s.province")), "left")
    need = F.greatest(F.col("p.min_rows") * 100, F.col("p.sample_size") * F.col("p.target_pct"))
    supply, got = F.coalesce("s.n", F.lit(0)), F.coalesce("d.drawn", F.lit(0))
    return joined.select(
        F.col("p.plan_id").alias("plan_id"), F.col("p.category").alias("category"), got.alias("drawn"),
        supply.alias("supply"), (need / 100).alias("need"), ((got * 100 < need) & (supply * 100 < need)).alias("unmet"),
    )


def _read(spark, sf_dir: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("companies", "sample_plans")]


def p2_found(spark, sf_dir: str) -> DataFrame:
    return report(*_read(spark, sf_dir)).where("unmet").select("plan_id", "category")


def p2_sample(spark, sf_dir: str) -> DataFrame:
    return sample(*_read(spark, sf_dir)).select("plan_id", "category", "company_key")


_CLEAN = "regexp_replace({0}, '^[\\s\\x{{3000}}\\x{{a0}}]+|[\\s\\x{{3000}}\\x{{a0}}]+$', '', 'g')"
_WIDE = "ＩＴＳＷｉｔｓｗ＿"
_NAMED = f"""
rows_ AS (
  SELECT company_key, province, lower(translate(nfc_normalize({_CLEAN.format('category')}), '{_WIDE}', 'ITSWitsw_')) AS same FROM companies WHERE company_key IS NOT NULL),
named AS (
  SELECT DISTINCT r.company_key, r.province, c.category
  FROM rows_ r JOIN (SELECT DISTINCT category FROM sample_plans) c ON r.same = lower(c.category))"""
P2_SQL = f"""
WITH {_NAMED}
SELECT p.plan_id, p.category FROM sample_plans p
WHERE greatest(p.min_rows * 100, p.sample_size * p.target_pct) > 100 * (
  SELECT count(DISTINCT n.company_key) FROM named n
  WHERE n.category = p.category AND (p.province IS NULL OR n.province = p.province))
"""
P2_SAMPLE_SQL = f"""
WITH {_NAMED},
members AS (
  SELECT DISTINCT p.plan_id, p.category, p.sample_size, p.target_pct, p.min_rows, n.company_key
  FROM sample_plans p JOIN named n ON n.category = p.category AND (p.province IS NULL OR n.province = p.province)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY plan_id, category ORDER BY substr(sha256('{C.SEED}|' || company_key), 1, 15), company_key) AS place FROM members),
rated AS (
  SELECT *, place <= min_rows AS is_floor, CASE WHEN target_pct > 0 THEN (place - 0.5::DOUBLE) / target_pct END AS priority FROM placed),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY is_floor DESC, priority, category, place) AS seat
  FROM rated WHERE is_floor OR priority IS NOT NULL)
SELECT plan_id, category, company_key FROM ordered WHERE is_floor OR seat <= sample_size
"""
