"""Candidates: a stratified quota sample of the master table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import seeded_order


def is_active(status: str = "operating_status") -> Column:
    """TRUE for a known active status; a missing one only isn't excluded."""
    return F.coalesce(F.col(status).isin(C.ACTIVE_STATUSES), F.lit(False))


def active_first(df: DataFrame) -> DataFrame:
    """Active companies and those without a status, with ``is_active`` to order by."""
    return df.withColumn("is_active", is_active()).where(F.col("is_active") | (F.coalesce("operating_status", F.lit("")) == ""))


def without_bottom_decile(df: DataFrame, column: str, keys: list[str] | None = None, least: int = C.DECILE_MIN_ROWS) -> DataFrame:
    """Rows above the exact 10th percentile (linear interpolation) of a column, and those where it is NULL.

    Per group of ``keys``; groups with up to ``least`` numbers stay whole. The
    percentile is an aggregate joined back, one row per group; the optimizer sees its size.
    """
    keys = keys or []
    cut = df.groupBy(*keys).agg(F.when(F.count(column) > least, F.percentile(column, 0.1)).alias("_cut"))
    joined = df.join(cut, keys) if keys else df.crossJoin(F.broadcast(cut))
    return joined.where(F.col(column).isNull() | F.col("_cut").isNull() | (F.col(column) > F.col("_cut"))).drop("_cut")


def industry_capped(df: DataFrame, keys: list[str] | None = None, share: float = C.INDUSTRY_CAP, seed: int = C.SEED) -> DataFrame:
    """At most max(1, floor(share x pool)) rows of each industry code per pool; NULL codes are exempt, '' isn't."""
    keys = keys or []
    pool = df.groupBy(*keys).agg(F.greatest(F.lit(1), F.floor(F.lit(share) * F.count("*"))).alias("_cap"))
    joined = df.join(pool, keys) if keys else df.crossJoin(F.broadcast(pool))
    place = F.row_number().over(W.partitionBy(*keys, "industry_code").orderBy(seeded_order(seed, "company_key"), "company_key"))
    ranked = joined.withColumn("_place", F.when(F.col("industry_code").isNotNull(), place))
    return ranked.where("industry_code is null or _place <= _cap").drop("_cap", "_place")


def newest_first(date: str = "registered_on", legacy_order: bool = False, ordinal: str = "company_key") -> list[Column]:
    """The order of candidates: active, then newest registration (NULL last), then a stable tie-break."""
    return [F.desc("is_active"), *([] if legacy_order else [F.col(date).desc_nulls_last()]), F.asc(ordinal)]


def _quota_table(df: DataFrame, quotas: Mapping[str, int], multiplier: float) -> DataFrame:
    rows = [(c, int(q * multiplier), int(int(q * multiplier) * C.METRO_SHARE)) for c, q in quotas.items()]
    return df.sparkSession.createDataFrame([(c, t, m, t - m) for c, t, m in rows], "category string, target int, metro_share int, rest_share int")


def stratified(df: DataFrame, quotas: Mapping[str, int] | None = None, multiplier: float = 1.5, seed: int = C.SEED, legacy_order: bool = False) -> DataFrame:
    """Per category a share of metropolitan and other companies; no back-fill.

    Input: rows of ``active_first`` with category, province, company_key. A
    stratum with fewer rows than its share comes whole; else the first
    floor(1.2 x share) by ``newest_first`` are kept and a seeded random choice
    of ``share`` of them is drawn. If no row of a category has a province, the
    category is one stratum with the whole target. The row_number filters let
    Spark prune each stratum before the shuffle.
    """
    quota = F.broadcast(_quota_table(df, quotas or C.QUOTAS, multiplier))
    known = df.groupBy("category").agg(F.max(F.col("province").isNotNull()).alias("_has_region"))
    rows = df.join(quota, "category").join(known, "category")
    metro = F.coalesce(F.col("province").isin(C.METRO_PROVINCES), F.lit(False))
    stratum = F.when(~F.col("_has_region"), F.lit("all")).when(metro, F.lit("metro")).otherwise(F.lit("rest"))
    share = F.when(~F.col("_has_region"), F.col("target")).when(metro, F.col("metro_share")).otherwise(F.col("rest_share"))
    by = ["category", "_stratum"]
    rows = rows.withColumn("_stratum", stratum).withColumn("_share", share)
    head = F.row_number().over(W.partitionBy(*by).orderBy(*newest_first(legacy_order=legacy_order)))
    pool = rows.withColumn("_head", head).where(F.col("_head") <= F.floor(F.col("_share") * C.HEAD_FACTOR))
    drawn = F.row_number().over(W.partitionBy(*by).orderBy(seeded_order(seed, "company_key"), "company_key"))
    return pool.withColumn("_drawn", drawn).where("_drawn <= _share").drop("_stratum", "_share", "_head", "_drawn", "_has_region", "metro_share", "rest_share")


def sample_candidates(master: DataFrame, quotas: Mapping[str, int] | None = None, multiplier: float = 1.5, seed: int = C.SEED, legacy_order: bool = False) -> DataFrame:
    """The candidates of every category; one lazy plan for all of them.

    Active filter, bottom deciles of employees and then capital, strata, cap per
    industry, trim to the target. The random choices are orders by a seeded
    hash, the same in any engine. An empty master gives an empty result.
    """
    pool = active_first(master.where(F.col("category").isin(list(quotas or C.QUOTAS))))
    for column in ("employees", "capital"):
        pool = without_bottom_decile(pool, column, ["category"])
    capped = industry_capped(stratified(pool, quotas, multiplier, seed, legacy_order), ["category"], seed=seed)
    last = F.row_number().over(W.partitionBy("category").orderBy(seeded_order(seed + 1, "company_key"), "company_key"))
    return capped.withColumn("_last", last).where("_last <= target").drop("_last", "target", "is_active")


def slice_rows(df: DataFrame, order: list[Column], start: int = 0, end: int = 0, limit: int = 0) -> DataFrame:
    """Rows from position ``start`` to before ``end`` (0: open), at most ``limit`` (0: all), in a stable order."""
    out = df.orderBy(*order)
    n = end - start if end else 0
    if limit:
        n = min(n, limit) if n else limit
    out = out.offset(start) if start else out
    return out.limit(n) if n else out
