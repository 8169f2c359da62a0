"""Reports as tables: category sheets, details, summary, status. Styling belongs to the workbook writer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.master import numbered
from ..operators.picks import best_picks
from ..streaming import state as S

#: Columns of the company sheets, in order; those a table lacks are left out.
SHEET_COLUMNS = ["company_name", "email", "source_url", "method", "industry_name", "province", "district", "road_address", "phone", "homepage", "employees", "capital", "category", "source_dataset_id", "checked_at"]


def with_master(master: DataFrame, emails: DataFrame) -> DataFrame:
    """Companies with their addresses (inner, 1:N); the addresses' own company_name is dropped. The optimizer picks the join."""
    clash = [c for c in emails.columns if c in master.columns and c != "company_key"]
    return master.join(emails.drop(*clash), "company_key")


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(c for c in columns if c in df.columns))


def dense_numbers(df: DataFrame, position: str, name: str = "company_name", out: str = "no") -> DataFrame:
    """Companies numbered from 1 by their first appearance; the numbers are made on one row per name, in ranges."""
    firsts = df.groupBy(name).agg(F.min(position).alias("_first"))
    ranked = numbered(firsts, [F.asc("_first"), F.asc(name)], out).drop("_first")
    a, b = df.alias("a"), ranked.alias("b")
    return a.join(b, F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))).select("a.*", out)


def quota_summary(master: DataFrame, picks: DataFrame, quotas: Mapping[str, int] | None = None) -> DataFrame:
    """category, quota, pick_rows, companies, delta: one row per category, also without picks; companies are counted by name."""
    spark = master.sparkSession
    dim = spark.createDataFrame(list((quotas or C.QUOTAS).items()), "category string, quota bigint")
    got = with_master(master, picks).groupBy("category").agg(F.count("*").alias("pick_rows"), F.count_distinct("company_name").alias("companies"))
    joined = dim.join(got, "category", "left").na.fill(0, ["pick_rows", "companies"])
    return joined.withColumn("delta", F.col("companies") - F.col("quota"))


def progress(state: DataFrame, candidates: DataFrame) -> DataFrame:
    """processed, candidates, progress_pct (0 without candidates)."""
    a = state.agg(F.count_distinct("company_key").alias("processed"))
    b = candidates.agg(F.count("*").alias("candidates"))
    pct = F.when(F.col("candidates") > 0, F.col("processed") * 100.0 / F.col("candidates")).otherwise(F.lit(0.0))
    return a.crossJoin(b).withColumn("progress_pct", pct)


def report(master: DataFrame, state: DataFrame, quotas: Mapping[str, int] | None = None, max_picks: int = C.MAX_PICKS) -> dict[str, DataFrame]:
    """The report's sheets by name: one per category, all picks, all collected addresses, and the summary.

    Always with all columns, also without any collected address.
    """
    collected = state.where("status = 'collected' and email != ''")
    picks = best_picks(collected, max_picks)
    order = "seq"
    sheet = lambda df: present(dense_numbers(df, order), ["no", *SHEET_COLUMNS, order]).orderBy("checked_at", order).drop(order)
    picked = with_master(master, picks)
    out = {c[:31]: sheet(picked.where(F.col("category") == c)) for c in (quotas or C.QUOTAS)}
    out["picks"] = sheet(picked)
    out["detail"] = sheet(with_master(master, collected))
    out["summary"] = summary(master, state, picks, quotas)
    return out


def percent_text(c: str | Column) -> Column:
    """A rate as reports show it: one decimal and a percent sign. Compare the number, never this."""
    return F.format_string("%.1f%%", c if isinstance(c, Column) else F.col(c))


def summary(master: DataFrame, state: DataFrame, picks: DataFrame, quotas: Mapping[str, int] | None = None) -> DataFrame:
    """The summary as one table: a row per category in the order of the quotas, the hit rate, the totals of the picks.

    The three parts have different columns; each leaves the others' NULL.
    ``part`` and ``place`` give the order.
    """
    order = F.create_map(*(F.lit(x) for k, c in enumerate(quotas or C.QUOTAS, 1) for x in (c, k)))
    per_category = quota_summary(master, picks, quotas).select(F.lit(1).alias("part"), F.try_element_at(order, F.col("category")).alias("place"), "category", "quota", "pick_rows", "companies", "delta")
    rates = S.hit_rates(state).select(F.lit(2).alias("part"), F.lit(1).alias("place"), F.col("status_sum").alias("processed"), "found", F.col("rate_of_statuses").alias("hit_rate"), percent_text("rate_of_statuses").alias("hit_rate_text"))
    totals = picks.agg(F.count("*").alias("pick_rows"), F.count_distinct("company_key").alias("pick_companies"), F.count_distinct("email").alias("emails")).select(F.lit(3).alias("part"), F.lit(1).alias("place"), "*")
    return per_category.unionByName(rates, allowMissingColumns=True).unionByName(totals, allowMissingColumns=True).orderBy("part", "place")


def status_report(master: DataFrame, candidates: DataFrame, state: DataFrame) -> dict[str, DataFrame]:
    return {
        "categories": master.groupBy("category").agg(F.count("*").alias("companies")).orderBy(F.desc("companies"), "category"),
        "candidates": candidates.groupBy("category").agg(F.count("*").alias("companies")).orderBy("category"),
        "sources": master.agg(F.count("*").alias("companies"), F.count_if(F.col("source_ids").contains(",")).alias("multi_source")),
        "statuses": S.status_counts(state),
        "hit_rate": S.hit_rates(state),
        "progress": progress(state, candidates),
    }
