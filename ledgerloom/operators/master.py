"""The master table: one best record per company, its lineage, and counts about it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import filled, real_date, source_priority
from ..session import settled


def with_ordinal(df: DataFrame, name: str = "row_ordinal") -> DataFrame:
    """The position of each row in the scan; use it before any shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered(df: DataFrame, order: list[Column], name: str = "no") -> DataFrame:
    """Rows numbered from 1 in an order that must be total, by many tasks.

    Rows are dealt into ranges of the order and numbered within each; the sizes
    of the ranges before are added. Only one row per range meets in one task.
    """
    ranged = settled(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    offsets = F.broadcast(sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before")))
    place = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return ranged.join(offsets, "_range").withColumn(name, (F.col("_before") + place).cast("int")).drop("_range", "_before")


def null_count(df: DataFrame, columns: list[str] | None = None) -> Column:
    """How many of the columns are NULL in a row; '' isn't."""
    return sum((F.col(c).isNull().cast("int") for c in columns or df.columns), F.lit(0))


def build_master(unified: DataFrame, priority: Mapping[str, int] | None = None, mode: str = "length", ordinal: str = "row_ordinal") -> DataFrame:
    """One row per company_key, with source_ids listing all its registries in order.

    The most trusted registry wins, then (``mode='length'``) the longer
    registered_on text or (``mode='newest'``) the newer real date, then the row
    with fewer NULLs, then the earlier one by ``ordinal``. Rows without a key are
    dropped. Equal rows count as one record each but leave one survivor.

    The winner is a minimum over a struct: Spark aggregates it before the
    shuffle, so a key with any number of rows costs one row per task.
    """
    if mode not in ("length", "newest"):
        raise ValueError(f"mode must be 'length' or 'newest', not {mode!r}")
    columns = [c for c in unified.columns if c != ordinal]
    schema = [c for c in C.UNIFIED_COLUMNS if c in columns]
    recent = F.length(F.coalesce("registered_on", F.lit(""))) if mode == "length" else F.coalesce(F.datediff(real_date("registered_on"), F.lit("0001-01-01").cast("date")), F.lit(-1))
    order = F.struct(source_priority("source_dataset_id", priority).alias("p"), (-recent).alias("d"), null_count(unified, schema).alias("n"), F.col(ordinal).alias("o"))
    best = F.min_by(F.struct(*columns), order).alias("row")
    sources = F.array_join(F.array_sort(F.collect_set("source_dataset_id")), ",").alias("all_sources")
    grouped = unified.where("company_key is not null").groupBy("company_key").agg(best, sources)
    return grouped.select(*(F.col("all_sources").alias(c) if c == "source_ids" else F.col(f"row.{c}").alias(c) for c in columns))


def keep_first(df: DataFrame, keys: list[str], ordinal: str = "row_ordinal") -> DataFrame:
    """The first row of each key by ``ordinal``; NULL keys form a group of their own."""
    first = F.row_number().over(W.partitionBy(*keys).orderBy(ordinal))
    return df.withColumn("_first", first).where("_first = 1").drop("_first")


def source_list(unified: DataFrame) -> DataFrame:
    """company_key, source_ids: the registries of each company, sorted, without repeats and NULLs."""
    return unified.where("company_key is not null").groupBy("company_key").agg(F.array_join(F.array_sort(F.collect_set("source_dataset_id")), ",").alias("source_ids"))


def dedup_ratio(unified: DataFrame) -> DataFrame:
    """rows_in, rows_out, duplicates, duplicate_pct (0 for an empty table)."""
    n, out = F.count("*"), F.count_distinct("company_key")
    pct = F.when(n > 0, (n - out) * 100.0 / n).otherwise(F.lit(0.0))
    return unified.agg(n.alias("rows_in"), out.alias("rows_out"), (n - out).alias("duplicates"), pct.alias("duplicate_pct"))


def empty_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, empty: rows in which a column is NULL or ''; one pass for all columns."""
    counted = df.agg(*(F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias(c) for c in columns))
    return counted.unpivot([], columns, "column_name", "empty")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL left out, '' a value; most frequent first."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def multi_source_count(master: DataFrame) -> DataFrame:
    """companies, multi_source: how many come from several registries."""
    return master.agg(F.count("*").alias("companies"), F.count_if(F.col("source_ids").contains(",")).alias("multi_source"))


def filled_share(df: DataFrame, column: str) -> Column:
    return F.avg(filled(column).cast("double"))
