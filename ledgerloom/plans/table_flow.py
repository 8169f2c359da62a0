"""Enriching a user's own table: known companies are reused, the others are searched."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import normalized_name, strip
from ..operators.master import numbered, with_ordinal
from ..sources.readers import read_csv
from ..sources.spec import detect_column
from ..sources.xlsx import read_xlsx
from .discovery import discover, first_hit, rendered_method

#: What happened to a row of the user's table.
NO_NAME, REUSED, REUSED_OTHER, KNOWN_EMPTY, FAILED, NOT_FOUND, COLLECTED = "no_name", "reused", "reused_other", "known_empty", "failed", "not_found", "collected"
#: The column that numbers the input's rows from 1.
NUMBER = "No."


@dataclass(frozen=True)
class Options:
    skip_existing: bool = False
    force: bool = False
    limit: int = 0
    quick: bool = False
    collected_on: str = ""


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A user's CSV or spreadsheet; any other kind of file is a ValueError."""
    low = path.lower()
    if low.endswith(".csv"):
        return read_csv(spark, path)
    if low.endswith((".xlsx", ".xls")):
        return read_xlsx(spark, path)
    raise ValueError(f"neither CSV nor spreadsheet: {path}")


def columns_of(df: DataFrame) -> dict[str, str | None]:
    """The headers that hold name, address and homepage; a table without a name column is a ValueError."""
    found = {k: detect_column(df.columns, a) for k, a in (("name", C.NAME_ALIASES), ("address", C.ADDRESS_ALIASES), ("homepage", C.HOMEPAGE_ALIASES))}
    if found["name"] is None:
        raise ValueError(f"no company name among the columns {df.columns}")
    return found


def table_key(name: str | Column) -> Column:
    return F.concat(F.lit("excel_"), normalized_name(name, square_form=True))


def existing_results(rows: DataFrame, state: DataFrame) -> DataFrame:
    """rows with what is known under the same normalized name: known_email, known_url, known_method, known_status (1:N)."""
    known = state.select(normalized_name("company_name", True).alias("_norm"), F.col("email").alias("known_email"), F.col("source_url").alias("known_url"), F.col("method").alias("known_method"), F.col("status").alias("known_status"))
    keyed = rows.withColumn("_norm", normalized_name("_name", True))
    joined = keyed.join(known.where("_norm != ''"), "_norm", "left")
    return joined.drop("_norm")


def enrich_table(df: DataFrame, state: DataFrame, search_results: DataFrame, pages: DataFrame, options: Options = Options(), **discovery) -> DataFrame:
    """The user's rows, numbered from 1, with email, source_url, method, collected_on and outcome; a row with several addresses comes several times.

    No row is lost: rows without a name, and rows whose search finds nothing,
    come out with their outcome (unless ``skip_existing`` leaves out known and
    nameless rows). An empty table is a ValueError, as is one without names.
    """
    where = columns_of(df)
    if df.isEmpty():
        raise ValueError("the table has no rows")
    ordered = numbered(df if "row_ordinal" in df.columns else with_ordinal(df), [F.asc("row_ordinal")], NUMBER)
    at = lambda c: strip(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) if c else F.lit("")
    rows = ordered.withColumns({"_name": at(where["name"]), "_home": at(where["homepage"])})
    if options.limit:
        rows = rows.where(F.col(f"`{NUMBER}`") <= options.limit)
    known = existing_results(rows, state).withColumn("is_known", F.col("known_status").isNotNull())
    if options.force:
        known = rows.withColumns({c: F.lit(None).cast("string") for c in ("known_email", "known_url", "known_method", "known_status")}).withColumn("is_known", F.lit(False))
    if options.skip_existing:
        known = known.where(~F.col("is_known") & (F.col("_name") != ""))
    todo = known.where(~F.col("is_known") & (F.col("_name") != ""))
    companies = todo.select(table_key("_name").alias("company_key"), F.col("_name").alias("company_name"), F.col("_home").alias("homepage")).dropDuplicates(["company_key"])
    hits = first_hit(companies, search_results, pages, **discovery) if options.quick else discover(companies, search_results, pages, **discovery)
    if not options.quick:
        hits = hits.withColumn("method", rendered_method())
    hits = hits.select(F.col("company_key").alias("_key"), F.col("email").alias("new_email"), F.col("source_url").alias("new_url"), F.col("method").alias("new_method"))
    a = known.withColumn("_key", F.when(~F.col("is_known"), table_key("_name")))
    joined = a.join(hits, "_key", "left")
    outcome = (
        F.when(F.col("_name") == "", NO_NAME)
        .when(F.col("is_known") & (F.col("known_status") == "collected") & (F.coalesce("known_email", F.lit("")) != ""), REUSED)
        .when(F.col("is_known") & (F.col("known_status") == "collected"), KNOWN_EMPTY)
        .when(F.col("is_known") & (F.col("known_status") == "failed"), FAILED)
        .when(F.col("is_known"), REUSED_OTHER)
        .when(F.col("new_email").isNull(), NOT_FOUND)
        .otherwise(COLLECTED)
    )
    return joined.select(
        F.col(f"`{NUMBER}`"), *(F.col(f"`{c}`") for c in df.columns if c not in ("row_ordinal", NUMBER)),
        F.coalesce("known_email", "new_email", F.lit("")).alias("email"), F.coalesce("known_url", "new_url", F.lit("")).alias("source_url"),
        F.coalesce("known_method", "new_method", F.lit("")).alias("method"), F.lit(options.collected_on).alias("collected_on"), outcome.alias("outcome"),
    ).orderBy(f"`{NUMBER}`", "email")


def table_summary(enriched: DataFrame) -> DataFrame:
    """rows_out, new, reused, empty and the rest of the outcomes, counted."""
    n = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return enriched.agg(
        F.count_distinct(f"`{NUMBER}`").alias("input_rows"), n(COLLECTED, NOT_FOUND).alias("searched"), n(REUSED, REUSED_OTHER, KNOWN_EMPTY, FAILED).alias("known"),
        n(NO_NAME).alias("nameless"), n(COLLECTED, REUSED).alias("with_email"), n(NOT_FOUND).alias("not_found"), n(FAILED).alias("failed"),
    )
