"""The state of contact attempts: an append-only log, views of it, and a stream into it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

KEYS = ["company_key", "email"]


def state_view(attempts: DataFrame) -> DataFrame:
    """The latest attempt of each (company_key, email) by seq, with retry_count = attempts of the pair before it.

    NULL e-mails count as ''. A row of a compacted log stands for ``merged`` attempts more. One aggregation, combined before the shuffle.
    """
    rest = [c for c in attempts.columns if c not in (*KEYS, "retry_count", "merged")]
    n = F.sum(F.lit(1) + F.coalesce("merged", F.lit(0))) if "merged" in attempts.columns else F.count("*")
    keyed = attempts.withColumn("email", F.coalesce("email", F.lit("")))
    grouped = keyed.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), "seq").alias("row"), (n - 1).alias("retry_count"))
    return grouped.select(*KEYS, "row.*", "retry_count")


def precedence(status: str = "status") -> Column:
    out = F.lit(len(C.STATUS_PRECEDENCE))
    for rank, name in reversed(list(enumerate(C.STATUS_PRECEDENCE))):
        out = F.when(F.col(status) == name, F.lit(rank)).otherwise(out)
    return out


def company_status(state: DataFrame) -> DataFrame:
    """One status per company: collected before skipped, not_found, failed; with its retry_count."""
    best = F.min_by(F.struct("status", "retry_count"), F.struct(precedence().alias("p"), F.col("email"))).alias("s")
    return state.groupBy("company_key").agg(best).select("company_key", "s.status", "s.retry_count")


def eligible(status: str = "status", retries: str = "retry_count") -> Column:
    """Should a company be tried? Never tried, or failed with retries left."""
    return F.col(status).isNull() | ((F.col(status) == "failed") & (F.col(retries) < C.MAX_RETRY))


def worklist(candidates: DataFrame, state: DataFrame, retry_failed: bool = False) -> DataFrame:
    """The candidates still to be tried; ``retry_failed`` takes every failed one, whatever its retries."""
    known = company_status(state).select("company_key", F.col("status").alias("_status"), F.col("retry_count").alias("_retries"))
    wanted = F.col("_status").isNull() | (F.col("_status") == "failed") if retry_failed else eligible("_status", "_retries")
    return candidates.join(known, "company_key", "left").where(wanted).drop("_status", "_retries")


def outcome_rows(companies: DataFrame, hits: DataFrame, checked_at: str, errors: DataFrame | None = None) -> DataFrame:
    """The attempts a run adds: one collected row per hit, else one marker row per company with email ''.

    A company without a name is skipped, one named in ``errors`` (company_key,
    error_message) failed, any other without a hit is not_found.
    """
    errors = companies.select("company_key").limit(0).withColumn("error_message", F.lit("")) if errors is None else errors
    base = companies.select("company_key", F.coalesce("company_name", F.lit("")).alias("company_name"))
    got = base.join(hits.select("company_key", "email", "source_url", "method"), "company_key")
    collected = got.select("company_key", "company_name", "email", "source_url", "method", F.lit("collected").alias("status"), F.lit(None).cast("string").alias("error_message"))
    rest = base.join(hits.select("company_key").distinct(), "company_key", "left_anti").join(errors.dropDuplicates(["company_key"]), "company_key", "left")
    status = F.when(F.trim("company_name") == "", "skipped").when(F.col("error_message").isNotNull(), "failed").otherwise("not_found")
    marker = rest.select("company_key", "company_name", F.lit("").alias("email"), F.lit(None).cast("string").alias("source_url"), F.lit(None).cast("string").alias("method"), status.alias("status"), "error_message")
    return collected.unionByName(marker).withColumn("checked_at", F.lit(checked_at))


def status_counts(state: DataFrame) -> DataFrame:
    """status, companies: distinct companies per status; a company may hold several."""
    return state.groupBy("status").agg(F.count_distinct("company_key").alias("companies"))


def total_processed(state: DataFrame) -> DataFrame:
    return state.agg(F.count_distinct("company_key").alias("companies"))


def companies_by_status(state: DataFrame, status: str) -> DataFrame:
    return state.where(F.col("status") == status).select("company_key").distinct()


def hit_rates(state: DataFrame) -> DataFrame:
    """found, companies, status_sum and the found share of both, in percent; 0 where nothing was tried."""
    found = F.count_distinct(F.when(F.col("status") == "collected", F.col("company_key")))
    total = F.count_distinct("company_key")
    per_status = [F.count_distinct(F.when(F.col("status") == s, F.col("company_key"))) for s in C.STATUSES]
    every = sum(per_status, F.lit(0))
    rate = lambda n: F.when(n > 0, found * 100.0 / n).otherwise(F.lit(0.0))
    return state.agg(found.alias("found"), total.alias("companies"), every.alias("status_sum"), rate(total).alias("rate_of_companies"), rate(every).alias("rate_of_statuses"))


def run_hit_rate(outcomes: DataFrame) -> DataFrame:
    """outcomes, hits, hit_rate of one run: per company, not per address."""
    per = outcomes.groupBy("company_key").agg(F.max((F.col("status") == "collected").cast("int")).alias("hit"))
    n = F.count("*")
    return per.agg(n.alias("outcomes"), F.sum("hit").alias("hits"), F.when(n > 0, F.sum("hit") * 100.0 / n).otherwise(F.lit(0.0)).alias("hit_rate"))


STATE_SCHEMA = "company_key string, email string, status string, checked_at string, seq bigint, retry_count bigint"


def _advance(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    status, at, seq, n = state.get if state.exists else ("", "", -1, 0)
    for pdf in batches:
        n += len(pdf) + int(pdf["merged"].sum())
        last = pdf.loc[pdf["seq"].idxmax()]
        if last["seq"] > seq:
            status, at, seq = last["status"], last["checked_at"], int(last["seq"])
    state.update((status, at, seq, n))
    yield pd.DataFrame([(*key, status, at, seq, n - 1)], columns=[c.split()[0] for c in STATE_SCHEMA.split(", ")])


def stream_state(attempts: DataFrame) -> DataFrame:
    """``state_view`` of a stream: each update of a pair's latest attempt, kept in Spark's state store.

    Late attempts (lower seq) count as retries but don't replace newer ones.
    """
    merged = F.coalesce("merged", F.lit(0)) if "merged" in attempts.columns else F.lit(0)
    rows = attempts.select("company_key", F.coalesce("email", F.lit("")).alias("email"), "status", "checked_at", "seq", merged.cast("bigint").alias("merged"))
    return rows.groupBy(*KEYS).applyInPandasWithState(_advance, STATE_SCHEMA, "status string, checked_at string, seq bigint, n bigint", "update", "NoTimeout")


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that appends to the log once per batch: a repeated batch replaces its own files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def compacted(attempts: DataFrame) -> DataFrame:
    """The log with one row per pair that still gives the same view, also with later attempts after it.

    Its latest row, and in ``merged`` how many earlier attempts it stands for.
    """
    return state_view(attempts).withColumnRenamed("retry_count", "merged")

