"""The stages end to end; each is one lazy plan over the tables of the stage before."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.category import categorize
from ..operators.master import build_master, with_ordinal
from ..operators.sampling import sample_candidates
from ..session import forget, settled
from ..sources import readers
from ..sources.xlsx import write_workbook
from ..streaming import state as S
from .discovery import discover, failures, rendered_method
from .report import report, status_report


class Store:
    """Where the tables of a run lie. Stages are kept unless forced; nothing is overwritten while it is read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return bool(readers._listed(self.spark, self.path(name)))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def normalize(self, collected_on: str, sources: Iterable[str] | None = None, force: bool = False) -> dict[str, str]:
        return readers.normalize_all(self.spark, self.path("raw"), self.path("normalized"), collected_on, sources, force)

    def master(self, force: bool = False, mode: str = "length") -> DataFrame:
        """Deduplicated and categorized in one plan, written once."""
        if force or not self.exists("master"):
            unified = readers.read_parquets(self.spark, self.path("normalized"))
            categorize(build_master(unified, mode=mode)).write.mode("overwrite").parquet(self.path("master"))
        return self.read("master")

    def sample(self, multiplier: float = 1.5, quotas: Mapping[str, int] | None = None) -> DataFrame:
        sample_candidates(self.read("master"), quotas, multiplier).write.mode("overwrite").parquet(self.path("candidates"))
        return self.read("candidates")

    def attempts(self) -> DataFrame:
        schema = "company_key string, company_name string, email string, source_url string, method string, status string, error_message string, checked_at string, seq bigint, merged bigint"
        if not self.exists("attempts"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(self.path("attempts"))

    def enrich(self, search_results: DataFrame, pages: DataFrame, checked_at: str, category: str | None = None, start: int = 0, end: int = 0, limit: int = 0, retry_failed: bool = False, parts: int = 1, **discovery) -> DataFrame:
        """Search the candidates that are still to be tried and append the outcomes; what is done isn't done again.

        The work is done and saved in ``parts``: after a failure a new run goes on with the companies not yet saved.
        """
        from ..operators.sampling import slice_rows

        candidates = self.read("candidates")
        if category:
            candidates = candidates.where(F.col("category") == category)
        if start or end or limit:
            candidates = slice_rows(candidates, [F.asc("company_key")], start, end, limit)
        log = self.attempts()
        todo = S.worklist(candidates, S.state_view(log), retry_failed)
        todo = settled(todo)
        last = log.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("last")).first()["last"]
        save = S.append_batches(f"{self.path('attempts')}/run={checked_at.replace(':', '').replace('-', '')}")
        for part in range(parts):
            own = todo.where(F.pmod(F.xxhash64("company_key"), F.lit(parts)) == part) if parts > 1 else todo
            hits = discover(own, search_results, pages, **discovery).withColumn("method", rendered_method())
            rows = S.outcome_rows(own, hits, checked_at, failures(own, search_results, pages))
            save(with_ordinal(rows, "_n").withColumn("seq", F.col("_n") + F.lit(last + 1 + part * 2**52)).drop("_n"), part)
        forget(self.spark)
        return S.state_view(self.attempts())

    def compact(self) -> DataFrame:
        """Replace the log by one row per pair; views, retries and work lists stay the same. For times when nothing is appended."""
        target, aside = self.path("attempts"), self.path("attempts_compacted")
        S.compacted(self.attempts()).write.mode("overwrite").parquet(f"{aside}/run=0")
        readers.replace_folder(self.spark, aside, target)
        return S.state_view(self.attempts())

    def export(self, path: str, quotas: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
        sheets = report(self.read("master"), S.state_view(self.attempts()), quotas)
        write_workbook(sheets, path)
        return sheets

    def status(self) -> dict[str, DataFrame]:
        return status_report(self.read("master"), self.read("candidates"), S.state_view(self.attempts()))
