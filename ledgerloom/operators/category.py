"""Each company's category, from its industry code or its registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import industry_category, source_category


def categorize(df: DataFrame, sources: Mapping[str, str] | None = None, ranges: Sequence[tuple[int, int, str]] | None = None, default: str = C.SERVICES) -> DataFrame:
    """The table with ``category`` set: the industry code decides, then the registry, then the default. Never NULL."""
    return df.withColumn("category", F.coalesce(industry_category("industry_code", ranges), source_category("source_dataset_id", sources), F.lit(default)))
