"""The queries of this package and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import encoding, entities, leakage, locations, mojibake, proportions, survivor, topn, truncation


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p2_found": proportions.p2_found,
        "p2_sample": proportions.p2_sample,
        "p3_found": topn.p3_found,
        "p4_found": survivor.p4_found,
        "p4_consensus": survivor.p4_consensus,
        "p5_found": entities.p5_found,
        "p5_reliability": entities.p5_reliability,
        "p6_found": locations.p6_found,
        "p6_buildings": locations.p6_buildings,
        "p7_found": mojibake.p7_found,
        "p8_ids": encoding.p8_ids,
        "p9_found": leakage.p9_found,
        "p10_found": truncation.p10_found,
        "p10_rates": truncation.p10_rates,
    }


def oracle_sql() -> dict[str, str]:
    return {"p2_found": proportions.P2_SQL, "p2_sample": proportions.P2_SAMPLE_SQL, "p3_found": topn.P3_SQL, "p4_found": survivor.P4_SQL}
