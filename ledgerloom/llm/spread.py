"""Work in Python spread over all cores, and statistics of a fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame


#: Tasks that count into tables of a fixed size, at most: what they hand on doesn't grow with the corpus.
MOST_COUNTERS = 1024


def for_counting(df: DataFrame) -> DataFrame:
    """The rows in at most MOST_COUNTERS partitions, without a shuffle."""
    return df.coalesce(MOST_COUNTERS)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out to every core if the scan has fewer partitions than there are cores.

    A large input has more partitions than cores already and isn't shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
