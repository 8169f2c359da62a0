"""ledgerloom: company registries unified, deduplicated, sampled and enriched on Spark.

Every operator is ``DataFrame -> DataFrame`` or ``Column -> Column``; nothing
touches the network or the clock unless a source asks for it.
"""

__version__ = "0.1.0"
