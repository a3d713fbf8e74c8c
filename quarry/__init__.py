"""quarry: a Spark-native engine for web-page ingestion, enrichment and
semantic retrieval.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function meant to be chained with ``DataFrame.transform``.  Nothing inside an
operator collects data to the driver except small, size-checked side tables
(per-partition counters, bounded query batches for nearest-neighbour search).
"""

from quarry.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
__version__ = "0.1.0"
