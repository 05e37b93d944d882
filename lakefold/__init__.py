"""lakefold: batch and streaming ELT on the PySpark DataFrame API.

Raw Bronze feeds are cleaned with column functions (``lakefold.functions``),
folded into keyed Silver tables with explicit merge semantics
(``lakefold.operators.merge``) and stored as versioned parquet
(``lakefold.sources.silver``).  Every operator takes and returns
DataFrames, so the stateless ones run unchanged under Structured Streaming.
"""

from lakefold.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
