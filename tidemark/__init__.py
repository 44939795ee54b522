"""tidemark: refine replicated operational data into trustworthy analytical tables on Spark.

Bronze (replicated, soft-deleting, drifting) -> silver (keyed, typed, deduplicated,
merged or historised), with quality, referential and freshness checks and PII masking.
Every operator is a function from DataFrames to a DataFrame; only
``tidemark.sources.tables`` writes.
"""

from tidemark.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
