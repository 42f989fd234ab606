"""tidemark: lakehouse analytics on Spark DataFrames.

Every operator is a plain function from DataFrames to DataFrames. Readers and
writers wrap ``spark.read`` / ``df.write``; the upsert (``operators.merge``),
as-of join (``operators.asof``), star schema and KPIs are DataFrame
compositions that Catalyst plans; the streaming journey uses
``transformWithState``.
"""

from tidemark.errors import DataLoaderError, DataWriterError

__all__ = ["DataLoaderError", "DataWriterError"]
