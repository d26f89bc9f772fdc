"""loglens: Spark-native analytics over service log streams.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own column expressions, windows, joins and aggregations.  The batch forms
live in :mod:`loglens.operators`; the Structured Streaming forms reuse the
same column expressions in :mod:`loglens.streaming`.
"""

from loglens.schema import LOG_SCHEMA, RESULT_SCHEMA  # noqa: F401

__all__ = ["LOG_SCHEMA", "RESULT_SCHEMA"]
