"""gondola — Spark-native weekly retail price, catalog classification and receipt analytics.

Sub-packages:
  functions/  column-expression helpers (text, prices, barcodes, vectors) — pure ``Column`` builders
  sources/    table loaders, fixture stand-ins, file sources (CSV landing, archives, HTML, binary)
  operators/  user-level operators: DataFrame -> DataFrame (silver, rules, n-grams, vectors, receipts, ...)
  plans/      registered query keys (Spark form + DuckDB oracle SQL)
  streaming/  Structured Streaming ingest and incremental classification
"""

from gondola.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
