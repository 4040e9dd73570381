"""wardlake: governed lakehouse analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames (or Columns) and is built from
built-in Spark SQL expressions, joins, aggregates, windows and Structured
Streaming, so Catalyst plans it and whole-stage codegen runs it.
"""

__all__ = ["session"]
