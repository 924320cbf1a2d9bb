"""restock: warehouse replenishment analytics as Spark DataFrame operators.

Every operator is a function from DataFrames (and plain parameters) to a
DataFrame. Nothing collects data to the driver; the work is expressed with
built-in column expressions, joins, aggregates and window functions so that
Catalyst plans it and it scales from a handful of series to millions.

Layout:
  sources/    readers, writers and adapters from the driver's tables
  functions/  pure column expressions (costs, explanation text)
  operators/  keyed relational transforms (features, plan, audit, ...)
  plans/      named end-to-end queries and their DuckDB oracle SQL
  streaming/  the daily aggregation over a streaming source
"""

from restock.session import get_session, checkpoint_dir  # noqa: F401

S = ["warehouse_id", "sku_id"]
