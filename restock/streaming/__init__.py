"""Streaming entry points.

The reference model is batch only (no streams, watermarks or state). The
one stage that naturally arrives as a stream is the sales feed, and its
first operator, the daily aggregation (D-1), is a keyed aggregate: it runs
unchanged on a ``readStream`` source. ``daily_sales_stream`` adds the event
time watermark that lets Spark drop the state of closed days; downstream
features are batch jobs over the resulting table.
"""

from restock.streaming.daily import daily_sales_stream  # noqa: F401
