"""Daily sales totals over a streaming sales source (D-1 on a stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock import S
from restock.operators.features import daily_sales


def daily_sales_stream(sales_stream: DataFrame, late_days: int = 2) -> DataFrame:
    """Per (date, warehouse, SKU) totals of a streaming sales frame.

    The sale date becomes the event time; a day's group is final (and its
    state dropped) ``late_days`` after the newest date seen. Use output mode
    ``append`` to emit each day once when it closes, or ``update`` to
    emit running totals.
    """
    # the sale date, as a timestamp, is the event time and a group key
    with_time = (sales_stream.withColumn("date", F.col("date").cast("timestamp"))
                 .withWatermark("date", f"{late_days} days"))
    agg = daily_sales(with_time)
    return agg.select(F.col("date").cast("date").alias("date"), *S, "quantity_sold", "revenue")
