"""Daily aggregation and per-series features (D-1, E-1..E-9, C1, H9, A9, B9, B10).

All windows share one partitioning (the series keys) and one sort (keys,
date), so the whole feature table costs one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock import S
from restock.functions.costs import series_key

# The feature names of the model.
FEATURE_COLUMNS = [
    "rolling_7d_mean", "rolling_7d_std", "rolling_28d_mean", "rolling_28d_std",
    "lag_1d", "lag_7d", "lag_28d",
    "day_of_week", "day_of_month", "month",
    "is_weekend", "is_holiday_season", "is_summer", "is_promotion",
]


def series_window() -> Window:
    return Window.partitionBy(*S)


def ordered_window() -> Window:
    return Window.partitionBy(*S).orderBy("date")


def daily_sales(sales: DataFrame, extra_sums: tuple[str, ...] = ()) -> DataFrame:
    """Units and revenue per (date, warehouse, SKU) (D-1).

    Rows with a NULL key are dropped first, as the pandas group-by does.
    The aggregate is partial on the map side, so the shuffle carries one
    row per group and partition, not one per sale. ``extra_sums`` adds more
    summed columns to the same aggregate (one pass feeds several tables).
    """
    return (sales.where(F.col("date").isNotNull() & F.col("warehouse_id").isNotNull()
                        & F.col("sku_id").isNotNull())
            .groupBy("date", *S)
            .agg(F.sum("quantity_sold").alias("quantity_sold"),
                 F.sum("revenue").alias("revenue"),
                 *[F.sum(c).alias(c) for c in extra_sums]))


def rolling_stats(daily: DataFrame) -> list:
    """Row-based rolling means and sample deviations, 7 and 28 rows (E-1, E-2)."""
    o = ordered_window()
    q = F.col("quantity_sold")
    out = []
    for n in (7, 28):
        w = o.rowsBetween(-(n - 1), 0)
        out.append(F.avg(q).over(w).alias(f"rolling_{n}d_mean"))
        out.append(F.coalesce(F.stddev_samp(q).over(w), F.lit(0.0)).alias(f"rolling_{n}d_std"))
    return out


def lags(daily: DataFrame) -> list:
    """Lag 1, 7, 28 rows, missing -> 0 (E-3)."""
    o = ordered_window()
    return [F.lag("quantity_sold", n, 0).over(o).alias(f"lag_{n}d") for n in (1, 7, 28)]


def calendar(date="date") -> list:
    """Calendar columns, Monday = 0 (E-4)."""
    d = F.col(date) if isinstance(date, str) else date
    dow = F.weekday(d)
    m = F.month(d)
    return [dow.alias("day_of_week"), F.dayofmonth(d).alias("day_of_month"), m.alias("month"),
            (dow >= 5).cast("int").alias("is_weekend"),
            m.isin(11, 12).cast("int").alias("is_holiday_season"),
            m.isin(6, 7, 8).cast("int").alias("is_summer")]


def promotion_flag() -> F.Column:
    """Spike: units above series mean + 2 sample deviations (E-5, D-19).

    The mean and deviation span the whole series (the flag sees the future,
    as the model it mirrors does); a one-row series has no deviation -> 0.
    """
    k = series_window()
    q = F.col("quantity_sold")
    spike = q > F.avg(q).over(k) + 2 * F.stddev_samp(q).over(k)
    return F.coalesce(spike.cast("int"), F.lit(0)).alias("is_promotion")


def rolling_features(daily: DataFrame) -> DataFrame:
    """Every feature in one projection (E-6)."""
    return daily.select("date", *S, "quantity_sold", "revenue",
                        *rolling_stats(daily), *lags(daily), *calendar(), promotion_flag())


def inventory_features(inventory: DataFrame, skus: DataFrame) -> DataFrame:
    """Snapshot rows plus SKU attributes, unmatched kept (C1), days of supply (H9)."""
    attrs = skus.select("sku_id", "safety_stock_days", "perishability_ttl_days",
                        "requires_refrigerated", "unit_cost")
    return (inventory.join(attrs, "sku_id", "left")
            .withColumn("days_of_supply", F.col("quantity_available") / 100))


def latest_inventory(inventory: DataFrame) -> DataFrame:
    """One row per cell: the newest snapshot (Q16), as a partial aggregate."""
    return (inventory.groupBy(*S)
            .agg(F.max("snapshot_date").alias("snapshot_date"),
                 F.max_by("quantity_available", "snapshot_date").alias("quantity_available")))


def series_registry(daily: DataFrame, seasonal_min_rows: int = 14,
                    trees_min_rows: int = 30) -> DataFrame:
    """Model registry: one row per series (A9, D-4, H15, B10)."""
    return (daily.groupBy(*S)
            .agg(F.max("date").alias("last_training_date"), F.count("*").alias("n_rows"))
            .select(series_key().alias("series_key"), *S, "last_training_date", "n_rows",
                    (F.col("n_rows") >= seasonal_min_rows).alias("seasonal_eligible"),
                    (F.col("n_rows") >= trees_min_rows).alias("trees_eligible")))


def chronological_split(features: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Row position, series length and the train flag (B9, E-9).

    The first floor(n * share) rows of each series train, the rest test.
    """
    o = ordered_window()
    rn = F.row_number().over(o)
    n = F.count(F.lit(1)).over(series_window())
    return (features.withColumn("row_pos", rn).withColumn("series_rows", n)
            .withColumn("is_train",
                        F.col("row_pos") <= F.floor(F.col("series_rows") * F.lit(train_share))))


def latest_features(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Last row per series, restricted to the feature columns present (E-8, B8).

    ``max_by`` on a struct is a partial aggregate: each map task keeps only
    its newest row per series before the shuffle.
    """
    wanted = [c for c in (columns or FEATURE_COLUMNS) if c in features.columns]
    last = features.groupBy(*S).agg(
        F.max_by(F.struct("date", *wanted), "date").alias("_last"))
    return last.select(*S, "_last.date", *[f"_last.{c}" for c in wanted])
