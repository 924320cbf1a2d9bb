"""Dashboard figures as queries (D-5..D-12, C2-C4, L1-L3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.operators.features import latest_inventory


def inventory_by_warehouse(inventory: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Units available per warehouse with its name (D-5, C3)."""
    units = (latest_inventory(inventory).groupBy("warehouse_id")
             .agg(F.sum("quantity_available").alias("quantity_available")))
    return units.join(warehouses.select("warehouse_id", "name"), "warehouse_id")


def capacity_usage(inventory: DataFrame, warehouses: DataFrame, skus: DataFrame) -> DataFrame:
    """Used volume per warehouse and its share of capacity in % (D-6)."""
    inv = latest_inventory(inventory).join(skus.select("sku_id", "volume_m3_per_unit"), "sku_id")
    used = (inv.groupBy("warehouse_id")
            .agg(F.sum(F.col("quantity_available") * F.col("volume_m3_per_unit"))
                 .alias("used_volume")))
    wh = warehouses.select("warehouse_id", "name", "capacity_volume_m3")
    return (used.join(wh, "warehouse_id")
            .withColumn("usage_pct",
                        F.try_divide(F.col("used_volume"), F.col("capacity_volume_m3")) * 100))


def warehouse_kpis(inventory: DataFrame, warehouses: DataFrame, skus: DataFrame) -> DataFrame:
    """One row: counts, inventory value and average capacity usage (D-7, D-8, C2, L1).

    Average usage is a ratio of means: mean used volume over warehouses with
    stock, divided by mean capacity over all warehouses. The warehouse and
    SKU figures are scalar sub-queries of the one-row inventory aggregate
    (no join between one-row frames).
    """
    inv = latest_inventory(inventory).join(
        skus.select("sku_id", "unit_cost", "volume_m3_per_unit"), "sku_id")
    per_wh = (inv.groupBy("warehouse_id")
              .agg(F.sum(F.col("quantity_available") * F.col("volume_m3_per_unit")).alias("_used"),
                   F.sum(F.col("quantity_available") * F.col("unit_cost")).alias("_value")))
    n_wh = warehouses.select(F.count(F.lit(1))).scalar()
    mean_cap = warehouses.select(F.avg("capacity_volume_m3")).scalar()
    n_sku = skus.select(F.count(F.lit(1))).scalar()
    return per_wh.agg(F.avg("_used").alias("_mean_used"),
                      F.coalesce(F.sum("_value"), F.lit(0.0)).alias("total_inventory_value")
                      ).select(n_wh.alias("total_warehouses"), n_sku.alias("total_skus"),
                               "total_inventory_value",
                               (F.try_divide(F.col("_mean_used"), mean_cap) * 100)
                               .alias("avg_capacity_usage_pct"))


def plan_summary(plan: DataFrame) -> DataFrame:
    """Rows, total and mean cost, distinct SKUs and destinations per plan (D-10, L3)."""
    return plan.groupBy("plan_id").agg(
        F.count(F.lit(1)).alias("total_transfers"),
        F.coalesce(F.sum("estimated_cost"), F.lit(0.0)).alias("total_cost"),
        F.avg("estimated_cost").alias("avg_cost"),
        F.countDistinct("sku_id").alias("unique_skus"),
        F.countDistinct("to_wh").alias("unique_destinations"))


def cost_by_destination(plan: DataFrame) -> DataFrame:
    """Cost per destination, largest first (D-11, F3)."""
    return (plan.groupBy("to_wh").agg(F.sum("estimated_cost").alias("estimated_cost"))
            .orderBy(F.col("estimated_cost").desc(), "to_wh"))


def plan_metrics(plan: DataFrame, skus: DataFrame) -> DataFrame:
    """Plan KPIs (D-12, C4): expected stockouts are 0 and waste is 0.1 per
    perishable transfer, as in the model's placeholder estimate."""
    j = plan.join(skus.select("sku_id", "perishability_ttl_days"), "sku_id", "left")
    n = F.count(F.lit(1))
    return j.groupBy("plan_id").agg(
        F.coalesce(F.sum("estimated_cost"), F.lit(0.0)).alias("total_cost"),
        n.alias("total_transfers"),
        F.lit(0).cast("long").alias("expected_stockouts"),
        (F.count("perishability_ttl_days") * 0.1).alias("expected_waste"),
        (1.0 - F.lit(0.0) / F.greatest(n, F.lit(1))).alias("service_level"))
