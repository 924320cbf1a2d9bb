"""Plan audit: constraint violations as rows (J6, B12, D-17, D-18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.operators.features import latest_inventory

AUDIT_COLUMNS = ["violation", "warehouse_id", "sku_id", "day", "amount", "limit_value"]


def ttl_violations(plan: DataFrame, warehouses: DataFrame, skus: DataFrame) -> DataFrame:
    """Transfers of a SKU that perishes before the destination's lead time."""
    lt = warehouses.select(F.col("warehouse_id").alias("to_wh"), "lead_time_days")
    ttl = skus.select("sku_id", "perishability_ttl_days")
    j = plan.join(lt, "to_wh").join(ttl, "sku_id")
    return (j.where(F.col("perishability_ttl_days").isNotNull()
                    & (F.col("lead_time_days") > F.col("perishability_ttl_days")))
            .select(F.lit("TTL").alias("violation"), F.col("to_wh").alias("warehouse_id"),
                    "sku_id", F.col("ship_date").alias("day"),
                    F.col("lead_time_days").cast("double").alias("amount"),
                    F.col("perishability_ttl_days").cast("double").alias("limit_value")))


def source_stock_violations(plan: DataFrame, inventory: DataFrame) -> DataFrame:
    """(source, SKU) pairs promised more units than they hold (D-17)."""
    out = (plan.groupBy(F.col("from_wh").alias("warehouse_id"), "sku_id")
           .agg(F.sum("qty").alias("_out")))
    stock = latest_inventory(inventory).select("warehouse_id", "sku_id", "quantity_available")
    j = out.join(stock, ["warehouse_id", "sku_id"], "left")
    lim = F.coalesce(F.col("quantity_available"), F.lit(0))
    return (j.where(F.col("_out") > lim)
            .select(F.lit("SOURCE_STOCK").alias("violation"), "warehouse_id", "sku_id",
                    F.lit(None).cast("date").alias("day"),
                    F.col("_out").cast("double").alias("amount"),
                    lim.cast("double").alias("limit_value")))


def capacity_violations(plan: DataFrame, warehouses: DataFrame, skus: DataFrame,
                        day_column: str = "ship_date") -> DataFrame:
    """(destination, day) pairs receiving more volume than capacity (D-18)."""
    vol = skus.select("sku_id", "volume_m3_per_unit")
    inbound = (plan.join(vol, "sku_id")
               .groupBy(F.col("to_wh").alias("warehouse_id"), F.col(day_column).alias("day"))
               .agg(F.sum(F.col("qty") * F.col("volume_m3_per_unit")).alias("_vol")))
    cap = warehouses.select("warehouse_id", "capacity_volume_m3")
    j = inbound.join(cap, "warehouse_id")
    return (j.where(F.col("_vol") > F.col("capacity_volume_m3"))
            .select(F.lit("CAPACITY").alias("violation"), "warehouse_id",
                    F.lit(None).cast("string").alias("sku_id"), "day",
                    F.col("_vol").alias("amount"),
                    F.col("capacity_volume_m3").alias("limit_value")))


def plan_audit(plan: DataFrame, warehouses: DataFrame, skus: DataFrame,
               inventory: DataFrame, day_column: str = "ship_date") -> DataFrame:
    """All violations of a plan, tagged; empty when the plan is feasible."""
    return (ttl_violations(plan, warehouses, skus)
            .unionByName(source_stock_violations(plan, inventory))
            .unionByName(capacity_violations(plan, warehouses, skus, day_column)))
