"""Plan explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock import S
from restock.functions import costs as C
from restock.functions import text as T
from restock.operators.features import latest_inventory
from restock.operators.plan import cell_demand


def plan_explained(plan: DataFrame, warehouses: DataFrame, skus: DataFrame,
                   inventory: DataFrame, forecasts: DataFrame,
                   explain_horizon: int = 14, strict: bool = False) -> DataFrame:
    """Add explanation_text, delta_cost_if_not_transferred and top_drivers.

    One set of lookups (destination stock, destination demand, SKU, warehouse)
    feeds all three columns. The safety stock in the text uses
    ``explain_horizon`` days (14 in the model, whatever the plan horizon);
    ``strict`` drops the "below safety stock" clause where it is not true.
    """
    stock = latest_inventory(inventory).select(
        F.col("warehouse_id").alias("to_wh"), "sku_id", F.col("quantity_available").alias("_stock"))
    dem = cell_demand(forecasts).select(F.col("warehouse_id").alias("to_wh"), "sku_id",
                                        F.col("demand").alias("_demand"))
    sk = skus.select("sku_id", "safety_stock_days", "perishability_ttl_days")
    wh = warehouses.select(F.col("warehouse_id").alias("to_wh"), "stockout_cost_per_unit")
    j = (plan.join(stock, ["to_wh", "sku_id"], "left").join(dem, ["to_wh", "sku_id"], "left")
         .join(sk, "sku_id", "left").join(wh, "to_wh", "left"))
    st = F.coalesce(F.col("_stock"), F.lit(0)).cast("double")
    dm = F.coalesce(F.col("_demand"), F.lit(0.0))
    safety = C.safety_stock(dm, C.safety_days("safety_stock_days"),
                            F.lit(explain_horizon))
    ttl = F.col("perishability_ttl_days")
    return j.select(
        *plan.columns,
        T.explanation(F.col("qty"), F.col("sku_id"), F.col("from_wh"), F.col("to_wh"),
                      st, dm, safety, ttl, strict).alias("explanation_text"),
        C.delta_cost("qty", "stockout_cost_per_unit", "estimated_cost")
         .alias("delta_cost_if_not_transferred"),
        T.top_drivers(st, safety, ttl).alias("top_drivers"))
