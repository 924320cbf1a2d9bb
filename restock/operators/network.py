"""Lanes between warehouses and what moving goods on them costs.

Lanes come from data (pairs that actually exchange goods), never from a
cross join of the warehouse table with itself. Each warehouse attribute is
looked up with an equi-join on the key, once per end of the lane.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock import S
from restock.functions import costs as C
from restock.functions.dates import as_date
from restock.operators.features import latest_inventory

TRUCK_OPTIONS = [("Small", False), ("Medium", False), ("Large", False), ("Refrigerated", False),
                 ("Small", True), ("Medium", True), ("Large", True), ("Refrigerated", True)]


def with_lane_km(lanes: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Add the great-circle distance of each (from_wh, to_wh) lane."""
    a = warehouses.select(F.col("warehouse_id").alias("from_wh"),
                          F.col("latitude").alias("_lat1"), F.col("longitude").alias("_lon1"))
    b = warehouses.select(F.col("warehouse_id").alias("to_wh"),
                          F.col("latitude").alias("_lat2"), F.col("longitude").alias("_lon2"))
    return (lanes.join(a, "from_wh").join(b, "to_wh")
            .withColumn("km", C.haversine_km("_lat1", "_lon1", "_lat2", "_lon2"))
            .drop("_lat1", "_lon1", "_lat2", "_lon2"))


def distance_matrix(shipments: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Ordered warehouse pairs that exchange goods, no self pair, with km."""
    pairs = (shipments.where(F.col("from_wh") != F.col("to_wh"))
             .groupBy("from_wh", "to_wh")
             .agg(F.sum("units").alias("units"), F.sum("n_lines").alias("n_lines")))
    return with_lane_km(pairs, warehouses).select("from_wh", "to_wh", "km", "units", "n_lines")


def lane_days(shipments: DataFrame, warehouses: DataFrame, skus: DataFrame,
              start_date: str, horizon: int = 14) -> DataFrame:
    """Every (lane, SKU, ship day) of the horizon with its TTL feasibility.

    Days come from ``explode(sequence)`` on each lane row (a bounded
    generator, h rows per lane), not from a join.
    """
    lt = warehouses.select(F.col("warehouse_id").alias("to_wh"), "lead_time_days")
    ttl = skus.select("sku_id", "perishability_ttl_days")
    start = as_date(start_date)
    lanes = (shipments.where(F.col("from_wh") != F.col("to_wh"))
             .select("from_wh", "to_wh", "sku_id").join(lt, "to_wh").join(ttl, "sku_id"))
    feasible = ~F.coalesce(F.col("perishability_ttl_days").isNotNull()
                           & (F.col("lead_time_days") > F.col("perishability_ttl_days")),
                           F.lit(False))
    return lanes.select("from_wh", "to_wh", "sku_id",
                        F.explode(F.sequence(start, F.date_add(start, horizon - 1))).alias("ship_date"),
                        feasible.alias("ttl_feasible"))


def transport_costs(shipments: DataFrame, warehouses: DataFrame, skus: DataFrame) -> DataFrame:
    """Cost of each observed lane's units under every truck type, normal and
    expedited (H2, H3, C9)."""
    opts = F.array(*[F.struct(F.lit(t).alias("truck_type"), F.lit(e).alias("expedited"))
                     for t, e in TRUCK_OPTIONS])
    sk = skus.select("sku_id", "volume_m3_per_unit", "weight_kg_per_unit")
    lanes = with_lane_km(shipments.where(F.col("from_wh") != F.col("to_wh")), warehouses).join(sk, "sku_id")
    x = lanes.select("from_wh", "to_wh", "sku_id", "units", "km", "volume_m3_per_unit",
                     "weight_kg_per_unit", F.explode(opts).alias("_o"))
    return x.select("from_wh", "to_wh", "sku_id", F.col("_o.truck_type").alias("truck_type"),
                    F.col("_o.expedited").alias("expedited"), "units", "km",
                    C.transport_cost("km", "units", "volume_m3_per_unit", "weight_kg_per_unit",
                                     F.col("_o.truck_type"), F.col("_o.expedited"))
                    .alias("transport_cost"))


def holding_stockout_ordering(inventory: DataFrame, demand: DataFrame, warehouses: DataFrame,
                              days: int = 14) -> DataFrame:
    """Per cell: holding cost of its stock over ``days``, stockout cost of the
    demand it cannot cover, ordering cost of those units (H4, H5, H7)."""
    stock = latest_inventory(inventory).select(*S, "quantity_available")
    d = demand.groupBy(*S).agg(F.sum("forecast").alias("demand"))
    wh = warehouses.select("warehouse_id", "holding_cost_per_unit_per_day", "stockout_cost_per_unit")
    j = stock.join(d, S, "full_outer").join(wh, "warehouse_id")
    q = F.coalesce(F.col("quantity_available"), F.lit(0))
    short = F.greatest(F.coalesce(F.col("demand"), F.lit(0.0)) - q, F.lit(0.0))
    return j.select(*S, q.alias("quantity_available"), short.alias("uncovered_units"),
                    C.holding_cost(q, "holding_cost_per_unit_per_day", F.lit(days)).alias("holding_cost"),
                    C.stockout_cost(short, "stockout_cost_per_unit").alias("stockout_cost"),
                    C.ordering_cost(short).alias("ordering_cost"))


def waste_costs(inventory: DataFrame, skus: DataFrame, lead_times: DataFrame) -> DataFrame:
    """Waste if a perishable cell's stock travelled for its realised lead time."""
    stock = latest_inventory(inventory).select(*S, "quantity_available")
    sk = skus.select("sku_id", "unit_cost", "perishability_ttl_days").where(
        F.col("perishability_ttl_days").isNotNull())
    j = stock.join(sk, "sku_id").join(lead_times.select(*S, "actual_lead_time"), S)
    return j.select(*S, "quantity_available", "perishability_ttl_days", "actual_lead_time",
                    C.waste_ratio("perishability_ttl_days", "actual_lead_time").alias("waste_ratio"),
                    C.waste_cost("quantity_available", "unit_cost", "perishability_ttl_days",
                                 "actual_lead_time").alias("waste_cost"))


def total_transfer_cost(plan: DataFrame, warehouses: DataFrame, skus: DataFrame,
                        lead_times: DataFrame) -> DataFrame:
    """Transport + waste breakdown of each plan row at its truck type and
    realised lead time (H8)."""
    sk = skus.select("sku_id", "volume_m3_per_unit", "weight_kg_per_unit", "unit_cost",
                     "perishability_ttl_days")
    lt = lead_times.select(F.col("warehouse_id").alias("to_wh"), "sku_id", "actual_lead_time")
    j = with_lane_km(plan, warehouses).join(sk, "sku_id").join(lt, ["to_wh", "sku_id"])
    c = C.total_transfer_cost("km", "qty", "volume_m3_per_unit", "weight_kg_per_unit",
                              "unit_cost", "perishability_ttl_days", "actual_lead_time",
                              F.col("truck_type"))
    return j.select("plan_id", "from_wh", "to_wh", "sku_id", "qty", "truck_type",
                    "actual_lead_time", c.alias("_c")).select(
        "plan_id", "from_wh", "to_wh", "sku_id", "qty", "truck_type", "actual_lead_time",
        "_c.transport_cost", "_c.perishability_waste_cost", "_c.total_cost")
