"""Scoring a delivered plan (K1-K3, G4, D-13..D-15, H21, H22, B6).

The realised lead times and demands are tables (one row per destination
cell), so scoring is joins and aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock import S
from restock.functions import costs as C
from restock.functions.dates import as_date
from restock.operators.features import latest_inventory

# The metric names of the report.
SUMMARY_METRICS = ["total_transfers", "total_transport_cost", "total_waste_cost", "total_cost",
                   "total_waste_units", "overall_service_level", "total_stockouts",
                   "total_demand", "total_fulfilled"]


def transfer_outcomes(plan: DataFrame, warehouses: DataFrame, skus: DataFrame,
                      lead_times: DataFrame) -> DataFrame:
    """Arrival, waste, received units and costs per transfer.

    ``lead_times``: (warehouse_id, sku_id, actual_lead_time) of destinations; a
    transfer without a row arrived after the planned lead time.
    """
    lt = lead_times.select(F.col("warehouse_id").alias("to_wh"), "sku_id", "actual_lead_time")
    sk = skus.select("sku_id", "perishability_ttl_days", "unit_cost")
    wh = warehouses.select(F.col("warehouse_id").alias("to_wh"),
                           F.col("lead_time_days").alias("planned_lead_time"))
    j = (plan.join(lt, ["to_wh", "sku_id"], "left").join(sk, "sku_id", "left").join(wh, "to_wh", "left")
         .withColumn("actual_lead_time", F.coalesce("actual_lead_time", "planned_lead_time")))
    waste = C.waste_units("qty", "perishability_ttl_days", "actual_lead_time")
    transport = F.coalesce(F.col("estimated_cost"), F.lit(0.0))
    waste_cost = F.coalesce(F.col("waste_qty") * F.col("unit_cost"), F.lit(0.0))
    return (j.withColumn("waste_qty", waste).select(
        F.col("plan_id").alias("transfer_id"), "from_wh", "to_wh", "sku_id",
        F.col("qty").alias("planned_qty"),
        (F.col("qty") - F.col("waste_qty")).alias("actual_qty_received"),
        "waste_qty",
        F.col("expected_arrival").alias("planned_arrival"),
        F.date_add("ship_date", F.col("actual_lead_time")).alias("actual_arrival"),
        "planned_lead_time", "actual_lead_time",
        transport.alias("transport_cost"),
        waste_cost.alias("waste_cost"),
        (transport + waste_cost).alias("total_cost")))


def cell_service(outcomes: DataFrame, inventory: DataFrame, demand: DataFrame) -> DataFrame:
    """Demand served per destination cell that received a transfer (K2, D-13, H22).

    ``demand``: (warehouse_id, sku_id, actual_demand); a cell without a row
    has demand 0.
    """
    recv = (outcomes.groupBy(F.col("transfer_id").alias("plan_id"),
                             F.col("to_wh").alias("warehouse_id"), "sku_id")
            .agg(F.sum("actual_qty_received").alias("received")))
    stock = latest_inventory(inventory).select(*S, "quantity_available")
    j = recv.join(stock, S, "left").join(demand.select(*S, "actual_demand"), S, "left")
    d = F.coalesce(F.col("actual_demand"), F.lit(0.0))
    avail = (F.coalesce(F.col("quantity_available"), F.lit(0)) + F.col("received")).cast("double")
    stockout, fulfilled, level = C.served(d, avail)
    return j.select("plan_id", *S, d.alias("demand"), avail.alias("available_stock"),
                    stockout.alias("stockout_qty"), fulfilled.alias("fulfilled_qty"),
                    level.alias("service_level"))


def stockout_report(service: DataFrame) -> DataFrame:
    """Cells whose demand exceeded what they had (K2)."""
    return service.where(F.col("stockout_qty") > 0)


def execution_summary(outcomes: DataFrame, service: DataFrame, run_date: str) -> DataFrame:
    """One row per plan: counts and sums of cost, waste and service (K3, D-14, D-15).

    Transfer rows and cell rows are stacked into one tagged frame and summed
    by one aggregate per plan (no join of the two per-plan summaries).
    """
    nul = F.lit(None).cast("double")
    t = outcomes.select(F.col("transfer_id").alias("plan_id"), F.lit(1).alias("_t"),
                        "transport_cost", "waste_cost", "total_cost",
                        F.col("waste_qty").cast("long").alias("waste_qty"),
                        nul.alias("demand"), nul.alias("fulfilled_qty"),
                        F.lit(None).cast("int").alias("_so"))
    s = service.select("plan_id", F.lit(None).cast("int").alias("_t"), nul.alias("transport_cost"),
                       nul.alias("waste_cost"), nul.alias("total_cost"),
                       F.lit(None).cast("long").alias("waste_qty"), "demand", "fulfilled_qty",
                       (F.col("stockout_qty") > 0).cast("int").alias("_so"))
    a = t.unionByName(s).groupBy("plan_id").agg(
        F.count("_t").alias("total_transfers"),
        F.sum("transport_cost").alias("total_transport_cost"),
        F.sum("waste_cost").alias("total_waste_cost"),
        F.sum("total_cost").alias("total_cost"),
        F.sum("waste_qty").alias("total_waste_units"),
        F.coalesce(F.sum("_so"), F.lit(0)).cast("long").alias("total_stockouts"),
        F.coalesce(F.sum("demand"), F.lit(0.0)).alias("total_demand"),
        F.coalesce(F.sum("fulfilled_qty"), F.lit(0.0)).alias("total_fulfilled"))
    level = F.coalesce(F.try_divide(F.col("total_fulfilled"), F.col("total_demand")), F.lit(1.0))
    return a.where(F.col("total_transfers") > 0).select(
        as_date(run_date).alias("simulation_date"), "plan_id",
        "total_transfers", "total_transport_cost", "total_waste_cost", "total_cost",
        "total_waste_units", level.alias("overall_service_level"),
        "total_stockouts", "total_demand", "total_fulfilled")


def execution_long(summary: DataFrame, outcomes: DataFrame, service: DataFrame) -> DataFrame:
    """The report as one tagged long table: SUMMARY, TRANSFER and STOCKOUT rows."""
    summ = (summary.select("plan_id", *[F.col(m).cast("double").alias(m) for m in SUMMARY_METRICS])
            .unpivot("plan_id", SUMMARY_METRICS, "metric", "value")
            .select(F.lit("SUMMARY").alias("type"), "plan_id", "metric", "value",
                    F.concat(F.lit("plan "), F.col("plan_id")).alias("details")))
    trans = outcomes.select(
        F.lit("TRANSFER").alias("type"), F.col("transfer_id").alias("plan_id"),
        F.lit("total_cost").alias("metric"), F.col("total_cost").alias("value"),
        F.concat_ws(" ", "from_wh", F.lit("→"), "to_wh", "sku_id").alias("details"),
        "from_wh", "to_wh", "sku_id")
    stock = stockout_report(service).select(
        F.lit("STOCKOUT").alias("type"), "plan_id", F.lit("stockout_qty").alias("metric"),
        F.col("stockout_qty").alias("value"),
        F.concat_ws(" ", "warehouse_id", "sku_id").alias("details"), "warehouse_id", "sku_id")
    return (summ.unionByName(trans, allowMissingColumns=True)
            .unionByName(stock, allowMissingColumns=True)
            .select("type", "plan_id", "metric", "value", "details",
                    "warehouse_id", "from_wh", "to_wh", "sku_id"))


def report_rows(long: DataFrame, row_type: str) -> DataFrame:
    """Rows of one type from the long report."""
    return long.where(F.col("type") == row_type)
