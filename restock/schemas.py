"""Declared table schemas (one StructType per model table).

Numbers are doubles at run time; quantities are longs; day counts ints.
Fixed values: the column names and keys below are those of the model.
"""

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType,
)


def _s(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


WAREHOUSES = _s(
    ("warehouse_id", StringType(), False),
    ("name", StringType(), True),
    ("city", StringType(), True),
    ("latitude", DoubleType(), True),
    ("longitude", DoubleType(), True),
    ("capacity_volume_m3", DoubleType(), True),
    ("capacity_weight_kg", DoubleType(), True),
    ("lead_time_days", IntegerType(), True),
    ("transfer_cost_per_km", DoubleType(), True),
    ("holding_cost_per_unit_per_day", DoubleType(), True),
    ("stockout_cost_per_unit", DoubleType(), True),
    ("num_docks", IntegerType(), True),
    ("dock_window_start", StringType(), True),
    ("dock_window_end", StringType(), True),
    # position of the row in the warehouse file; the greedy planner scans
    # candidate sources in this order
    ("source_ord", LongType(), True),
)

SKUS = _s(
    ("sku_id", StringType(), False),
    ("name", StringType(), True),
    ("category", StringType(), True),
    ("volume_m3_per_unit", DoubleType(), True),
    ("weight_kg_per_unit", DoubleType(), True),
    ("unit_cost", DoubleType(), True),
    ("perishability_ttl_days", IntegerType(), True),
    ("requires_refrigerated", BooleanType(), True),
    ("safety_stock_days", IntegerType(), True),
)

SALES_HISTORY = _s(
    ("date", DateType(), True),
    ("warehouse_id", StringType(), True),
    ("sku_id", StringType(), True),
    ("quantity_sold", LongType(), True),
    ("revenue", DoubleType(), True),
)

INVENTORY_SNAPSHOT = _s(
    ("snapshot_date", DateType(), True),
    ("warehouse_id", StringType(), False),
    ("sku_id", StringType(), False),
    ("quantity_on_hand", LongType(), True),
    ("quantity_reserved", LongType(), True),
    ("quantity_available", LongType(), True),
)

INBOUND_POS = _s(
    ("po_id", StringType(), False),
    ("warehouse_id", StringType(), True),
    ("sku_id", StringType(), True),
    ("order_date", DateType(), True),
    ("expected_arrival_date", DateType(), True),
    ("quantity_ordered", LongType(), True),
    ("quantity_received", LongType(), True),
    ("supplier_lead_time_days", IntegerType(), True),
    ("status", StringType(), True),
)

FLEET = _s(
    ("truck_id", StringType(), False),
    ("truck_type", StringType(), True),
    ("volume_capacity_m3", DoubleType(), True),
    ("weight_capacity_kg", DoubleType(), True),
    ("cost_per_km", DoubleType(), True),
    ("is_refrigerated", BooleanType(), True),
    ("max_daily_hours", DoubleType(), True),
    ("fixed_cost_per_trip", DoubleType(), True),
)

DRIVERS = _s(
    ("driver_id", StringType(), False),
    ("name", StringType(), True),
    ("shift_start", StringType(), True),
    ("shift_end", StringType(), True),
    ("max_hours_per_day", DoubleType(), True),
    ("can_drive_refrigerated", BooleanType(), True),
)

FORECASTS = _s(
    ("date", DateType(), True),
    ("warehouse_id", StringType(), False),
    ("sku_id", StringType(), False),
    ("forecast", DoubleType(), True),
    ("lower", DoubleType(), True),
    ("upper", DoubleType(), True),
    ("model_type", StringType(), True),
)

PLAN = _s(
    ("plan_id", StringType(), False),
    ("run_date", DateType(), True),
    ("from_wh", StringType(), False),
    ("to_wh", StringType(), False),
    ("sku_id", StringType(), False),
    ("qty", LongType(), True),
    ("ship_date", DateType(), True),
    ("expected_arrival", DateType(), True),
    ("truck_type", StringType(), True),
    ("driver_id", StringType(), True),
    ("estimated_cost", DoubleType(), True),
    ("reason_code", StringType(), True),
)

MANIFEST = _s(
    ("run_date", DateType(), True),
    ("n_rows", LongType(), True),
    ("plan_id", StringType(), False),
)

# Raw tables the ETL stage loads and the date columns parsed on load.
RAW_TABLES = {
    "warehouses": WAREHOUSES,
    "skus": SKUS,
    "sales_history": SALES_HISTORY,
    "inventory_snapshot": INVENTORY_SNAPSHOT,
    "inbound_pos": INBOUND_POS,
}
REQUIRED_TABLES = ["warehouses", "skus", "sales_history", "inventory_snapshot"]

# Columns that tell a row of each table from all others.
KEYS = {
    "warehouses": ["warehouse_id"],
    "skus": ["sku_id"],
    "inventory_snapshot": ["snapshot_date", "warehouse_id", "sku_id"],
    "inbound_pos": ["po_id"],
    "fleet": ["truck_id"],
    "drivers": ["driver_id"],
    "forecasts": ["date", "warehouse_id", "sku_id", "model_type"],
    "daily_sales_aggregated": ["date", "warehouse_id", "sku_id"],
    "plan": ["plan_id", "from_wh", "to_wh", "sku_id", "ship_date"],
}

# Columns that must have a value, beside the keys, and those that must not be negative.
REQUIRED = {
    "warehouses": ["name"],
    "skus": ["name"],
    "inventory_snapshot": ["quantity_on_hand", "quantity_reserved", "quantity_available"],
    "sales_history": ["date", "warehouse_id", "sku_id", "quantity_sold"],
    "inbound_pos": ["warehouse_id", "sku_id", "order_date", "quantity_ordered"],
    "fleet": ["truck_type"],
    "plan": ["run_date", "qty"],
}
NOT_NEGATIVE = {
    "warehouses": ["capacity_volume_m3", "lead_time_days", "stockout_cost_per_unit"],
    "skus": ["volume_m3_per_unit", "weight_kg_per_unit", "unit_cost", "perishability_ttl_days", "safety_stock_days"],
    "inventory_snapshot": ["quantity_on_hand", "quantity_reserved", "quantity_available"],
    "sales_history": ["quantity_sold", "revenue"],
    "inbound_pos": ["quantity_ordered", "quantity_received"],
    "forecasts": ["forecast", "lower", "upper"],
    "plan": ["qty"],
}
