"""Adapters from the driver's TPC-H-like tables to the replenishment model.

warehouse = nation of the supplier, sale = line item, SKU = part brand, or the
part itself where ``grain="part"`` (25 brands, but as many parts as the data
have). All derived numbers use integer arithmetic first and become doubles
last, so the oracle SQL computes the same values.

Fixed values of the mapping (chosen for this repository):
  warehouse_id        'WH-' || lpad(n + 1, 3, '0')   (n = n_nationkey)
  latitude            25 + (n * 7) % 24
  longitude           -120 + (n * 11) % 50
  capacity_volume_m3  5000 + (n * 601) % 15000
  lead_time_days      1 + n % 3
  holding cost/unit/d (1 + n % 5) / 100
  stockout cost/unit  10 + (n * 13) % 41
  brand number b      cast(substr(p_brand, 7) as int)     (1..25)
  volume_m3_per_unit  (2 + 4b) / 1000
  weight_kg_per_unit  (1 + 4b) / 10
  perishability ttl   b % 5 = 0 -> b div 5;  b % 5 = 1 -> b + 4;  else NULL
  requires_refrig.    b % 10 = 0
  safety_stock_days   3 + b % 11
  SKU number k        b, or p_partkey at part grain
  stock on hand       units of the cell's last 28 daily rows * (37n + 53k) % 120 div 100
                      (a share of the cell's own recent units, so stock and
                      demand grow together)
  stand-in demand     round(mean of the last 28 daily rows, 6) * 14
  dock capacity       round(volume of the stock on hand / 50, 4) per warehouse
  actual lead time    1 + n % 3 + (5b + 7n) % 24       (n of the destination)
  actual demand       demand * (5 + (3b + n) % 11) / 10
  planning start      the day after the last ship date in the data
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from restock import S

HORIZON = 14
RECENT = 28
TASK_ROWS = 400_000         # most rows a task is dealt at part grain


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wh_no(warehouse_id) -> F.Column:
    return F.substring(warehouse_id, 4, 10).cast("int") - 1


def wh_id(n) -> F.Column:
    return F.concat(F.lit("WH-"), F.lpad((n + 1).cast("string"), 3, "0"))


def part_id(partkey) -> F.Column:
    return F.concat(F.lit("Part#"), partkey.cast("string"))


def brand_no(sku_id) -> F.Column:
    return F.substring(sku_id, 7, 10).cast("int")


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    nul = lambda t: F.lit(None).cast(t)
    return table(spark, sf_dir, "nation").select(
        wh_id(n).alias("warehouse_id"),
        F.col("n_name").alias("name"),
        nul(StringType()).alias("city"),
        (25 + (n * 7) % 24).cast("double").alias("latitude"),
        (-120 + (n * 11) % 50).cast("double").alias("longitude"),
        (5000 + (n * 601) % 15000).cast("double").alias("capacity_volume_m3"),
        nul(DoubleType()).alias("capacity_weight_kg"),
        (1 + n % 3).cast("int").alias("lead_time_days"),
        nul(DoubleType()).alias("transfer_cost_per_km"),
        ((1 + n % 5).cast("double") / 100).alias("holding_cost_per_unit_per_day"),
        (10 + (n * 13) % 41).cast("double").alias("stockout_cost_per_unit"),
        nul(IntegerType()).alias("num_docks"),
        nul(StringType()).alias("dock_window_start"),
        nul(StringType()).alias("dock_window_end"),
        n.cast("long").alias("source_ord"),
    )


def skus(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    part = table(spark, sf_dir, "part")
    if grain == "part":
        rows = part.select(part_id(F.col("p_partkey")).alias("sku_id"), "p_brand", F.col("p_type").alias("category"),
                           F.col("p_retailprice").alias("unit_cost"))
    else:
        rows = (part.groupBy("p_brand").agg(F.min("p_type").alias("category"), F.min("p_retailprice").alias("unit_cost"))
                .withColumn("sku_id", F.col("p_brand")))
    b = brand_no(F.col("p_brand"))
    return rows.select(
        "sku_id",
        F.col("sku_id").alias("name"),
        "category",
        ((2 + 4 * b).cast("double") / 1000).alias("volume_m3_per_unit"),
        ((1 + 4 * b).cast("double") / 10).alias("weight_kg_per_unit"),
        F.col("unit_cost").cast("double").alias("unit_cost"),
        F.when(b % 5 == 0, F.expr("cast(substr(p_brand, 7) as int) div 5"))
         .when(b % 5 == 1, b + 4).cast("int").alias("perishability_ttl_days"),
        (b % 10 == 0).alias("requires_refrigerated"),
        (3 + b % 11).cast("int").alias("safety_stock_days"),
    )


def sales_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its warehouse and SKU.

    Both lookups are equi-joins on the dimension key; Catalyst broadcasts a
    dimension only when its estimated size is under the broadcast threshold
    and AQE re-checks that with runtime sizes, otherwise it shuffles.
    """
    return _lines(spark, sf_dir, "brand").select(
        "date", wh_id(F.col("s_nationkey")).alias("warehouse_id"), F.col("_sku").alias("sku_id"),
        F.col("_q").alias("quantity_sold"), F.col("_rev").alias("revenue"))


def _lines(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """(date, s_nationkey, _sku, _q, _rev) of every line item: integer keys, no string built per line."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey)
    if grain == "part":
        sku = F.col("l_partkey")
    else:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        j, sku = j.join(part, li.l_partkey == part.p_partkey), F.col("p_brand")
    return j.select(F.col("l_shipdate").cast("date").alias("date"), "s_nationkey", sku.alias("_sku"),
                    F.col("l_quantity").cast("long").alias("_q"),
                    (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("_rev"))


def keyed_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that line items, or tables of no more rows, are dealt to by a key, so that
    what one task holds does not grow with the tables (the count reads file footers)."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "lineitem").count() // TASK_ROWS))


def daily(spark: SparkSession, sf_dir: str, grain: str = "brand", tasks: int | None = None) -> DataFrame:
    """Daily aggregate (D-1) with the number of lines.

    Features, stock and demand all derive from it. It groups on the integer
    nation key and formats ids after aggregating. With ``tasks`` the lines are
    dealt by SKU first: few lines of a part share a day, so sums per map task
    would hold nearly every line.
    """
    lines = (_lines(spark, sf_dir, grain)
             .where(F.col("date").isNotNull() & F.col("s_nationkey").isNotNull() & F.col("_sku").isNotNull()))
    agg = ((lines.repartition(tasks, "_sku") if tasks else lines)
           .groupBy("date", "s_nationkey", "_sku")
           .agg(F.sum("_q").alias("quantity_sold"), F.sum("_rev").alias("revenue"), F.count(F.lit(1)).alias("n_rows")))
    sku = part_id(F.col("_sku")) if grain == "part" else F.col("_sku")
    return agg.select("date", wh_id(F.col("s_nationkey")).alias("warehouse_id"), sku.alias("sku_id"),
                      "quantity_sold", "revenue", "n_rows")


def start_date(daily_df: DataFrame) -> F.Column:
    """The day after the last row, as a scalar sub-query of the plan that uses it."""
    return daily_df.select(F.date_add(F.max("date"), 1)).scalar()


def recent(daily_df: DataFrame) -> DataFrame:
    """Sum and mean of the last 28 daily rows per cell (Spark keeps at most that
    many rows per cell before the shuffle)."""
    last = Window.partitionBy(*S).orderBy(F.col("date").desc())
    return (daily_df.select("date", *S, "quantity_sold").withColumn("_n", F.row_number().over(last))
            .where(F.col("_n") <= RECENT).groupBy(*S)
            .agg(F.max("date").alias("snapshot_date"), F.sum("quantity_sold").alias("_units"),
                 F.avg("quantity_sold").alias("_mean")))


def inventory_snapshot(daily_df: DataFrame) -> DataFrame:
    """One snapshot row per cell with sales."""
    return recent_stock(recent(daily_df))


def recent_stock(recent_df: DataFrame) -> DataFrame:
    """The snapshot rows from the rows of ``recent``."""
    k = F.regexp_extract("sku_id", "([0-9]+)$", 1).cast("long")
    share = (37 * wh_no(F.col("warehouse_id")) + 53 * k) % 120
    stock = recent_df.withColumn("_share", share).withColumn("_stock", F.expr("_units * _share div 100"))
    return stock.select("snapshot_date", *S, F.col("_stock").alias("quantity_on_hand"),
                        F.lit(0).cast("long").alias("quantity_reserved"),
                        F.col("_stock").alias("quantity_available"))


def flat_forecast(daily_df: DataFrame, start, horizon: int = HORIZON) -> DataFrame:
    """The mean of the last 28 daily rows on every day of the horizon."""
    m = F.round(F.col("_mean"), 6)
    days = F.sequence(start, F.date_add(start, horizon - 1))
    return recent(daily_df).select(F.explode(days).alias("date"), *S, m.alias("forecast"), m.alias("lower"),
                                   m.alias("upper"), F.lit("rolling_mean").alias("model_type"))


def standin_demand(recent_df: DataFrame, start, horizon: int = HORIZON) -> DataFrame:
    """Stand-in forecast for series too short to fit, from the rows of ``recent``: one row per
    series holding the horizon total."""
    f = F.round(F.col("_mean"), 6) * horizon
    return recent_df.select(start.alias("date"), *S, f.alias("forecast"), f.alias("lower"), f.alias("upper"),
                                   F.lit("rolling_mean").alias("model_type"))


def dock_capacity(warehouses_df: DataFrame, skus_df: DataFrame, inventory: DataFrame) -> DataFrame:
    """The warehouses with a daily inbound capacity that follows their stock."""
    vol = (inventory.join(skus_df.select("sku_id", "volume_m3_per_unit"), "sku_id").groupBy("warehouse_id")
           .agg(F.round(F.sum(F.col("quantity_available") * F.col("volume_m3_per_unit")) / 50, 4).alias("_cap")))
    return (warehouses_df.join(vol, "warehouse_id", "left")
            .withColumn("capacity_volume_m3", F.coalesce("_cap", F.lit(0.0))).drop("_cap"))


def actual_lead_times(cells: DataFrame, warehouses_df: DataFrame) -> DataFrame:
    """Realised lead time per destination cell (input of K1)."""
    n = F.col("source_ord")
    b = brand_no(F.col("sku_id"))
    return (cells.select(*S).join(warehouses_df.select("warehouse_id", "source_ord"), "warehouse_id")
            .select(*S, (1 + n % 3 + (5 * b + 7 * n) % 24).cast("int").alias("actual_lead_time")))


def actual_demand(demand_df: DataFrame, warehouses_df: DataFrame) -> DataFrame:
    """Realised demand per cell (input of K2)."""
    n = F.col("source_ord")
    b = brand_no(F.col("sku_id"))
    d = demand_df.groupBy(*S).agg(F.sum("forecast").alias("_d"))
    return (d.join(warehouses_df.select("warehouse_id", "source_ord"), "warehouse_id")
            .select(*S, (F.col("_d") * (5 + (3 * b + n) % 11).cast("double") / 10)
                    .alias("actual_demand")))


def shipments(spark: SparkSession, sf_dir: str, by_sku: bool = True) -> DataFrame:
    """Observed lanes: units moved from the supplier's warehouse to the
    customer's warehouse, per SKU or in all (source of C7-C9 and H1-H3 queries).

    Orders meet customers first (the smaller side), so the line items are
    shuffled once by order key, never re-keyed by customer. The aggregate is
    partial and on integer keys; lanes within one warehouse drop out before it
    and ids are formatted after it.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    dest = (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .select("o_orderkey", "c_nationkey"))
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(dest, li.l_orderkey == dest.o_orderkey)
    keys = ["s_nationkey", "c_nationkey"]
    if by_sku:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        j, keys = j.join(part, li.l_partkey == part.p_partkey), [*keys, "p_brand"]
    agg = (j.where(F.col("s_nationkey") != F.col("c_nationkey")).groupBy(*keys)
           .agg(F.sum(F.col("l_quantity").cast("long")).alias("units"), F.count(F.lit(1)).alias("n_lines")))
    sku = [F.col("p_brand").alias("sku_id")] if by_sku else []
    return agg.select(wh_id(F.col("s_nationkey")).alias("from_wh"), wh_id(F.col("c_nationkey")).alias("to_wh"),
                      *sku, "units", "n_lines")
