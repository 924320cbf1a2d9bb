"""Replenishment cells, needs, source search and the plans (C6, C10-C11,
D-2, H10-H14, B11-B12, E-7, F5, J1-J4, J7, J8).

Scale notes
-----------
* Cells are the warehouse x SKU pairs that have stock or demand. A pair
  with neither has stock 0, demand 0 and safety stock 0, so it can never
  trigger (0 < 0 is false); building cells from a full outer join of the
  two keyed facts gives the same plan as the W x S grid without a cross
  join whose size grows as W * S.
* The source search never emits (destination, source) pairs. For each SKU
  the candidate sources and the needy destinations are put in one ordered
  stream (stock / need descending); a running minimum of the warehouse
  order over that stream is, at each destination row, the first warehouse
  (in warehouse order) holding at least the needed units. A second running
  value gives the next best, used when the best is the destination itself.
  Cost: one shuffle by SKU and one sort; a SKU partition holds at most two
  rows per warehouse, whatever the size of the sales history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock import S
from restock.functions import costs as C
from restock.functions.dates import as_date
from restock.operators.features import latest_inventory

def new_plan_id(now=None, token: str | None = None) -> str:
    """Plan id "PLAN-yyyymmdd-HHMMSS-<8 hex>" (H16), made on the driver and
    passed to the planners as a parameter so reruns can repeat it."""
    import datetime as _dt
    import uuid
    now = now or _dt.datetime.now()
    return f"PLAN-{now:%Y%m%d-%H%M%S}-{token or uuid.uuid4().hex[:8]}"


def cell_demand(forecasts: DataFrame) -> DataFrame:
    """Demand per cell: the sum over all its forecast rows (D-2, Q17)."""
    return forecasts.groupBy(*S).agg(F.sum("forecast").alias("demand"))


def cells(warehouses: DataFrame, skus: DataFrame, inventory: DataFrame,
          forecasts: DataFrame, horizon_days: int = 14) -> DataFrame:
    """Every cell with stock or demand, defaults 0, plus its attributes."""
    inv = latest_inventory(inventory).select(*S, F.col("quantity_available").alias("_stock"))
    dem = cell_demand(forecasts)
    keyed = inv.join(dem, S, "full_outer")
    wh = warehouses.select("warehouse_id", "source_ord", "lead_time_days",
                           "stockout_cost_per_unit", "latitude", "longitude",
                           "capacity_volume_m3")
    sk = skus.select("sku_id", "safety_stock_days", "perishability_ttl_days",
                     "requires_refrigerated", "volume_m3_per_unit", "weight_kg_per_unit",
                     "unit_cost")
    j = keyed.join(wh, "warehouse_id").join(sk, "sku_id")
    stock = F.coalesce(F.col("_stock"), F.lit(0).cast("long"))
    demand = F.coalesce(F.col("demand"), F.lit(0.0))
    return j.select(*[c for c in j.columns if c not in ("_stock", "demand")],
                    stock.alias("current_stock"), demand.alias("demand"),
                    C.safety_stock(demand, C.safety_days("safety_stock_days"), F.lit(horizon_days))
                    .alias("safety_stock"))


def replenishment_need(cells_df: DataFrame) -> DataFrame:
    """Cells below safety stock (strict) and their order size.

    ``ttl_blocked``: the SKU perishes before the destination's lead time, so
    no source may serve the cell (a property of the cell, not of the pair).
    """
    ttl = F.col("perishability_ttl_days")
    return (cells_df.where(F.col("current_stock") < F.col("safety_stock"))
            .withColumns({
                "needed_qty": C.needed_qty("safety_stock", "current_stock", "demand"),
                "ttl_blocked": F.coalesce(ttl.isNotNull() & (F.col("lead_time_days") > ttl),
                                          F.lit(False))}))


def _first_two_orders(warehouses: DataFrame) -> tuple:
    """The two smallest warehouse orders, as scalar sub-queries (evaluated
    once by Spark inside the plan; no join, no driver round trip)."""
    g1 = warehouses.select(F.min("source_ord")).scalar()
    g2 = warehouses.where(F.col("source_ord") > g1).select(F.min("source_ord")).scalar()
    return g1, g2


def feasible_sources(need: DataFrame, inventory: DataFrame, warehouses: DataFrame,
                     tasks: int | None = None) -> DataFrame:
    """First source in warehouse order with stock >= need, not the destination
    (C11, B12, E-7, F5).

    Input ``need``: rows of ``replenishment_need`` (TTL-blocked rows drop).
    Output: the need rows that found a source, plus its ``from_ord``; a cell
    that no warehouse can serve has no row, as in the model. ``tasks``: how many
    tasks the SKUs are dealt to, where the session's number is not meant.

    Stock quantities are counts (>= 0). A cell with no inventory row holds 0
    units; such a warehouse qualifies only for a need of 0 units, where every
    warehouse does, so that case takes the first warehouse that is not the
    destination.
    """
    wh = warehouses.select("warehouse_id", "source_ord")
    q = need.where(~F.col("ttl_blocked"))
    qtype = q.select(F.struct(*q.columns).alias("_q")).schema["_q"].dataType
    src = (latest_inventory(inventory).join(wh, "warehouse_id")
           .select("sku_id", F.col("quantity_available").cast("double").alias("_key"),
                   F.lit(0).alias("_kind"), F.col("source_ord").alias("_ord"),
                   F.lit(None).cast("string").alias("_to"),
                   F.lit(None).cast(qtype).alias("_q")))
    # the needy row rides along as a struct, so no join back is needed
    qrows = q.select("sku_id", F.col("needed_qty").cast("double").alias("_key"),
                     F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_ord"),
                     F.col("warehouse_id").alias("_to"), F.struct(*q.columns).alias("_q"))
    stream = src.unionByName(qrows)
    if tasks:
        stream = stream.repartition(tasks, "sku_id")

    order = Window.partitionBy("sku_id").orderBy(F.col("_key").desc(), "_kind", "_ord", "_to")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    src_ord = F.when(F.col("_kind") == 0, F.col("_ord"))

    s1 = stream.select("*", F.min(src_ord).over(upto).alias("_best1"),
                       F.min(src_ord).over(before).alias("_prev"))
    # A source row is a record when it beats every earlier source; the best
    # of the prefix without its current best is the lower of the best
    # non-record and the record that preceded the current one.
    is_rec = (F.col("_kind") == 0) & (F.col("_prev").isNull() | (F.col("_ord") < F.col("_prev")))
    s2 = s1.select("*",
                   F.min(F.when((F.col("_kind") == 0) & ~is_rec, F.col("_ord"))).over(upto)
                    .alias("_nonrec"),
                   F.last(F.when(is_rec, F.col("_prev")), ignorenulls=True).over(upto)
                    .alias("_prevrec"))
    ans = s2.where(F.col("_kind") == 1).select(
        "_q.*", "_best1", F.least("_nonrec", "_prevrec").alias("_best2"))

    g1, g2 = _first_two_orders(warehouses)
    to_ord = F.col("source_ord")
    pick_real = F.when(F.col("_best1") != to_ord, F.col("_best1")).otherwise(F.col("_best2"))
    zero_pick = F.when(g1 != to_ord, g1).otherwise(g2)
    pick = F.when(F.col("needed_qty") <= 0, zero_pick).otherwise(pick_real)
    return (ans.withColumn("from_ord", pick.cast("long"))
            .where(F.col("from_ord").isNotNull())
            .drop("_best1", "_best2"))


def _plan_rows(chosen: DataFrame, warehouses: DataFrame, start_date, plan_id: str,
               qty: str, reason: str) -> DataFrame:
    """The plan table from destination cells with a chosen ``from_ord``.

    The cost is priced at the Medium rate whatever the truck type, like the
    model it mirrors (Q11).
    """
    src = warehouses.select(F.col("source_ord").alias("from_ord"),
                            F.col("warehouse_id").alias("from_wh"),
                            F.col("latitude").alias("_flat"), F.col("longitude").alias("_flon"))
    start = as_date(start_date)
    km = C.haversine_km("_flat", "_flon", "latitude", "longitude")
    return (chosen.join(src, "from_ord").select(
        F.lit(plan_id).alias("plan_id"),
        start.alias("run_date"),
        "from_wh",
        F.col("warehouse_id").alias("to_wh"),
        "sku_id",
        F.col(qty).alias("qty"),
        start.alias("ship_date"),
        F.date_add(start, F.col("lead_time_days")).alias("expected_arrival"),
        C.truck_type_for("requires_refrigerated").alias("truck_type"),
        F.lit(None).cast("string").alias("driver_id"),
        C.transport_cost(km, qty, "volume_m3_per_unit", "weight_kg_per_unit",
                         "Medium").alias("estimated_cost"),
        F.lit(reason).alias("reason_code")))


def greedy_plan(warehouses: DataFrame, skus: DataFrame, inventory: DataFrame,
                forecasts: DataFrame, start_date, horizon_days: int = 14,
                plan_id: str = "PLAN-GREEDY", tasks: int | None = None) -> DataFrame:
    """The greedy replenishment plan.

    Decisions are independent (source stock is not reduced between them), so
    the plan is one relational query.
    """
    c = cells(warehouses, skus, inventory, forecasts, horizon_days)
    chosen = feasible_sources(replenishment_need(c), inventory, warehouses, tasks)
    return _plan_rows(chosen, warehouses, start_date, plan_id, "needed_qty", "GREEDY_HEURISTIC")


def balanced_plan(warehouses: DataFrame, skus: DataFrame, inventory: DataFrame,
                  forecasts: DataFrame, start_date, horizon_days: int = 14,
                  plan_id: str = "PLAN-BALANCED") -> DataFrame:
    """A plan that never promises more than a source can spare (J2, re-aimed).

    Per SKU, what the warehouses hold above their safety stock and what the
    needy cells lack are laid out along one line each, in warehouse order. The
    ends of both layouts, sorted together, cut the line into pieces that lie in
    one source's and one destination's part: each is a transfer. One shuffle by
    SKU and one sort; at most sources + destinations transfers, never pairs.
    """
    c = cells(warehouses, skus, inventory, forecasts, horizon_days)
    need = replenishment_need(c).where(~F.col("ttl_blocked") & (F.col("needed_qty") > 0))
    spare = (c.withColumn("spare", F.floor(F.col("current_stock") - F.col("safety_stock")).cast("long"))
             .where("spare > 0"))
    line = Window.partitionBy("sku_id").orderBy("source_ord").rowsBetween(Window.unboundedPreceding, 0)
    columns = [x for x in need.columns if x != "sku_id"]
    kind = need.select(F.struct(*columns).alias("d")).schema["d"].dataType
    ends = (need.select("sku_id", F.sum("needed_qty").over(line).alias("end"), F.lit(None).cast("long").alias("from_ord"),
                        F.struct(*columns).alias("d"))
            .unionByName(spare.select("sku_id", F.sum("spare").over(line).alias("end"), F.col("source_ord").alias("from_ord"),
                                      F.lit(None).cast(kind).alias("d"))))
    order = Window.partitionBy("sku_id").orderBy("end", F.col("from_ord").isNull())
    ahead = order.rowsBetween(0, Window.unboundedFollowing)
    cut = ends.select("sku_id", (F.col("end") - F.lag("end", 1, 0).over(order)).alias("qty"),
                      F.first("from_ord", ignorenulls=True).over(ahead).alias("from_ord"),
                      F.first("d", ignorenulls=True).over(ahead).alias("d"))
    chosen = (cut.where((F.col("qty") > 0) & F.col("from_ord").isNotNull() & F.col("d").isNotNull())
              .select("sku_id", "qty", "from_ord", "d.*"))
    return _plan_rows(chosen, warehouses, start_date, plan_id, "qty", "STOCK_BALANCED")


def _min_cost(*args, **kwargs) -> DataFrame:
    from restock.operators.market import min_cost_plan      # builds on this module
    return min_cost_plan(*args, **kwargs)


# planning methods by name
METHODS = {"greedy": greedy_plan, "balanced": balanced_plan, "min_cost": _min_cost}


def plan_with_method(method: str, *args, **kwargs) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown planning method: {method}")
    return METHODS[method](*args, **kwargs)


def capacity_days(plan: DataFrame, warehouses: DataFrame, skus: DataFrame,
                  start_date, horizon_days: int = 14) -> DataFrame:
    """Split transfers over ship days so inbound volume per destination and
    day stays within capacity, and no unit is left over that fits a day (J3).

    Units of one volume are alike, so the days are filled for the totals per
    (destination, unit volume), large volumes first: each day takes as many as
    its room holds, and what fits no day is shortfall. That fold runs over the
    distinct unit volumes shipped to a destination, not over its transfers. A
    transfer then takes the stretch of its class that its running count covers
    (ordered by cost, source, SKU), cut where the class's days end; pieces are
    differences of one count, so they add up. No volume given means no room
    needed, no capacity given means no limit; a transfer of no units ships
    nothing on the first day.
    """
    vol = skus.select("sku_id", F.coalesce("volume_m3_per_unit", F.lit(0.0)).alias("_v"))
    cap = warehouses.select(F.col("warehouse_id").alias("to_wh"), "capacity_volume_m3")
    p = plan.join(vol, "sku_id").join(cap, "to_wh")
    group = ["plan_id", "to_wh"]
    totals = (p.groupBy(*group, "_v").agg(F.sum("qty").alias("n"), F.first("capacity_volume_m3").alias("cap"))
              .groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(F.col("_v").alias("v"), "n")), asc=False).alias("classes"),
                                   F.coalesce(F.first("cap"), F.lit(1e300)).alias("cap")))
    days = f"sequence(0, {horizon_days - 1})"
    fill = (f"aggregate({days}, struct(c.n as left, cast(array() as array<double>) as room, cast(array() as array<bigint>) as days), "
            "(s, d) -> transform(array(if(c.v <= 0, s.left, least(s.left, cast(floor(a.room[d] / c.v + 1e-9) as bigint)))), "
            "k -> struct(s.left - k as left, concat(s.room, array(a.room[d] - k * c.v)) as room, concat(s.days, array(k)) as days))[0])")
    filled = totals.select(*group, F.expr(
        f"aggregate(classes, struct(transform({days}, d -> cap) as room, "
        "cast(array() as array<struct<v: double, days: array<bigint>>>) as out), "
        f"(a, c) -> transform(array({fill}), r -> struct(r.room as room, "
        "concat(a.out, array(struct(c.v as v, concat(r.days, array(r.left)) as days))) as out))[0], a -> a.out)").alias("out"))
    classes = filled.select(*group, F.explode("out").alias("o")).select(*group, F.col("o.v").alias("_v"), F.col("o.days").alias("days"))
    stretch = (Window.partitionBy(*group, "_v").orderBy("estimated_cost", "from_wh", "sku_id", "ship_date")
               .rowsBetween(Window.unboundedPreceding, 0))
    p = p.withColumn("_to", F.sum("qty").over(stretch)).withColumn("_from", F.col("_to") - F.col("qty"))
    # piece of day k: the overlap of the transfer's stretch with the day's
    pieces = p.join(classes, [*group, "_v"]).withColumn("_d", F.expr(
        "transform(days, (n, k) -> struct(k as day_offset, least(_to, aggregate(slice(days, 1, k + 1), 0L, (x, y) -> x + y)) "
        "- greatest(_from, aggregate(slice(days, 1, k), 0L, (x, y) -> x + y)) as units))"))
    pieces = pieces.withColumn("_d", F.explode(F.expr(
        "if(qty = 0, array(struct(0 as day_offset, 0L as units)), filter(_d, x -> x.units > 0))")))
    k = F.col("_d.day_offset")
    return pieces.select("plan_id", "from_wh", "to_wh", "sku_id", "qty",
                         F.col("_d.units").alias("units"), (F.col("_d.units") * F.col("_v")).alias("volume_m3"),
                         "capacity_volume_m3", k.alias("day_offset"),
                         F.date_add(as_date(start_date), k).alias("assigned_ship_date"),
                         (k >= horizon_days).alias("shortfall"))


def capacity_rule(plan: DataFrame, days: DataFrame, skus: DataFrame, horizon_days: int = 14) -> DataFrame:
    """What ``capacity_days`` promises, per plan and destination: units planned
    and accounted for, transfers whose pieces do not add up, days above
    capacity, and left-over pieces of which a unit would fit some day (J3, D-18)."""
    group = ["plan_id", "to_wh"]
    lane = [*group, "from_wh", "sku_id"]
    split = (plan.groupBy(*lane).agg(F.sum("qty").alias("q"))
             .join(days.groupBy(*lane).agg(F.sum("units").alias("u")), lane, "left")
             .groupBy(*group).agg(F.sum("q").alias("planned_units"), F.sum("u").alias("accounted_units"),
                                  F.count_if(~F.col("u").eqNullSafe(F.col("q"))).alias("broken_transfers")))
    used = (days.where(~F.col("shortfall")).groupBy(*group, "day_offset")
            .agg(F.sum("volume_m3").alias("used"), F.first("capacity_volume_m3").alias("cap")))
    room = used.groupBy(*group).agg(
        F.count_if(F.col("used") > F.col("cap") + 1e-6).alias("days_over"),
        # a day without any piece has its whole capacity free
        F.when(F.count("*") < horizon_days, F.first("cap")).otherwise(F.max(F.col("cap") - F.col("used"))).alias("free"))
    left = (days.where("shortfall").join(skus.select("sku_id", "volume_m3_per_unit"), "sku_id")
            .join(room.select(*group, "free"), group, "left")
            .groupBy(*group).agg(F.count_if(F.col("volume_m3_per_unit") <= F.coalesce("free", "capacity_volume_m3") - 1e-6)
                                 .alias("left_but_fitting")))
    zero = F.lit(0).cast("long")
    return (split.join(room.select(*group, "days_over"), group, "left").join(left, group, "left")
            .select(*group, "planned_units", "accounted_units", "broken_transfers",
                    F.coalesce("days_over", zero).alias("days_over"),
                    F.coalesce("left_but_fitting", zero).alias("left_but_fitting")))


def plan_lookup(plans: DataFrame, plan_id: str | None = None) -> DataFrame:
    """Rows of one plan, or of the newest plan when no id is given."""
    if plan_id is not None:
        return plans.where(F.col("plan_id") == plan_id)
    from restock.sources.io import newest_plan
    return newest_plan(plans)


def plan_gantt(plan: DataFrame) -> DataFrame:
    """Timeline rows: lane label, start, duration in days, quantity."""
    return plan.select(
        "plan_id",
        F.concat_ws(" → ", "from_wh", "to_wh").alias("lane"),
        "sku_id", F.col("ship_date").alias("start"),
        F.datediff("expected_arrival", "ship_date").alias("duration_days"),
        "qty")
