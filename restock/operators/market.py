"""The cost-minimal plan (J2) with inbound capacity shared by SKUs (J3, D-18).

Minimise freight plus the penalty of units still lacking, such that no source
ships more than its stock, perishable SKUs only go where they arrive in time and
no destination takes in more volume a day than its capacity. Freight is charged
a unit (km * rate / units a load), as in the model, so an optimal plan has prices:
one for each source's units of a SKU, one for each destination's cubic metre.

How it works, and why it scales
-------------------------------
* A SKU is one row: its sources, its needy cells and the gain of every lane
  between them (at most warehouses squared, whatever the sales history). Source
  prices of a SKU depend on nothing else, so all their rounds run inside that
  row, as array functions: cells spread their need over the lanes by a smoothed
  choice (softmax of gain less price, not buying is a choice too), a source's
  price moves by the logarithm of demand over stock, and the smoothing shrinks
  from round to round. No shuffle, no Python, no state table.
* Capacity couples SKUs. Its prices (one row a warehouse) are found by halving
  an interval per destination: each round is one aggregate of the volumes that
  all SKUs want at the prices so far.
* Whole units: each lane gets its share to the nearest unit, then what is left is
  granted in rounds of joins (cells ask at their best lane, sources serve the
  highest gain, destinations take the highest gain a volume until full), each
  round written to a table, until nothing more is granted.
* Any prices give a lower bound of every plan's cost (the dual), so the plan
  comes with its exact gap: nothing has to be believed about the rounds.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.functions import costs as C
from restock.operators.plan import _plan_rows, capacity_days, cells
from restock.session import drop_tables, materialize

SMOOTHING = (8.0, 4.0, 2.0, 1.0, 0.5, 0.25, 0.12, 0.06, 0.03)   # currency a unit
ROUNDS = 30                # price rounds at each smoothing
HALVINGS = 10              # of the capacity prices
NO_LANE = -1e9


def stock_and_lack(cells_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the model may move: all stock of every cell (supply), and the whole
    units that demand exceeds stock by (need) where the SKU does not perish on the way."""
    ttl = F.col("perishability_ttl_days")
    blocked = F.coalesce(F.col("lead_time_days") > ttl, F.lit(False))
    lack = F.ceil(F.col("demand") - F.col("current_stock")).cast("long")
    return (cells_df.select("*", F.col("current_stock").alias("units")).where("units > 0"),
            cells_df.select("*", lack.alias("units"), blocked.alias("ttl_blocked")).where("units > 0"))


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _shares(d: str, p: str, tau: str) -> str:
    """Units that cell ``d`` wants of each source at prices ``p``."""
    return _let("x", f"zip_with({d}.b, {p}, (b, q) -> (b - q) / {tau})",
                _let("m", "greatest(0D, array_max(x))",
                     _let("e", "transform(x, y -> exp(y - m))",
                          _let("z", "exp(-m) + aggregate(e, 0D, (a, y) -> a + y)", f"transform(e, y -> {d}.r * y / z)"))))


def _demand(p: str, tau: str) -> str:
    return f"aggregate(dests, transform(u, y -> 0D), (a, d) -> zip_with(a, {_shares('d', p, tau)}, (g, h) -> g + h))"


def _prices(smoothing, rounds: int) -> str:
    step = (f"zip_with(p, zip_with({_demand('p', 'tau')}, u, (g, h) -> ln(greatest(g, 1e-300D) / h)), "
            "(q, l) -> greatest(0D, q + tau * l))")
    taus = ", ".join(f"{t}D" for t in smoothing)
    return (f"aggregate(array({taus}), transform(u, y -> 0D), "
            f"(s, tau) -> aggregate(sequence(1, {rounds}), s, (p, i) -> {step}))")


def market(supply: DataFrame, need: DataFrame, load: float = 1.0) -> DataFrame:
    """One row a SKU: ``src`` (ord, units), ``u`` (units), ``dests`` (ord, r, v, b).

    ``b`` is the gain of a unit from each source: the penalty it saves less its
    freight. Cells that no source can reach (or that are blocked) keep an empty market."""
    place = ["source_ord", "latitude", "longitude"]
    src = (supply.groupBy("sku_id")
           .agg(F.sort_array(F.collect_list(F.struct(F.col("source_ord").alias("ord"), "units", "latitude", "longitude"))).alias("src")))
    dst = need.groupBy("sku_id").agg(
        F.first("volume_m3_per_unit").alias("volume"),
        F.sort_array(F.collect_list(F.struct(F.col("source_ord").alias("ord"), F.col("units").cast("double").alias("r"),
                                             F.col("stockout_cost_per_unit").alias("v"), "ttl_blocked", *place[1:]))).alias("dst"))
    none = F.array().cast("array<struct<ord: bigint, units: bigint, latitude: double, longitude: double>>")
    rows = dst.join(src, "sku_id", "left").withColumn("src", F.coalesce("src", none))

    def gain(d, s):
        km = C.haversine_km(s["latitude"], s["longitude"], d["latitude"], d["longitude"])
        g = d["v"] - km * C.truck_rate() / load
        return F.when((s["ord"] == d["ord"]) | d["ttl_blocked"] | (g <= 0) | g.isNull(), NO_LANE).otherwise(g)

    return rows.select("sku_id", F.coalesce("volume", F.lit(0.0)).alias("volume"), "src",
                       F.transform("src", lambda s: s["units"].cast("double")).alias("u"),
                       F.transform("dst", lambda d: F.struct(d["ord"].alias("ord"), d["r"].alias("r"), d["v"].alias("v"),
                                                             F.transform("src", lambda s: gain(d, s)).alias("b"))).alias("dests"))


def _priced(m: DataFrame, room: DataFrame, smoothing, rounds: int) -> DataFrame:
    """The market at the capacity prices ``room`` (ord, mu): gains net of them, the
    source prices ``p``, the shares ``x`` of every cell, and the SKU's part of the dual."""
    mu = room.agg(F.map_from_entries(F.collect_list(F.struct("ord", "mu")))).scalar()     # one entry a warehouse
    net = m.withColumn("_mu", mu).withColumn("dests", F.expr(
        "transform(dests, d -> struct(d.ord as ord, d.r as r, d.v as v, d.b as gross, "
        "transform(d.b, y -> y - coalesce(_mu[d.ord], 0D) * volume) as b))")).drop("_mu")
    out = net.withColumn("p", F.expr(_prices(smoothing, rounds)))
    # bound to a name, so that no rewrite of the plan works the prices out again for every cell
    x = _let("q", "p", f"transform(dests, d -> {_shares('d', 'q', f'{smoothing[-1]}D')})")
    dual = ("aggregate(dests, 0D, (a, d) -> a + d.r * (d.v - greatest(0D, coalesce(array_max(zip_with(d.b, p, (b, q) -> b - q)), 0D)))) "
            "- aggregate(zip_with(u, p, (h, q) -> h * q), 0D, (a, y) -> a + y)")
    return out.select("*", F.expr(x).alias("x"), F.expr(_let("p", "p", dual)).alias("dual"))


def _wanted(priced: DataFrame) -> DataFrame:
    """Volume that all SKUs want at each destination."""
    each = "zip_with(dests, x, (d, s) -> struct(d.ord as ord, volume * aggregate(s, 0D, (a, y) -> a + y) as vol))"
    return priced.select(F.explode(F.expr(each)).alias("e")).groupBy(F.col("e.ord").alias("ord")).agg(F.sum("e.vol").alias("vol"))


def capacity_prices(m: DataFrame, room: DataFrame, smoothing=SMOOTHING, rounds: int = ROUNDS, halvings: int = HALVINGS) -> DataFrame:
    """(ord, cap, mu): a price a cubic metre at every destination whose wanted
    volume exceeds its capacity over the horizon, by halving."""
    # above its dearest gain a volume, a destination wants nothing
    dearest = m.select("volume", F.explode("dests").alias("d")).groupBy(F.col("d.ord").alias("ord")).agg(
        F.max(F.when(F.col("volume") > 0, F.col("d.v") / F.col("volume"))).alias("hi"))
    state = materialize(room.join(dearest, "ord", "left").select(
        "ord", "cap", F.lit(0.0).alias("mu"), F.lit(0.0).alias("lo"), F.coalesce("hi", F.lit(0.0)).alias("hi")), "market-room")
    for i in range(halvings + 1):
        seen = state.join(_wanted(_priced(m, state, smoothing, rounds)), "ord", "left").withColumn(
            "over", F.coalesce(F.col("vol") > F.col("cap"), F.lit(False)))
        low, high = F.when(F.col("over"), F.col("mu")).otherwise(F.col("lo")), F.when(F.col("over"), F.col("hi")).otherwise(F.col("mu"))
        done = ~F.col("over") & (F.col("mu") == 0)             # room enough without a price
        new = materialize(seen.select("ord", "cap", F.when(done, 0.0).otherwise((low + high) / 2).alias("mu"),
                                      F.when(done, 0.0).otherwise(low).alias("lo"), F.when(done, 0.0).otherwise(high).alias("hi"), "over"),
                          "market-room")
        drop_tables(state)
        state = new
        if i == 0 and not state.where("over").head(1):
            break
    return state


def _lanes(priced: DataFrame) -> DataFrame:
    """(sku_id, volume, to_ord, from_ord, r, u, gain, p, share): the lanes that save
    cost, whatever room costs; ``gain`` is net of that."""
    d = priced.select("sku_id", "volume", "src", "p", F.posexplode(F.arrays_zip("dests", "x")).alias("_i", "z"))
    lane = d.select("sku_id", "volume", F.col("z.dests.ord").alias("to_ord"), F.col("z.dests.r").cast("long").alias("r"),
                    F.explode(F.arrays_zip("src", "p", F.col("z.dests.gross").alias("gross"), F.col("z.dests.b").alias("b"),
                                           F.col("z.x").alias("x"))).alias("l")).where("l.gross > 0")
    return lane.select("sku_id", "volume", "to_ord", F.col("l.src.ord").alias("from_ord"), "r", F.col("l.src.units").alias("u"),
                       F.col("l.b").alias("gain"), F.col("l.p").alias("p"), F.col("l.x").alias("share"))


def _until_full(df: DataFrame, keys: list[str], amount: str, room: str, order: list, out: str) -> DataFrame:
    """``out``: what ``room`` (one value a key) leaves of ``amount`` for each row, in the given order."""
    before = F.sum(amount).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(amount)
    return df.withColumn(out, F.greatest(F.lit(0).cast("double"), F.least(F.col(amount), F.col(room) - before)))


def whole_units(priced: DataFrame, room: DataFrame) -> DataFrame:
    """(sku_id, from_ord, to_ord, qty): whole units on lanes, within stock, need and capacity."""
    lanes = materialize(_lanes(priced), "market-lanes")
    cap = room.select(F.col("ord").alias("to_ord"), "cap")
    order = [F.col("gain").desc(), "from_ord", "to_ord"]
    by_volume = [(F.col("gain") / F.greatest("volume", F.lit(1e-12))).desc(), "sku_id", "from_ord"]

    def granted(asked: DataFrame) -> DataFrame:
        """``ask`` units on lanes, cut to what the source has left and then to the destination's room."""
        g = _until_full(asked, ["sku_id", "from_ord"], "ask", "left_u", order, "g")
        g = g.withColumn("g", F.floor("g").cast("double")).withColumn("gv", F.col("g") * F.col("volume"))
        g = _until_full(g, ["to_ord"], "gv", "left_cap", by_volume, "gv")
        return g.withColumn("qty", F.when(F.col("volume") > 0, F.floor(F.col("gv") / F.col("volume") + 1e-9)).otherwise(F.col("g")).cast("long"))

    # the shares to the nearest unit; where a cell, a source or a destination would be over, the later lanes are cut
    first = _until_full(lanes.withColumn("ask", F.round("share")).where("ask > 0"), ["sku_id", "to_ord"], "ask", "r",
                        [F.col("share").desc(), "from_ord"], "ask")
    first = first.join(cap, "to_ord", "left").withColumns(
        {"left_u": F.col("u").cast("double"), "left_cap": F.coalesce("cap", F.lit(1e300))})
    done = materialize(granted(first.where("ask > 0")).where("qty > 0").select("sku_id", "from_ord", "to_ord", "qty", "volume"), "market-grants")
    while True:
        used = done.groupBy("sku_id", "from_ord").agg(F.sum("qty").alias("uu"))
        met = done.groupBy("sku_id", "to_ord").agg(F.sum("qty").alias("rr"))
        full = done.groupBy("to_ord").agg(F.sum(F.col("qty") * F.col("volume")).alias("vv"))
        zero = F.lit(0)
        rest = (lanes.join(used, ["sku_id", "from_ord"], "left").join(met, ["sku_id", "to_ord"], "left")
                .join(cap.join(full, "to_ord", "left"), "to_ord", "left")
                .withColumns({"left_u": (F.col("u") - F.coalesce("uu", zero)).cast("double"),
                              "ask": (F.col("r") - F.coalesce("rr", zero)).cast("double"),
                              "left_cap": F.coalesce(F.col("cap") - F.coalesce("vv", zero), F.lit(1e300))})
                .where("left_u > 0 and ask > 0 and left_cap >= volume - 1e-9"))
        best = F.row_number().over(Window.partitionBy("sku_id", "to_ord").orderBy((F.col("gain") - F.col("p")).desc(), "from_ord"))
        more = granted(rest.withColumn("_n", best).where("_n = 1")).where("qty > 0").select("sku_id", "from_ord", "to_ord", "qty", "volume")
        more = materialize(more, "market-grants")
        if not more.head(1):
            drop_tables(more)
            break
        new = materialize(done.unionByName(more).groupBy("sku_id", "from_ord", "to_ord").agg(F.sum("qty").alias("qty"), F.first("volume").alias("volume")), "market-grants")
        drop_tables(done, more)
        done = new
    out = done.select("sku_id", "from_ord", "to_ord", "qty")
    out._written_at = done._written_at
    return out


def _room(warehouses: DataFrame, horizon_days: int) -> DataFrame:
    return warehouses.where("capacity_volume_m3 is not null").select(
        F.col("source_ord").alias("ord"), (F.col("capacity_volume_m3") * horizon_days).alias("cap"))


def min_cost(supply: DataFrame, need: DataFrame, warehouses: DataFrame, horizon_days: int = 14, load: float = 1.0,
             smoothing=SMOOTHING, rounds: int = ROUNDS, halvings: int = HALVINGS) -> tuple[DataFrame, DataFrame]:
    """(flows, report): whole units per lane, and one row with the plan's cost,
    the lower bound of any plan's cost and the gap between them.

    ``supply`` and ``need`` are cells with ``units``; a missing capacity is none."""
    m = materialize(market(supply, need, load), "market")
    room = capacity_prices(m, _room(warehouses, horizon_days), smoothing, rounds, halvings)
    priced = materialize(_priced(m, room, smoothing, rounds), "market-priced")
    flows = whole_units(priced, room)
    return flows, plan_cost(flows, m, priced, room)


def plan_cost(flows: DataFrame, m: DataFrame, priced: DataFrame, room: DataFrame) -> DataFrame:
    """(units, units_lacking, cost, bound, gap) of whole-unit flows."""
    d = m.select("sku_id", "src", F.explode("dests").alias("d"))
    lane = d.select("sku_id", F.col("d.ord").alias("to_ord"), F.col("d.v").alias("v"),
                    F.explode(F.arrays_zip("src", F.col("d.b").alias("b"))).alias("l"))
    lane = lane.select("sku_id", "to_ord", "v", F.col("l.src.ord").alias("from_ord"), F.col("l.b").alias("gain"))
    saved = flows.join(lane, ["sku_id", "from_ord", "to_ord"]).agg(F.coalesce(F.sum("qty"), F.lit(0)).alias("units"),
                                                                F.coalesce(F.sum(F.col("qty") * F.col("gain")), F.lit(0.0)).alias("saved"))
    need = d.select(F.coalesce(F.sum("d.r"), F.lit(0.0)).cast("long")).scalar()
    penalty = d.select(F.coalesce(F.sum(F.col("d.r") * F.col("d.v")), F.lit(0.0))).scalar()
    dual = priced.select(F.coalesce(F.sum("dual"), F.lit(0.0))).scalar()
    held = room.select(F.coalesce(F.sum(F.col("mu") * F.col("cap")), F.lit(0.0))).scalar()
    one = saved.select("units", (need - F.col("units")).alias("units_lacking"), (penalty - F.col("saved")).alias("cost"),
                       F.greatest(F.lit(0.0), dual - held).alias("bound"))
    return one.withColumn("gap", F.when(F.col("cost") > 0, (F.col("cost") - F.col("bound")) / F.col("cost")).otherwise(0.0))


class Solution(NamedTuple):
    plan: DataFrame
    cells: DataFrame
    market: DataFrame
    priced: DataFrame
    room: DataFrame


def solve(warehouses: DataFrame, skus: DataFrame, inventory: DataFrame, forecasts: DataFrame, start_date,
          horizon_days: int = 14, plan_id: str = "PLAN-MIN-COST", load: float = 1.0) -> Solution:
    """The plan with what certifies it. Units that fit no day's capacity whole are left out."""
    c = materialize(cells(warehouses, skus, inventory, forecasts, horizon_days), "market-cells")
    m = materialize(market(*stock_and_lack(c), load), "market")
    room = capacity_prices(m, _room(warehouses, horizon_days))
    priced = materialize(_priced(m, room, SMOOTHING, ROUNDS), "market-priced")
    chosen = whole_units(priced, room).join(c.withColumn("to_ord", F.col("source_ord")), ["sku_id", "to_ord"])
    rows = _plan_rows(chosen, warehouses, start_date, plan_id, "qty", "OPTIMIZATION")
    fits = (capacity_days(rows, warehouses, skus, start_date, horizon_days).where("not shortfall")
            .groupBy("from_wh", F.col("to_wh").alias("warehouse_id"), "sku_id").agg(F.sum("units").alias("_fit")))
    ids = warehouses.select(F.col("source_ord").alias("from_ord"), F.col("warehouse_id").alias("from_wh"))
    kept = chosen.join(ids, "from_ord").join(fits, ["from_wh", "warehouse_id", "sku_id"]).where("_fit > 0").drop("from_wh")
    plan = materialize(_plan_rows(kept, warehouses, start_date, plan_id, "_fit", "OPTIMIZATION"), "market-plan")
    return Solution(plan, c, m, priced, room)


def min_cost_plan(warehouses: DataFrame, skus: DataFrame, inventory: DataFrame, forecasts: DataFrame, start_date,
                  horizon_days: int = 14, plan_id: str = "PLAN-MIN-COST", load: float = 1.0) -> DataFrame:
    """The plan table of the cost-minimal plan."""
    return solve(warehouses, skus, inventory, forecasts, start_date, horizon_days, plan_id, load).plan


def gap_report(s: Solution, warehouses: DataFrame) -> DataFrame:
    """(units, units_lacking, cost, bound, gap) of the plan as it ships."""
    ord_ = lambda side: warehouses.select(F.col("warehouse_id").alias(f"{side}_wh"), F.col("source_ord").alias(f"{side}_ord"))
    flows = s.plan.join(ord_("from"), "from_wh").join(ord_("to"), "to_wh").select("sku_id", "from_ord", "to_ord", "qty")
    return plan_cost(flows, s.market, s.priced, s.room)


def rules(s: Solution, warehouses: DataFrame, skus: DataFrame, start_date, horizon_days: int = 14, most: float = 0.05) -> DataFrame:
    """(rule, checked, violations): what the plan promises, each counted over all it applies to."""
    supply, need = stock_and_lack(s.cells)
    cell = ["warehouse_id", "sku_id"]
    got = s.plan.groupBy(F.col("to_wh").alias("warehouse_id"), "sku_id").agg(F.sum("qty").alias("got"))
    out = s.plan.groupBy(F.col("from_wh").alias("warehouse_id"), "sku_id").agg(F.sum("qty").alias("out"))
    days = capacity_days(s.plan, warehouses, skus, start_date, horizon_days)
    over = days.groupBy("to_wh", "day_offset").agg((F.sum("volume_m3") > F.first("capacity_volume_m3") + 1e-6).alias("over"), F.first("shortfall").alias("late"))
    row = lambda df, name, checked, bad: df.agg(F.lit(name).alias("rule"), checked.cast("long").alias("checked"),
                                                F.count_if(bad).alias("violations"))
    each = F.count(F.lit(1))
    cells_in = s.cells.join(got, cell, "left").join(need.select(*cell, F.col("units").alias("need"), "ttl_blocked"), cell, "left")
    return (row(cells_in, "cell takes no more than it lacks", each, F.coalesce("got", F.lit(0)) > F.coalesce("need", F.lit(0)))
            .unionByName(row(cells_in.where("ttl_blocked"), "perishable cell takes nothing", each, F.col("got").isNotNull()))
            .unionByName(row(s.cells.join(out, cell, "left"), "source ships no more than its stock", each, F.col("out") > F.col("current_stock")))
            .unionByName(row(warehouses.join(over.withColumnRenamed("to_wh", "warehouse_id"), "warehouse_id", "left"),
                             "destination stays within its capacity", F.count_distinct("warehouse_id"), F.col("over") | F.col("late")))
            .unionByName(row(gap_report(s, warehouses), "cost near the lower bound", each, (F.col("gap") > most) | (F.col("bound") > F.col("cost") + 1e-6))))
