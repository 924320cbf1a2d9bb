"""Named end-to-end queries over the driver's tables.

Each query is ``f(spark, sf_dir) -> DataFrame``; the model tables are built
from the driver's tables by ``restock.sources.tpch``, so every query's work
grows with the input. Queries that reuse intermediates several times
materialise them first (see ``Model``). Doubles are rounded to 4 places at
the end so results compare across engines.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from restock import S, schemas
from restock.operators import audit, execution, explain, features as Fe, forecast as Fc
from restock.operators import kpi, linear, network, plan as P, quality, state
from restock.session import materialize, scratch_table_path
from restock.sources import io, tpch

H = tpch.HORIZON


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    return df.select([F.round(F.col(f.name), places).alias(f.name)
                      if isinstance(f.dataType, DoubleType) else F.col(f.name)
                      for f in df.schema.fields])


class Model:
    """The model tables of one input folder, built lazily.

    ``keep`` names the intermediates that a query reads more than once:
    ``"daily"`` (cells x days, not line items), ``"recent"`` and ``"plan"`` (cells).
    These are written once as Parquet in the shared checkpoint folder, so the line items
    are scanned once and a lost executor costs nothing. All else is one lazy plan.

    At part grain cells are about as many as line items, so keyed steps deal them to
    ``tasks`` tasks, a number that follows the line items.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, start=None, horizon: int = H,
                 keep: tuple[str, ...] = (), grain: str = "brand"):
        self.spark, self.sf_dir, self.h, self.keep, self.grain = spark, sf_dir, horizon, keep, grain
        self._start = start

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if name in self.keep else df

    @cached_property
    def warehouses(self):
        return tpch.warehouses(self.spark, self.sf_dir)

    @cached_property
    def tasks(self):
        return tpch.keyed_tasks(self.spark, self.sf_dir) if self.grain == "part" else None

    def _dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        return df.repartition(self.tasks, *keys) if self.tasks else df

    @cached_property
    def skus(self):
        return self._dealt(tpch.skus(self.spark, self.sf_dir, self.grain), "sku_id")

    @cached_property
    def sales(self):
        return tpch.sales_history(self.spark, self.sf_dir)

    @cached_property
    def daily_counted(self):
        return self._kept(tpch.daily(self.spark, self.sf_dir, self.grain, self.tasks), "daily")

    @cached_property
    def daily(self):
        return self.daily_counted.drop("n_rows")

    @cached_property
    def start(self):
        return tpch.start_date(self.daily) if self._start is None else self._start

    @cached_property
    def features(self):
        return Fe.rolling_features(self.daily)

    @cached_property
    def recent(self):
        return self._kept(tpch.recent(self._dealt(self.daily, *S)), "recent")

    @cached_property
    def inventory(self):
        return self._dealt(tpch.recent_stock(self.recent), *S)

    @cached_property
    def forecasts(self):
        """Stored forecast rows, one a day and series (I1, where it has none the flat mean)."""
        if self.grain == "part":
            return self._dealt(tpch.standin_demand(self.recent, self.start, self.h), *S)
        return Fc.combine_forecasts(Fc.trend_weekly_forecast(self.daily, self.start, self.h),
                                    tpch.flat_forecast(self.daily, self.start, self.h))

    @cached_property
    def plan(self):
        return self._kept(P.greedy_plan(self.warehouses, self.skus, self.inventory,
                                        self.forecasts, self.start, self.h, tasks=self.tasks), "plan")

    @cached_property
    def balanced(self):
        return self._kept(P.balanced_plan(self.warehouses, self.skus, self.inventory,
                                          self.forecasts, self.start, self.h), "plan")

    @cached_property
    def docks(self):
        return tpch.dock_capacity(self.warehouses, self.skus, self.inventory)

    @cached_property
    def lead_times(self):
        return tpch.actual_lead_times(self.inventory, self.warehouses)

    @cached_property
    def actual_demand(self):
        return tpch.actual_demand(self.forecasts, self.warehouses)

    @cached_property
    def shipments(self):
        return tpch.shipments(self.spark, self.sf_dir)

    @cached_property
    def outcomes(self):
        return self._kept(execution.transfer_outcomes(self.plan, self.warehouses, self.skus, self.lead_times), "outcomes")

    @cached_property
    def service(self):
        return self._kept(execution.cell_service(self.outcomes, self.inventory, self.actual_demand), "service")


# Which intermediates a query keeps; explaining or testing a whole plan sets it off.
KEEP = True


def _model(*keep: str, grain: str = "brand"):
    def make(spark, sf_dir) -> Model:
        return Model(spark, sf_dir, keep=keep if KEEP else (), grain=grain)
    return make


_m = _model()                       # every table is read once
_mm = _model("daily")               # stock and forecasts both read the daily table
_mp = _model("daily", "plan")       # the plan is read more than once too
_mx = _model("daily", "plan", "outcomes", "service")
_mc = _model("daily", "recent", grain="part")       # stock and demand both read the cells


# ------------------------------------------------------------ sources ----
def load_sales(spark, sf_dir):
    return rounded(_m(spark, sf_dir).sales)


def integrity_report(spark, sf_dir):
    m = _mm(spark, sf_dir)
    return quality.integrity_report(m.daily_counted, m.inventory, m.warehouses, m.skus)


def declared_rules(spark, sf_dir):
    """Declared keys and domains of the model tables, counted."""
    m = _mm(spark, sf_dir)
    return quality.rule_report({"warehouses": m.warehouses, "skus": m.skus, "sales_history": m.sales, "daily_sales_aggregated": m.daily,
                                "inventory_snapshot": m.inventory, "forecasts": m.forecasts})


# ----------------------------------------------------------- features ----
def daily_sales(spark, sf_dir):
    return rounded(_m(spark, sf_dir).daily)


def rolling_stats(spark, sf_dir):
    d = _m(spark, sf_dir).daily
    return rounded(d.select("date", *S, "quantity_sold", *Fe.rolling_stats(d)))


def lags(spark, sf_dir):
    d = _m(spark, sf_dir).daily
    return d.select("date", *S, "quantity_sold", *Fe.lags(d))


def calendar_features(spark, sf_dir):
    return _m(spark, sf_dir).daily.select("date", *S, *Fe.calendar())


def promotion_flag(spark, sf_dir):
    return _m(spark, sf_dir).daily.select("date", *S, "quantity_sold", Fe.promotion_flag())


def rolling_features(spark, sf_dir):
    return rounded(_m(spark, sf_dir).features)


def stored_features(spark, sf_dir):
    """The features over a stored daily table that is clustered by series: no shuffle (A3, E-6)."""
    root = scratch_table_path(spark, "stored-daily")
    io.write_table(_m(spark, sf_dir).daily, root, cluster_by=list(S), sort_by=["date"])
    return rounded(Fe.rolling_features(io.read_table(spark, root)))


def inventory_features(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rounded(Fe.inventory_features(m.inventory, m.skus))


def series_registry(spark, sf_dir):
    return Fe.series_registry(_m(spark, sf_dir).daily)


def chronological_split(spark, sf_dir):
    d = _m(spark, sf_dir).daily
    return Fe.chronological_split(d).select("date", *S, "row_pos", "series_rows", "is_train")


def latest_features(spark, sf_dir):
    return rounded(Fe.latest_features(_m(spark, sf_dir).features))


def sample_export(spark, sf_dir):
    return rounded(io.sample_export(_m(spark, sf_dir).features, [*S, "date"], 1000))


# -------------------------------------------------------------- costs ----
def distance_matrix(spark, sf_dir):
    pairs = tpch.shipments(spark, sf_dir, by_sku=False)
    return rounded(network.distance_matrix(pairs, _m(spark, sf_dir).warehouses))


def lane_days(spark, sf_dir):
    m = _m(spark, sf_dir)
    return network.lane_days(m.shipments, m.warehouses, m.skus, m.start, H)


def transport_costs(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rounded(network.transport_costs(m.shipments, m.warehouses, m.skus))


def holding_stockout_ordering(spark, sf_dir):
    m = _mm(spark, sf_dir)
    return rounded(network.holding_stockout_ordering(m.inventory, m.forecasts, m.warehouses, H))


def waste_costs(spark, sf_dir):
    m = _mm(spark, sf_dir)
    return rounded(network.waste_costs(m.inventory, m.skus, m.lead_times))


def total_transfer_cost(spark, sf_dir):
    m = _mm(spark, sf_dir)
    return rounded(network.total_transfer_cost(m.plan, m.warehouses, m.skus, m.lead_times))


# --------------------------------------------------------------- plan ----
def _cells(m: Model) -> DataFrame:
    return P.cells(m.warehouses, m.skus, m.inventory, m.forecasts, H)


def cells(spark, sf_dir):
    return rounded(_cells(_mm(spark, sf_dir)).select(*S, "current_stock", "demand", "safety_stock"))


def replenishment_need(spark, sf_dir):
    n = P.replenishment_need(_cells(_mm(spark, sf_dir)))
    return rounded(n.select(*S, "current_stock", "demand", "safety_stock", "needed_qty", "ttl_blocked"))


def _sources(m: Model) -> DataFrame:
    ch = P.feasible_sources(P.replenishment_need(_cells(m)), m.inventory, m.warehouses, m.tasks)
    src = m.warehouses.select(F.col("source_ord").alias("from_ord"), F.col("warehouse_id").alias("from_wh"))
    return ch.join(src, "from_ord").select(F.col("warehouse_id").alias("to_wh"), "sku_id", "needed_qty", "from_wh")


def feasible_sources(spark, sf_dir):
    return _sources(_mm(spark, sf_dir))


def greedy_plan(spark, sf_dir):
    return rounded(_mm(spark, sf_dir).plan)


def greedy_plan_by_part(spark, sf_dir):
    return rounded(_mc(spark, sf_dir).plan)


def feasible_sources_by_part(spark, sf_dir):
    return _sources(_mc(spark, sf_dir))


def balanced_plan(spark, sf_dir):
    return rounded(_mm(spark, sf_dir).balanced)


def balanced_plan_audit(spark, sf_dir):
    m = _mp(spark, sf_dir)
    return rounded(audit.plan_audit(m.balanced, m.warehouses, m.skus, m.inventory))


def plan_explained(spark, sf_dir):
    m = _mm(spark, sf_dir)
    return rounded(explain.plan_explained(m.plan, m.warehouses, m.skus, m.inventory, m.forecasts))


def plan_audit(spark, sf_dir):
    m = _mp(spark, sf_dir)
    return rounded(audit.plan_audit(m.plan, m.warehouses, m.skus, m.inventory))


def capacity_violations(spark, sf_dir):
    """The greedy plan ships all on one day: destinations above their dock capacity (D-18)."""
    m = _mm(spark, sf_dir)
    return rounded(audit.capacity_violations(m.plan, m.docks, m.skus))


def _stored_plans(m: Model) -> DataFrame:
    """The plan table after two planning runs of one day: the greedy and the balanced plan."""
    return m.plan.unionByName(P.balanced_plan(m.warehouses, m.skus, m.inventory, m.forecasts, m.start, m.h))


def plan_lookup(spark, sf_dir):
    return rounded(P.plan_lookup(_stored_plans(_mm(spark, sf_dir))))


def plan_by_manifest(spark, sf_dir):
    """The newest plan of a stored table of two, found by the manifest."""
    m = _mm(spark, sf_dir)
    root = scratch_table_path(spark, "stored-plans")
    both = _stored_plans(m)
    io.write_table(both, f"{root}/plans", partition_by=["plan_id"])
    stored = io.read_table(spark, f"{root}/plans", schemas.PLAN)
    io.write_table(io.manifest_of(stored), f"{root}/manifest", partition_by=["plan_id"])
    return rounded(io.newest_by_manifest(stored, io.read_table(spark, f"{root}/manifest", schemas.MANIFEST)))


def plan_by_id(spark, sf_dir):
    return rounded(P.plan_lookup(_stored_plans(_mm(spark, sf_dir)), "PLAN-BALANCED"))


def plan_gantt(spark, sf_dir):
    return P.plan_gantt(_mm(spark, sf_dir).plan)


def plan_summary(spark, sf_dir):
    return rounded(kpi.plan_summary(_stored_plans(_mm(spark, sf_dir))))


def cost_by_destination(spark, sf_dir):
    return rounded(kpi.cost_by_destination(_mm(spark, sf_dir).plan))


def plan_metrics(spark, sf_dir):
    m = _mm(spark, sf_dir)
    return rounded(kpi.plan_metrics(m.plan, m.skus))


def capacity_days(spark, sf_dir):
    m = _mp(spark, sf_dir)
    return rounded(P.capacity_days(m.plan, m.docks, m.skus, m.start, H))


def capacity_rule(spark, sf_dir):
    m = _mp(spark, sf_dir)
    return P.capacity_rule(m.plan, P.capacity_days(m.plan, m.docks, m.skus, m.start, H), m.skus, H)


# ---------------------------------------------------------------- kpi ----
def inventory_by_warehouse(spark, sf_dir):
    m = _m(spark, sf_dir)
    return kpi.inventory_by_warehouse(m.inventory, m.warehouses)


def capacity_usage(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rounded(kpi.capacity_usage(m.inventory, m.warehouses, m.skus))


def warehouse_kpis(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rounded(kpi.warehouse_kpis(m.inventory, m.warehouses, m.skus))


# ----------------------------------------------------------- forecast ----
def _trend(m: Model, start=None, horizon=H):
    return Fc.trend_weekly_forecast(m.daily, m.start if start is None else start, horizon)


def trend_weekly_forecast(spark, sf_dir):
    return rounded(_trend(_m(spark, sf_dir)))


def _stored_forecast(m: Model) -> DataFrame:
    """28 days from a week before the planning start."""
    return _trend(m, F.date_sub(m.start, 7), 28)


def forecast_lookup(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rounded(Fc.forecast_lookup(_stored_forecast(m), m.start, H))


def forecast_point(spark, sf_dir):
    """One (warehouse, SKU) in date order."""
    m = _m(spark, sf_dir)
    return rounded(Fc.forecast_lookup(_stored_forecast(m), m.start, H, "WH-008", "Brand#11", "trend_weekly"))


def forecast_summary(spark, sf_dir):
    return rounded(Fc.forecast_summary(_trend(_m(spark, sf_dir))))


def forecast_combined(spark, sf_dir):
    return rounded(_mm(spark, sf_dir).forecasts)


def forecast_error(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rounded(Fc.forecast_error(m.daily, m.start))


def fourier_forecast(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rounded(Fc.fourier_forecast(m.daily, m.start, H))


def bent_trend_forecast(spark, sf_dir):
    """Trend with bends and weekly terms."""
    m = _m(spark, sf_dir)
    return rounded(linear.bent_trend_forecast(m.daily, m.start, H))


def model_state(spark, sf_dir):
    """The stored sums of the seasonal model."""
    return state.weekday_sums(_m(spark, sf_dir).daily)


def forecast_from_state(spark, sf_dir):
    """The seasonal forecast from a state that grew by three parts of the history."""
    m = _mm(spark, sf_dir)
    cut = [F.date_sub(m.start, n) for n in (400, 90)]
    kept = state.merge(state.weekday_sums(m.daily.where(F.col("date") < cut[0])),
                       state.weekday_sums(m.daily.where((F.col("date") >= cut[0]) & (F.col("date") < cut[1]))))
    kept = state.merge_new(materialize(kept, "models"), m.daily)       # the days after the last one kept
    return rounded(state.forecast_from_state(kept, m.start, H))


def fourier_design_sums(spark, sf_dir):
    """The sums that the Fourier fit of each series starts from."""
    m = _m(spark, sf_dir)
    return rounded(Fc.fourier_sums(m.daily, m.start))


def tree_training_rows(spark, sf_dir):
    """Rows and sums of the trees' training and validation parts."""
    from restock.operators import ml
    return rounded(ml.training_sums(_m(spark, sf_dir).features))


def tree_training_pairs(spark, sf_dir):
    """Sums of the direct trees' pairs with their keys' means."""
    from restock.operators import ml
    return rounded(ml.pair_sums(_m(spark, sf_dir).features))


# ---------------------------------------------------------- execution ----
def transfer_outcomes(spark, sf_dir):
    return rounded(_mm(spark, sf_dir).outcomes)


def stockout_report(spark, sf_dir):
    return rounded(execution.stockout_report(_mm(spark, sf_dir).service))


def execution_summary(spark, sf_dir):
    m = _mx(spark, sf_dir)
    return rounded(execution.execution_summary(m.outcomes, m.service, m.start))


def _long(spark, sf_dir):
    m = _mx(spark, sf_dir)
    return execution.execution_long(execution.execution_summary(m.outcomes, m.service, m.start), m.outcomes, m.service)


def execution_long(spark, sf_dir):
    return rounded(_long(spark, sf_dir))


def execution_stockout_rows(spark, sf_dir):
    """One row type of the long report."""
    return rounded(execution.report_rows(_long(spark, sf_dir), "STOCKOUT"))


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and getattr(fn, "__module__", None) == __name__
           and not name.startswith("_") and name not in ("rounded", "Model")}


# ------------------------------------------------- models (rows-only) ----
def gbt_forecast(spark, sf_dir):
    from restock.operators import ml
    m = _mm(spark, sf_dir)
    return rounded(ml.gbt_forecast(materialize(m.features, "features"), m.start, H))


def tree_holdout(spark, sf_dir):
    """The direct and the recursive trees on the last 14 days of the data."""
    from restock.operators import ml
    m = _mm(spark, sf_dir)
    return rounded(ml.holdout_error(materialize(m.features, "features")))


def model_error(spark, sf_dir):
    """MAE and RMSE per series of the trend model and of the trees (I7, D-16)."""
    from restock.operators import ml
    m = _mm(spark, sf_dir)
    a = Fc.forecast_error(m.daily, m.start).withColumn("model_type", F.lit("trend_weekly"))
    b = ml.gbt_error(materialize(m.features, "features")).withColumn("model_type", F.lit("gbt"))
    return rounded(a.unionByName(b))


# A load of 1,000 units, and docks that take in a tenth: lanes are worth using, and capacity binds.
LOAD, TIGHT = 1000.0, 10


def _min_cost(spark, sf_dir):
    from restock.operators import market
    m = _mm(spark, sf_dir)
    docks = materialize(m.docks.withColumn("capacity_volume_m3", F.col("capacity_volume_m3") / TIGHT), "docks")
    return market, m, docks, market.solve(docks, m.skus, m.inventory, m.forecasts, m.start, H, load=LOAD)


def min_cost_plan(spark, sf_dir):
    """The cost-minimal plan within stock and shared dock capacity."""
    return rounded(_min_cost(spark, sf_dir)[-1].plan)


def min_cost_gap(spark, sf_dir):
    """Its cost, the lower bound of any plan's cost, and the gap."""
    market, _, docks, s = _min_cost(spark, sf_dir)
    return rounded(market.gap_report(s, docks))


def min_cost_rule(spark, sf_dir):
    """What it promises, counted."""
    market, m, docks, s = _min_cost(spark, sf_dir)
    return market.rules(s, docks, m.skus, m.start, H)


QUERIES.update(gbt_forecast=gbt_forecast, tree_holdout=tree_holdout, model_error=model_error, min_cost_plan=min_cost_plan, min_cost_gap=min_cost_gap,
               min_cost_rule=min_cost_rule)
