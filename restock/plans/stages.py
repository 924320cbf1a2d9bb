"""The four stages a user runs: ETL, forecast, optimise, score.

Each stage reads tables from folders (CSV or Parquet, a file or a folder),
runs the operators as one Spark job graph and writes its outputs, returning
the row count of every table written (counted by an ``Observation`` on the
write itself, A14).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from restock import S, schemas
from restock.operators import execution, explain, features as Fe, forecast as Fc
from restock.operators import plan as P, quality, state
from restock.session import materialize
from restock.sources import io

log = logging.getLogger(__name__)


def _p(d: str, name: str) -> str:
    return f"{d.rstrip('/')}/{name}"


def etl(spark: SparkSession, in_dir: str, out_dir: str, fmt: str = "csv") -> dict:
    """Raw tables -> daily features, inventory features, dimension copies (A1, A2, C5, E-6, C1, A8).

    Rows that cannot be read as declared go to ``quarantine``; ``rule_report``
    counts what breaks the declared keys and domains. Neither stops the stage."""
    raw, bad = io.load_checked_tables(spark, in_dir, fmt)
    io.require_tables(raw)
    quarantined = io.write_table(bad, _p(out_dir, "quarantine"), versioned=True)
    if quarantined:
        log.warning("malformed cells found: %d (see quarantine)", quarantined)
    orphans = quality.integrity_report(raw["sales_history"], raw["inventory_snapshot"],
                                       raw["warehouses"], raw["skus"])
    out = {"quarantine": quarantined, "integrity_report": io.write_table(orphans, _p(out_dir, "integrity_report"), versioned=True),
           "rule_report": io.write_table(quality.rule_report(raw), _p(out_dir, "rule_report"), versioned=True)}
    if out["integrity_report"]:
        log.warning("orphan keys found: %d (see integrity_report)", out["integrity_report"])
    daily = Fe.rolling_features(Fe.daily_sales(raw["sales_history"]))
    out["daily_sales_aggregated"] = io.write_table(daily, _p(out_dir, "daily_sales_aggregated"), cluster_by=list(S), sort_by=["date"])
    inv = Fe.inventory_features(raw["inventory_snapshot"], raw["skus"])
    out["inventory_snapshot"] = io.write_table(inv, _p(out_dir, "inventory_snapshot"), versioned=True)
    # the reader gives a file without ``source_ord`` its row order
    for name in ("warehouses", "skus", "inbound_pos"):
        if name in raw:
            out[name] = io.copy_table(raw[name], _p(out_dir, name), versioned=True)
    return out


def forecast(spark: SparkSession, processed_dir: str, out_dir: str, start_date,
             horizon: int = 14, fallback: str = "trees", refit: bool = False) -> dict:
    """Daily features -> forecasts + registry + model state.

    The seasonal model lives in the table ``model_state``: a run adds the days
    after its last one and forecasts from it, unless ``refit`` starts it anew
    (after corrections of days it has seen). Seasonal where it has rows; for the other series the boosted
    trees (``fallback="trees"``), and the flat mean where those cannot be
    trained (no series of 30 rows) or with ``fallback="flat"``.
    """
    daily = io.read_table(spark, _p(processed_dir, "daily_sales_aggregated"))
    registry = materialize(Fe.series_registry(daily), "registry")
    kept = None if refit else io.read_optional(spark, _p(out_dir, "model_state"), state.weekday_sums(daily).schema)
    sums = state.weekday_sums(daily) if kept is None else state.merge_new(kept, daily)
    n_state = io.write_table(sums, _p(out_dir, "model_state"), versioned=True)
    fc = state.forecast_from_state(io.read_table(spark, _p(out_dir, "model_state")), start_date, horizon)
    short = registry.where("not seasonal_eligible")
    if fallback == "trees" and not short.isEmpty() and not registry.where("trees_eligible").isEmpty():
        from restock.operators import ml
        fc = fc.unionByName(ml.gbt_forecast(daily, start_date, horizon, only=short))
    fc = Fc.combine_forecasts(fc, Fc.flat_forecast(daily, start_date, horizon))
    return {"forecasts": io.write_table(fc, _p(out_dir, "forecasts"), versioned=True),
            "models": io.write_table(registry, _p(out_dir, "models"), versioned=True), "model_state": n_state}


def optimize(spark: SparkSession, processed_dir: str, forecasts_path: str, out_dir: str,
             start_date, horizon: int = 14, method: str = "greedy",
             plan_id: str | None = None) -> dict:
    """Inventory + forecasts -> explained plan and its ship days within capacity,
    both by plan id; earlier plans stay (A4-A7, J3-J5)."""
    wh = io.read_table(spark, _p(processed_dir, "warehouses"), schemas.WAREHOUSES)
    sk = io.read_table(spark, _p(processed_dir, "skus"), schemas.SKUS)
    inv = io.read_table(spark, _p(processed_dir, "inventory_snapshot"), schemas.INVENTORY_SNAPSHOT)
    fcs = io.read_optional(spark, forecasts_path, schemas.FORECASTS)
    plan = materialize(P.plan_with_method(method, wh, sk, inv, fcs, start_date, horizon,
                                          plan_id=plan_id or P.new_plan_id()), "plan")
    days = P.capacity_days(plan, wh, sk, start_date, horizon)
    return {"plans": io.write_table(explain.plan_explained(plan, wh, sk, inv, fcs),
                                    _p(out_dir, "plans"), partition_by=["plan_id"]),
            "plans_manifest": io.write_table(io.manifest_of(plan), _p(out_dir, "plans_manifest"), partition_by=["plan_id"]),
            "ship_days": io.write_table(days, _p(out_dir, "ship_days"), partition_by=["plan_id"])}


def simulate(spark: SparkSession, plans_dir: str, processed_dir: str, forecasts_path: str,
             out_dir: str, run_date, plan_id: str | None = None,
             lead_times: DataFrame | None = None, demand: DataFrame | None = None) -> dict:
    """Score one plan (the newest when no id is given): outcomes, stockouts,
    summary and the long report, all by plan id (K1-K3, G4, A10).

    Realised lead times and demands are tables; without them transfers arrive
    as planned and demand is what was forecast.
    """
    plans = io.read_table(spark, plans_dir, schemas.PLAN)
    manifest = io.read_optional(spark, f"{plans_dir.rstrip('/')}_manifest", schemas.MANIFEST)
    if plan_id is None and manifest.head(1):
        plan = io.newest_by_manifest(plans, manifest)
    else:
        plan = P.plan_lookup(plans, plan_id)
    plan = materialize(plan, "plan")
    wh = io.read_table(spark, _p(processed_dir, "warehouses"), schemas.WAREHOUSES)
    sk = io.read_table(spark, _p(processed_dir, "skus"), schemas.SKUS)
    inv = io.read_table(spark, _p(processed_dir, "inventory_snapshot"), schemas.INVENTORY_SNAPSHOT)
    if lead_times is None:
        lead_times = spark.createDataFrame([], "warehouse_id string, sku_id string, actual_lead_time int")
    if demand is None:
        fcs = io.read_optional(spark, forecasts_path, schemas.FORECASTS)
        demand = P.cell_demand(fcs).withColumnRenamed("demand", "actual_demand")
    outcomes = materialize(execution.transfer_outcomes(plan, wh, sk, lead_times), "outcomes")
    service = materialize(execution.cell_service(outcomes, inv, demand), "service")
    summary = execution.execution_summary(outcomes, service, run_date)
    report = execution.execution_long(summary, outcomes, service)
    return {"simulation": io.write_table(report, _p(out_dir, "simulation"), partition_by=["plan_id", "type"]),
            "transfers": io.write_table(outcomes, _p(out_dir, "transfers"), partition_by=["transfer_id"]),
            "stockouts": io.write_table(execution.stockout_report(service), _p(out_dir, "stockouts"),
                                        partition_by=["plan_id"])}
