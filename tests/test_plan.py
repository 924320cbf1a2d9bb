"""The plans against a plain statement of their rules (J1-J3, B11, C11, E-7)."""
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from restock import schemas
from restock.operators import audit, plan as P

START = "2024-01-01"


def wh_df(spark, n):
    rows = [(f"W{i:02d}", f"n{i}", None, 10.0 + i, -100.0 + 2 * i, 1000.0, None, 1 + i % 3, None,
             0.01, 20.0 + i, None, None, None, i) for i in range(n)]
    return spark.createDataFrame(rows, schemas.WAREHOUSES)


def sku_df(spark, ttls):
    rows = [(f"S{k}", f"S{k}", "c", 0.01, 1.0, 5.0, ttl, k % 2 == 0, 3 + k % 5)
            for k, ttl in enumerate(ttls)]
    return spark.createDataFrame(rows, schemas.SKUS)


def expected_plan(whs, skus, inv, dem, horizon):
    """The rule as a statement about sets: a cell is needy if its stock is below
    its safety stock; the sources that may serve it are the other warehouses
    that hold at least the need; the plan takes the first of them in order."""
    sku = {s["id"]: s for s in skus}
    rank = {w["id"]: i for i, w in enumerate(whs)}
    cell = {(w["id"], s): {"stock": inv.get((w["id"], s), 0), "demand": dem.get((w["id"], s), 0.0), "lead": w["lead"]}
            for w in whs for s in sku}
    safety = {k: c["demand"] * sku[k[1]]["ssd"] / horizon for k, c in cell.items()}
    needy = {k: int(safety[k] - c["stock"] + c["demand"]) for k, c in cell.items() if c["stock"] < safety[k]}
    lasting = {k: n for k, n in needy.items() if sku[k[1]]["ttl"] is None or cell[k]["lead"] <= sku[k[1]]["ttl"]}
    able = {k: [w for w in rank if w != k[0] and cell[w, k[1]]["stock"] >= n] for k, n in lasting.items()}
    return sorted((min(ws, key=rank.get), *k, lasting[k]) for k, ws in able.items() if ws)


@pytest.mark.parametrize("seed", range(8))
def test_greedy_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    nw, ns = rnd.randint(2, 7), rnd.randint(1, 4)
    ttls = [rnd.choice([None, 1, 2, 5]) for _ in range(ns)]
    whs = [{"id": f"W{i:02d}", "lead": 1 + i % 3} for i in range(nw)]
    skus = [{"id": f"S{k}", "ttl": t, "ssd": 3 + k % 5} for k, t in enumerate(ttls)]
    inv, dem = {}, {}
    for w in whs:
        for s in skus:
            if rnd.random() < 0.7:
                inv[(w["id"], s["id"])] = rnd.choice([0, 1, 5, 20, 40, 80, 200])
            if rnd.random() < 0.7:
                dem[(w["id"], s["id"])] = rnd.choice([0.2, 3.0, 14.0, 30.5, 70.0, 150.0])
    d0 = dt.date(2023, 12, 31)
    inv_df = spark.createDataFrame([(d0, w, s, q, 0, q) for (w, s), q in inv.items()],
                                   schemas.INVENTORY_SNAPSHOT)
    dem_df = spark.createDataFrame([(w, s, f) for (w, s), f in dem.items()],
                                   "warehouse_id string, sku_id string, forecast double")
    plan = P.greedy_plan(wh_df(spark, nw), sku_df(spark, ttls), inv_df, dem_df, START, 14)
    got = sorted((r.from_wh, r.to_wh, r.sku_id, r.qty) for r in plan.collect())
    assert got == expected_plan(whs, skus, inv, dem, 14)

    # the balanced plan: nobody gives away more than it can spare or gets more than it lacks
    bal = P.balanced_plan(wh_df(spark, nw), sku_df(spark, ttls), inv_df, dem_df, START, 14).collect()
    given, taken = {}, {}
    for r in bal:
        assert r.qty > 0 and r.from_wh != r.to_wh
        given[r.from_wh, r.sku_id] = given.get((r.from_wh, r.sku_id), 0) + r.qty
        taken[r.to_wh, r.sku_id] = taken.get((r.to_wh, r.sku_id), 0) + r.qty
    need = {(r.warehouse_id, r.sku_id): r.needed_qty for r in P.replenishment_need(
        P.cells(wh_df(spark, nw), sku_df(spark, ttls), inv_df, dem_df, 14)).where("not ttl_blocked").collect()}
    spare = {(r.warehouse_id, r.sku_id): math.floor(r.current_stock - r.safety_stock)
             for r in P.cells(wh_df(spark, nw), sku_df(spark, ttls), inv_df, dem_df, 14).collect()}
    assert all(n <= spare[k] for k, n in given.items()) and all(n <= need[k] for k, n in taken.items())
    for s in {k[1] for k in need}:                  # all that can be moved is moved
        lack = sum(n for k, n in need.items() if k[1] == s)
        have = sum(max(n, 0) for k, n in spare.items() if k[1] == s)
        assert sum(n for k, n in taken.items() if k[1] == s) == min(lack, have)


def test_trigger_is_strict_and_small_need_emits_zero(spark):
    d0 = dt.date(2023, 12, 31)
    whs = wh_df(spark, 3)
    skus = sku_df(spark, [None])           # safety_stock_days = 3
    # Stock 3 = safety (14 * 3 / 14) -> no trigger
    # Demand 0.3, safety 0.064, stock 0 -> need int(0.364) = 0, still emitted
    inv = spark.createDataFrame([(d0, "W00", "S0", 3, 0, 3), (d0, "W02", "S0", 9, 0, 9)],
                                schemas.INVENTORY_SNAPSHOT)
    dem = spark.createDataFrame([("W00", "S0", 14.0), ("W01", "S0", 0.3)],
                                "warehouse_id string, sku_id string, forecast double")
    rows = P.greedy_plan(whs, skus, inv, dem, START, 14).collect()
    assert [(r.from_wh, r.to_wh, r.qty) for r in rows] == [("W00", "W01", 0)]


def test_ttl_blocked_cell_gets_no_transfer(spark):
    d0 = dt.date(2023, 12, 31)
    whs = wh_df(spark, 3)                  # W02 lead time 3
    skus = sku_df(spark, [1])              # ttl 1 day
    inv = spark.createDataFrame([(d0, "W00", "S0", 500, 0, 500)], schemas.INVENTORY_SNAPSHOT)
    dem = spark.createDataFrame([("W02", "S0", 50.0), ("W00", "S0", 1.0)],
                                "warehouse_id string, sku_id string, forecast double")
    plan = P.greedy_plan(whs, skus, inv, dem, START, 14)
    assert plan.count() == 0
    assert audit.ttl_violations(plan, whs, skus).count() == 0


def test_greedy_plan_has_no_cross_join(spark, capsys):
    d0 = dt.date(2023, 12, 31)
    inv = spark.createDataFrame([(d0, "W00", "S0", 5, 0, 5)], schemas.INVENTORY_SNAPSHOT)
    dem = spark.createDataFrame([("W01", "S0", 50.0)],
                                "warehouse_id string, sku_id string, forecast double")
    P.greedy_plan(wh_df(spark, 2), sku_df(spark, [None]), inv, dem, START, 14).explain()
    out = capsys.readouterr().out
    assert "CartesianProduct" not in out and "NestedLoopJoin" not in out


def test_capacity_days_splits_and_respects_capacity(spark):
    skus = sku_df(spark, [None])   # 0.01 m3 per unit
    whs = wh_df(spark, 2)          # capacity 1000 m3
    plan = spark.createDataFrame(
        [("P", dt.date(2024, 1, 1), "W00", "W01", "S0", q, dt.date(2024, 1, 1),
          dt.date(2024, 1, 2), "Medium", None, float(i), "X")
         for i, q in enumerate([60000, 70001, 30000, 90000])], schemas.PLAN)
    for horizon in (14, 2):
        d = P.capacity_days(plan, whs, skus, START, horizon).toPandas()
        per_row = d.groupby("qty").units.sum()
        assert (per_row.index == per_row.values).all()          # pieces add up
        placed = d[~d.shortfall]
        per_day = placed.groupby("day_offset").volume_m3.sum()
        assert (per_day <= 1000.0 + 1e-9).all()                  # capacity holds
        assert placed.day_offset.max() < horizon
        assert d.day_offset.nunique() > 1                        # rows were split
    # 2500 m3 in total: with two days the rest is shortfall
    assert d[d.shortfall].units.sum() > 0


def _transfers(spark, rows):
    return spark.createDataFrame(
        [("P", dt.date(2024, 1, 1), "W00", to, sku, q, dt.date(2024, 1, 1), dt.date(2024, 1, 2), "Medium", None, float(i), "X")
         for i, (to, sku, q) in enumerate(rows)], schemas.PLAN)


def test_capacity_days_places_whatever_fits(spark):
    vol = {"A": 1.0, "B": 40.0, "N": None, "Z": 0.0}
    skus = spark.createDataFrame([(k, k, "c", v, 1.0, 5.0, None, False, 3) for k, v in vol.items()], schemas.SKUS)

    def days(cap, rows, horizon=14):
        whs = spark.createDataFrame([("W01", "n", None, 1.0, 1.0, cap, None, 1, None, 0.1, 1.0, None, None, None, 1)],
                                    schemas.WAREHOUSES)
        plan = _transfers(spark, [("W01", s, q) for s, q in rows])
        d = P.capacity_days(plan, whs, skus, START, horizon)
        rule = P.capacity_rule(plan, d, skus, horizon).first()
        assert rule.planned_units == rule.accounted_units
        assert rule.broken_transfers == rule.days_over == rule.left_but_fitting == 0
        return d.toPandas()
    d = days(1.5, [("A", 3)])
    assert not d.shortfall.any() and (d.units == 1).all() and len(d) == 3
    d = days(100.0, [("A", 280), ("B", 1)])
    assert not d.shortfall.any() and d.day_offset.max() == 3
    d = days(100.0, [("N", 7), ("Z", 9), ("A", 0)])
    assert sorted(zip(d.sku_id, d.units, d.day_offset)) == [("A", 0, 0), ("N", 7, 0), ("Z", 9, 0)]
    d = days(0.5, [("A", 3)])
    assert d.shortfall.all() and d.units.sum() == 3
    assert not days(None, [("B", 1000)]).shortfall.any()
    r = random.Random(3)
    for _ in range(4):
        days(r.choice([10.0, 41.0, 90.5]), [(r.choice("AB"), r.randint(0, 60)) for _ in range(6)], r.choice([1, 3, 14]))


def test_plan_size_does_not_depend_on_the_units(spark):
    """Ten or a hundred times the units: the same cells are served (stock and demand grow together)."""
    from restock.plans import catalog
    m = catalog.Model(spark, "/root/testdata/sf0.01")
    daily = m.daily.persist()
    sizes = []
    for k in (1, 10, 100):
        big = catalog.Model(spark, "/root/testdata/sf0.01")
        big.__dict__["daily"] = daily.withColumn("quantity_sold", F.col("quantity_sold") * k)
        sizes.append(big.plan.count())
    assert sizes[0] > 100 and max(sizes) <= 1.1 * min(sizes)


def test_cluster_conf_scales_partitions():
    from restock.session import cluster_conf
    assert cluster_conf(8000)["spark.sql.shuffle.partitions"] == "64000"
    assert cluster_conf(4)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(8)["spark.sql.adaptive.enabled"] == "true"
