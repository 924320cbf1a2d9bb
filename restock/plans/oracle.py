"""DuckDB SQL twins of the catalog queries (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver's
tables (pre-registered views). Where the Spark plan avoids a cross join,
the SQL twin uses the literal grid / all-pairs form, so a match also checks
that the rewrite is exact.

Engine spellings: DuckDB ``//`` is integer division; a double goes to an
integer through ``trunc`` (a plain cast rounds); Monday = ``isodow - 1``.
"""

from __future__ import annotations

import math

from restock import schemas

START = "(SELECT CAST(max(l_shipdate) AS DATE) + 1 FROM lineitem)"

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, list(deps))


def with_(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + body


def hav(lat1, lon1, lat2, lon2) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"(6371.0 * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


def whid(n: str) -> str:
    return f"('WH-' || lpad(CAST({n} + 1 AS VARCHAR), 3, '0'))"


def transport(km, qty, vol, wt, rate="1.5") -> str:
    return (f"({km} * {rate} + 100.0 + {qty} * {vol} * 0.1::DOUBLE"
            f" + {qty} * {wt} * 0.001::DOUBLE)")


def waste_cost(q, uc, ttl, days) -> str:
    return (f"(CASE WHEN {ttl} IS NULL THEN 0.0 WHEN {days} > {ttl} THEN {q} * {uc} "
            f"WHEN {days} > {ttl} * 0.8::DOUBLE THEN {q} * (({days} - {ttl} * 0.8::DOUBLE) / "
            f"({ttl} * 0.2::DOUBLE)) * {uc} ELSE 0.0 END)")


def waste_units(q, ttl, days) -> str:
    return (f"(CASE WHEN {ttl} IS NULL THEN CAST(0 AS BIGINT) WHEN {days} > {ttl} THEN "
            f"CAST({q} AS BIGINT) WHEN {days} > {ttl} * 0.8::DOUBLE THEN CAST(trunc({q} * "
            f"(({days} - {ttl} * 0.8::DOUBLE) / ({ttl} * 0.2::DOUBLE))) AS BIGINT) "
            f"ELSE CAST(0 AS BIGINT) END)")


# ------------------------------------------------------------ model ------
cte("wh", f"""
  SELECT {whid('n_nationkey')} AS warehouse_id, n_name AS name,
         CAST(25 + (n_nationkey * 7) % 24 AS DOUBLE) AS latitude,
         CAST(-120 + (n_nationkey * 11) % 50 AS DOUBLE) AS longitude,
         CAST(5000 + (n_nationkey * 601) % 15000 AS DOUBLE) AS capacity_volume_m3,
         CAST(1 + n_nationkey % 3 AS INTEGER) AS lead_time_days,
         CAST(1 + n_nationkey % 5 AS DOUBLE) / 100 AS holding_cost_per_unit_per_day,
         CAST(10 + (n_nationkey * 13) % 41 AS DOUBLE) AS stockout_cost_per_unit,
         CAST(n_nationkey AS INTEGER) AS source_ord
  FROM nation""")
cte("skb", """
  SELECT p_brand AS sku_id, min(p_type) AS category, min(p_retailprice) AS unit_cost,
         CAST(substr(p_brand, 7) AS INTEGER) AS b
  FROM part GROUP BY p_brand""")
cte("sku", """
  SELECT sku_id, category,
         CAST(2 + 4 * b AS DOUBLE) / 1000 AS volume_m3_per_unit,
         CAST(1 + 4 * b AS DOUBLE) / 10 AS weight_kg_per_unit,
         CAST(unit_cost AS DOUBLE) AS unit_cost,
         CAST(CASE WHEN b % 5 = 0 THEN b // 5 WHEN b % 5 = 1 THEN b + 4 END AS INTEGER)
           AS perishability_ttl_days,
         (b % 10 = 0) AS requires_refrigerated,
         CAST(3 + b % 11 AS INTEGER) AS safety_stock_days, b
  FROM skb""", "skb")
cte("lines", f"""
  SELECT CAST(l_shipdate AS DATE) AS date, {whid('s_nationkey')} AS warehouse_id,
         p_brand AS sku_id, CAST(trunc(l_quantity) AS BIGINT) AS quantity_sold,
         l_extendedprice * (1 - l_discount) AS revenue, l_returnflag = 'R' AS returned
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""")
cte("daily", """
  SELECT date, warehouse_id, sku_id, CAST(sum(quantity_sold) AS BIGINT) AS quantity_sold,
         sum(revenue) AS revenue
  FROM lines WHERE date IS NOT NULL AND warehouse_id IS NOT NULL AND sku_id IS NOT NULL
  GROUP BY date, warehouse_id, sku_id""", "lines")
cte("feat", """
  SELECT date, warehouse_id, sku_id, quantity_sold, revenue,
    avg(quantity_sold) OVER w7 AS rolling_7d_mean,
    coalesce(stddev_samp(quantity_sold) OVER w7, 0.0) AS rolling_7d_std,
    avg(quantity_sold) OVER w28 AS rolling_28d_mean,
    coalesce(stddev_samp(quantity_sold) OVER w28, 0.0) AS rolling_28d_std,
    lag(quantity_sold, 1, 0) OVER wo AS lag_1d,
    lag(quantity_sold, 7, 0) OVER wo AS lag_7d,
    lag(quantity_sold, 28, 0) OVER wo AS lag_28d,
    CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
    CAST(dayofmonth(date) AS INTEGER) AS day_of_month,
    CAST(month(date) AS INTEGER) AS month,
    CAST(isodow(date) - 1 >= 5 AS INTEGER) AS is_weekend,
    CAST(month(date) IN (11, 12) AS INTEGER) AS is_holiday_season,
    CAST(month(date) IN (6, 7, 8) AS INTEGER) AS is_summer,
    coalesce(CAST(quantity_sold > avg(quantity_sold) OVER ws
                  + 2 * stddev_samp(quantity_sold) OVER ws AS INTEGER), 0) AS is_promotion
  FROM daily
  WINDOW wo AS (PARTITION BY warehouse_id, sku_id ORDER BY date),
         w7 AS (PARTITION BY warehouse_id, sku_id ORDER BY date
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w28 AS (PARTITION BY warehouse_id, sku_id ORDER BY date
                 ROWS BETWEEN 27 PRECEDING AND CURRENT ROW),
         ws AS (PARTITION BY warehouse_id, sku_id)""", "daily")
cte("recent", """
  SELECT warehouse_id, sku_id, max(date) AS snapshot_date, CAST(sum(quantity_sold) AS BIGINT) AS units,
         avg(quantity_sold) AS mean
  FROM (SELECT *, row_number() OVER (PARTITION BY warehouse_id, sku_id ORDER BY date DESC) AS n FROM daily) x
  WHERE n <= 28 GROUP BY 1, 2""", "daily")
cte("inv", """
  SELECT snapshot_date, warehouse_id, sku_id,
         units * ((37 * (CAST(substr(warehouse_id, 4) AS BIGINT) - 1)
                   + 53 * CAST(regexp_extract(sku_id, '[0-9]+$') AS BIGINT)) % 120) // 100 AS quantity_available
  FROM recent""", "recent")
cte("dem", """
  SELECT warehouse_id, sku_id, sum(forecast) AS forecast FROM fc GROUP BY warehouse_id, sku_id""", "fc")
cte("grid", """
  SELECT w.warehouse_id, w.source_ord, w.lead_time_days, w.stockout_cost_per_unit,
         w.latitude, w.longitude, w.capacity_volume_m3,
         s.sku_id, s.safety_stock_days, s.perishability_ttl_days, s.requires_refrigerated,
         s.volume_m3_per_unit, s.weight_kg_per_unit, s.unit_cost
  FROM wh w CROSS JOIN sku s""", "wh", "sku")
cte("cellsall", """
  SELECT g.*, coalesce(i.quantity_available, 0) AS current_stock,
         coalesce(d.forecast, 0.0) AS demand,
         coalesce(d.forecast, 0.0) * g.safety_stock_days / 14 AS safety_stock,
         (i.warehouse_id IS NOT NULL OR d.warehouse_id IS NOT NULL) AS active
  FROM grid g
  LEFT JOIN inv i ON i.warehouse_id = g.warehouse_id AND i.sku_id = g.sku_id
  LEFT JOIN dem d ON d.warehouse_id = g.warehouse_id AND d.sku_id = g.sku_id""",
    "grid", "inv", "dem")
cte("need", """
  SELECT *, CAST(trunc(safety_stock - current_stock + demand) AS BIGINT) AS needed_qty,
         coalesce(perishability_ttl_days IS NOT NULL
                  AND lead_time_days > perishability_ttl_days, false) AS ttl_blocked
  FROM cellsall WHERE current_stock < safety_stock""", "cellsall")
cte("chosen", """
  SELECT * FROM (
    SELECT n.*, s.warehouse_id AS from_wh, s.latitude AS flat, s.longitude AS flon,
           row_number() OVER (PARTITION BY n.warehouse_id, n.sku_id ORDER BY s.source_ord) AS rk
    FROM need n JOIN wh s ON s.warehouse_id <> n.warehouse_id
    LEFT JOIN inv si ON si.warehouse_id = s.warehouse_id AND si.sku_id = n.sku_id
    WHERE coalesce(si.quantity_available, 0) >= n.needed_qty AND NOT n.ttl_blocked) x
  WHERE rk = 1""", "need", "wh", "inv")
cte("plan", f"""
  SELECT 'PLAN-GREEDY' AS plan_id, {START} AS run_date, from_wh, warehouse_id AS to_wh, sku_id,
         needed_qty AS qty, {START} AS ship_date,
         CAST({START} + lead_time_days AS DATE) AS expected_arrival,
         CASE WHEN coalesce(requires_refrigerated, false) THEN 'Refrigerated' ELSE 'Medium' END
           AS truck_type,
         CAST(NULL AS VARCHAR) AS driver_id,
         {transport(hav('flat', 'flon', 'latitude', 'longitude'), 'needed_qty',
                    'volume_m3_per_unit', 'weight_kg_per_unit')} AS estimated_cost,
         'GREEDY_HEURISTIC' AS reason_code
  FROM chosen""", "chosen")
cte("leadt", """
  SELECT i.warehouse_id, i.sku_id,
         CAST(1 + w.source_ord % 3 + (5 * CAST(substr(i.sku_id, 7) AS INTEGER)
              + 7 * w.source_ord) % 24 AS INTEGER) AS actual_lead_time
  FROM inv i JOIN wh w ON w.warehouse_id = i.warehouse_id""", "inv", "wh")
cte("actdem", """
  SELECT d.warehouse_id, d.sku_id,
         d.forecast * CAST(5 + (3 * CAST(substr(d.sku_id, 7) AS INTEGER) + w.source_ord) % 11
                           AS DOUBLE) / 10 AS actual_demand
  FROM dem d JOIN wh w ON w.warehouse_id = d.warehouse_id""", "dem", "wh")
cte("ship", f"""
  SELECT {whid('s_nationkey')} AS from_wh, {whid('c_nationkey')} AS to_wh, p_brand AS sku_id,
         CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS units,
         count(*) AS n_lines
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3""")
cte("lanes", f"""
  SELECT s.*, {hav('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} AS km
  FROM ship s JOIN wh a ON a.warehouse_id = s.from_wh JOIN wh b ON b.warehouse_id = s.to_wh
  WHERE s.from_wh <> s.to_wh""", "ship", "wh")
cte("outc", f"""
  SELECT p.plan_id AS transfer_id, p.from_wh, p.to_wh, p.sku_id, p.qty AS planned_qty,
         p.qty - {waste_units('p.qty', 's.perishability_ttl_days', 'l.actual_lead_time')}
           AS actual_qty_received,
         {waste_units('p.qty', 's.perishability_ttl_days', 'l.actual_lead_time')} AS waste_qty,
         p.expected_arrival AS planned_arrival,
         CAST(p.ship_date + l.actual_lead_time AS DATE) AS actual_arrival,
         w.lead_time_days AS planned_lead_time, l.actual_lead_time,
         coalesce(p.estimated_cost, 0.0) AS transport_cost,
         {waste_units('p.qty', 's.perishability_ttl_days', 'l.actual_lead_time')} * s.unit_cost
           AS waste_cost
  FROM (SELECT p.*, coalesce(l.actual_lead_time, w.lead_time_days) AS actual_lead_time
        FROM plan p JOIN wh w ON w.warehouse_id = p.to_wh
        LEFT JOIN leadt l ON l.warehouse_id = p.to_wh AND l.sku_id = p.sku_id) l
  JOIN plan p ON p.to_wh = l.to_wh AND p.sku_id = l.sku_id AND p.from_wh = l.from_wh
  JOIN sku s ON s.sku_id = p.sku_id JOIN wh w ON w.warehouse_id = p.to_wh""",
    "plan", "leadt", "sku", "wh")
cte("serv", """
  SELECT r.plan_id, r.warehouse_id, r.sku_id, coalesce(a.actual_demand, 0.0) AS demand,
         CAST(coalesce(i.quantity_available, 0) + r.received AS DOUBLE) AS available_stock
  FROM (SELECT transfer_id AS plan_id, to_wh AS warehouse_id, sku_id,
               sum(actual_qty_received) AS received
        FROM outc GROUP BY 1, 2, 3) r
  LEFT JOIN inv i ON i.warehouse_id = r.warehouse_id AND i.sku_id = r.sku_id
  LEFT JOIN actdem a ON a.warehouse_id = r.warehouse_id AND a.sku_id = r.sku_id""",
    "outc", "inv", "actdem")
cte("serv2", """
  SELECT *, greatest(0.0, demand - available_stock) AS stockout_qty,
         least(demand, available_stock) AS fulfilled_qty,
         CASE WHEN demand > 0 THEN least(demand, available_stock) / demand ELSE 1.0 END
           AS service_level
  FROM serv""", "serv")
cte("summ", f"""
  SELECT {START} AS simulation_date, t.plan_id, t.total_transfers, t.total_transport_cost,
         t.total_waste_cost, t.total_cost, t.total_waste_units,
         coalesce(CASE WHEN s.total_demand = 0 THEN NULL
                       ELSE s.total_fulfilled / s.total_demand END, 1.0) AS overall_service_level,
         coalesce(s.total_stockouts, 0) AS total_stockouts,
         coalesce(s.total_demand, 0.0) AS total_demand,
         coalesce(s.total_fulfilled, 0.0) AS total_fulfilled
  FROM (SELECT transfer_id AS plan_id, count(*) AS total_transfers,
               sum(transport_cost) AS total_transport_cost, sum(waste_cost) AS total_waste_cost,
               sum(transport_cost + waste_cost) AS total_cost,
               CAST(sum(waste_qty) AS BIGINT) AS total_waste_units
        FROM outc GROUP BY 1) t
  LEFT JOIN (SELECT plan_id, sum(demand) AS total_demand, sum(fulfilled_qty) AS total_fulfilled,
                    count(*) FILTER (WHERE stockout_qty > 0) AS total_stockouts
             FROM serv2 GROUP BY 1) s ON s.plan_id = t.plan_id""", "outc", "serv2")
cte("spare", """
  SELECT *, sum(units) OVER (PARTITION BY sku_id ORDER BY source_ord) AS hi FROM (
    SELECT sku_id, warehouse_id, source_ord, latitude, longitude,
           CAST(floor(current_stock - safety_stock) AS BIGINT) AS units FROM cellsall) x WHERE units > 0""", "cellsall")
cte("lack", """
  SELECT *, sum(needed_qty) OVER (PARTITION BY sku_id ORDER BY source_ord) AS hi
  FROM need WHERE NOT ttl_blocked AND needed_qty > 0""", "need")
cte("balanced", f"""
  SELECT 'PLAN-BALANCED' AS plan_id, {START} AS run_date, from_wh, to_wh, sku_id, qty, {START} AS ship_date,
         CAST({START} + lead_time_days AS DATE) AS expected_arrival,
         CASE WHEN coalesce(requires_refrigerated, false) THEN 'Refrigerated' ELSE 'Medium' END AS truck_type,
         CAST(NULL AS VARCHAR) AS driver_id,
         {transport(hav('flat', 'flon', 'latitude', 'longitude'), 'qty', 'volume_m3_per_unit',
                    'weight_kg_per_unit')} AS estimated_cost,
         'STOCK_BALANCED' AS reason_code
  FROM (SELECT d.*, s.warehouse_id AS from_wh, d.warehouse_id AS to_wh, s.latitude AS flat, s.longitude AS flon,
               CAST(least(s.hi, d.hi) - greatest(s.hi - s.units, d.hi - d.needed_qty) AS BIGINT) AS qty
        FROM spare s JOIN lack d ON s.sku_id = d.sku_id
         AND s.hi > d.hi - d.needed_qty AND d.hi > s.hi - s.units) x""", "spare", "lack")
cte("docks", """
  SELECT w.* REPLACE (coalesce(v.cap, 0.0) AS capacity_volume_m3)
  FROM wh w LEFT JOIN (SELECT i.warehouse_id, round(sum(i.quantity_available * s.volume_m3_per_unit) / 50, 4) AS cap
                       FROM inv i JOIN sku s ON s.sku_id = i.sku_id GROUP BY 1) v ON v.warehouse_id = w.warehouse_id""",
    "wh", "inv", "sku")
cte("twoplans", "SELECT * FROM plan UNION ALL SELECT * FROM balanced", "plan", "balanced")


def fit_sql(train_pred: str = "TRUE", start: str = START, min_rows: int = 14,
            src: str = "daily") -> str:
    """Per-series trend + weekday fit as SQL pieces (model, effects, sigma)."""
    return f"""
  base AS (SELECT warehouse_id, sku_id, date, CAST(quantity_sold AS DOUBLE) AS y,
                  CAST(date_diff('day', {start}, date) AS DOUBLE) AS t,
                  CAST(isodow(date) - 1 AS INTEGER) AS dow, ({train_pred}) AS fit_row
           FROM {src}),
  coef AS (SELECT warehouse_id, sku_id,
                  regr_slope(y, t) FILTER (WHERE fit_row) AS slope,
                  regr_intercept(y, t) FILTER (WHERE fit_row) AS intercept,
                  count(*) FILTER (WHERE fit_row) AS n_fit
           FROM base GROUP BY 1, 2 HAVING count(*) FILTER (WHERE fit_row) >= {min_rows}),
  res AS (SELECT b.*, c.slope, c.intercept, b.y - (c.intercept + c.slope * b.t) AS r
          FROM base b JOIN coef c USING (warehouse_id, sku_id)),
  eff AS (SELECT warehouse_id, sku_id, dow, avg(r) FILTER (WHERE fit_row) AS dow_effect
          FROM res GROUP BY 1, 2, 3),
  sig AS (SELECT warehouse_id, sku_id,
                 coalesce(stddev_samp(r - e.dow_effect) FILTER (WHERE fit_row), 0.0) AS sigma
          FROM res JOIN eff e USING (warehouse_id, sku_id, dow) GROUP BY 1, 2)"""


def trend_sql(start: str = START, horizon: int = 14, min_rows: int = 14) -> str:
    """Full trend + weekly forecast as a SELECT (usable as a sub-query)."""
    return f"""
  SELECT f.date, f.warehouse_id, f.sku_id,
         greatest(f.yhat, 0.0) AS forecast,
         greatest(f.yhat - 1.96 * f.sigma, 0.0) AS lower,
         greatest(f.yhat + 1.96 * f.sigma, 0.0) AS upper,
         'trend_weekly' AS model_type
  FROM (SELECT CAST(d.date AS DATE) AS date, c.warehouse_id, c.sku_id, s.sigma,
               c.intercept + c.slope * CAST(date_diff('day', {start}, CAST(d.date AS DATE)) AS DOUBLE)
                 + coalesce(e.dow_effect, 0.0) AS yhat
        FROM coef c JOIN sig s USING (warehouse_id, sku_id)
        CROSS JOIN (SELECT CAST({start} + CAST(i AS INTEGER) AS DATE) AS date FROM range({horizon}) r(i)) d
        LEFT JOIN eff e ON e.warehouse_id = c.warehouse_id AND e.sku_id = c.sku_id
             AND e.dow = CAST(isodow(CAST(d.date AS DATE)) - 1 AS INTEGER)) f"""


cte("base", f"""SELECT warehouse_id, sku_id, date, CAST(quantity_sold AS DOUBLE) AS y,
    CAST(date_diff('day', {START}, date) AS DOUBLE) AS t, CAST(isodow(date) - 1 AS INTEGER) AS dow FROM daily""", "daily")
cte("coef", """SELECT warehouse_id, sku_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept
    FROM base GROUP BY 1, 2 HAVING count(*) >= 14""", "base")
cte("res", """SELECT b.*, b.y - (c.intercept + c.slope * b.t) AS r FROM base b JOIN coef c USING (warehouse_id, sku_id)""",
    "base", "coef")
cte("eff", "SELECT warehouse_id, sku_id, dow, avg(r) AS dow_effect FROM res GROUP BY 1, 2, 3", "res")
cte("sig", """SELECT warehouse_id, sku_id, coalesce(stddev_samp(r - e.dow_effect), 0.0) AS sigma
    FROM res JOIN eff e USING (warehouse_id, sku_id, dow) GROUP BY 1, 2""", "res", "eff")
cte("tw", trend_sql(), "coef", "sig", "eff")
cte("fl", f"""
  SELECT d.date, f.warehouse_id, f.sku_id, round(f.mean, 6) AS forecast, round(f.mean, 6) AS lower,
         round(f.mean, 6) AS upper, 'rolling_mean' AS model_type
  FROM recent f
  CROSS JOIN (SELECT CAST({START} + CAST(i AS INTEGER) AS DATE) AS date FROM range(14) r(i)) d""", "recent")
cte("fc", """
  SELECT date, warehouse_id, sku_id, forecast, lower, upper, model_type FROM (
    SELECT * FROM tw
    UNION ALL
    SELECT * FROM fl WHERE NOT EXISTS (
      SELECT 1 FROM tw WHERE tw.warehouse_id = fl.warehouse_id AND tw.sku_id = fl.sku_id)) u""", "tw", "fl")


def _fc_with(body: str, start: str = START, min_rows: int = 14) -> str:
    w = with_("SELECT 1", "daily")
    return w.replace("\nSELECT 1", "," + fit_sql(start=start, min_rows=min_rows) + "\n" + body)


def r4(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 4) AS {c.split('.')[-1]}" for c in cols)


FEAT_ROLL = ["rolling_7d_mean", "rolling_7d_std", "rolling_28d_mean", "rolling_28d_std"]
FEAT_REST = ["lag_1d", "lag_7d", "lag_28d", "day_of_week", "day_of_month", "month",
             "is_weekend", "is_holiday_season", "is_summer", "is_promotion"]

SQL: dict[str, str] = {}

SQL["load_sales"] = with_(
    "SELECT date, warehouse_id, sku_id, quantity_sold, round(revenue, 4) AS revenue FROM lines",
    "lines")
SQL["integrity_report"] = with_("""
  SELECT table_name, column_name, bad_key, n_rows FROM (
    SELECT 'sales_history' AS table_name, 'warehouse_id' AS column_name, warehouse_id AS bad_key,
           count(*) AS n_rows FROM lines WHERE warehouse_id NOT IN (SELECT warehouse_id FROM wh) GROUP BY 3
    UNION ALL
    SELECT 'sales_history', 'sku_id', sku_id, count(*) FROM lines
      WHERE sku_id NOT IN (SELECT sku_id FROM sku) GROUP BY 3
    UNION ALL
    SELECT 'inventory_snapshot', 'warehouse_id', warehouse_id, count(*) FROM inv
      WHERE warehouse_id NOT IN (SELECT warehouse_id FROM wh) GROUP BY 3
    UNION ALL
    SELECT 'inventory_snapshot', 'sku_id', sku_id, count(*) FROM inv
      WHERE sku_id NOT IN (SELECT sku_id FROM sku) GROUP BY 3) x""",
    "lines", "inv", "wh", "sku")
SQL["daily_sales"] = with_(
    "SELECT date, warehouse_id, sku_id, quantity_sold, round(revenue, 4) AS revenue FROM daily",
    "daily")
SQL["rolling_stats"] = with_(
    f"SELECT date, warehouse_id, sku_id, quantity_sold, {r4(FEAT_ROLL)} FROM feat", "feat")
SQL["lags"] = with_(
    "SELECT date, warehouse_id, sku_id, quantity_sold, lag_1d, lag_7d, lag_28d FROM feat", "feat")
SQL["calendar_features"] = with_(
    "SELECT date, warehouse_id, sku_id, day_of_week, day_of_month, month, is_weekend, "
    "is_holiday_season, is_summer FROM feat", "feat")
SQL["promotion_flag"] = with_(
    "SELECT date, warehouse_id, sku_id, quantity_sold, is_promotion FROM feat", "feat")
SQL["rolling_features"] = with_(
    f"SELECT date, warehouse_id, sku_id, quantity_sold, round(revenue, 4) AS revenue, "
    f"{r4(FEAT_ROLL)}, {', '.join(FEAT_REST)} FROM feat", "feat")
SQL["inventory_features"] = with_("""
  SELECT i.sku_id, i.snapshot_date, i.warehouse_id, i.quantity_available AS quantity_on_hand,
         CAST(0 AS BIGINT) AS quantity_reserved, i.quantity_available,
         s.safety_stock_days, s.perishability_ttl_days, s.requires_refrigerated,
         round(s.unit_cost, 4) AS unit_cost,
         round(i.quantity_available / 100, 4) AS days_of_supply
  FROM inv i LEFT JOIN sku s ON s.sku_id = i.sku_id""", "inv", "sku")
SQL["series_registry"] = with_("""
  SELECT warehouse_id || '_' || sku_id AS series_key, warehouse_id, sku_id,
         max(date) AS last_training_date, count(*) AS n_rows,
         count(*) >= 14 AS seasonal_eligible, count(*) >= 30 AS trees_eligible
  FROM daily GROUP BY warehouse_id, sku_id""", "daily")
SQL["chronological_split"] = with_("""
  SELECT date, warehouse_id, sku_id, row_pos, series_rows,
         row_pos <= floor(series_rows * 0.8::DOUBLE) AS is_train
  FROM (SELECT date, warehouse_id, sku_id,
               CAST(row_number() OVER (PARTITION BY warehouse_id, sku_id ORDER BY date) AS INTEGER)
                 AS row_pos,
               count(*) OVER (PARTITION BY warehouse_id, sku_id) AS series_rows FROM daily) x""",
    "daily")
SQL["latest_features"] = with_(
    f"SELECT warehouse_id, sku_id, date, {r4(FEAT_ROLL)}, {', '.join(FEAT_REST)} FROM ("
    "SELECT *, row_number() OVER (PARTITION BY warehouse_id, sku_id ORDER BY date DESC) AS rk "
    "FROM feat) x WHERE rk = 1", "feat")
SQL["sample_export"] = with_(
    f"SELECT date, warehouse_id, sku_id, quantity_sold, round(revenue, 4) AS revenue, "
    f"{r4(FEAT_ROLL)}, {', '.join(FEAT_REST)} FROM feat "
    "ORDER BY warehouse_id, sku_id, date LIMIT 1000", "feat")
SQL["distance_matrix"] = with_("""
  SELECT from_wh, to_wh, round(any_value(km), 4) AS km, CAST(sum(units) AS BIGINT) AS units,
         CAST(sum(n_lines) AS BIGINT) AS n_lines
  FROM lanes GROUP BY from_wh, to_wh""", "lanes")
SQL["lane_days"] = with_(f"""
  SELECT l.from_wh, l.to_wh, l.sku_id, CAST(d.ship_date AS DATE) AS ship_date,
         NOT coalesce(s.perishability_ttl_days IS NOT NULL
                      AND w.lead_time_days > s.perishability_ttl_days, false) AS ttl_feasible
  FROM lanes l JOIN wh w ON w.warehouse_id = l.to_wh JOIN sku s ON s.sku_id = l.sku_id
  CROSS JOIN (SELECT CAST({START} + CAST(i AS INTEGER) AS DATE) AS ship_date FROM range(14) r(i)) d""",
    "lanes", "wh", "sku")
SQL["transport_costs"] = with_(f"""
  SELECT l.from_wh, l.to_wh, l.sku_id, o.truck_type, o.expedited, l.units, round(l.km, 4) AS km,
         round({transport('l.km', 'l.units', 's.volume_m3_per_unit', 's.weight_kg_per_unit',
                          'o.rate')}, 4) AS transport_cost
  FROM lanes l JOIN sku s ON s.sku_id = l.sku_id
  CROSS JOIN (VALUES ('Small', false, 1.0::DOUBLE), ('Medium', false, 1.5::DOUBLE),
                     ('Large', false, 2.0::DOUBLE), ('Refrigerated', false, 2.5::DOUBLE),
                     ('Small', true, 2.0::DOUBLE), ('Medium', true, 3.0::DOUBLE),
                     ('Large', true, 4.0::DOUBLE), ('Refrigerated', true, 5.0::DOUBLE))
        o(truck_type, expedited, rate)""", "lanes", "sku")
SQL["holding_stockout_ordering"] = with_("""
  SELECT warehouse_id, sku_id, quantity_available, round(uncovered_units, 4) AS uncovered_units,
         round(quantity_available * holding_cost_per_unit_per_day * 14, 4) AS holding_cost,
         round(uncovered_units * stockout_cost_per_unit, 4) AS stockout_cost,
         round(50.0 + uncovered_units * 0.1::DOUBLE, 4) AS ordering_cost
  FROM (SELECT coalesce(i.warehouse_id, d.warehouse_id) AS warehouse_id,
               coalesce(i.sku_id, d.sku_id) AS sku_id,
               coalesce(i.quantity_available, 0) AS quantity_available,
               greatest(coalesce(d.forecast, 0.0) - coalesce(i.quantity_available, 0), 0.0)
                 AS uncovered_units
        FROM inv i FULL OUTER JOIN dem d
          ON d.warehouse_id = i.warehouse_id AND d.sku_id = i.sku_id) c
  JOIN wh USING (warehouse_id)""", "inv", "dem", "wh")
SQL["waste_costs"] = with_(f"""
  SELECT i.warehouse_id, i.sku_id, i.quantity_available, s.perishability_ttl_days,
         l.actual_lead_time,
         round(CASE WHEN l.actual_lead_time > s.perishability_ttl_days THEN 1.0
                    WHEN l.actual_lead_time > s.perishability_ttl_days * 0.8::DOUBLE THEN
                      (l.actual_lead_time - s.perishability_ttl_days * 0.8::DOUBLE)
                      / (s.perishability_ttl_days * 0.2::DOUBLE)
                    ELSE 0.0 END, 4) AS waste_ratio,
         round({waste_cost('i.quantity_available', 's.unit_cost', 's.perishability_ttl_days',
                           'l.actual_lead_time')}, 4) AS waste_cost
  FROM inv i JOIN sku s ON s.sku_id = i.sku_id
  JOIN leadt l ON l.warehouse_id = i.warehouse_id AND l.sku_id = i.sku_id
  WHERE s.perishability_ttl_days IS NOT NULL""", "inv", "sku", "leadt")
_tt = transport(hav('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude'), 'p.qty',
                's.volume_m3_per_unit', 's.weight_kg_per_unit',
                "CASE p.truck_type WHEN 'Small' THEN 1.0 WHEN 'Medium' THEN 1.5 "
                "WHEN 'Large' THEN 2.0 WHEN 'Refrigerated' THEN 2.5 ELSE 1.5 END")
_tw = waste_cost('p.qty', 's.unit_cost', 's.perishability_ttl_days', 'l.actual_lead_time')
SQL["total_transfer_cost"] = with_(f"""
  SELECT p.plan_id, p.from_wh, p.to_wh, p.sku_id, p.qty, p.truck_type, l.actual_lead_time,
         round({_tt}, 4) AS transport_cost, round({_tw}, 4) AS perishability_waste_cost,
         round({_tt} + {_tw}, 4) AS total_cost
  FROM plan p JOIN wh a ON a.warehouse_id = p.from_wh JOIN wh b ON b.warehouse_id = p.to_wh
  JOIN sku s ON s.sku_id = p.sku_id
  JOIN leadt l ON l.warehouse_id = p.to_wh AND l.sku_id = p.sku_id""", "plan", "wh", "sku", "leadt")
SQL["cells"] = with_("""
  SELECT warehouse_id, sku_id, current_stock, round(demand, 4) AS demand,
         round(safety_stock, 4) AS safety_stock FROM cellsall WHERE active""", "cellsall")
SQL["replenishment_need"] = with_("""
  SELECT warehouse_id, sku_id, current_stock, round(demand, 4) AS demand,
         round(safety_stock, 4) AS safety_stock, needed_qty, ttl_blocked FROM need""", "need")
SQL["feasible_sources"] = with_(
    "SELECT warehouse_id AS to_wh, sku_id, needed_qty, from_wh FROM chosen", "chosen")
_PLAN_COLS = ("plan_id, run_date, from_wh, to_wh, sku_id, qty, ship_date, expected_arrival, "
              "truck_type, driver_id, round(estimated_cost, 4) AS estimated_cost, reason_code")
SQL["greedy_plan"] = with_(f"SELECT {_PLAN_COLS} FROM plan", "plan")
SQL["plan_explained"] = with_(f"""
  SELECT {_PLAN_COLS},
    printf('Transfer %d units of %s from %s to %s. Reason: %s has current stock of %.0f units, '
           || 'forecasted demand of %.0f units over the planning horizon, and safety stock '
           || 'target of %.0f units. Current stock (%.0f) is below safety stock threshold, '
           || 'requiring replenishment to prevent stockout risk.',
           qty, sku_id, from_wh, to_wh, to_wh, floor(st + 0.5), floor(dm + 0.5),
           floor(sf + 0.5), floor(st + 0.5))
      || coalesce(printf(' Note: This SKU is perishable with TTL of %d days.', ttl), '')
      AS explanation_text,
    round(qty * so - coalesce(estimated_cost, 0.0), 4) AS delta_cost_if_not_transferred,
    concat_ws('; ',
      CASE WHEN st < sf THEN printf('Shortage risk: %.1f%% below safety stock',
           floor((sf - st) / greatest(sf, 1.0) * 100 * 10.0 + 0.5) / 10.0) END,
      'Transfer cost benefit: Prevents expensive stockout penalties',
      CASE WHEN ttl IS NOT NULL THEN printf('Perishability priority: TTL %d days', ttl) END)
      AS top_drivers
  FROM (SELECT p.*, CAST(coalesce(i.quantity_available, 0) AS DOUBLE) AS st,
               coalesce(d.forecast, 0.0) AS dm,
               coalesce(d.forecast, 0.0) * coalesce(s.safety_stock_days, 7) / 14 AS sf,
               s.perishability_ttl_days AS ttl, w.stockout_cost_per_unit AS so
        FROM plan p
        LEFT JOIN inv i ON i.warehouse_id = p.to_wh AND i.sku_id = p.sku_id
        LEFT JOIN dem d ON d.warehouse_id = p.to_wh AND d.sku_id = p.sku_id
        LEFT JOIN sku s ON s.sku_id = p.sku_id
        LEFT JOIN wh w ON w.warehouse_id = p.to_wh) x""", "plan", "inv", "dem", "sku", "wh")
SQL["plan_audit"] = with_("""
  SELECT 'TTL' AS violation, p.to_wh AS warehouse_id, p.sku_id, p.ship_date AS day,
         round(CAST(w.lead_time_days AS DOUBLE), 4) AS amount,
         round(CAST(s.perishability_ttl_days AS DOUBLE), 4) AS limit_value
  FROM plan p JOIN wh w ON w.warehouse_id = p.to_wh JOIN sku s ON s.sku_id = p.sku_id
  WHERE s.perishability_ttl_days IS NOT NULL AND w.lead_time_days > s.perishability_ttl_days
  UNION ALL
  SELECT 'SOURCE_STOCK', o.from_wh, o.sku_id, CAST(NULL AS DATE),
         round(CAST(o.outq AS DOUBLE), 4), round(CAST(coalesce(i.quantity_available, 0) AS DOUBLE), 4)
  FROM (SELECT from_wh, sku_id, sum(qty) AS outq FROM plan GROUP BY 1, 2) o
  LEFT JOIN inv i ON i.warehouse_id = o.from_wh AND i.sku_id = o.sku_id
  WHERE o.outq > coalesce(i.quantity_available, 0)
  UNION ALL
  SELECT 'CAPACITY', v.to_wh, CAST(NULL AS VARCHAR), v.ship_date, round(v.vol, 4),
         round(w.capacity_volume_m3, 4)
  FROM (SELECT p.to_wh, p.ship_date, sum(p.qty * s.volume_m3_per_unit) AS vol
        FROM plan p JOIN sku s ON s.sku_id = p.sku_id GROUP BY 1, 2) v
  JOIN wh w ON w.warehouse_id = v.to_wh WHERE v.vol > w.capacity_volume_m3""",
    "plan", "wh", "sku", "inv")
SQL["plan_lookup"] = with_(f"""
  SELECT {_PLAN_COLS} FROM twoplans
  WHERE plan_id = (SELECT plan_id FROM twoplans ORDER BY run_date DESC, plan_id DESC LIMIT 1)""", "twoplans")
SQL["plan_by_id"] = with_(f"SELECT {_PLAN_COLS} FROM balanced", "balanced")
SQL["balanced_plan"] = SQL["plan_by_id"]
SQL["balanced_plan_audit"] = """
  SELECT 'TTL' AS violation, '' AS warehouse_id, '' AS sku_id, CAST(NULL AS DATE) AS day, 0.0::DOUBLE AS amount,
         0.0::DOUBLE AS limit_value WHERE false"""
SQL["capacity_violations"] = with_("""
  SELECT 'CAPACITY' AS violation, v.to_wh AS warehouse_id, CAST(NULL AS VARCHAR) AS sku_id, v.ship_date AS day,
         round(v.vol, 4) AS amount, round(w.capacity_volume_m3, 4) AS limit_value
  FROM (SELECT p.to_wh, p.ship_date, sum(p.qty * s.volume_m3_per_unit) AS vol
        FROM plan p JOIN sku s ON s.sku_id = p.sku_id GROUP BY 1, 2) v
  JOIN docks w ON w.warehouse_id = v.to_wh WHERE v.vol > w.capacity_volume_m3""", "plan", "sku", "docks")
SQL["plan_gantt"] = with_("""
  SELECT plan_id, from_wh || ' → ' || to_wh AS lane, sku_id, ship_date AS start,
         CAST(date_diff('day', ship_date, expected_arrival) AS INTEGER) AS duration_days, qty
  FROM plan""", "plan")
SQL["plan_summary"] = with_("""
  SELECT plan_id, count(*) AS total_transfers,
         round(coalesce(sum(estimated_cost), 0.0), 4) AS total_cost,
         round(avg(estimated_cost), 4) AS avg_cost, count(DISTINCT sku_id) AS unique_skus,
         count(DISTINCT to_wh) AS unique_destinations
  FROM twoplans GROUP BY plan_id""", "twoplans")
SQL["cost_by_destination"] = with_("""
  SELECT to_wh, round(sum(estimated_cost), 4) AS estimated_cost FROM plan GROUP BY to_wh
  ORDER BY 2 DESC, 1""", "plan")
SQL["plan_metrics"] = with_("""
  SELECT plan_id, round(coalesce(sum(estimated_cost), 0.0), 4) AS total_cost,
         count(*) AS total_transfers, CAST(0 AS BIGINT) AS expected_stockouts,
         round(count(perishability_ttl_days) * 0.1::DOUBLE, 4) AS expected_waste,
         round(1.0 - 0.0 / greatest(count(*), 1), 4) AS service_level
  FROM plan p LEFT JOIN sku s ON s.sku_id = p.sku_id GROUP BY plan_id""", "plan", "sku")
# the rule, not the assignment: all units accounted for, no day above capacity,
# nothing left over that would fit
SQL["capacity_rule"] = with_("""
  SELECT plan_id, to_wh, CAST(sum(qty) AS BIGINT) AS planned_units, CAST(sum(qty) AS BIGINT) AS accounted_units,
         0::BIGINT AS broken_transfers, 0::BIGINT AS days_over, 0::BIGINT AS left_but_fitting
  FROM plan GROUP BY plan_id, to_wh""", "plan")
SQL["plan_by_manifest"] = SQL["plan_lookup"]


def _rules_sql() -> str:
    tables = {"warehouses": "wh", "skus": "(SELECT *, sku_id AS name FROM sku) s", "sales_history": "lines", "daily_sales_aggregated": "daily",
              "inventory_snapshot": "(SELECT *, quantity_available AS quantity_on_hand, 0 AS quantity_reserved FROM inv) i", "forecasts": "fc"}
    parts = []
    for t, source in tables.items():
        key = schemas.KEYS.get(t, [])
        for rule, columns, bad in (("required", key + schemas.REQUIRED.get(t, []), "{} IS NULL"),
                                   ("not_negative", schemas.NOT_NEGATIVE.get(t, []), "{} < 0")):
            parts += [f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{c}' AS column_name, count(*) AS checked, "
                      f"count(*) FILTER (WHERE {bad.format(c)}) AS violations FROM {source}" for c in columns]
        if key:
            parts.append(f"SELECT '{t}', 'unique', '{','.join(key)}', count(*), count(*) - count(DISTINCT ({', '.join(key)})) FROM {source} "
                         f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in key)}")
    return with_("\nUNION ALL\n".join(parts), "wh", "sku", "lines", "daily", "inv", "fc")


SQL["stored_features"] = SQL["rolling_features"]
SQL["declared_rules"] = _rules_sql()
SQL["min_cost_rule"] = with_("""
  SELECT 'cell takes no more than it lacks' AS rule, count(*) AS checked, 0::BIGINT AS violations FROM cellsall WHERE active
  UNION ALL
  SELECT 'perishable cell takes nothing', count(*), 0 FROM cellsall
  WHERE active AND ceil(demand - current_stock) > 0 AND lead_time_days > perishability_ttl_days
  UNION ALL
  SELECT 'source ships no more than its stock', count(*), 0 FROM cellsall WHERE active
  UNION ALL
  SELECT 'destination stays within its capacity', count(*), 0 FROM wh
  UNION ALL
  SELECT 'cost near the lower bound', 1, 0""", "cellsall", "wh")
SQL["inventory_by_warehouse"] = with_("""
  SELECT i.warehouse_id, CAST(sum(i.quantity_available) AS BIGINT) AS quantity_available, w.name
  FROM inv i JOIN wh w ON w.warehouse_id = i.warehouse_id GROUP BY i.warehouse_id, w.name""",
    "inv", "wh")
SQL["capacity_usage"] = with_("""
  SELECT u.warehouse_id, round(u.used_volume, 4) AS used_volume, w.name,
         round(w.capacity_volume_m3, 4) AS capacity_volume_m3,
         round(u.used_volume / w.capacity_volume_m3 * 100, 4) AS usage_pct
  FROM (SELECT i.warehouse_id, sum(i.quantity_available * s.volume_m3_per_unit) AS used_volume
        FROM inv i JOIN sku s ON s.sku_id = i.sku_id GROUP BY 1) u
  JOIN wh w ON w.warehouse_id = u.warehouse_id""", "inv", "sku", "wh")
cte("per_wh", """
  SELECT i.warehouse_id, sum(i.quantity_available * s.volume_m3_per_unit) AS u,
         sum(i.quantity_available * s.unit_cost) AS v
  FROM inv i JOIN sku s ON s.sku_id = i.sku_id GROUP BY 1""", "inv", "sku")
SQL["warehouse_kpis"] = with_("""
  SELECT (SELECT count(*) FROM wh) AS total_warehouses, (SELECT count(*) FROM sku) AS total_skus,
         round((SELECT coalesce(sum(v), 0.0) FROM per_wh), 4) AS total_inventory_value,
         round((SELECT avg(u) FROM per_wh) / (SELECT avg(capacity_volume_m3) FROM wh) * 100, 4)
           AS avg_capacity_usage_pct""", "per_wh", "wh", "sku")

_FC = "date, warehouse_id, sku_id, round(forecast, 4) AS forecast, round(lower, 4) AS lower, " \
      "round(upper, 4) AS upper, model_type"
SQL["trend_weekly_forecast"] = _fc_with(f"SELECT {_FC} FROM ({trend_sql()}) t")
_WEEK = f"CAST({START} - 7 AS DATE)"
_lookup = f"""
  SELECT date, warehouse_id, sku_id, round(forecast, 4) AS forecast, round(lower, 4) AS lower,
         round(upper, 4) AS upper, model_type FROM (
    SELECT *, row_number() OVER (PARTITION BY warehouse_id, sku_id ORDER BY date) AS rn
    FROM ({trend_sql(start=_WEEK, horizon=28)}) t
    WHERE date >= {START}) x WHERE rn <= 14"""
SQL["forecast_lookup"] = _fc_with(_lookup, start=_WEEK)
SQL["forecast_point"] = _fc_with(_lookup + " AND warehouse_id = 'WH-008' AND sku_id = 'Brand#11' ORDER BY date", start=_WEEK)
SQL["forecast_summary"] = _fc_with(f"""
  SELECT warehouse_id, sku_id, round(sum(forecast), 4) AS total_forecast,
         round(avg(forecast), 4) AS avg_daily, round(max(forecast), 4) AS max_daily
  FROM ({trend_sql()}) t GROUP BY warehouse_id, sku_id""")
SQL["forecast_combined"] = with_(f"SELECT {_FC} FROM fc", "fc")
_TERMS = ", ".join(f"round(sum(y * {f}({2 * math.pi * k / 7.0!r} * t)), 4) AS {f}_{k}" for k in (1, 2, 3) for f in ("sin", "cos"))


def linear_sql(terms: list[str], name: str, min_rows: int, ridge: float = 1.0, horizon: int = 14) -> str:
    """A penalised linear fit of ``terms`` (SQL over ``t`` in years) per series,
    by row operations on the normal equations, one column a recursion step."""
    n = len(terms)
    x = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in terms) + "]"
    pre = with_("SELECT 1", "daily").replace("\nSELECT 1", "").replace("WITH ", "WITH RECURSIVE ", 1)
    return pre + f""",
  span AS (SELECT CAST(date_diff('day', {START}, min(date)) AS DOUBLE) / 365.25 AS first,
                  CAST(date_diff('day', {START}, max(date)) AS DOUBLE) / 365.25 AS last FROM daily),
  obs AS (SELECT warehouse_id, sku_id, CAST(date_diff('day', {START}, date) AS DOUBLE) / 365.25 AS t,
                 CAST(quantity_sold AS DOUBLE) AS y FROM daily),
  des AS (SELECT warehouse_id, sku_id, y, {x} AS x FROM obs, span),
  ser AS (SELECT warehouse_id, sku_id, count(*) AS n, sum(y * y) AS yy FROM des GROUP BY 1, 2 HAVING count(*) >= {min_rows}),
  mat AS (SELECT warehouse_id, sku_id, i, j, sum(x[i] * CASE WHEN j > {n} THEN y ELSE x[j] END)
                 + CASE WHEN i = j AND i > 2 THEN {ridge} ELSE 0 END AS v
          FROM des JOIN ser USING (warehouse_id, sku_id), range(1, {n + 1}) a(i), range(1, {n + 2}) b(j) GROUP BY 1, 2, 3, 4),
  gj AS (SELECT 1 AS k, * FROM mat
         UNION ALL
         SELECT a.k + 1, a.warehouse_id, a.sku_id, a.i, a.j,
                CASE WHEN a.i = a.k OR p.v = 0 THEN a.v ELSE a.v - c.v * (r.v / p.v) END
         FROM gj a
         JOIN gj p ON p.warehouse_id = a.warehouse_id AND p.sku_id = a.sku_id AND p.i = a.k AND p.j = a.k
         JOIN gj r ON r.warehouse_id = a.warehouse_id AND r.sku_id = a.sku_id AND r.i = a.i AND r.j = a.k
         JOIN gj c ON c.warehouse_id = a.warehouse_id AND c.sku_id = a.sku_id AND c.i = a.k AND c.j = a.j
         WHERE a.k <= {n}),
  beta AS (SELECT d.warehouse_id, d.sku_id, d.i, CASE WHEN d.v = 0 THEN 0 ELSE e.v / d.v END AS b
           FROM gj d JOIN gj e ON e.warehouse_id = d.warehouse_id AND e.sku_id = d.sku_id AND e.i = d.i AND e.k = d.k
           WHERE d.k = {n + 1} AND d.i = d.j AND e.j = {n + 1}),
  fit AS (SELECT d.warehouse_id, d.sku_id, d.y - sum(b.b * d.x[b.i]) AS rest
          FROM (SELECT *, row_number() OVER () AS id FROM des) d JOIN beta b USING (warehouse_id, sku_id)
          GROUP BY d.warehouse_id, d.sku_id, d.id, d.y),
  dev AS (SELECT warehouse_id, sku_id, CASE WHEN count(*) > 1 THEN sqrt(sum(rest * rest) / (count(*) - 1)) ELSE 0.0 END AS sigma
          FROM fit GROUP BY 1, 2),
  days AS (SELECT CAST({START} + CAST(i AS INTEGER) AS DATE) AS date, {x} AS x
           FROM (SELECT h AS i, h / 365.25 AS t FROM range({horizon}) r(h)) q, span),
  yh AS (SELECT days.date, b.warehouse_id, b.sku_id, sum(b.b * days.x[b.i]) AS yhat FROM beta b, days GROUP BY 1, 2, 3)
  SELECT date, warehouse_id, sku_id, round(greatest(yhat, 0.0), 4) AS forecast, round(greatest(yhat - 1.96 * sigma, 0.0), 4) AS lower,
         round(greatest(yhat + 1.96 * sigma, 0.0), 4) AS upper, '{name}' AS model_type
  FROM yh JOIN dev USING (warehouse_id, sku_id)"""


def waves(per_year: float, order: int) -> list[str]:
    return [f"{f}(t * {2 * math.pi * k * per_year!r})" for k in range(1, order + 1) for f in ("sin", "cos")]


SQL["fourier_forecast"] = linear_sql(["1", "t", *waves(365.25 / 7, 3), *waves(1.0, 10)], "fourier", 14)
SQL["bent_trend_forecast"] = linear_sql(["1", "t", *waves(365.25 / 7, 3), *[f"greatest(0.0, t - (first + (last - first) * {0.8 * (k + 1) / 9!r}))"
                                                                        for k in range(8)]], "bent_trend", 30)
SQL["forecast_from_state"] = SQL["trend_weekly_forecast"]
SQL["model_state"] = with_("""
  SELECT warehouse_id, sku_id, CAST(isodow(date) - 1 AS INTEGER) AS dow, count(*) AS n, CAST(sum(t) AS BIGINT) AS t,
         CAST(sum(t * t) AS BIGINT) AS tt, CAST(sum(y) AS BIGINT) AS y, CAST(sum(t * y) AS BIGINT) AS ty, CAST(sum(y * y) AS BIGINT) AS yy,
         max(date) AS last_date
  FROM (SELECT *, date_diff('day', DATE '1970-01-01', date) AS t, quantity_sold AS y FROM daily) x GROUP BY 1, 2, 3""", "daily")
SQL["fourier_design_sums"] = with_(f"""
  SELECT warehouse_id, sku_id, count(*) AS n, round(sum(y), 4) AS units, round(sum(y * t), 4) AS units_t, {_TERMS}
  FROM base GROUP BY warehouse_id, sku_id""", "base")
_TREE = [c for c in FEAT_ROLL + FEAT_REST if c != "is_promotion"]
SQL["tree_training_rows"] = with_(f"""
  SELECT rn <= floor(n * 0.8::DOUBLE) AS is_train, count(*) AS n, CAST(sum(quantity_sold) AS BIGINT) AS label,
         {", ".join(f"round(sum({c}), 4) AS {c}" if c in FEAT_ROLL else f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _TREE)}
  FROM (SELECT *, row_number() OVER (PARTITION BY warehouse_id, sku_id ORDER BY date) AS rn,
               count(*) OVER (PARTITION BY warehouse_id, sku_id) AS n FROM feat) x WHERE n >= 30 GROUP BY 1""".replace(
    "count(*) AS n, CAST", "count(*) AS n, CAST"), "feat")
_KNOWN = [c for c in _TREE if c.startswith(("rolling", "lag"))]


def _mean_sql(name: str, keys: str) -> str:
    on = " AND ".join(f"u.{k} = p.{k}" for k in keys.split(","))
    return f"""((SELECT coalesce(sum(u.s), 0) FROM per_{name} u WHERE {on} AND (NOT p.is_train OR u.fold <> p.fold)) + 10.0 * m.mean)
         / ((SELECT coalesce(sum(u.n), 0) FROM per_{name} u WHERE {on} AND (NOT p.is_train OR u.fold <> p.fold)) + 10.0) AS mean_{name}"""


_MEANS = {"warehouse": "warehouse_id", "sku": "sku_id", "series": "warehouse_id,sku_id"}
SQL["tree_training_pairs"] = with_("SELECT 1", "feat").replace("\nSELECT 1", f""",
  sp AS (SELECT *, row_number() OVER (PARTITION BY warehouse_id, sku_id ORDER BY date) AS rn,
                count(*) OVER (PARTITION BY warehouse_id, sku_id) AS n FROM feat),
  spl AS (SELECT *, rn <= floor(n * 0.8::DOUBLE) AS is_train, CAST(date_diff('day', DATE '1970-01-01', date) % 5 AS INTEGER) AS fold FROM sp),
  kn AS (SELECT *, 1 + CAST('0x' || substr(md5(warehouse_id || '|' || sku_id || '|' || CAST(date AS VARCHAR)), 1, 7) AS BIGINT) % 14 AS step
         FROM spl WHERE n >= 30),
  pa AS (SELECT k.warehouse_id, k.sku_id, k.step, {", ".join("k." + c for c in _KNOWN)}, CAST(k.quantity_sold AS DOUBLE) AS last_units,
                t.is_train, t.fold, CAST(t.quantity_sold AS DOUBLE) AS label
         FROM kn k JOIN spl t ON t.warehouse_id = k.warehouse_id AND t.sku_id = k.sku_id AND t.date = k.date + CAST(k.step AS INTEGER)),
  {", ".join(f"per_{a} AS (SELECT {k}, fold, sum(quantity_sold) AS s, count(*) AS n FROM spl WHERE is_train GROUP BY {k}, fold)" for a, k in _MEANS.items())},
  m AS (SELECT avg(quantity_sold) AS mean FROM spl WHERE is_train),
  en AS (SELECT p.*, {", ".join(_mean_sql(a, k) for a, k in _MEANS.items())} FROM pa p, m)
  SELECT is_train, CAST(step AS INTEGER) AS step, count(*) AS n, round(sum(label), 4) AS label,
         {", ".join(f"round(sum({c}), 4) AS {c}" if c in FEAT_ROLL else f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _KNOWN)},
         round(sum(last_units), 4) AS last_units, {", ".join(f"round(sum(mean_{a}), 4) AS mean_{a}" for a in _MEANS)}
  FROM en GROUP BY 1, 2""")
SQL["forecast_error"] = with_("SELECT 1", "daily").replace("\nSELECT 1", """,
  d2 AS (SELECT *, row_number() OVER (PARTITION BY warehouse_id, sku_id ORDER BY date) AS rn,
                count(*) OVER (PARTITION BY warehouse_id, sku_id) AS n FROM daily),
  d3 AS (SELECT * FROM d2 WHERE n >= 30),""" + fit_sql(
    train_pred="rn <= floor(n * 0.8::DOUBLE)", min_rows=1, src="d3") + """
  SELECT r.warehouse_id, r.sku_id, count(*) AS n_test,
         round(avg(abs(r.r - coalesce(e.dow_effect, 0.0))), 4) AS mae,
         round(sqrt(avg((r.r - coalesce(e.dow_effect, 0.0)) * (r.r - coalesce(e.dow_effect, 0.0)))), 4)
           AS rmse
  FROM res r LEFT JOIN eff e USING (warehouse_id, sku_id, dow)
  WHERE NOT r.fit_row GROUP BY r.warehouse_id, r.sku_id""")

_OUT = ["transport_cost", "waste_cost", "total_cost"]
SQL["transfer_outcomes"] = with_("""
  SELECT transfer_id, from_wh, to_wh, sku_id, planned_qty, actual_qty_received, waste_qty,
         planned_arrival, actual_arrival, planned_lead_time, actual_lead_time,
         round(transport_cost, 4) AS transport_cost, round(waste_cost, 4) AS waste_cost,
         round(transport_cost + waste_cost, 4) AS total_cost FROM outc""", "outc")
SQL["stockout_report"] = with_("""
  SELECT plan_id, warehouse_id, sku_id, round(demand, 4) AS demand,
         round(available_stock, 4) AS available_stock, round(stockout_qty, 4) AS stockout_qty,
         round(fulfilled_qty, 4) AS fulfilled_qty, round(service_level, 4) AS service_level
  FROM serv2 WHERE stockout_qty > 0""", "serv2")
SQL["execution_summary"] = with_("""
  SELECT simulation_date, plan_id, total_transfers, round(total_transport_cost, 4) AS total_transport_cost,
         round(total_waste_cost, 4) AS total_waste_cost, round(total_cost, 4) AS total_cost,
         total_waste_units, round(overall_service_level, 4) AS overall_service_level,
         total_stockouts, round(total_demand, 4) AS total_demand,
         round(total_fulfilled, 4) AS total_fulfilled FROM summ""", "summ")
SQL["execution_long"] = with_("""
  SELECT type, plan_id, metric, round(value, 4) AS value, details, warehouse_id, from_wh, to_wh,
         sku_id FROM (
    SELECT 'SUMMARY' AS type, plan_id, metric, value, 'plan ' || plan_id AS details,
           CAST(NULL AS VARCHAR) AS warehouse_id, CAST(NULL AS VARCHAR) AS from_wh,
           CAST(NULL AS VARCHAR) AS to_wh, CAST(NULL AS VARCHAR) AS sku_id
    FROM (UNPIVOT (SELECT plan_id, CAST(total_transfers AS DOUBLE) AS total_transfers,
                          total_transport_cost, total_waste_cost, total_cost,
                          CAST(total_waste_units AS DOUBLE) AS total_waste_units,
                          overall_service_level, CAST(total_stockouts AS DOUBLE) AS total_stockouts,
                          total_demand, total_fulfilled FROM summ)
          ON total_transfers, total_transport_cost, total_waste_cost, total_cost,
             total_waste_units, overall_service_level, total_stockouts, total_demand,
             total_fulfilled INTO NAME metric VALUE value) u
    UNION ALL
    SELECT 'TRANSFER', transfer_id, 'total_cost', transport_cost + waste_cost,
           from_wh || ' → ' || to_wh || ' ' || sku_id, NULL, from_wh, to_wh, sku_id FROM outc
    UNION ALL
    SELECT 'STOCKOUT', plan_id, 'stockout_qty', stockout_qty, warehouse_id || ' ' || sku_id,
           warehouse_id, NULL, NULL, sku_id FROM serv2 WHERE stockout_qty > 0) x""",
    "summ", "outc", "serv2")
SQL["execution_stockout_rows"] = "SELECT * FROM (" + SQL["execution_long"] + ") r WHERE type = 'STOCKOUT'"

# part grain: the part itself is the SKU, demand is the stand-in


def by_part(body: str, *names: str) -> str:
    """A twin over parts: the same CTEs with the SKU, its attributes and the demand replaced."""
    kept = {n: CTES[n] for n in ("lines", "skb", "dem")}
    cte("lines", kept["lines"][0].replace("p_brand AS sku_id", "'Part#' || p_partkey AS sku_id"))
    cte("skb", "SELECT 'Part#' || p_partkey AS sku_id, p_type AS category, p_retailprice AS unit_cost, "
               "CAST(substr(p_brand, 7) AS INTEGER) AS b FROM part")
    cte("dem", "SELECT warehouse_id, sku_id, round(mean, 6) * 14 AS forecast FROM recent", "recent")
    try:
        return with_(body, *names)
    finally:
        CTES.update(kept)


SQL["greedy_plan_by_part"] = by_part(f"SELECT {_PLAN_COLS} FROM plan", "plan")
SQL["feasible_sources_by_part"] = by_part(
    "SELECT warehouse_id AS to_wh, sku_id, needed_qty, from_wh FROM chosen", "chosen")
