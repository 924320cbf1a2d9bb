"""Cost formulas as column expressions.

Each function takes columns (or names) and returns a Column, so it runs
inside whole-stage codegen; lookups of the inputs are joins done by the
caller, once per dimension.

Fixed values (must equal the reference model's):
  earth radius           6371 km
  truck rate per km      Small 1.0, Medium 1.5, Large 2.0, Refrigerated 2.5, other 1.5
  expedited multiplier   2.0
  fixed cost per trip    100.0
  volume cost            0.1 per m3, weight cost 0.001 per kg
  ordering cost          50.0 + 0.1 per unit
  waste onset            0.8 of the shelf life, full waste 0.2 later
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
TRUCK_RATES = {"Small": 1.0, "Medium": 1.5, "Large": 2.0, "Refrigerated": 2.5}
DEFAULT_RATE = 1.5
EXPEDITED_FACTOR = 2.0
FIXED_TRIP_COST = 100.0
VOLUME_RATE = 0.1
WEIGHT_RATE = 0.001
ORDER_FIXED = 50.0
ORDER_PER_UNIT = 0.1
WASTE_ONSET = 0.8
WASTE_SPAN = 0.2


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance, atan2 form (H1)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(EARTH_RADIUS_KM) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))


def truck_rate(truck_type="Medium", expedited=False) -> Column:
    """Cost per km of a truck type, doubled when expedited (H2).

    ``truck_type`` and ``expedited`` are literals or Columns (a string here is
    a truck type name, not a column name).
    """
    if not isinstance(truck_type, Column):
        rate = F.lit(TRUCK_RATES.get(truck_type, DEFAULT_RATE))
    else:
        chain = None
        for name, r in TRUCK_RATES.items():
            cond = truck_type == name
            chain = F.when(cond, F.lit(r)) if chain is None else chain.when(cond, F.lit(r))
        rate = chain.otherwise(F.lit(DEFAULT_RATE))
    if not isinstance(expedited, Column):
        return rate * EXPEDITED_FACTOR if expedited else rate
    return F.when(expedited, rate * EXPEDITED_FACTOR).otherwise(rate)


def transport_cost(km, qty, volume_per_unit, weight_per_unit,
                   truck_type="Medium", expedited=False) -> Column:
    """km * rate + fixed trip cost + volume and weight components (H3)."""
    km, qty, v, w = map(_c, (km, qty, volume_per_unit, weight_per_unit))
    return (km * truck_rate(truck_type, expedited) + F.lit(FIXED_TRIP_COST)
            + qty * v * VOLUME_RATE + qty * w * WEIGHT_RATE)


def holding_cost(qty, holding_per_unit_day, days) -> Column:
    """Holding cost of stock for some days (H4).

    The model multiplies by the unit cost and divides it back out; the
    simplified product is the same number and has no division by zero.
    """
    return _c(qty) * _c(holding_per_unit_day) * _c(days)


def stockout_cost(qty, stockout_per_unit) -> Column:
    """Penalty of units not served (H5)."""
    return _c(qty) * _c(stockout_per_unit)


def waste_ratio(ttl, days) -> Column:
    """Share of units that expire after ``days`` in transit (NULL ttl -> 0)."""
    ttl, days = _c(ttl).cast("double"), _c(days).cast("double")
    onset = ttl * WASTE_ONSET
    return (F.when(ttl.isNull(), F.lit(0.0))
             .when(days > ttl, F.lit(1.0))
             .when(days > onset, (days - onset) / (ttl * WASTE_SPAN))
             .otherwise(F.lit(0.0)))


def waste_cost(qty, unit_cost, ttl, days) -> Column:
    """Perishability waste cost (H6): all, partial after the onset, or none."""
    ttl_d, days_d = _c(ttl).cast("double"), _c(days).cast("double")
    onset = ttl_d * WASTE_ONSET
    q, uc = _c(qty), _c(unit_cost)
    return (F.when(ttl_d.isNull(), F.lit(0.0))
             .when(days_d > ttl_d, q * uc)
             .when(days_d > onset, q * ((days_d - onset) / (ttl_d * WASTE_SPAN)) * uc)
             .otherwise(F.lit(0.0)))


def ordering_cost(qty) -> Column:
    """Supplier order cost (H7)."""
    return F.lit(ORDER_FIXED) + _c(qty) * ORDER_PER_UNIT


def total_transfer_cost(km, qty, volume_per_unit, weight_per_unit, unit_cost, ttl,
                        days_in_transit, truck_type="Medium", expedited=False) -> Column:
    """Transport, waste and their total as one struct (H8)."""
    t = transport_cost(km, qty, volume_per_unit, weight_per_unit, truck_type, expedited)
    w = waste_cost(qty, unit_cost, ttl, days_in_transit)
    return F.struct(t.alias("transport_cost"), w.alias("perishability_waste_cost"),
                    (t + w).alias("total_cost"))


def safety_stock(demand, safety_stock_days, horizon_days) -> Column:
    """Safety stock target over the horizon."""
    return _c(demand) * _c(safety_stock_days) / _c(horizon_days)


def safety_days(days) -> Column:
    """Safety days of a SKU, 7 where none are given."""
    return F.coalesce(_c(days), F.lit(7))


def needed_qty(safety, stock, demand) -> Column:
    """Units to order: truncated toward zero like int()."""
    return (_c(safety) - _c(stock) + _c(demand)).cast("long")


def truck_type_for(requires_refrigerated) -> Column:
    """Refrigerated SKUs go by refrigerated truck, others Medium; NULL -> Medium."""
    return F.when(F.coalesce(_c(requires_refrigerated), F.lit(False)),
                  F.lit("Refrigerated")).otherwise(F.lit("Medium"))


def series_key(warehouse_id="warehouse_id", sku_id="sku_id") -> Column:
    """Display key "{wh}_{sku}" (H15)."""
    return F.concat_ws("_", _c(warehouse_id), _c(sku_id))


def delta_cost(qty, stockout_per_unit, estimated_cost) -> Column:
    """Stockout penalty avoided minus the transfer cost."""
    return stockout_cost(qty, stockout_per_unit) - F.coalesce(_c(estimated_cost), F.lit(0.0))


def forecast_band(pred) -> tuple[Column, Column, Column]:
    """Non-negative point forecast with a +-20 % band."""
    p = F.greatest(_c(pred), F.lit(0.0))
    return p, p * 0.8, p * 1.2


def waste_units(qty, ttl, days) -> Column:
    """Units lost in transit (H21): none, int(qty * ratio), or all."""
    ttl_d, days_d = _c(ttl).cast("double"), _c(days).cast("double")
    q = _c(qty)
    onset = ttl_d * WASTE_ONSET
    return (F.when(ttl_d.isNull(), F.lit(0).cast("long"))
             .when(days_d > ttl_d, q.cast("long"))
             .when(days_d > onset,
                   (q * ((days_d - onset) / (ttl_d * WASTE_SPAN))).cast("long"))
             .otherwise(F.lit(0).cast("long")))


def served(demand, available) -> tuple[Column, Column, Column]:
    """Stockout, fulfilled and row service level."""
    d, a = _c(demand), _c(available)
    stockout = F.greatest(F.lit(0.0), d - a)
    fulfilled = F.least(d, a)
    level = F.when(d > 0, fulfilled / d).otherwise(F.lit(1.0))
    return stockout, fulfilled, level
