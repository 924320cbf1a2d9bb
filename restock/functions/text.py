"""Explanation text for plan rows.

Numbers are quantised half-up before formatting (floor(x * 10^k + 0.5) /
10^k), so the printed text does not depend on an engine's rounding of
binary fractions.

Fixed texts (must equal the reference model's):
  "Transfer {qty} units of {sku} from {from} to {to}. Reason: {to} has current
   stock of {stock} units, forecasted demand of {demand} units over the planning
   horizon, and safety stock target of {safety} units. Current stock ({stock}) is
   below safety stock threshold, requiring replenishment to prevent stockout risk."
  " Note: This SKU is perishable with TTL of {ttl} days."
  "Shortage risk: {pct:.1f}% below safety stock"
  "Transfer cost benefit: Prevents expensive stockout penalties"
  "Perishability priority: TTL {ttl} days"
  drivers joined by "; ", at most three
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXPLANATION = (
    "Transfer %d units of %s from %s to %s. "
    "Reason: %s has current stock of %.0f units, "
    "forecasted demand of %.0f units over the planning horizon, "
    "and safety stock target of %.0f units. "
    "Current stock (%.0f) is below safety stock threshold, "
    "requiring replenishment to prevent stockout risk."
)
PERISHABLE_NOTE = " Note: This SKU is perishable with TTL of %d days."
SHORTAGE_DRIVER = "Shortage risk: %.1f%% below safety stock"
COST_DRIVER = "Transfer cost benefit: Prevents expensive stockout penalties"
TTL_DRIVER = "Perishability priority: TTL %d days"
DRIVER_SEPARATOR = "; "
MAX_DRIVERS = 3


def quantise(x: Column, places: int) -> Column:
    scale = 10.0 ** places
    return F.floor(x.cast("double") * scale + 0.5) / scale


STRICT_NOT_BELOW = (
    "Transfer %d units of %s from %s to %s. "
    "Reason: %s has current stock of %.0f units, "
    "forecasted demand of %.0f units over the planning horizon, "
    "and safety stock target of %.0f units."
)


def explanation(qty, sku, from_wh, to_wh, stock, demand, safety, ttl,
                strict: bool = False) -> Column:
    """The explanation sentence. The model always says the stock is below the
    safety target; with ``strict`` that clause is left out when it is not true."""
    s0, d0, f0 = quantise(stock, 0), quantise(demand, 0), quantise(safety, 0)
    body = F.format_string(EXPLANATION, qty, sku, from_wh, to_wh, to_wh, s0, d0, f0, s0)
    if strict:
        body = F.when(stock < safety, body).otherwise(
            F.format_string(STRICT_NOT_BELOW, qty, sku, from_wh, to_wh, to_wh, s0, d0, f0))
    note = F.when(ttl.isNotNull(), F.format_string(PERISHABLE_NOTE, ttl.cast("int")))
    return F.concat(body, F.coalesce(note, F.lit("")))


def top_drivers(stock, safety, ttl) -> Column:
    pct = (safety - stock) / F.greatest(safety, F.lit(1.0)) * 100
    drivers = F.array(
        F.when(stock < safety, F.format_string(SHORTAGE_DRIVER, quantise(pct, 1))),
        F.lit(COST_DRIVER),
        F.when(ttl.isNotNull(), F.format_string(TTL_DRIVER, ttl.cast("int"))),
    )
    return F.array_join(F.slice(F.array_compact(drivers), 1, MAX_DRIVERS), DRIVER_SEPARATOR)
