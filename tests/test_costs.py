"""Hand-computed cases for the cost and rule expressions."""
import math

import pytest
from pyspark.sql import functions as F

from restock.functions import costs as C


def one(spark, col, **vals):
    df = spark.createDataFrame([tuple(vals.values())], list(vals.keys())) if vals else spark.range(1)
    return df.select(col.alias("x")).first()["x"]


def test_haversine_known_distance(spark):
    km = one(spark, C.haversine_km("a", "b", "c", "d"), a=0.0, b=0.0, c=0.0, d=1.0)
    assert km == pytest.approx(6371.0 * math.radians(1.0), rel=1e-12)
    assert one(spark, C.haversine_km("a", "b", "c", "d"), a=40.0, b=-100.0, c=40.0, d=-100.0) == 0.0


@pytest.mark.parametrize("truck,exp,rate", [("Small", False, 1.0), ("Medium", False, 1.5),
                                            ("Large", False, 2.0), ("Refrigerated", False, 2.5),
                                            ("Other", False, 1.5), ("Large", True, 4.0)])
def test_truck_rates(spark, truck, exp, rate):
    assert one(spark, C.truck_rate(truck, exp)) == rate


def test_transport_cost_medium(spark):
    # 100 units, 0.01 m3 and 2 kg each, 10 km at Medium
    v = one(spark, C.transport_cost("km", "q", "v", "w"), km=10.0, q=100, v=0.01, w=2.0)
    assert v == pytest.approx(10 * 1.5 + 100 + 100 * 0.01 * 0.1 + 100 * 2.0 * 0.001)


def test_holding_stockout_ordering(spark):
    assert one(spark, C.holding_cost("q", "h", "d"), q=100, h=0.02, d=7) == pytest.approx(14.0)
    assert one(spark, C.stockout_cost("q", "r"), q=50, r=12.0) == 600.0
    assert one(spark, C.ordering_cost("q"), q=10) == pytest.approx(51.0)


@pytest.mark.parametrize("ttl,days,expected", [
    (None, 30, 0.0),          # not perishable
    (5, 10, 1000.0),          # past TTL: everything
    (5, 2, 0.0),              # well before
    (5, 4, 0.0),              # exactly 0.8 * ttl: not yet
    (5, 5, 1000.0 * (5 - 4.0) / 1.0),   # at TTL: partial ratio 1.0
    (5, 6, 1000.0),
])
def test_waste_cost(spark, ttl, days, expected):
    df = spark.createDataFrame([(100, 10.0, ttl, days)], "q long, uc double, ttl int, d int")
    v = df.select(C.waste_cost("q", "uc", "ttl", "d").alias("x")).first()["x"]
    assert v == pytest.approx(expected)


@pytest.mark.parametrize("ttl,days,expected", [(None, 9, 0), (5, 4, 0), (5, 5, 100), (10, 9, 50),
                                               (5, 6, 100)])
def test_waste_units(spark, ttl, days, expected):
    df = spark.createDataFrame([(100, ttl, days)], "q long, ttl int, d int")
    assert df.select(C.waste_units("q", "ttl", "d").alias("x")).first()["x"] == expected


def test_needed_qty_truncates(spark):
    assert one(spark, C.needed_qty("s", "st", "d"), s=0.4, st=0, d=0.3) == 0
    assert one(spark, C.needed_qty("s", "st", "d"), s=10.9, st=2, d=5.0) == 13


def test_served_and_levels(spark):
    df = spark.createDataFrame([(10.0, 4.0), (0.0, 5.0), (3.0, 8.0)], "d double, a double")
    so, ful, lvl = C.served("d", "a")
    got = [tuple(r) for r in df.select(so, ful, lvl).collect()]
    assert got == [(6.0, 4.0, 0.4), (0.0, 0.0, 1.0), (0.0, 3.0, 1.0)]
    for s, f, (d, _a) in zip([g[0] for g in got], [g[1] for g in got], [(10.0, 4.0), (0.0, 5.0), (3.0, 8.0)]):
        assert s + f == pytest.approx(d)


def test_truck_type_and_key(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "r boolean")
    assert [r[0] for r in df.select(C.truck_type_for("r")).collect()] == \
        ["Refrigerated", "Medium", "Medium"]
    assert one(spark, C.series_key(F.lit("WH-1"), F.lit("S-2"))) == "WH-1_S-2"


def test_forecast_band(spark):
    p, lo, hi = C.forecast_band(F.lit(-3.0))
    assert one(spark, p) == 0.0
    p, lo, hi = C.forecast_band(F.lit(10.0))
    assert (one(spark, lo), one(spark, hi)) == (8.0, 12.0)
