"""Forecast models: planted signal recovered, bands ordered."""
import datetime as dt

import numpy as np
import pytest

from restock.operators import forecast as Fc


@pytest.fixture(scope="module")
def planted(spark):
    start = dt.date(2023, 1, 2)   # a Monday
    effect = [0, 2, 4, 6, 8, 10, 12]
    rows = []
    for i in range(140):
        d = start + dt.timedelta(days=i)
        rows.append((d, "W", "A", int(round(20 + 0.5 * i + effect[d.weekday()])), 1.0))
    rows += [(start + dt.timedelta(days=i), "W", "B", 5, 1.0) for i in range(10)]
    return spark.createDataFrame(rows, "date date, warehouse_id string, sku_id string, "
                                       "quantity_sold long, revenue double")


def test_trend_weekly_recovers_signal(spark, planted):
    start = "2023-05-22"   # day 140, a Monday
    f = Fc.trend_weekly_forecast(planted, start, 14).toPandas().sort_values("date")
    assert set(f.sku_id) == {"A"}          # B has 10 rows < 14
    days = np.arange(140, 154)
    eff = np.array([0, 2, 4, 6, 8, 10, 12] * 2)
    np.testing.assert_allclose(f.forecast.to_numpy(), 20 + 0.5 * days + eff, atol=0.6)
    assert (f.lower <= f.forecast).all() and (f.forecast <= f.upper).all()


def test_fourier_recovers_signal(spark, planted):
    f = Fc.fourier_forecast(planted, "2023-05-22", 14).toPandas().sort_values("date")
    days = np.arange(140, 154)
    eff = np.array([0, 2, 4, 6, 8, 10, 12] * 2)
    assert np.abs(f.forecast.to_numpy() - (20 + 0.5 * days + eff)).mean() < 3.0
    assert (f.lower <= f.forecast).all() and (f.forecast <= f.upper).all()


def test_combined_prefers_seasonal_and_tags(spark, planted):
    from restock.operators import features as Fe
    feats = Fe.rolling_features(planted)
    c = Fc.combine_forecasts(Fc.trend_weekly_forecast(planted, "2023-05-22", 7),
                             Fc.flat_forecast(feats, "2023-05-22", 7)).toPandas()
    assert dict(c.groupby("sku_id").model_type.first()) == {"A": "trend_weekly", "B": "rolling_mean"}
    assert len(c) == 14


def test_lookup_point_and_slice(spark, planted):
    stored = Fc.trend_weekly_forecast(planted, "2023-05-15", 28)
    got = Fc.forecast_lookup(stored, "2023-05-22", 5, warehouse_id="W", sku_id="A").toPandas()
    assert len(got) == 5 and str(got.date.min()) == "2023-05-22"


def test_error_small_on_clean_signal(spark, planted):
    e = Fc.forecast_error(planted, "2023-05-22").toPandas()
    assert list(e.sku_id) == ["A"] and e.n_test[0] == 28 and e.mae[0] < 1.0


def test_gbt_forecast_properties(spark):
    from restock.operators import ml
    from restock.plans import catalog
    m = catalog.Model(spark, "/root/testdata/sf0.001")
    f = ml.gbt_forecast(m.features, m.start, 7, max_iter=10).toPandas()
    assert len(f) == 7 * f.groupby(["warehouse_id", "sku_id"]).ngroups > 0
    assert (f.forecast >= 0).all() and (f.lower <= f.forecast).all() and (f.forecast <= f.upper).all()
    assert set(f.model_type) == {"gbt"}


def test_strict_explanation(spark):
    from pyspark.sql import functions as F
    from restock.functions import text as T
    df = spark.createDataFrame([(5, 10.0, 20.0, 8.0)], "q long, st double, dm double, sf double")
    loose = df.select(T.explanation(F.col("q"), F.lit("S"), F.lit("A"), F.lit("B"), F.col("st"),
                                    F.col("dm"), F.col("sf"), F.lit(None).cast("int"))).first()[0]
    strict = df.select(T.explanation(F.col("q"), F.lit("S"), F.lit("A"), F.lit("B"), F.col("st"),
                                     F.col("dm"), F.col("sf"), F.lit(None).cast("int"),
                                     strict=True)).first()[0]
    assert "below safety stock" in loose and "below safety stock" not in strict
    assert strict.endswith("safety stock target of 8 units.")
