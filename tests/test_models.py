"""Linear models without Python and the stored sums."""
import contextlib
import datetime as dt
import io as _io

import numpy as np
import pytest
from pyspark.sql import functions as F

from restock.operators import linear, state
from restock.operators import forecast as Fc
from restock.plans import catalog

SF = "/root/testdata/sf0.001"
DAILY = "date date, warehouse_id string, sku_id string, quantity_sold long, revenue double"
START = dt.date(2023, 12, 31)


@pytest.fixture(scope="module")
def daily(spark):
    r = np.random.default_rng(3)
    rows = []
    for sku, days in (("A", 700), ("B", 200), ("C", 40), ("D", 13)):
        for i in sorted(r.choice(np.arange(1, 800), days, replace=False).tolist()):
            rows.append((START - dt.timedelta(days=i), "W", sku, int(50 + 10 * np.sin(i / 9) + r.integers(0, 20)), 1.0))
    return spark.createDataFrame(rows, DAILY).persist()


def numpy_design(t, weekly, yearly, knots=()):
    cols = [np.ones_like(t), t]
    for per_year, order in ((365.25 / 7, weekly), (1.0, yearly)):
        for k in range(1, order + 1):
            cols += [np.sin(2 * np.pi * k * per_year * t), np.cos(2 * np.pi * k * per_year * t)]
    return np.column_stack(cols + [np.maximum(0, t - b) for b in knots])


@pytest.mark.parametrize("weekly,yearly,bends", [(3, 10, 0), (3, 0, 8), (0, 0, 0), (1, 1, 2)])
def test_fit_equals_numpy(spark, daily, weekly, yearly, bends):
    got = linear.linear_forecast(daily, START.isoformat(), 14, 14, weekly, yearly, bends).toPandas()
    pdf = daily.toPandas()
    t = np.array([(d - START).days for d in pdf.date]) / 365.25
    knots = [t.min() + (t.max() - t.min()) * 0.8 * (k + 1) / (bends + 1) for k in range(bends)]
    assert set(got.sku_id) == {"A", "B", "C"}
    for sku in "ABC":
        own = (pdf.sku_id == sku).to_numpy()
        X, y = numpy_design(t[own], weekly, yearly, knots), pdf.quantity_sold[own].to_numpy(float)
        pen = np.eye(X.shape[1])
        pen[0, 0] = pen[1, 1] = 0
        beta = np.linalg.solve(X.T @ X + pen, X.T @ y)
        sigma = np.std(y - X @ beta, ddof=1)
        yhat = numpy_design(np.arange(14) / 365.25, weekly, yearly, knots) @ beta
        f = got[got.sku_id == sku].sort_values("date")
        np.testing.assert_allclose(f.forecast, np.maximum(yhat, 0), rtol=1e-6)
        np.testing.assert_allclose(f.upper, np.maximum(yhat + 1.96 * sigma, 0), rtol=1e-6)


def test_no_python_in_the_plan(spark, daily):
    for f in (Fc.fourier_forecast(daily, "2023-12-31"), linear.bent_trend_forecast(daily, "2023-12-31"),
              Fc.trend_weekly_forecast(daily, "2023-12-31")):
        out = _io.StringIO()
        with contextlib.redirect_stdout(out):
            f.explain()
        assert not {"Python", "Pandas", "Arrow", "Window"} & {w for w in ("Python", "Pandas", "Arrow", "Window") if w in out.getvalue()}


def test_bent_trend_recovers_a_bend(spark):
    """Units rise until day 350 and fall from then on: a straight trend misses that."""
    rows = [(START - dt.timedelta(days=500 - i), "W", "A", int(100 + i if i < 350 else 450 - 2 * (i - 350)), 1.0) for i in range(500)]
    df = spark.createDataFrame(rows, DAILY)
    truth = np.array([450 - 2 * (i - 350) for i in range(500, 514)])
    bent = linear.bent_trend_forecast(df, START.isoformat(), ridge=0.01).toPandas().sort_values("date")
    straight = Fc.trend_weekly_forecast(df, START.isoformat()).toPandas().sort_values("date")
    assert np.abs(bent.forecast - truth).max() < 25 < np.abs(straight.forecast - truth).min()


def test_merged_state_equals_one_fit(spark, daily):
    once = state.weekday_sums(daily)
    cuts = [F.col("date") < "2022-06-01", F.col("date").between("2022-06-01", "2023-02-28"), F.col("date") > "2023-02-28"]
    parts = [state.weekday_sums(daily.where(c)) for c in cuts]
    rows = lambda df: sorted(map(tuple, df.select(*once.columns).collect()))
    assert rows(state.merge(state.merge(parts[2], parts[0]), parts[1])) == rows(once)      # exact, in any order
    kept = state.merge(parts[0], parts[1])
    grown = state.merge_new(kept, daily)
    assert rows(grown) == rows(once) and rows(state.merge_new(grown, daily)) == rows(once)  # a second run adds nothing
    none = once.where("false")
    assert rows(state.merge_new(none, daily)) == rows(once) and state.forecast_from_state(none, "2024-01-01").count() == 0


def test_state_forecast_equals_least_squares(spark, daily):
    got = state.forecast_from_state(state.weekday_sums(daily), START.isoformat(), 7).toPandas()
    assert set(got.sku_id) == {"A", "B", "C"}          # D has 13 rows
    pdf = daily.toPandas()
    for sku in "ABC":
        own = pdf[pdf.sku_id == sku]
        t, y = np.array([(d - START).days for d in own.date], float), own.quantity_sold.to_numpy(float)
        slope, icpt = np.polyfit(t, y, 1)
        dow = np.array([d.weekday() for d in own.date])
        res = y - icpt - slope * t
        eff = {w: res[dow == w].mean() for w in set(dow)}
        sigma = np.std(res - np.array([eff[w] for w in dow]), ddof=1)
        f = got[got.sku_id == sku].sort_values("date")
        want = np.array([icpt + slope * h + eff.get((START + dt.timedelta(days=h)).weekday(), 0) for h in range(7)])
        np.testing.assert_allclose(f.forecast, np.maximum(want, 0), rtol=1e-8)
        np.testing.assert_allclose(f.upper - f.forecast, 1.96 * sigma, rtol=1e-6)


def test_rows_without_date_or_quantity_do_not_count(spark, daily):
    holes = daily.unionByName(spark.createDataFrame([(None, "W", "A", 5, 1.0), (START, "W", "A", None, 1.0)], DAILY))
    for f in (lambda d: state.weekday_sums(d), lambda d: linear.product_sums(d, "2023-12-31", 1, 0)):
        assert sorted(map(str, f(holes).collect())) == sorted(map(str, f(daily).collect()))


def test_state_query_reads_only_new_days(spark):
    got = catalog.forecast_from_state(spark, SF).count()
    assert got == catalog.trend_weekly_forecast(spark, SF).count()
