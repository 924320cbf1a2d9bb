"""Daily aggregation and window features against pandas (D-1, E-1..E-5)."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest

from restock.operators import features as Fe


def pandas_features(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("date").copy()
    q = g["quantity_sold"]
    g["rolling_7d_mean"] = q.rolling(7, min_periods=1).mean()
    g["rolling_7d_std"] = q.rolling(7, min_periods=1).std().fillna(0)
    g["rolling_28d_mean"] = q.rolling(28, min_periods=1).mean()
    g["rolling_28d_std"] = q.rolling(28, min_periods=1).std().fillna(0)
    for n in (1, 7, 28):
        g[f"lag_{n}d"] = q.shift(n).fillna(0)
    d = pd.to_datetime(g["date"])
    g["day_of_week"] = d.dt.dayofweek
    g["is_promotion"] = (q > q.mean() + 2 * q.std()).astype(int)
    return g


@pytest.fixture(scope="module")
def daily(spark):
    rng = np.random.default_rng(7)
    rows = []
    start = dt.date(2020, 1, 1)
    # one-row series, 9-row series, 60-row series with date gaps and a spike
    rows.append((start, "W1", "A", 5, 1.0))
    for i in range(9):
        rows.append((start + dt.timedelta(days=i), "W1", "B", int(rng.integers(1, 20)), 1.0))
    day = 0
    for i in range(60):
        day += int(rng.integers(1, 4))
        q = 500 if i == 30 else int(rng.integers(1, 30))
        rows.append((start + dt.timedelta(days=day), "W2", "A", q, 2.0))
    return spark.createDataFrame(rows, "date date, warehouse_id string, sku_id string, "
                                       "quantity_sold long, revenue double")


def test_features_match_pandas(spark, daily):
    got = Fe.rolling_features(daily).toPandas().sort_values(["warehouse_id", "sku_id", "date"])
    exp = pd.concat([pandas_features(g) for _, g in
                     daily.toPandas().groupby(["warehouse_id", "sku_id"])])
    exp = exp.sort_values(["warehouse_id", "sku_id", "date"])
    for c in ["rolling_7d_mean", "rolling_7d_std", "rolling_28d_mean", "rolling_28d_std",
              "lag_1d", "lag_7d", "lag_28d", "day_of_week", "is_promotion"]:
        np.testing.assert_allclose(got[c].to_numpy(float), exp[c].to_numpy(float), atol=1e-9,
                                   err_msg=c)
    assert got.loc[got.quantity_sold == 500, "is_promotion"].tolist() == [1]


def test_daily_sales_sums_and_drops_null_keys(spark):
    d = dt.date(2020, 1, 1)
    sales = spark.createDataFrame(
        [(d, "W", "A", 2, 1.0), (d, "W", "A", 3, 2.0), (d, None, "A", 9, 9.0)],
        "date date, warehouse_id string, sku_id string, quantity_sold long, revenue double")
    out = Fe.daily_sales(sales).collect()
    assert [(r.warehouse_id, r.quantity_sold, r.revenue) for r in out] == [("W", 5, 3.0)]


def test_one_window_exchange(spark, daily, capsys):
    # all windows share the series partitioning: at most one shuffle
    Fe.rolling_features(daily).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") <= 1


def test_split_and_latest(spark, daily):
    s = Fe.chronological_split(daily).toPandas()
    w2 = s[s.sku_id.eq("A") & s.warehouse_id.eq("W2")]
    assert w2.is_train.sum() == 48 and len(w2) == 60
    last = Fe.latest_features(Fe.rolling_features(daily)).toPandas()
    assert len(last) == 3
