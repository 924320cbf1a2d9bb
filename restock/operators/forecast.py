"""Demand forecasts (I1, I2, I5-I7, B2, B4, B9, B10, D-9, D-16, H20).

The seasonal model is a least-squares trend per series, a mean residual per
weekday, and a 95 % band from the deviation of what is left; it is fitted from
the sums of ``restock.operators.state`` (one partial aggregate, seven rows a
series). Only the error report needs fitted rows: its windows are partitioned by
the series keys. Future dates come from ``explode(sequence(...))`` per series.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock import S
from restock.functions.costs import forecast_band
from restock.functions.dates import as_date
from restock.operators.linear import linear_forecast
from restock.operators.state import forecast_from_state, weekday_sums

FORECAST_COLUMNS = ["date", "warehouse_id", "sku_id", "forecast", "lower", "upper", "model_type"]


def _fit(daily: DataFrame, start_date: str, min_rows: int, train=None) -> DataFrame:
    """Per-row fitted trend, weekday effect and residual deviation.

    ``train``: optional boolean column; only those rows fit the model.
    """
    k = Window.partitionBy(*S)
    kd = Window.partitionBy(*S, "dow")
    start = as_date(start_date)
    use = F.lit(True) if train is None else train
    base = daily.select(*S, "date", F.col("quantity_sold").cast("double").alias("y"),
                        F.datediff("date", start).cast("double").alias("t"),
                        F.weekday("date").alias("dow"), use.alias("_fit_row"))
    fit_row = F.col("_fit_row")
    y = F.when(fit_row, F.col("y"))
    t = F.when(fit_row, F.col("t"))
    base = base.select("*", F.regr_slope(y, t).over(k).alias("slope"),
                       F.regr_intercept(y, t).over(k).alias("intercept"),
                       F.count(F.when(fit_row, 1)).over(k).alias("n_fit"))
    r = F.col("y") - (F.col("intercept") + F.col("slope") * F.col("t"))
    base = base.select("*", F.avg(F.when(F.col("_fit_row"), r)).over(kd).alias("dow_effect"))
    r2 = r - F.col("dow_effect")
    base = base.select("*", F.coalesce(F.stddev_samp(F.when(F.col("_fit_row"), r2)).over(k),
                                       F.lit(0.0)).alias("sigma"))
    return base.where(F.col("n_fit") >= min_rows)


def trend_weekly_forecast(daily: DataFrame, start_date: str, horizon: int = 14,
                          min_rows: int = 14) -> DataFrame:
    """Trend + weekday seasonality with a 95 % band, series with >= min_rows.

    The point forecast and band are clipped at 0 (demand is not negative).
    """
    return forecast_from_state(weekday_sums(daily), start_date, horizon, min_rows)


def flat_forecast(daily_features: DataFrame, start_date: str, horizon: int = 14) -> DataFrame:
    """Last 28-row mean repeated over the horizon (the stand-in model)."""
    last = daily_features.groupBy(*S).agg(F.max_by("rolling_28d_mean", "date").alias("_m"))
    start = as_date(start_date)
    m = F.round(F.col("_m"), 6)
    return last.select(F.explode(F.sequence(start, F.date_add(start, horizon - 1))).alias("date"),
                       *S, m.alias("forecast"), m.alias("lower"), m.alias("upper"),
                       F.lit("rolling_mean").alias("model_type"))


def combine_forecasts(preferred: DataFrame, fallback: DataFrame) -> DataFrame:
    """Preferred model's rows per series, the fallback only where it has none.

    Each row keeps the name of the model that produced it.
    """
    missing = fallback.join(preferred.select(*S).distinct(), S, "left_anti")
    return preferred.select(*FORECAST_COLUMNS).unionByName(missing.select(*FORECAST_COLUMNS))


def forecast_lookup(forecasts: DataFrame, start_date: str, horizon: int,
                    warehouse_id: str | None = None, sku_id: str | None = None,
                    model_type: str | None = None) -> DataFrame:
    """Stored forecast from ``start_date``, first ``horizon`` days per series.

    Reads the forecast table; nothing is re-fitted per request. With a
    warehouse / SKU given it is a point lookup (filters reach the scan).
    """
    f = forecasts.where(F.col("date") >= as_date(start_date))
    if warehouse_id is not None:
        f = f.where(F.col("warehouse_id") == warehouse_id)
    if sku_id is not None:
        f = f.where(F.col("sku_id") == sku_id)
    if model_type is not None:
        f = f.where(F.col("model_type") == model_type)
    rn = F.row_number().over(Window.partitionBy(*S).orderBy("date"))
    out = f.withColumn("_rn", rn).where(F.col("_rn") <= horizon).drop("_rn")
    # a point lookup is one short series: return it in date order (F2)
    return out.orderBy("date") if warehouse_id is not None and sku_id is not None else out


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    """Total, daily mean and daily max per series (D-9, L2)."""
    return forecasts.groupBy(*S).agg(F.sum("forecast").alias("total_forecast"),
                                     F.avg("forecast").alias("avg_daily"),
                                     F.max("forecast").alias("max_daily"))


def forecast_error(daily: DataFrame, start_date: str, train_share: float = 0.8,
                   min_rows: int = 30) -> DataFrame:
    """MAE and RMSE per series on its last 20 % of rows (I7, B9, D-16).

    The seasonal model is fitted on the first floor(n * 0.8) rows only and
    scored on the rest; series shorter than ``min_rows`` are skipped.
    """
    o = Window.partitionBy(*S).orderBy("date")
    k = Window.partitionBy(*S)
    d = (daily.withColumn("_rn", F.row_number().over(o))
         .withColumn("_n", F.count(F.lit(1)).over(k))
         .where(F.col("_n") >= min_rows))
    train = F.col("_rn") <= F.floor(F.col("_n") * F.lit(train_share))
    d = d.withColumn("_train", train)
    fitted = _fit(d, start_date, 1, F.col("_train"))
    pred = F.col("intercept") + F.col("slope") * F.col("t") + F.coalesce(F.col("dow_effect"), F.lit(0.0))
    test = fitted.where(~F.col("_fit_row"))
    err = F.col("y") - pred
    return test.groupBy(*S).agg(F.count(F.lit(1)).alias("n_test"),
                                F.avg(F.abs(err)).alias("mae"),
                                F.sqrt(F.avg(err * err)).alias("rmse"))


# ---------------------------------------------------------------- I2 -----
def fourier_sums(daily: DataFrame, start_date, weekly_order: int = 3) -> DataFrame:
    """Per series: rows, and the sums of units and of units times each weekly term."""
    t = F.datediff("date", as_date(start_date)).cast("double")
    y = F.col("quantity_sold").cast("double")
    terms = []
    for k in range(1, weekly_order + 1):
        ang = F.lit(2 * math.pi * k / 7.0) * t
        terms += [F.sum(y * F.sin(ang)).alias(f"sin_{k}"), F.sum(y * F.cos(ang)).alias(f"cos_{k}")]
    return daily.groupBy(*S).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("units"), F.sum(y * t).alias("units_t"), *terms)


def fourier_forecast(daily: DataFrame, start_date, horizon: int = 14,
                     min_rows: int = 14, weekly_order: int = 3, yearly_order: int = 10,
                     ridge: float = 1.0) -> DataFrame:
    """Trend + weekly and yearly Fourier terms per series, ridge-fitted.

    Intercept and trend are not penalised; the seasonal terms are, so a short
    history gets small yearly terms (``yearly_order=0`` leaves them out).
    """
    return linear_forecast(daily, start_date, horizon, min_rows, weekly_order, yearly_order, ridge=ridge)


def band(pred_col) -> list:
    """Point forecast >= 0 with a +-20 % band (H20) as three named columns."""
    p, lo, hi = forecast_band(pred_col)
    return [p.alias("forecast"), lo.alias("lower"), hi.alias("upper")]
