"""Linear models of the calendar per series (I1 with bends, I2), without Python.

A model is a list of terms of the day: trend, sines and cosines of the week and
the year, and hinges that let the trend bend at fixed places of the history. All
a fit needs are the sums of products of terms with each other and with the
units: one partial aggregate over the daily rows, after which a series is one
row. The penalised normal equations of that row are solved by elimination,
written as array functions (the matrix is symmetric and positive, so no pivot is
searched). Days count in years from the forecast's start; the intercept and the
trend are not penalised, the other terms are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock import S
from restock.functions.dates import as_date

YEAR = 365.25
Z95 = 1.96
BENDS = 8                  # places where a trend may bend, even steps
BENT_PART = 0.8            # of the history that they divide


def calendar_terms(t: Column, weekly: int, yearly: int, bends: list[Column] = ()) -> list[Column]:
    """The terms at ``t`` years from the start: 1, t, sine and cosine pairs, hinges."""
    out = [F.lit(1.0), t]
    for per_year, order in ((YEAR / 7, weekly), (1.0, yearly)):
        for k in range(1, order + 1):
            angle = t * (2 * math.pi * k * per_year)
            out += [F.sin(angle), F.cos(angle)]
    return out + [F.greatest(F.lit(0.0), t - b) for b in bends]


def bend_places(daily: DataFrame, start_date, bends: int = BENDS, part: float = BENT_PART) -> list[Column]:
    """Years (from the start) at which trends may bend: even steps over the first
    ``part`` of the table's history, the same for all series."""
    at = lambda f: daily.select(F.datediff(f("date"), as_date(start_date))).scalar() / YEAR
    first, last = at(F.min), at(F.max)
    return [first + (last - first) * (part * (k + 1) / (bends + 1)) for k in range(bends)]


def product_sums(daily: DataFrame, start_date, weekly: int, yearly: int, bends: list[Column] = ()) -> DataFrame:
    """(series, n, yy, xy, xx): sums of the units squared, of each term times the
    units, and of each pair of terms (row by row of the upper triangle)."""
    t = F.datediff("date", as_date(start_date)).cast("double") / YEAR
    x = calendar_terms(t, weekly, yearly, bends)
    names = [f"x{i}" for i in range(len(x))]
    seen = daily.where(F.col("date").isNotNull() & F.col("quantity_sold").isNotNull())
    rows = seen.select(*S, F.col("quantity_sold").cast("double").alias("y"), *[c.alias(a) for c, a in zip(x, names)])
    return rows.groupBy(*S).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y") * F.col("y")).alias("yy"),
        F.array(*[F.sum(F.col(a) * F.col("y")) for a in names]).alias("xy"),
        F.array(*[F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]).alias("xx"))


def solved(sums: DataFrame, size: int, ridge: float, free: int = 2) -> DataFrame:
    """``sums`` with ``beta``, the penalised fit, and ``sigma``, the deviation of
    what is left; the first ``free`` terms are not penalised."""
    at = lambda i, j: min(i, j) * size - min(i, j) * (min(i, j) - 1) // 2 + abs(i - j)
    matrix = ", ".join("array(" + ", ".join([f"xx[{at(i, j)}]" + (f" + {ridge}D" if i == j and i >= free else "") for j in range(size)]
                                            + [f"xy[{i}]"]) + ")" for i in range(size))
    # one column after the other is cleared from the rows below its own, then the terms follow from the last to the first
    cleared = ("transform(m, (row, i) -> if(i <= k or m[k][k] = 0, row, transform(array(row[k] / m[k][k]), "
               "f -> zip_with(row, m[k], (a, b) -> a - b * f))[0]))")
    down = f"aggregate(sequence(0, {size - 1}), array({matrix}), (m, k) -> {cleared})"
    known = f"aggregate(zip_with(slice(t[k], k + 2, {size - 1} - k), q, (a, b) -> a * b), 0D, (x, y) -> x + y)"
    beta = (f"transform(array({down}), t -> aggregate(sequence({size - 1}, 0, -1), cast(array() as array<double>), "
            f"(q, k) -> concat(array(if(t[k][k] = 0, 0D, (t[k][{size}] - {known}) / t[k][k])), q)))[0]")
    fit = sums.withColumn("beta", F.expr(beta))
    # by the normal equations, the squares of what is left need no second look at the rows
    explained = "aggregate(zip_with(q, xy, (b, c) -> b * c), 0D, (a, v) -> a + v)"
    penalty = f"aggregate(slice(q, {free + 1}, {size - free}), 0D, (a, b) -> a + {ridge}D * b * b)" if size > free else "0D"
    rest = f"transform(array(beta), q -> yy - {explained} - {penalty})[0]"
    return fit.withColumn("sigma", F.when(F.col("n") > 1, F.sqrt(F.greatest(F.expr(rest), F.lit(0.0)) / (F.col("n") - 1))).otherwise(0.0))


def linear_forecast(daily: DataFrame, start_date, horizon: int = 14, min_rows: int = 14, weekly: int = 3, yearly: int = 10,
                    bends: int = 0, ridge: float = 1.0, name: str = "fourier") -> DataFrame:
    """Forecast with a 95 % band of the series with ``min_rows`` rows."""
    places = bend_places(daily, start_date, bends) if bends else []
    sums = product_sums(daily, start_date, weekly, yearly, places).where(F.col("n") >= min_rows)
    size = 2 + 2 * (weekly + yearly) + bends
    fit = solved(sums, size, ridge).select(*S, "beta", "sigma")
    start = as_date(start_date)
    ahead = fit.withColumn("date", F.explode(F.sequence(start, F.date_add(start, horizon - 1))))
    # a column first: sub-queries may not stand inside array functions
    ahead = ahead.withColumn("x", F.array(*calendar_terms(F.datediff("date", start).cast("double") / YEAR, weekly, yearly, places)))
    ahead = ahead.withColumn("yhat", F.aggregate(F.zip_with("beta", "x", lambda b, v: b * v), F.lit(0.0), lambda a, v: a + v))
    yhat, wide = F.col("yhat"), Z95 * F.col("sigma")
    return ahead.select("date", *S, F.greatest(yhat, F.lit(0.0)).alias("forecast"), F.greatest(yhat - wide, F.lit(0.0)).alias("lower"),
                        F.greatest(yhat + wide, F.lit(0.0)).alias("upper"), F.lit(name).alias("model_type"))


def bent_trend_forecast(daily: DataFrame, start_date, horizon: int = 14, min_rows: int = 30, bends: int = BENDS, ridge: float = 1.0) -> DataFrame:
    """Trend with bends and weekly terms (I1): the trend goes on as it last went."""
    return linear_forecast(daily, start_date, horizon, min_rows, 3, 0, bends, ridge, "bent_trend")
