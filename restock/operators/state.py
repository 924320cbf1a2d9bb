"""Fitted models that last (A9, I6): sums per series and weekday.

The trend + weekday model depends on the history only through six sums per
series and weekday (rows, days, days squared, units, days x units, units
squared). They are kept as a table, at most seven rows a series; new days are
added to them and no day is read twice. Days count from 1970-01-01 and sums of
whole units are whole numbers, so merges are exact in any order. A forecast
reads the table alone.

The sums are a partial aggregate: of the daily rows only seven a series travel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock import S
from restock.functions.dates import as_date

SUMS = ["n", "t", "tt", "y", "ty", "yy"]
Z95 = 1.96


def weekday_sums(daily: DataFrame) -> DataFrame:
    """The state of a daily table: one row a series and weekday that has rows.
    Rows without a date or quantity are no observations."""
    t, y = F.unix_date("date").cast("long"), F.col("quantity_sold")
    seen = daily.where(F.col("date").isNotNull() & y.isNotNull())
    return seen.groupBy(*S, F.weekday("date").alias("dow")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(t).alias("t"), F.sum(t * t).alias("tt"), F.sum(y).alias("y"),
        F.sum(t * y).alias("ty"), F.sum(y * y).alias("yy"), F.max("date").alias("last_date"))


def merge(*states: DataFrame) -> DataFrame:
    """The state of all days of several states that share no day of a series."""
    return (reduce(DataFrame.unionByName, states).groupBy(*S, "dow")
            .agg(*[F.sum(c).alias(c) for c in SUMS], F.max("last_date").alias("last_date")))


def merge_new(state: DataFrame, daily: DataFrame) -> DataFrame:
    """The state with the days after its last one added; days it has seen are
    left out, so running the same day's job again changes nothing."""
    last = state.select(F.max("last_date")).scalar()
    return merge(state, weekday_sums(daily.where(last.isNull() | (F.col("date") > last))))


def fitted(state: DataFrame, origin, min_rows: int = 14) -> DataFrame:
    """Per series: rows, slope and intercept (days from ``origin``), weekday
    effects and the deviation of what is left."""
    d = F.unix_date(as_date(origin)).cast("long")
    n, t, tt, y, ty = (F.col(c) for c in SUMS[:5])
    moved = state.select(*S, "dow", "n", "y", "yy", (t - n * d).alias("t"), (tt - 2 * d * t + n * d * d).alias("tt"), (ty - d * y).alias("ty"))
    one = moved.groupBy(*S).agg(*[F.sum(c).cast("double").alias(c) for c in SUMS],
                                F.collect_list(F.struct("dow", *[F.col(c).cast("double").alias(c) for c in SUMS])).alias("w"))
    spread = n * tt - t * t
    one = one.where(n >= min_rows).withColumn("slope", F.when(spread > 0, (n * ty - t * y) / spread).otherwise(0.0))
    one = one.withColumn("intercept", (y - F.col("slope") * t) / n)
    a, b = F.col("intercept"), F.col("slope")

    def effect(w: Column) -> Column:
        return (w["y"] - w["n"] * a - b * w["t"]) / w["n"]

    def left(w: Column) -> Column:
        return (w["yy"] - 2 * a * w["y"] - 2 * b * w["ty"] + w["n"] * a * a + 2 * a * b * w["t"] + b * b * w["tt"]
                - w["n"] * effect(w) * effect(w))

    rest = F.aggregate("w", F.lit(0.0), lambda s, w: s + left(w))
    return one.select(*S, F.col("n").cast("long").alias("n"), "slope", "intercept",
                      F.map_from_entries(F.transform("w", lambda w: F.struct(w["dow"], effect(w)))).alias("effects"),
                      F.when(n > 1, F.sqrt(F.greatest(rest, F.lit(0.0)) / (n - 1))).otherwise(0.0).alias("sigma"))


def forecast_from_state(state: DataFrame, start_date, horizon: int = 14, min_rows: int = 14) -> DataFrame:
    """Trend + weekday forecast with a 95 % band, clipped at 0, of the series with ``min_rows`` rows."""
    start = as_date(start_date)
    ahead = fitted(state, start, min_rows).withColumn("date", F.explode(F.sequence(start, F.date_add(start, horizon - 1))))
    t = F.datediff("date", start).cast("double")
    yhat = (F.col("intercept") + F.col("slope") * t
            + F.coalesce(F.element_at(F.col("effects"), F.weekday("date")), F.lit(0.0)))
    wide = Z95 * F.col("sigma")
    return ahead.select("date", *S, F.greatest(yhat, F.lit(0.0)).alias("forecast"), F.greatest(yhat - wide, F.lit(0.0)).alias("lower"),
                        F.greatest(yhat + wide, F.lit(0.0)).alias("upper"), F.lit("trend_weekly").alias("model_type"))
