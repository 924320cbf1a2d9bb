"""Boosted-tree demand forecast.

``gbt_forecast`` is a direct model: a training row is a pair of days of one
series, what was known on the first and the units of the second, with the days
between them as a feature. So the whole horizon is one transform of one row a
series and day, and no prediction waits for another. Trees are pooled over all
series but know them by their mean units: of the warehouse, the SKU and the
series, taken over the training part and, for training rows, over the other
folds of days only (no row sees its own units). The means are small aggregates
joined by key.

``gbt_recursive_forecast`` is the model's own way, day after day. One pooled ``GBTRegressor`` is trained over all series (Spark ML trains on
the JVM from the distributed feature table) instead of one model per
series. Early stopping watches a validation flag: the last 20 % of each
series, by the chronological split (fixes Q15, which watched training data).
The promotion flag is left out of the features: it is computed from the
whole series, future included (Q14).

Prediction is recursive over the horizon: the feature row of day d takes
the calendar of day d and lag_1d = the prediction of day d-1 (the first day
uses the last observed units); the other lags and rolling statistics stay
at their last observed values. Each day is one distributed transform of a
one-row-per-series frontier; the lineage is cut with a reliable
``checkpoint()`` (into spark.checkpoint.dir) after every day by default.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock import S
from restock.functions.costs import forecast_band
from restock.functions.dates import as_date
from restock.session import checkpoint_dir, materialize
from restock.operators.features import FEATURE_COLUMNS, calendar, chronological_split

TREE_FEATURES = [c for c in FEATURE_COLUMNS if c != "is_promotion"]
CALENDAR_COLUMNS = ["day_of_week", "day_of_month", "month", "is_weekend", "is_holiday_season",
                    "is_summer"]


def train_gbt(features: DataFrame, min_rows: int = 30, max_iter: int = 100,
              step_size: float = 0.05, max_depth: int = 5, subset: str = "0.9",
              seed: int = 42):
    """Fit the pooled model on series with >= min_rows rows."""
    split = chronological_split(features).where(F.col("series_rows") >= min_rows)
    data = VectorAssembler(inputCols=TREE_FEATURES, outputCol="features",
                           handleInvalid="keep").transform(
        split.select(*TREE_FEATURES, F.col("quantity_sold").cast("double").alias("label"),
                     (~F.col("is_train")).alias("is_validation")))
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter,
                       stepSize=step_size, maxDepth=max_depth, featureSubsetStrategy=subset,
                       validationIndicatorCol="is_validation", seed=seed)
    return gbt.fit(data)


def training_sums(features: DataFrame, min_rows: int = 30) -> DataFrame:
    """Rows, label sum and feature sums of the training and validation parts."""
    split = chronological_split(features).where(F.col("series_rows") >= min_rows)
    return split.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity_sold").alias("label"),
                                         *[F.sum(c).alias(c) for c in TREE_FEATURES])


def gbt_error(features: DataFrame, min_rows: int = 30, max_iter: int = 100) -> DataFrame:
    """MAE and RMSE per series of the trees on its last 20 % of rows, which take
    no part in the training (I7, D-16)."""
    rows = chronological_split(features).where(F.col("series_rows") >= min_rows)
    assembler = VectorAssembler(inputCols=TREE_FEATURES, outputCol="features", handleInvalid="keep")
    fit_rows = rows.where("is_train").select(*TREE_FEATURES, F.col("quantity_sold").cast("double").alias("label"))
    model = GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, stepSize=0.05, maxDepth=5,
                         featureSubsetStrategy="0.9", seed=42).fit(assembler.transform(fit_rows))
    tested = model.transform(assembler.transform(rows.where("not is_train").select(*S, "quantity_sold", *TREE_FEATURES)))
    err = F.col("quantity_sold") - F.greatest(F.col("prediction"), F.lit(0.0))
    return tested.groupBy(*S).agg(F.count(F.lit(1)).alias("n_test"), F.avg(F.abs(err)).alias("mae"),
                                  F.sqrt(F.avg(err * err)).alias("rmse"))


def gbt_recursive_forecast(features: DataFrame, start_date, horizon: int = 14, min_rows: int = 30,
                           max_iter: int = 100, checkpoint_every: int = 1, only: DataFrame | None = None) -> DataFrame:
    """Recursive multi-day forecast with a +-20 % band.

    The pooled model trains on series of ``min_rows`` rows and predicts those,
    or the series (warehouse_id, sku_id) of ``only``, whatever their length.
    """
    checkpoint_dir(features.sparkSession)
    model = train_gbt(features, min_rows=min_rows, max_iter=max_iter)
    rows = (features.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*S))).where(F.col("_n") >= min_rows)
            if only is None else features.join(only.select(*S).distinct(), S, "left_semi"))
    last = (rows.groupBy(*S).agg(F.max_by(F.struct("quantity_sold", *TREE_FEATURES), "date")
                                 .alias("_l"))
            .select(*S, F.col("_l.quantity_sold").cast("double").alias("prev"),
                    *[F.col(f"_l.{c}").alias(c) for c in TREE_FEATURES]))
    assembler = VectorAssembler(inputCols=TREE_FEATURES, outputCol="features",
                                handleInvalid="keep")
    start = as_date(start_date)
    frontier = last
    outputs = []
    for i in range(horizon):
        day = F.date_add(start, i)
        row = frontier.drop(*CALENDAR_COLUMNS, "lag_1d").select(
            "*", *calendar(day), F.col("prev").alias("lag_1d"))
        pred = model.transform(assembler.transform(row)).withColumn("date", day)
        pred = pred.withColumn("prediction", F.greatest(F.col("prediction"), F.lit(0.0)))
        step = pred.select(*S, "date", "prediction", *[c for c in TREE_FEATURES])
        if checkpoint_every and (i + 1) % checkpoint_every == 0:
            step = step.checkpoint()
        outputs.append(step.select("date", *S, "prediction"))
        frontier = step.select(*S, F.col("prediction").alias("prev"),
                               *[c for c in TREE_FEATURES])
    out = outputs[0]
    for o in outputs[1:]:
        out = out.unionByName(o)
    p, lo, hi = forecast_band(F.col("prediction"))
    return out.select("date", *S, p.alias("forecast"), lo.alias("lower"), hi.alias("upper"),
                      F.lit("gbt").alias("model_type"))


# ------------------------------------------------------- direct model ----
FOLDS = 5
PRIOR = 10.0               # rows that the overall mean counts for beside a key's own
KEYS = {"mean_warehouse": ["warehouse_id"], "mean_sku": ["sku_id"], "mean_series": list(S)}
KNOWN = [c for c in TREE_FEATURES if c not in CALENDAR_COLUMNS]
DIRECT_FEATURES = [*KNOWN, "last_units", "step", *CALENDAR_COLUMNS, *KEYS]


def _fold(day: str) -> Column:
    return F.pmod(F.unix_date(day), F.lit(FOLDS)).cast("int")


def key_means(units: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fold, sum, n): sums of ``units`` (date, quantity_sold) per key and
    fold left out; fold null holds the sums over all."""
    per = units.groupBy(*keys, _fold("date").alias("fold")).agg(F.sum("quantity_sold").alias("s"), F.count(F.lit(1)).alias("n"))
    all_ = per.groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.collect_list(F.struct("fold", "s", "n")).alias("own"))
    left = all_.select(*keys, "s", "n", F.explode(F.expr(f"transform(sequence(0, {FOLDS - 1}), f -> struct(f as fold, "
                                                     "get(filter(own, o -> o.fold = f), 0) as o))")).alias("f"))
    return (left.select(*keys, F.col("f.fold").alias("fold"), (F.col("s") - F.coalesce("f.o.s", F.lit(0))).alias("s"),
                        (F.col("n") - F.coalesce("f.o.n", F.lit(0))).alias("n"))
            .unionByName(all_.select(*keys, F.lit(None).cast("int").alias("fold"), "s", "n")))


def with_key_means(rows: DataFrame, units: DataFrame, fold) -> DataFrame:
    """``rows`` with the mean units of their keys: without fold ``fold``, or over
    all where it is null; keys that ``units`` does not know get the overall mean."""
    mean = units.select(F.avg("quantity_sold")).scalar()
    out = rows.withColumn("_f", fold).withColumn("_m", F.coalesce(mean, F.lit(0.0)))
    for name, keys in KEYS.items():
        m = key_means(units, keys).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("fold").alias("_fold"), F.col("s").alias("_s"), F.col("n").alias("_n"))
        on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.coalesce("_f", F.lit(-1)) == F.coalesce("_fold", F.lit(-1))]
        out = (out.join(m, on, "left")
               .withColumn(name, (F.coalesce("_s", F.lit(0)) + PRIOR * F.col("_m")) / (F.coalesce("_n", F.lit(0)) + PRIOR))
               .drop(*[f"_{k}" for k in keys], "_fold", "_s", "_n"))
    return out.drop("_f", "_m")


def training_pairs(features: DataFrame, horizon: int = 14, min_rows: int = 30) -> DataFrame:
    """One row a day of a series that had a row 1 to ``horizon`` days before: what
    was known then, the days since, and the units (``label``). Each row is the
    first day of one pair, its distance drawn by a hash of the row."""
    split = chronological_split(features).where(F.col("series_rows") >= min_rows)
    known = split.select(*S, F.col("date").alias("_from"), F.col("quantity_sold").cast("double").alias("last_units"), *KNOWN)
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", *S, F.col("_from").cast("string"))), 1, 7), 16, 10).cast("long")
    known = known.withColumn("step", (1 + draw % horizon).cast("int"))
    target = split.select(*S, "date", F.col("quantity_sold").cast("double").alias("label"), "is_train")
    return (known.withColumn("date", F.expr("date_add(_from, step)")).drop("_from").join(target, [*S, "date"])
            .select("*", *calendar(F.col("date"))))


def encoded_pairs(features: DataFrame, units: DataFrame, horizon: int = 14, min_rows: int = 30) -> DataFrame:
    """The training pairs with the mean units of their keys, for training rows without their own fold."""
    pairs = training_pairs(features, horizon, min_rows)
    return with_key_means(pairs, units, F.when(F.col("is_train"), _fold("date")))


def pair_sums(features: DataFrame, horizon: int = 14, min_rows: int = 30) -> DataFrame:
    """Rows, units and feature sums of the training and validation pairs by their distance."""
    sums = [F.sum(c).alias(c) for c in DIRECT_FEATURES if c not in ("step", *CALENDAR_COLUMNS)]
    pairs = encoded_pairs(features, _train_units(features), horizon, min_rows)
    return pairs.groupBy("is_train", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("label"), *sums)


def train_direct(features: DataFrame, units: DataFrame, horizon: int = 14, min_rows: int = 30, max_iter: int = 100, seed: int = 42):
    """The pooled direct model; the last 20 % of each series' rows stop the training early.
    The pairs are written once, as the training reads them again for every tree."""
    pairs = encoded_pairs(features, units, horizon, min_rows).select(*DIRECT_FEATURES, "label", "is_train")
    pairs = materialize(pairs, "tree-pairs")
    data = VectorAssembler(inputCols=DIRECT_FEATURES, outputCol="features", handleInvalid="keep").transform(
        pairs.select(*DIRECT_FEATURES, "label", (~F.col("is_train")).alias("is_validation")))
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, stepSize=0.05, maxDepth=5,
                       featureSubsetStrategy="0.9", validationIndicatorCol="is_validation", seed=seed)
    return gbt.fit(data)


def _train_units(features: DataFrame) -> DataFrame:
    return chronological_split(features).where("is_train").select(*S, "date", "quantity_sold")


def gbt_forecast(features: DataFrame, start_date, horizon: int = 14, min_rows: int = 30, max_iter: int = 100,
                 only: DataFrame | None = None) -> DataFrame:
    """Direct multi-day forecast with a +-20 % band (I4, H20), one transform.

    The pooled model trains on series of ``min_rows`` rows and predicts those,
    or the series (warehouse_id, sku_id) of ``only``, whatever their length.
    """
    units = materialize(_train_units(features), "tree-units")
    model = train_direct(features, units, horizon, min_rows, max_iter)
    rows = (features.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*S))).where(F.col("_n") >= min_rows)
            if only is None else features.join(only.select(*S).distinct(), S, "left_semi"))
    last = rows.groupBy(*S).agg(F.max_by(F.struct("date", "quantity_sold", *KNOWN), "date").alias("_l"))
    start = as_date(start_date)
    ahead = last.select(*S, "_l", F.explode(F.sequence(start, F.date_add(start, horizon - 1))).alias("date"))
    ahead = ahead.select(*S, "date", F.col("_l.quantity_sold").cast("double").alias("last_units"), *[F.col(f"_l.{c}").alias(c) for c in KNOWN],
                         F.datediff("date", "_l.date").alias("step"), *calendar(F.col("date")))
    ahead = with_key_means(ahead, units, F.lit(None).cast("int"))
    out = model.transform(VectorAssembler(inputCols=DIRECT_FEATURES, outputCol="features", handleInvalid="keep").transform(ahead))
    p, lo, hi = forecast_band(F.col("prediction"))
    return out.select("date", *S, p.alias("forecast"), lo.alias("lower"), hi.alias("upper"), F.lit("gbt").alias("model_type"))


def holdout_error(features: DataFrame, horizon: int = 14, min_rows: int = 30, max_iter: int = 100) -> DataFrame:
    """(model, n, mae, rmse) of both ways over the last ``horizon`` days, which
    take no part in the training: real forecasts, no row of these days is known."""
    cut = features.select(F.date_sub(F.max("date"), horizon - 1)).first()[0]
    before, after = features.where(F.col("date") < F.lit(cut)), features.where(F.col("date") >= F.lit(cut)).select("date", *S, "quantity_sold")
    out = []
    for name, forecast in (("direct", gbt_forecast), ("recursive", gbt_recursive_forecast)):
        e = F.col("quantity_sold") - F.col("forecast")
        out.append(forecast(before, cut, horizon, min_rows, max_iter).join(after, ["date", *S])
                   .agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse")))
    return out[0].unionByName(out[1])
