"""Referential integrity, key sets and declared rules (A13, C5, D-3, G1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock import schemas


def integrity_report(sales: DataFrame, inventory: DataFrame,
                     warehouses: DataFrame, skus: DataFrame) -> DataFrame:
    """Orphan warehouse and SKU keys of sales and inventory.

    Each fact is read once and summed by (warehouse, SKU) before anything
    moves; both key checks start from these sums, and one anti-join against
    the keys of both dimensions finds the orphans. A fact may carry the number
    of rows it stands for as ``n_rows``. Orphans are reported, not fatal.
    """
    cells = []
    for name, fact in (("sales_history", sales), ("inventory_snapshot", inventory)):
        n = F.sum("n_rows") if "n_rows" in fact.columns else F.count(F.lit(1))
        cells.append(fact.groupBy("warehouse_id", "sku_id").agg(n.cast("long").alias("n_rows"))
                     .withColumn("table_name", F.lit(name)))
    both = cells[0].unionByName(cells[1])
    keys = both.select("table_name", "n_rows", F.explode(F.array(*[
        F.struct(F.lit(k).alias("column_name"), F.col(k).alias("bad_key")) for k in ("warehouse_id", "sku_id")])).alias("k"))
    sums = (keys.select("table_name", "k.column_name", "k.bad_key", "n_rows").where(F.col("bad_key").isNotNull())
            .groupBy("table_name", "column_name", "bad_key").agg(F.sum("n_rows").alias("n_rows")))
    known = (warehouses.select(F.lit("warehouse_id").alias("column_name"), F.col("warehouse_id").alias("bad_key"))
             .unionByName(skus.select(F.lit("sku_id").alias("column_name"), F.col("sku_id").alias("bad_key"))))
    return sums.join(known, ["column_name", "bad_key"], "left_anti").select(
        "table_name", "column_name", "bad_key", "n_rows")


def rule_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, column_name, checked, violations) of the declared keys and
    domains (A13), one row a rule, rules that hold included.

    A table is read once for its required and not-negative columns: all its
    counts are one partial aggregate of a row. Keys are counted by a partial
    aggregate on the key (a key held by a third of the rows is summed before it
    travels); ``violations`` are the rows beyond the first of each key. A null
    in a key violates the required rule and is not compared with others."""
    parts = []
    for name, df in tables.items():
        key = schemas.KEYS.get(name, [])
        rules = [("required", c, F.col(c).isNull()) for c in [*key, *schemas.REQUIRED.get(name, [])] if c in df.columns]
        rules += [("not_negative", c, F.col(c) < 0) for c in schemas.NOT_NEGATIVE.get(name, []) if c in df.columns]
        if rules:
            one = df.agg(F.count(F.lit(1)).alias("checked"), *[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(rules)])
            each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name"), F.col(f"v{i}").alias("violations"))
                                       for i, (r, c, _) in enumerate(rules)]))
            parts.append(one.select(F.lit(name).alias("table_name"), "checked", each.alias("r")).select("table_name", "r.rule", "r.column_name", "checked", "r.violations"))
        if key and set(key) <= set(df.columns):
            groups = df.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            parts.append(groups.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("checked"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations"))
                         .select(F.lit(name).alias("table_name"), F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column_name"), "checked", "violations"))
    return reduce(DataFrame.unionByName, parts)


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct key tuples (D-3)."""
    return df.select(*keys).distinct()
