"""Readers and writers.

The stages' tables that are replaced whole are versioned: the data go into a new
folder below ``versions``, and only when all of it is there does the table's
pointer file change, by one rename. Readers follow the pointer, so a job that
dies while writing leaves the table as it was, a job may replace the table that
it reads, and a reader that has begun keeps its version (the last ``KEPT`` stay).
"""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
from pyspark.errors import AnalysisException

from restock import schemas

log = logging.getLogger(__name__)

POINTER = "_current"       # file in a table's folder that names its version
KEPT = 2                   # versions that stay, the current one included


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and its ``Path`` class (driver side)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _pointer(spark: SparkSession, path: str) -> dict | None:
    """What a table's pointer says: its version, and how it is clustered."""
    fs, hadoop = _fs(spark, path)
    pointer = hadoop.Path(f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def current_version(spark: SparkSession, path: str) -> str:
    """The folder that a table's pointer names; the path itself where it has none."""
    told = _pointer(spark, path)
    return path if told is None else f"{path.rstrip('/')}/versions/{told['version']}"


def _load(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """A table's current version; a clustered one as a catalog table, which tells Spark so."""
    told = _pointer(spark, path)
    df = spark.read.format(fmt).load(path if told is None else f"{path.rstrip('/')}/versions/{told['version']}")
    if told is None or "buckets" not in told:
        return df
    name = f"restock_{told['version']}"
    quoted = lambda cols: ", ".join(f"`{c}`" for c in cols)
    at = f"{path.rstrip('/')}/versions/{told['version']}".replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({df._jdf.schema().toDDL()}) USING {fmt} CLUSTERED BY ({quoted(told['by'])}) "
              f"SORTED BY ({quoted(told['sorted'])}) INTO {told['buckets']} BUCKETS LOCATION '{at}'")
    return spark.table(name)


def _point_to(spark: SparkSession, root: str, version: str, **more) -> None:
    """Change the pointer in one step and drop versions that are out of use."""
    fs, hadoop = _fs(spark, root)
    draft = hadoop.Path(f"{root}/{POINTER}-{version}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"version": version, **more}).encode()))
    out.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(draft, hadoop.Path(f"{root}/{POINTER}"), options)
    old = sorted(((s.getModificationTime(), s.getPath()) for s in fs.listStatus(hadoop.Path(f"{root}/versions"))
                  if s.getPath().getName() != version), key=lambda x: x[0])
    for _, folder in old[:max(0, len(old) - KEPT + 1)]:
        spark.sql(f"DROP TABLE IF EXISTS restock_{folder.getName()}")
        fs.delete(folder, True)


def _fmt(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    p = path.rstrip("/").lower()
    return "csv" if p.endswith(".csv") else "parquet"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read one table from a file or a folder (A4, A5).

    CSV is read with the declared schema (dates parsed on read, no
    inference pass); Parquet keeps its own schema and is projected and cast
    to the declared one so downstream code sees fixed types. A folder with a
    pointer is read at the version that it names.
    """
    f = _fmt(path, fmt)
    if f == "csv":
        path = current_version(spark, path)
        # columns are matched by header name (not position); integers written
        # by float-typed writers ("23.0") go through double first
        df = spark.read.option("header", True).csv(path)
        if schema is None:
            return df

        def conv(fld):
            c = F.col(fld.name)
            if isinstance(fld.dataType, (IntegerType, LongType)):
                c = c.cast("double")
            return c.cast(fld.dataType)
    else:
        df = _load(spark, path, f)
        if schema is None:
            return df

        def conv(fld):
            return F.col(fld.name).cast(fld.dataType)
    # a warehouse table's scan order is its row order: file by file, in file order
    ordered = any(f.name == "source_ord" for f in schema.fields) and "source_ord" not in df.columns
    if ordered:
        place = Window.orderBy("_metadata.file_path", F.monotonically_increasing_id())
        df = df.withColumn("source_ord", F.row_number().over(place) - 1)
    return df.select([conv(fld).alias(fld.name) if fld.name in df.columns
                      else F.lit(None).cast(fld.dataType).alias(fld.name)
                      for fld in schema.fields])


def _malformed(raw, kind):
    """Whether a cell holds something that is no value of its type."""
    if isinstance(kind, StringType):
        return F.lit(False)
    return (F.trim(raw) != "") & _typed(raw, kind).isNull()


def _typed(raw, kind):
    c = F.trim(raw)
    if isinstance(kind, (IntegerType, LongType)):
        c = c.try_cast("double")             # "23.0", as float-typed writers have it
        return F.when(~F.isnan(c) & (F.abs(c) < 9.2e18), c).try_cast(kind)
    return raw if isinstance(kind, StringType) else c.try_cast(kind)


QUARANTINE = "table_name string, file string, column_name string, raw_value string, record string"


def read_checked(spark: SparkSession, path: str, schema: StructType, fmt: str | None = None,
                 name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) of one raw table (A1): rows with a cell that is no value
    of its declared type, without a key, or with more or fewer fields than the
    header go to the quarantine, one row a bad cell with the file, the raw value
    and the whole record; the rest are clean. Files are split, so a record is
    told by its text and not by a line number. A blank cell is null."""
    f, name = _fmt(path, fmt), name or path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
    at = current_version(spark, path)
    if f == "csv":
        header = spark.read.option("header", True).csv(at).columns
        text = StructType([StructField(c, StringType()) for c in header] + [StructField("_broken", StringType())])
        raw = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", "_broken").option("enforceSchema", True).csv(at))
    else:
        raw = spark.read.format(f).load(at)
        header = raw.columns
        raw = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in header], F.lit(None).cast("string").alias("_broken"), "_metadata")
    raw = raw.select("*", F.col("_metadata.file_path").alias("_file"))
    if any(x.name == "source_ord" for x in schema.fields) and "source_ord" not in header:
        place = Window.orderBy("_file", F.monotonically_increasing_id())
        raw = raw.withColumn("_ord", F.row_number().over(place) - 1)
    bad = []
    for x in schema.fields:
        if x.name in header:
            cell = F.col(f"`{x.name}`")
            wrong = _malformed(cell, x.dataType) if x.nullable else _malformed(cell, x.dataType) | (F.coalesce(F.trim(cell), F.lit("")) == "")
            bad.append(F.when(wrong, F.struct(F.lit(x.name).alias("column_name"), cell.alias("raw_value"))))
    bad.append(F.when(F.col("_broken").isNotNull(), F.struct(F.lit(None).cast("string").alias("column_name"), F.col("_broken").alias("raw_value"))))
    record = F.coalesce("_broken", F.to_json(F.struct(*[F.col(f"`{c}`") for c in header])))
    marked = raw.withColumn("_bad", F.array_compact(F.array(*bad)))
    clean = marked.where(F.size("_bad") == 0).select([
        _typed(F.col(f"`{x.name}`"), x.dataType).alias(x.name) if x.name in header
        else (F.col("_ord").cast(x.dataType) if x.name == "source_ord" and "_ord" in raw.columns else F.lit(None).cast(x.dataType)).alias(x.name)
        for x in schema.fields])
    quarantine = marked.where(F.size("_bad") > 0).select(
        F.lit(name).alias("table_name"), F.col("_file").alias("file"), F.explode("_bad").alias("b"), record.alias("record"))
    return clean, quarantine.select("table_name", "file", "b.column_name", "b.raw_value", "record")


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """An optional source that is absent becomes an empty frame with its schema."""
    return spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, path: str, schema: StructType,
                  fmt: str | None = None) -> DataFrame:
    try:
        df = read_table(spark, path, schema, fmt)
        df.schema  # resolves the path
        return df
    except AnalysisException:
        log.warning("table not found, using an empty one: %s", path)
        return empty_table(spark, schema)


def load_checked_tables(spark: SparkSession, in_dir: str, fmt: str = "csv") -> tuple[dict[str, DataFrame], DataFrame]:
    """The clean rows of the raw tables that are there, and the quarantine of all (A1)."""
    out, bad = {}, spark.createDataFrame([], QUARANTINE)
    for name, schema in schemas.RAW_TABLES.items():
        path = f"{in_dir.rstrip('/')}/{name}.{fmt}"
        try:
            out[name], wrong = read_checked(spark, path, schema, fmt, name)
            bad = bad.unionByName(wrong)
        except AnalysisException:
            log.warning("file not found: %s", path)
    return out, bad


def load_raw_tables(spark: SparkSession, in_dir: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The clean rows of the five raw tables; a missing one is skipped with a warning (A1)."""
    return load_checked_tables(spark, in_dir, fmt)[0]


def require_tables(tables: dict, required=tuple(schemas.REQUIRED_TABLES)) -> None:
    """Stop when a required table is missing (A2)."""
    missing = [n for n in required if n not in tables]
    if missing:
        raise ValueError(f"missing required data: {', '.join(missing)}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite", versioned: bool = False, cluster_by: list[str] | None = None, sort_by: list[str] = (),
                buckets: int | None = None) -> int:
    """Write a table and return its row count.

    The count comes from an ``Observation`` on the write itself, so no
    second job scans the result. An empty frame still writes its schema. With
    ``partition_by`` only the partitions that the frame holds are replaced, so
    earlier plans stay. ``versioned``: a Parquet table that is replaced whole gets a
    new version, which ``read_table`` finds once it is complete (a plain overwrite
    deletes first). ``cluster_by`` also lays its rows out by a key, in ``buckets``
    files (as many as there are shuffle partitions by default).
    """
    spark, root = df.sparkSession, path.rstrip("/")
    if (versioned or cluster_by) and (fmt != "parquet" or mode != "overwrite" or partition_by):
        raise ValueError("only Parquet tables that are replaced whole have versions")
    version = uuid.uuid4().hex if versioned or cluster_by else None
    obs = Observation("rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if cluster_by:
        n, order = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), [*cluster_by, *sort_by]
        (observed.repartition(n, *cluster_by).write.mode(mode).format(fmt).bucketBy(n, *cluster_by).sortBy(*order)
         .option("path", f"{root}/versions/{version}").saveAsTable(f"restock_{version}"))
        _point_to(spark, root, version, buckets=n, by=cluster_by, sorted=order)
    else:
        w.save(f"{root}/versions/{version}" if version else path)
        if version:
            _point_to(spark, root, version)
    rows = obs.get.get("rows", 0) if obs.get else 0
    log.info("saved %s: %d rows", path, rows)
    return rows


def copy_table(df: DataFrame, path: str, versioned: bool = False) -> int:
    """Pass-through copy of a cleaned dimension table."""
    return write_table(df, path, versioned=versioned)


def newest_plan(plans: DataFrame, by: str = "run_date") -> DataFrame:
    """Rows of the newest plan (A10, F7); of plans of one day the last id.

    ``by`` is a column of the plan table (``run_date``) or the hidden file
    column ``_metadata.file_modification_time`` of a file source. One
    aggregate finds the newest key, then a join keeps its rows (no sort of
    the whole table).
    """
    newest = (plans.agg(F.max(F.struct(F.col(by).alias("at"), F.col("plan_id").alias("id"))).alias("_n"))
              .select(F.col("_n.id").alias("_newest_plan")))
    return (plans.join(newest, plans["plan_id"] == newest["_newest_plan"], "inner")
            .drop("_newest_plan"))


def manifest_of(plan: DataFrame) -> DataFrame:
    """(run_date, n_rows, plan_id): one row a plan. The manifest table holds one
    tiny partition a plan beside the plan table's."""
    return plan.groupBy("plan_id").agg(F.max("run_date").alias("run_date"), F.count(F.lit(1)).alias("n_rows")).select("run_date", "n_rows", "plan_id")


def newest_by_manifest(plans: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of the newest plan (A10, F7) of a table partitioned by ``plan_id``.

    The id comes from the manifest as a sub-query, so at run time only that
    plan's partition is listed and read, however many plans there are."""
    newest = manifest.select(F.max(F.struct(F.col("run_date").alias("at"), F.col("plan_id").alias("id"))).alias("n")).select("n.id").scalar()
    return plans.where(F.col("plan_id") == newest)


def sample_export(df: DataFrame, order_by: list[str], n: int = 1000) -> DataFrame:
    """First ``n`` rows in a fixed key order (A11, F4): a top-k, not a full sort."""
    return df.orderBy(*order_by).limit(n)
