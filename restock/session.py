"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: adaptive execution (runtime re-planning, skew
# splitting, partition coalescing), a fixed session time zone so dates agree
# with other engines, and Arrow for the few grouped-map operators.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (about 100 TB of line items, ~1000 executors).
# Reads: 256 MB splits keep the task count near 400k for 100 TB. Shuffles:
# AQE sizes the reduce side to ~256 MB partitions from the runtime map
# output, starting from an upper bound of 8 partitions per core; skewed
# partitions over 5x the median (and 512 MB) are split. The checkpoint
# folder must be shared storage (set by the cluster, read by the library).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def cluster_conf(total_cores: int) -> dict:
    """Recommended settings for a cluster with ``total_cores`` executor cores."""
    conf = dict(DEFAULT_CONF)
    conf.update(CLUSTER_CONF)
    conf["spark.sql.shuffle.partitions"] = str(max(200, 8 * total_cores))
    conf.pop("spark.ui.enabled", None)
    return conf


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "restock", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_CLEANED: set[str] = set()     # applications whose tables go when the program ends


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local master with the setting unset (tests) gets a scratch
    folder of its own; any other master without it is an error, because
    executors could not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not path and sc.getCheckpointDir():
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="restock-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint dir for a written intermediate table."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark).rstrip('/')}/tables-{app}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back: the lineage is cut, the result survives lost executors,
    and later reads prune columns and push filters into the scan."""
    spark = df.sparkSession
    path = scratch_table_path(spark, name)
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return written_at(spark.read.schema(schema).parquet(path), path)


def written_at(df: DataFrame, path: str) -> DataFrame:
    """Remember the folder of a written table, so that it can be dropped; what
    is left when the program ends goes then."""
    df._written_at = path
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _CLEANED:
        _CLEANED.add(sc.applicationId)
        atexit.register(_drop_all, df.sparkSession, sc.applicationId)
    return df


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_tables(*tables: DataFrame) -> None:
    """Delete written intermediate tables that no pending result reads."""
    for t in tables:
        _delete(t.sparkSession, t._written_at)


def _drop_all(spark: SparkSession, app: str) -> None:
    if spark.sparkContext._jsc is not None and spark.sparkContext.applicationId == app:
        _delete(spark, f"{checkpoint_dir(spark).rstrip('/')}/tables-{app}")
