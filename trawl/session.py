"""Session settings and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "trawl", driver_memory: str | None = None) -> SparkSession:
    """A session tuned for the engine: AQE on (coalescing + skew joins), UTC, no UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if driver_memory:  # only takes effect when this call starts the JVM (local mode)
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder stands in only where driver and tasks share one machine (a local
    master); on a cluster an unset folder is an error, because other machines could not
    read what one of them wrote.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share (master {master})")
        root = tempfile.mkdtemp(prefix="trawl-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/trawl/{name}-{uuid.uuid4().hex[:12]}"


def planned_bytes(df: DataFrame) -> int:
    """The size that Spark's planner expects of a result (very large where it knows none); starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fs_uri(spark: SparkSession, path: str) -> str:
    """The full URI of a path as Spark itself resolves it (a plain path belongs to the
    cluster's default file system, not to the local disk)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = str(hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop))
    return "file://" + uri[len("file:"):] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows as a plan of literals, whose size the planner knows."""
    names = [c.strip().split(" ", 1) for c in schema.split(",")]
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
