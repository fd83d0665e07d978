"""Session settings and the size limits every operator shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# One ordered run is sorted inside one task, so it must stay small enough to sort with a
# modest spill.  Keys with more rows than this are split (see operators.ordered).
RUN_ROWS = ("spark.terrasse.runRows", 4_000_000)

# A side is broadcast on purpose only after a count shows it is below this many rows.
BROADCAST_ROWS = ("spark.terrasse.broadcastRows", 500_000)

# A lookup broadcasts the codes that hold at least one of so many parts of the rows; so there are no more of them.
HOT_CODES = ("spark.terrasse.hotCodes", 100_000)

# Defaults for a session we build ourselves; a running session keeps what it has.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Shared folder of a running session whose cluster named none; may be set at any time.
SHARED_DIR = "spark.terrasse.sharedDir"


def build_session(app_name: str = "terrasse", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def limit_of(spark: SparkSession, setting: tuple[str, int]) -> int:
    name, default = setting
    return int(spark.conf.get(name, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or where that is unset ``spark.terrasse.sharedDir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED_DIR, None)
    if not named:
        raise RuntimeError(f"set spark.checkpoint.dir or {SHARED_DIR} to a folder all executors share")
    return named.rstrip("/")


def _stage_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/terrasse/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{_stage_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Delete the stage tables this application wrote; frames that still read them become invalid."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(_stage_root(spark))
    root.getFileSystem(context._jsc.hadoopConfiguration()).delete(root, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own file system."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).exists(target)


def child_names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of what lies in a folder, sorted."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(target)
    return sorted(name for name in (f.getPath().getName() for f in found) if name.startswith(prefix))


def durable(df: DataFrame, label: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the plan, fixes values that a second evaluation could change, and survives the loss
    of any executor.  ``compression`` names a Parquet codec other than the session's.
    """
    return durable_counted(df, label, compression)[0]


def durable_counted(df: DataFrame, label: str = "stage", compression: str | None = None) -> tuple[DataFrame, int]:
    """Like ``durable``, with the number of rows, counted while writing."""
    path = fresh_path(df.sparkSession, label)
    seen = Observation(label)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]
