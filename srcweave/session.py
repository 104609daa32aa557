"""Session settings, scratch tables and size checks."""

from __future__ import annotations

import atexit
import math
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Source text per hash partition; its nodes take some 90 times as much as rows in memory, and are sorted there.
TARGET_PARTITION_BYTES = 2 << 20
# Rows up to which a caller-supplied dimension table is broadcast.
BROADCAST_ROW_LIMIT = 100_000

_scratch: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Let one hash layout on `file` serve every per-file join.

    All relations of a corpus are laid out by `file`, while joins key on
    `(file, …)`.  By default Spark insists on hashing every join key and would
    reshuffle both sides; the layout on `file` alone is already co-located.

    Constraint propagation rewrites every predicate once per alias above it,
    in all combinations; over the wide rows of the rule sweep that is minutes
    of planning, for inferred null filters nothing here needs.

    The JVM never compiles a method of more than 8,000 bytes: whole stages that
    would become one are run operator by operator instead.
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local path would be invisible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _scratch:
        _scratch[app] = tempfile.mkdtemp(prefix="srcweave-")
        atexit.register(shutil.rmtree, _scratch[app], ignore_errors=True)
    return _scratch[app]


def partitions_for(sources: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Hash partitions for a source table: the bytes of its text over the target, at least the cores there are.

    The bytes are measured by an aggregate that reads the text column alone;
    estimates of a plan with joins may be off by any factor.
    """
    size = sources.agg(F.sum(F.octet_length("source"))).first()[0] or 0
    return max(sources.sparkSession.sparkContext.defaultParallelism, math.ceil(size / target_bytes))


def _scratch_database(spark: SparkSession) -> str:
    app = re.sub(r"\W", "_", spark.sparkContext.applicationId)
    name = f"srcweave_{app}".lower()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_dir(spark)}/{name}'")
    return name


def stage(df: DataFrame, label: str, partitions: int, *, shuffle: bool = True) -> tuple[DataFrame, str]:
    """Write a relation once, bucketed by `file`; returns the stored table and its name.

    Readers then prune columns, push filters into Parquet and join or window
    per file without an exchange.  The table lives in the shared scratch
    folder, so losing executors costs nothing that was already written.
    The repartition is elided by Spark when `df` already has that layout;
    `shuffle=False` is for inputs laid out before an opaque step.
    """
    spark = df.sparkSession
    most = "spark.sql.sources.bucketing.maxBuckets"
    if partitions > int(spark.conf.get(most)):
        spark.conf.set(most, partitions)
    name = f"{_scratch_database(spark)}.{label}_{uuid.uuid4().hex}"
    laid_out = df.repartition(partitions, "file") if shuffle else df
    # a task holds one bucket: with writers kept open by bucket its rows need no sort before they are written
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, 4)
    try:
        laid_out.write.format("parquet").bucketBy(partitions, "file").saveAsTable(name)
    finally:
        spark.conf.set(writers, before)
    return spark.table(name), name


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a relation once, as it is laid out now; for inputs costly to read again."""
    name = f"{_scratch_database(df.sparkSession)}.{label}_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name), name


def unstage(spark: SparkSession, name: str) -> None:
    """Drop a staged table and its files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast a caller-supplied table only when it is shown to be small.

    Counts at most `limit + 1` rows; a larger table is left to a shuffle join.
    """
    rows = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return F.broadcast(df) if rows <= limit else df
