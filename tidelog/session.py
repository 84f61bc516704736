"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_dirs: dict[str, str] = {}


# Tasks do not grow with the tables: scans are cut by bytes, and a shuffle starts with many parts, of which small ones
# are joined. Log rows take ten times the bytes of a scan in memory, and sorted ones forty times those of a shuffle.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job relies on; all can be changed at run time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    for name, value in TASK_SIZES.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    A local session without the setting gets a temporary folder of its own; on
    a cluster a missing setting is an error, as a machine's own folder would be
    lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidelog-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where two passes must see the very same partition numbers: a lost
    executor or a second planning must not number the rows anew.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows a side may have before it is broadcast.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Hint a broadcast only after counting; the count stops at ``max_rows + 1``."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(df) if small else df), small


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the files of shuffles that no plan holds any more.

    It does so when the driver's collector finds them gone, which in a large heap
    can take until the disks are full.
    """
    spark._jvm.System.gc()


def plain_types(df: DataFrame) -> DataFrame:
    """Zone-free timestamps and doubles in place of decimals, for comparison outside Spark."""
    changed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            changed[f.name] = F.col(f"`{f.name}`").cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            changed[f.name] = F.col(f"`{f.name}`").cast("double")
    return df.withColumns(changed) if changed else df
