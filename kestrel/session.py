"""SparkSession settings the pipelines rely on.

* UTC session time zone: ``DATE(timestamp)`` in the source dialect is UTC.
* ANSI on (Spark 4 default): strict casts raise, ``try_*`` variants are the
  safe forms.
* AQE on: runtime coalescing of shuffle partitions and skew-join splitting.  Coalesced partitions hold at most
  ``COALESCED_BYTES``: the rows here compress well, so a task's sorts and hash tables take some twenty times that.
* Generated code stays below the size that the JVM compiles: a wide projection in one larger method would be
  interpreted, so such a stage is generated projection by projection instead, in small methods.
* Checkpoint directory: read from the session; only set when unset (tests).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

#: Settings applied to every session used by the pipelines.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",  # bytes; HotSpot leaves larger methods interpreted
}

#: shuffled (compressed) bytes of a coalesced partition
COALESCED_BYTES = 16 << 20
_ADVISORY, _ADVISORY_DEFAULT = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 64 << 20


def scale_conf(input_bytes: int, *, executor_cores_total: int = 8000,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` (apply on the cluster session).

    Shuffle partitions are chosen so each holds about ``target_partition_bytes`` of the input
    (shuffles here carry at most about the input: projections and partial aggregations only shrink
    it), at least two waves of the cluster's cores, rounded up to a multiple of them; AQE then
    coalesces small ones and splits skewed join partitions.  Scan splits are 256 MiB.  For 100 TB
    this gives ~400k initial partitions of 256 MiB, coalesced at run time to 256 MiB targets.
    """
    parts = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    parts = -(-parts // executor_cores_total) * executor_cores_total
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the pipelines depend on to an existing session."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    # a session sized on purpose (``scale_conf``) asks for more than Spark's default and keeps its partitions
    if COALESCED_BYTES < _bytes(spark.conf.get(_ADVISORY)) <= _ADVISORY_DEFAULT:
        spark.conf.set(_ADVISORY, str(COALESCED_BYTES))
    return spark


def _bytes(size: str) -> int:
    """Bytes of a size as Spark writes it (``64MB``, ``16m``, ``1024``)."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit.removesuffix("ib").removesuffix("b") if unit != "b" else ""]


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a scratch one only for a local session without any.

    On a cluster a machine-local folder would lose rows (executors write to their own disks), so that fails.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kestrel") -> SparkSession:
    """Session for tests and the local bench (no UI, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
