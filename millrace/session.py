"""Session settings and the shared folder that long jobs write to."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators rely on. All of them can be changed per session.
SETTINGS = {
    # JSON with a repeated key keeps the last value instead of being rejected.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Joins on a hot key are split at run time, also where a later operator
    # then needs one more shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join whose build side is small in every partition needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Streaming state that need not fit in executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# What may be broadcast: a frame that was measured and stays within both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session whose executor is the driver itself may do without: it gets a
    temporary folder of its own, which goes when the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if context.getCheckpointDir():
            return context.getCheckpointDir()
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _own_folder()
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


@cache
def _own_folder() -> str:
    kept = tempfile.TemporaryDirectory(prefix="millrace-", ignore_cleanup_errors=True)
    atexit.register(kept.cleanup)
    return kept.name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def _size() -> Column:
    return F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("size")


def cut_lineage(df: DataFrame) -> tuple[DataFrame, int, int]:
    """Materialise ``df`` in the shared folder, so a lost executor costs no earlier round.

    Returns it with its rows and their size as text, measured in the same job.
    """
    shared_dir(df.sparkSession)
    observation = Observation()
    kept = df.observe(observation, F.count("*").alias("rows"), _size()).checkpoint(eager=True)
    found = observation.get
    return kept, found["rows"], found["size"]


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and their size as text, from one distributed aggregate."""
    return tuple(df.agg(F.count("*"), _size()).first())


def fits_broadcast(rows: int, size: int, max_rows: int = BROADCAST_ROWS) -> bool:
    return rows <= max_rows and size <= BROADCAST_BYTES


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` may be broadcast; reads little more than ``max_rows`` rows to tell."""
    return fits_broadcast(*measure(df.limit(max_rows + 1)), max_rows)
