"""SparkSession for tests, the benchmark and local runs."""

from __future__ import annotations

import os
import threading
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Fixed value: Spark's setting that removes an action's shuffle files when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writes = threading.Lock(), weakref.WeakKeyDictionary()


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "ledgerline") -> SparkSession:
    """Local session: AQE on, UTC, UI off."""
    parts = shuffle_partitions or (2 * (os.cpu_count() or 4) if cores == "*" else 2 * int(cores))
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", str(parts))
             .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a local-mode session (one machine, as in tests) gets a
    folder that goes with the session; on a cluster that is an error, since a
    folder of the driver's own would not be seen by the executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = os.path.join(spark.sparkContext._temp_dir, "checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


@contextmanager
def shuffles_released(spark: SparkSession):
    """Writes inside give their shuffle files back when they end.

    Else the files stay until the driver happens to collect its garbage, so a run of
    several writes holds the shuffles of all of them on disk.  The setting holds for
    the writes only (concurrent ones share it); one that the session has is kept.
    """
    with _lock:
        before = _writes.get(spark, 0)
        ours = before > 0 or spark.conf.get(RELEASE, None) is None
        if ours:
            _writes[spark] = before + 1
            spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if ours:
            with _lock:
                _writes[spark] -= 1
                if not _writes[spark]:
                    spark.conf.unset(RELEASE)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut the lineage of ``df``: write it as parquet under the shared
    checkpoint folder and return the re-read table.

    Computes the plan once (``Dataset.checkpoint`` computes it twice unless
    cached) and survives executor loss, unlike a local checkpoint.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-{label}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.option("compression", "zstd").parquet(path)     # half of its bytes are digests in hex
    return spark.read.parquet(path)
