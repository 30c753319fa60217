"""Session settings and shared scratch locations."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: instants are compared in UTC, AQE re-plans joins and
# shuffle partition counts at runtime and splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "kestrel",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark. On a cluster, use the session the platform gives."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # checkpoint files of frames that are garbage collected are removed by Spark's cleaner
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "16g")))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the runtime settings above on an existing session (only those a job may change)."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings stay as the platform set them
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; on a local master one under /tmp if it is unset.

    On a cluster the driver's own folder is not seen by executors, so there the setting must be given.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str):
    """A session setting inside the block (for eager actions only), then as it was."""
    old = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, old)


def case_sensitive(spark: SparkSession):
    """Resolve column names case-sensitively inside the block (for eager actions only), then restore."""
    return session_setting(spark, "spark.sql.caseSensitive", "true")


_RUN = uuid.uuid4().hex[:12]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for tables a job writes and reads back.

    All paths of a driver process lie in one folder, which is removed when the process ends.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kestrel-scratch-{_RUN}"
    if base not in _scratch:
        _scratch.add(base)
        atexit.register(_remove, spark, base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_scratch: set[str] = set()


def _remove(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that Spark writes it with, while the session still runs."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
