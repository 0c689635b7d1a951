"""Session helpers: building a local session for tests/bench and resolving
the shared checkpoint folder that iterative jobs cut lineage into."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Shuffle files go when the action that wrote them ends, not when the driver
# happens to collect its garbage.  A frame takes the setting it is made under.
FREED_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rankwalk") -> SparkSession:
    """A local session configured like the tests and the bench expect.

    AQE stays on (runtime coalescing, skew-join splitting, join demotion);
    the UI stays off.  A checkpoint folder is set only if the caller's
    environment did not already name one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS,
    object store, ...); we never invent a machine-local one there.  Only a
    local-mode session without the setting (tests, the bench) gets a fresh
    scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: iterative jobs need a shared, reliable "
            "checkpoint folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rankwalk-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written
    intermediate tables (lineage cuts, round-trips)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of written intermediates that nothing reads any more."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Apply SQL settings for the duration of a block, then restore them."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


__all__ = ["local_session", "ensure_checkpoint_dir", "scratch_path", "drop_path", "session_conf", "FREED_CONF"]
