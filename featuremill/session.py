"""Session helpers: one place for the settings every operator assumes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. ANSI mode stays on (Spark 4 default): every lenient
# cast of the original notebook is written with try_* functions instead.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


# Starting points for a large cluster (100 TB-class inputs). The initial shuffle partition
# count is set high on purpose: AQE coalesces small partitions to the advisory size and
# splits skewed ones at runtime, so 256 MB tasks come out at every stage.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def get_session(master: str | None = None, app: str = "featuremill",
                shuffle_partitions: int | None = None, extra: dict | None = None,
                driver_memory: str | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the settings above. ``driver_memory`` only takes
    effect when this call starts the JVM (local mode: the driver is the executor)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a local-mode session without one
    (tests, laptops) gets a fresh temporary folder; a cluster session without one is an
    error, because a machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    path = tempfile.mkdtemp(prefix="featuremill-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the scratch folder for one written table."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
