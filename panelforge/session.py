"""SparkSession defaults and the shared checkpoint folder."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults tuned for correctness (ANSI, UTC) and scale (AQE with skew splitting).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partitions sized for executor memory at scale: AQE coalesces small shuffle partitions up
    # to the advisory size and splits skewed ones above the skew thresholds
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "panelforge",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read.
    When it is unset (local tests) a private scratch folder is created.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="panelforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/panelforge/{name}"


def cut_lineage(df):
    """Reliable checkpoint (written to the shared folder, survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
