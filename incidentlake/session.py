"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_session(app: str = "incidentlake", **conf: str) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Where a local session without the setting (tests) keeps scratch data.
LOCAL_SCRATCH = "/tmp/checkpoints"


def _scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a cluster without the setting is an error."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = LOCAL_SCRATCH
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed with all its siblings when the session ends."""
    home = f"{_scratch_root(spark)}/scratch-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(home)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{home}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder that is already set."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(_scratch_root(spark))
