"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the operators rely on for right results. Producers write zone-less UTC text,
# so the session zone has to be UTC.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app_name: str = "tickengine",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC, AQE and a disk-backed state store; ``conf`` overrides."""
    settings = {
        **REQUIRED_CONF,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own; on a
    cluster a folder of the driver's machine would be of no use.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tickengine-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created or deleted."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
