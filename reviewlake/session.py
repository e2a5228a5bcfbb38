"""Session construction and the few session-level settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every reviewlake job wants. Shuffle partition count is deliberately
# NOT pinned here: AQE coalesces small shuffles and splits skewed ones, and the
# cluster operator sizes `spark.sql.shuffle.partitions` for the data at hand.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "reviewlake",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and skew handling on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # getOrCreate may hand back an existing session: make the SQL settings stick.
    for k, v in {**_DEFAULTS, **(conf or {})}.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, honouring the cluster's setting.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local session where it is unset gets a private one; elsewhere
    executors couldn't see such a folder, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="reviewlake-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for job outputs under the shared checkpoint folder."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/reviewlake-{name}-{uuid.uuid4().hex}"
