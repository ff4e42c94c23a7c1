"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings that change results (time zone) or that the plans count on (AQE splits
# skewed join partitions and coalesces small ones).  All can be set at run time, so
# a session made by somebody else can be brought in line as well.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Folder names are text: a timeframe "1d" must not come back as the number 1.0.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


# Settings that only a new session can take.  Call-site capture costs several gateway
# calls for every column expression that is built.
STARTUP_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "quoteloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STARTUP_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and staged tables, as named by ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests, a laptop) gets a new temporary folder; on a
    cluster, where every machine would write to a disk of its own, it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quoteloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named
