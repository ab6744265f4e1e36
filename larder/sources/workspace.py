"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names for checkpoints.

    Only a local session without that setting falls back to a temporary
    folder, since executors on other machines could not read it.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return f"{configured.rstrip('/')}/larder-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return f"file://{tempfile.mkdtemp(prefix='larder-')}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Boosting cuts its lineage through the checkpoint folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
