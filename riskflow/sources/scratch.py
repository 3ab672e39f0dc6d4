"""Where jobs keep intermediate tables, checkpoints and saved models."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_local: tempfile.TemporaryDirectory | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which every node can reach.

    Only a local session without that setting gets a temporary folder of its own.
    """
    global _local
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):  # local-cluster[..] has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local is None:
        _local = tempfile.TemporaryDirectory(prefix="riskflow-", ignore_cleanup_errors=True)
    return _local.name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_root(spark)}/riskflow-{uuid.uuid4().hex}/{name}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))
