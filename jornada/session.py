"""Session helpers: the shared scratch folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests, laptops) gets a fresh
    temporary folder of its own; on a cluster a missing setting is an error,
    since a machine-local folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for scratch tables")
        root = tempfile.mkdtemp(prefix="jornada-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
        else:
            spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/jornada/{label}-{uuid.uuid4().hex[:12]}"
