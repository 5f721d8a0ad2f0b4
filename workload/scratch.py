"""Folders for what the queries write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DIR = "spark.strata.localDir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint directory.

    Only a local session without one falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_DIR, None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        spark.conf.set(LOCAL_DIR, tempfile.mkdtemp(prefix="strata-"))
        return spark.conf.get(LOCAL_DIR)
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
