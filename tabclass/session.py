"""Session helpers.

The library never builds its own cluster session in production: callers pass
the ``SparkSession`` they were given.

Durable scratch space (metrics sinks, materialised feature tables, CSV round
trips) always lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is missing (a laptop or a
test run) do we create one, so the library never writes to a machine-local
temporary folder on a real cluster.
"""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured and sc is not None:
        configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        master = sc.master if sc is not None else ""
        if not re.match(r"local(\[[^\[]*\])?$", master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        # One machine (tests, bench).
        configured = tempfile.mkdtemp(prefix="tabclass-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tabclass", f"{name}-{uuid.uuid4().hex[:12]}")
