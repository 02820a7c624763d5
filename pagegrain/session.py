"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def submitted() -> set[str]:
    """Settings that spark-submit was called with: its JVM is there before the session is."""
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        return set()
    SparkContext._ensure_initialized()
    return {k for k, _ in SparkConf().getAll()}


def get_spark(app: str = "pagegrain", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are written for. On a cluster, spark-submit's own settings win over these
    defaults; ``conf`` wins over both."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # pages are wide rows: small batches keep a Python worker's memory flat
        "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
        "spark.ui.enabled": "false",
    }
    given = submitted()
    for key, value in {**{k: v for k, v in defaults.items() if k not in given}, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder wherever it is stored."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for one run under the cluster's shared ``spark.checkpoint.dir``.

    Only on a local master, where the session names none, is a temporary folder used; it is removed when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pagegrain-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}") if "://" not in root else f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
