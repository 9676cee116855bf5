"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import os
import re
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "gradeline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this package is tested under; a cluster may pass its own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates derived from timestamps must not depend on where the job runs."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def reach_package(spark: SparkSession) -> None:
    """Let Python workers that see this file system import the package from where the driver has it.

    On a cluster whose executors do not, pass the package by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


#: Where a local session keeps intermediate tables if it names no folder; a cluster has to name one.
LOCAL_FOLDER = "/tmp/checkpoints"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session, so every executor sees what another one
    wrote and a lost executor loses no data. Only a session whose executors are this very process may
    leave it unset. All paths of an application lie in one folder, which goes when the application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = LOCAL_FOLDER
    folder = f"{base}/gradeline/{spark.sparkContext.applicationId}"
    _drop_at_end(spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


_dropped: set[str] = set()


def _drop_at_end(spark: SparkSession, folder: str) -> None:
    if folder not in _dropped:
        _dropped.add(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
