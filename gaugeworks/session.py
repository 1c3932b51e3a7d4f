"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(name: str = "gaugeworks", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators count on; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Without that setting a local session gets a fresh temporary folder; a cluster session
    is refused, because a machine-local folder would not be seen by the other machines.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    """The temporary folder of one local application; the setting itself cannot be changed later."""
    return tempfile.mkdtemp(prefix=f"gaugeworks-{application}-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the scratch root."""
    return f"{scratch_root(spark)}/gaugeworks/{label}-{uuid.uuid4().hex}"
