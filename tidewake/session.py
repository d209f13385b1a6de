"""The session that the analytics expect."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def session(name: str = "tidewake", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; sizes of partitions are left to the cluster's settings."""
    own = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    builder = SparkSession.builder.appName(name)
    builder = builder.master(master) if master else builder
    for k, v in own.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, ``spark.checkpoint.dir``; on a local master without one a temporary folder."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        there = _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tidewake-"))
    return f"{there.rstrip('/')}/{name}-{uuid.uuid4().hex}"
