"""Session set-up and the few session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL: list[str] = []


def build_session(app_name: str = "barlake", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the settings every job here needs.

    ``conf`` keys use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Call-site capture doubles the number of gateway calls while a plan is being built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC: bar times are zone-free UTC wall times."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: in ``spark.checkpoint.dir``, or on this machine if it is the only one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="barlake-"))
        base = _LOCAL[0]
    return f"{base.rstrip('/')}/lake-{uuid.uuid4().hex}"
