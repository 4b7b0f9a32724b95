"""Session settings the results depend on, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "tradeflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC days and adaptive execution; pass ``master`` only for local runs."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: every day boundary in the metrics is a UTC day.

    The setting stays. Registered queries call this on the caller's session, as Spark takes the zone of
    some conversions when a frame is built and of others when it is collected.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new, unused folder below ``spark.checkpoint.dir`` that all executors can reach.

    A local session without that setting gets a folder in the machine's temporary directory;
    on a cluster the setting is required, because executors do not share local disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tradeflow-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/tradeflow-{uuid.uuid4().hex}"
