"""Spark session and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_made: list[str] = []

# HotSpot never compiles a method above this size; it runs interpreted, several times slower.
METHOD_LIMIT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def build(app: str = "salvor", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every plan here assumes (UTC, ANSI, AQE)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(METHOD_LIMIT, METHOD_BYTES)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def compiled_methods(spark: SparkSession) -> None:
    """Have Spark run a stage operator by operator, in small methods, where its generated code has a method too large to be
    compiled, as very wide projections do. A session that has Spark's default limit gets this one from here on, as frames run
    later; a value of its own stays."""
    if spark.conf.get(METHOD_LIMIT) == "65535":
        spark.conf.set(METHOD_LIMIT, METHOD_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where it is unset (a single machine, as in tests) a new folder is made once
    and remembered as the session's setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="salvor-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A path no other run uses, below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch paths made so far. Call it when their queries are finished."""
    while _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
