"""Session settings that the operators count on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with ANSI arithmetic and adaptive plans; partition numbers are the cluster's to set."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true")
    builder = builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one that ``spark.checkpoint.dir`` names; only a local session may have none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/ledgerloom/{name}-{uuid.uuid4().hex}"
