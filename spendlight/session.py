"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from file-size estimates: AQE broadcasts a side only after measuring it at run time.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "spendlight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for.

    ``conf`` entries use ``__`` for dots (``spark__sql__shuffle__partitions="8"``)
    and win over the defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_base() -> tempfile.TemporaryDirectory:
    """One temporary folder per process, removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="spendlight-", ignore_cleanup_errors=True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder all executors share.

    The base is ``spark.checkpoint.dir``. Where that is unset, a local session
    gets a temporary folder; a cluster session is refused, because a
    machine-local folder there would not be visible to the other machines.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        base = _local_base().name
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
