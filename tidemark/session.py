"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the library expects; `extra` uses `__` for dots in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {name.replace("__", "."): value for name, value in extra.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def setting(spark: SparkSession, name: str, default: int) -> int:
    """Integer tuning value `spark.tidemark.<name>`."""
    return int(spark.conf.get(f"spark.tidemark.{name}", str(default)))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind: Spark removes them as soon as a write has ended.

    Otherwise they stay until the driver happens to collect garbage, so that a run needs the disk for all its steps at once.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def shared_root(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; only a local session may fall back to its own."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(root)
    return root


def work_folder(spark: SparkSession, name: str) -> str:
    """Fresh sub-folder path of the shared root."""
    return f"{shared_root(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
