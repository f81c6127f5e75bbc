"""Session helpers: configuration, scratch space, pinned input splits."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SPLIT_CONF = "spark.sql.files.minPartitionNum"


def build_session(app_name: str = "orderlayers", **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # HotSpot never compiles a method above this size, and interpreting one is slower
        # than the split-up code Spark generates instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Without call sites on every column expression, wide plans build faster.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder of its own;
    on a cluster a folder of one machine would not outlive that machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="orderlayers-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str | int) -> Iterator[None]:
    """A session setting that holds inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def pinned_splits(spark: SparkSession) -> Iterator[None]:
    """Keep file splits the same for every scan inside the block.

    Spark sizes splits by the number of cores it holds at that moment, so gaining
    or losing an executor between two scans of a file would cut it differently.
    """
    before = spark.conf.get(SPLIT_CONF, None)
    if before is None:
        spark.conf.set(SPLIT_CONF, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SPLIT_CONF)
