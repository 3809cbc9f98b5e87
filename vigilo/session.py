"""Session-scoped locations.

Scratch data (landing files, incremental targets, stream checkpoints) goes
under the shared folder the cluster names in ``spark.checkpoint.dir``; a
local directory is made only when the session sets none (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

AT_ONCE = 8  # independent jobs that one step may run side by side
#: Shuffle files go when their query has ended, not when the driver happens to collect its garbage.
REMOVE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder, registered with the SparkContext so
    ``DataFrame.checkpoint()`` writes there."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="vigilo-checkpoints-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/vigilo/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back: cuts
    the lineage, survives lost executors, and keeps column pruning.
    ``options`` are the writer's."""
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the duration of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def for_each(spark: SparkSession, run: Callable, items: Iterable) -> list:
    """``run`` of every item, in order.  They run side by side, so that a job
    with one long task leaves the other cores to the rest; the first failure
    is raised when all have ended."""
    with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(run), x) for x in items]]
