"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the results depend on; safe to apply to a running session.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in a record is legal JSON; the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: Settings for speed; a cluster's own values are left alone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Plans are built of many small expressions; noting the Python call site of
    # each takes longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Windows and remembered ids of a large stream do not fit in executor memory.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_STATE = "org.apache.spark.sql.execution.streaming.state"
IN_MEMORY, ON_DISK = f"{_STATE}.HDFSBackedStateStoreProvider", f"{_STATE}.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on, and keep stream state on disk."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    # Spark's own default is replaced, any other choice is left alone.
    if spark.conf.get(STATE_STORE, IN_MEMORY) == IN_MEMORY:
        spark.conf.set(STATE_STORE, ON_DISK)
    return spark


def get_spark(app_name: str = "revwatch", **conf: str) -> SparkSession:
    """The active session (as under ``spark-submit``) or a new one with our defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        for key, value in conf.items():
            active.conf.set(key, value)
        return configure(active)
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULT_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def written_once(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder, for plans that use them several times."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Like :func:`written_once` for a run that ends with the block, which removes its folders."""
    paths = []

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        paths.append(shared_folder(spark, purpose))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(conf).delete(path, True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run, below the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local-mode
    session may go without; on a cluster a machine-local folder would lose data
    with the machine, so that is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="revwatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/revwatch/{purpose}-{uuid.uuid4().hex}"
