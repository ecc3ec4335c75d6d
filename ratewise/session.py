"""Session construction and cluster-safe helpers.

Library code never invents storage locations: scratch output and lineage cuts go to the shared
folder that the session's own settings name.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

# Settings every plan in this package relies on.
#  - AQE re-plans joins at runtime from real shuffle sizes (size-checked broadcast, skew split,
#    partition coalescing).
#  - LAST_WIN: flattened attribute maps may repeat a key; the later value wins.
REQUIRED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ratewise") -> SparkSession:
    """Build (or reuse) a session with the settings the plans need.

    On a cluster pass ``master=None`` and let spark-submit decide; locally tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("RATEWISE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the plans depend on, and let Python workers find this package
    (idempotent). A setting that the cluster has fixed stays as it is."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def _setting(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared scratch root, from session settings only, registered with the context.

    ``spark.checkpoint.dir`` where it is set; otherwise a folder of ``spark.sql.warehouse.dir``,
    which every executor of a session shares as well.
    """
    path = _setting(spark, "spark.checkpoint.dir") or (
        f"{_setting(spark, 'spark.sql.warehouse.dir').rstrip('/')}/_scratch")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch root; :func:`clear_scratch` removes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/ratewise-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete every scratch path this process made. Call it when no frame reads them any more."""
    n = 0
    while _SCRATCH:
        n += _delete(spark, _SCRATCH.pop())
    return n


def _delete(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True))


def persist(df: DataFrame) -> DataFrame:
    """Cache a reused intermediate; blocks lost with an executor are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


#: Spark deletes the shuffle files of a query when it has ended; where they are missed later, it makes them anew.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries written in this block leave no shuffle files behind; the session's own setting comes back."""
    if not spark.conf.isModifiable(FREE_SHUFFLES):  # a Spark without it keeps them until the driver collects garbage
        yield
        return
    was = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, was)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into spark.checkpoint.dir (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table under the scratch root: less disk than a checkpoint of as many rows, and the
    shuffles that made it are deleted."""
    path = scratch_path(df.sparkSession, name)
    with _freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame that ``make`` builds, :func:`stored`; the tables stored while building it are deleted."""
    before = len(_SCRATCH)
    df = make()
    spark, within = df.sparkSession, _SCRATCH[before:]
    out = stored(df, name)
    for path in within:
        _delete(spark, path)
        _SCRATCH.remove(path)
    return out
