"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallycrest")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallycrest-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_written: list[tuple[SparkSession, str]] = []


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _remove_written() -> None:
    """Delete what ``materialize`` wrote, as far as its sessions still run."""
    for spark, path in _written:
        try:
            _remove(spark, path)
        except Exception:  # the session has ended: its files stay, as after a crash
            return


atexit.register(_remove_written)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For frames that several jobs reuse (model fitting): the files outlive lost
    executors, cut the lineage, and keep column pruning, unlike a cache. They are
    deleted when the application ends.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that ``materialize`` writes inside are deleted at the end, so that steps of an algorithm do not
    fill the disk; the yielded function writes those that stay. What leaves the scope must read these only."""
    start = len(_written)
    kept: list[tuple[SparkSession, str]] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        stored = materialize(df, name)
        kept.append(_written[-1])
        return stored

    try:
        yield keep
    finally:
        inner = _written[start:]
        _written[start:] = kept
        for spark, path in inner:
            if (spark, path) not in kept:
                _remove(spark, path)
