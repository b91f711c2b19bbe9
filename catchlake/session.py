"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A session for tests and the benchmark, with its shared folder; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("catchlake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shared:
        builder = builder.config(CHECKPOINT_KEY, shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it. A session whose executor is the driver's own process, and
    no other, is given a temporary folder where it names none."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"{CHECKPOINT_KEY} is not set; name a folder that every executor can reach")
    spark.conf.set(CHECKPOINT_KEY, tempfile.mkdtemp(prefix="catchlake-"))
    return spark.conf.get(CHECKPOINT_KEY)


_WRITTEN: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    _WRITTEN.append(f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete what is written to the shared folder within the block. Results that are still wanted must be read by then."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _WRITTEN[before:]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        del _WRITTEN[before:]


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame once to the shared folder and go on from the written table.

    Several consumers then share one computation, and a lost executor costs a re-read, not a re-run.
    """
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
