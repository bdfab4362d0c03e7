"""Session settings and the shared scratch folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int = 8, app: str = "shelfscan", **extra: str) -> SparkSession:
    """A session for tests and benchmarks. A cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # keeps building a plan with many columns cheap
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # both ends of a local session live on one machine
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
    }
    for key, value in {**SETTINGS, **defaults, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session (tests) may go without: it gets a fresh temporary folder,
    which is then set as the checkpoint folder of the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return os.path.dirname(set_before)
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="shelfscan-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


#: Codec of the Parquet files written here, and of text files, which Spark cannot write in the former.
TABLE_CODEC = "zstd"
TEXT_CODEC = "gzip"

#: Rows from which an exchange of whole rows is taken in slices, one after another, and the most slices.
#: More slices need less disk at a time, but each reads the whole source.
SLICE_ROWS = 1 << 20
MOST_SLICES = 8

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(*sessions: SparkSession) -> Iterator[None]:
    """Jobs begun in the block delete their shuffle files when they end.

    Otherwise the files stay until the driver happens to collect its garbage. A task that needs
    them again, for lost cached rows say, has them made again.
    """
    before = [(spark, spark.conf.get(_RELEASE, None)) for spark in sessions]
    for spark in sessions:
        spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        for spark, value in reversed(before):
            if value is None:
                spark.conf.unset(_RELEASE)
            else:
                spark.conf.set(_RELEASE, value)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: what reads it twice sees the same rows in the
    same places, and a lost executor costs no work that lies before it."""
    return written_in_slices([frame], fresh_folder(frame.sparkSession, label))


def written_in_slices(frames: Iterable[DataFrame], path: str) -> DataFrame:
    """The rows of all frames as one table in a new folder.

    The frames are written one after another, and the shuffle files of one are gone when the next
    begins: slices of a large exchange need the disk of one slice.
    """
    for frame in frames:
        with shuffles_released(frame.sparkSession):
            frame.write.mode("append").option("compression", TABLE_CODEC).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def slice_count(rows: int) -> int:
    """Into how many slices an exchange of so many rows is cut."""
    return max(1, min(MOST_SLICES, rows // SLICE_ROWS))


def slices_by_key(key: Column, rows: int) -> list[Column]:
    """Conditions that deal rows to slices; all rows of a key, or without one, are in one slice."""
    count = slice_count(rows)
    if count == 1:
        return [F.lit(True)]
    # not the hash that deals a slice's rows to tasks
    number = F.pmod(F.xxhash64(F.lit("slice"), key), F.lit(count))
    return [number == i for i in range(count)]


def even_groups(counts: Iterable[tuple[object, int]]) -> list[list]:
    """Neighbouring items with row counts in groups of about equal rows, one group a slice."""
    counts = list(counts)
    total = sum(rows for _, rows in counts)
    slices, before = slice_count(total), 0
    groups: dict[int, list] = {}
    for item, rows in counts:
        groups.setdefault(min(slices - 1, slices * (before + rows // 2) // max(total, 1)), []).append(item)
        before += rows
    return list(groups.values())


def removed(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where there is no such folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[
        F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields])
