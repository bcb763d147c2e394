"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tamiz", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):  # not local-cluster[...]
                raise RuntimeError(
                    "set spark.checkpoint.dir to a folder shared by all executors"
                )
            configured = tempfile.mkdtemp(prefix="tamiz-")
        context.setCheckpointDir(configured)
        folder = context.getCheckpointDir()
    return folder


_INTERMEDIATES: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _INTERMEDIATES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_intermediates(spark: SparkSession) -> int:
    """Delete what this application stored below ``fresh_path``, and say how many paths it was.

    For the end of a job: DataFrames that read the stored tables cannot be used afterwards.
    """
    return sum(_delete(spark, path) for path in _INTERMEDIATES.pop(spark.sparkContext.applicationId, []))


def drop_stored(*frames: DataFrame) -> int:
    """Delete the tables below ``fresh_path`` that these frames read, and say how many it was.

    For tables on the way to a result: no frame that reads them can be used afterwards.
    """
    dropped = 0
    for df in frames:
        spark = df.sparkSession
        known = _INTERMEDIATES.get(spark.sparkContext.applicationId, [])
        read = {_plain_path(spark, f) for f in df.inputFiles()}
        for path in [p for p in known if any(f.startswith(_plain_path(spark, p) + "/") for f in read)]:
            dropped += _delete(spark, path)
            known.remove(path)
    return dropped


def _plain_path(spark: SparkSession, path: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()


def _delete(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _inside, _before = threading.Lock(), Counter(), {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files as they end.

    Otherwise these stay on the executors' disks until the driver happens to collect its garbage, so that the
    files of all steps of a long job add up.
    """
    with _lock:
        if not _inside[id(spark)]:
            _before[id(spark)] = spark.conf.get(_DROP_SHUFFLES, None)
            spark.conf.set(_DROP_SHUFFLES, "true")
        _inside[id(spark)] += 1
    try:
        yield
    finally:
        with _lock:
            _inside[id(spark)] -= 1
            if not _inside[id(spark)]:
                before = _before.pop(id(spark))
                spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


COMPACT = {"compression": "zstd"}  # files of tables that live long or are written often


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, fixes values that depend
    on the physical layout, and gives the optimizer a measured size for
    choosing joins. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with shuffles_dropped(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROW_BYTES = 16  # a key and a number: what a row takes at the least


def looked_up(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table as the side of a join that is looked up: not broadcast where its rows are too many.

    Spark goes by the size of files, where a million ascending keys can take less than a megabyte. ``rows``
    is counted if not given, which for stored tables reads no cell.
    """
    spark = df.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):  # nothing is broadcast anyway
        return df
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    if rows is None:
        rows = df.count()
    return df.hint("merge") if rows * ROW_BYTES > most else df


def build_together(
    spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]], at_once: int = 8
) -> dict[str, DataFrame]:
    """Run independent builders side by side, so that small jobs share the cluster."""
    with ThreadPoolExecutor(min(at_once, len(builders))) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(build))
            for name, build in builders.items()
        }
        return {name: job.result() for name, job in running.items()}
