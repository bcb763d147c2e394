"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.session import materialize

# A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
NARROW_ROWS, NARROW_BYTES = 8000, 8 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, unless they are told where it is."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    context = spark.sparkContext
    told = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if context.applicationId in _SHIPPED or root in told:
        return
    # The driver serves the archive to all executors; the folder is the driver's own.
    archive = shutil.make_archive(
        os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="ship-")), name), "zip", root, name
    )
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


TASK_ROWS = 100_000


def in_few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """For cheap steps over narrow rows, at most ``rows``: a task for each core, or one for every 100,000 rows.

    A table of a few thousand rows then does not become a file for each shuffle partition.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a row without id belongs to fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0)) % parts


def held_out(doc_id: str, parts: int, remainder: int) -> Column:
    """True for rows that nothing is learned from; a row without id always is one."""
    return (fold(doc_id, parts) == remainder) | F.col(doc_id).isNull()


def narrow(batches: Iterator[pa.RecordBatch], text: str, most: int = NARROW_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each has few rows and few bytes of text.

    A single text longer than the limit makes a batch of its own.
    """
    for batch in batches:
        sizes = batch.column(text).nbytes // max(1, batch.num_rows) + 1
        rows = max(1, min(NARROW_ROWS, most // sizes))
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def texts(column: pa.Array) -> list[str]:
    """Python strings, a null as the empty one."""
    return [x or "" for x in column.to_pylist()]


def release() -> None:
    """Give back to the system what a task no longer needs: Python workers outlive their tasks and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def release_driver(spark: SparkSession) -> None:
    """Collect the driver's garbage between the steps of an operator that runs hundreds of jobs.

    What finished jobs have broadcast and shuffled is held until then, and both heaps grow meanwhile.
    """
    release()
    spark._jvm.System.gc()


def map_batches(
    df: DataFrame, text: str, function: Callable, schema, most: int = NARROW_BYTES
) -> DataFrame:
    """Run ``function(batch) -> dict of columns | RecordBatch | None`` over small batches."""
    wanted = _arrow_schema(df, schema)

    def run(batches):
        for batch in narrow(batches, text, most):
            out = function(batch)
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [_as(out[f.name], f.type) for f in wanted], schema=wanted
                )
        batch = out = None
        release()

    return df.mapInArrow(run, schema)


def _as(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    parsed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return to_arrow_schema(parsed)


def own_columns(df: DataFrame, added: tuple[str, ...]) -> list[str]:
    """Columns of ``df`` that an operator keeps: those whose names it does not set itself."""
    names = {a.lower() for a in added}
    return [c for c in df.columns if c.lower() not in names]


def keyed_rows(docs: DataFrame, doc_id: str, name: str) -> tuple[DataFrame, str]:
    """The rows and a column that tells them apart: the id if every row has its own, else a stored number ``name``."""
    shared = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n")).filter(F.col(doc_id).isNull() | (F.col("n") > 1))
    if shared.isEmpty():
        return docs, doc_id
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), name), name
