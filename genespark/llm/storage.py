"""Shared scratch folders and files that executors write by themselves.

Operators that need intermediate tables, or that write a file format of their
own, put them below ``spark.checkpoint.dir``: the one folder that the driver
and all executors share.  A file is written under a temporary name and moved
into place when complete, so a retried or duplicated task attempt can only
replace a whole file by an equal one.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes that one Arrow batch may hold on its way to a Python worker.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20
#: Bytes of a row group that a task holds while it writes a staged table.
ROW_GROUP = 32 << 20
#: A table of a few numbers a row may be broadcast up to this many rows; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 200_000


def scratch_root(spark: SparkSession) -> str:
    """URI of the shared folder.

    A local session without one (tests) gets a private folder; on a cluster that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="genespark-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


#: Folders that this process has named, in order; ``tidy`` forgets those it deletes.
made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """URI of a new folder below the shared one."""
    made.append(f"{scratch_root(spark)}/genespark-{name}-{uuid.uuid4().hex}")
    return made[-1]


def tidy(spark: SparkSession, since: int, keep: str | None = None) -> None:
    """Delete the scratch folders named after the first ``since`` ones, but for ``keep``."""
    for uri in made[since:]:
        if uri != keep:
            drop(spark, uri)
    made[since:] = [keep] if keep else []


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and bytes, so that very long texts don't pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: What operators keep in this Python worker from task to task: the function that lets it go, by operator.
held: dict[str, Callable[[], object]] = {}


def hold(owner: str, free: Callable[[], object]) -> None:
    """Note what an operator keeps in this worker, so that another one's first task here lets it go."""
    held[owner] = free


def trim() -> None:
    """Give memory that is free back to the system; else a worker stays as large as its largest task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def settle(owner: str) -> None:
    """Let go of what other operators keep in this worker."""
    for name in [n for n in held if n != owner]:
        held.pop(name)()


def worker(owner: str, function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over Arrow batches in workers that live through many operators: it leaves no more memory than ``hold`` says."""

    def run(batches):
        settle(owner)
        try:
            yield from function(batches)
        finally:
            trim()

    return run


def stage(df: DataFrame, name: str, uri: str | None = None) -> DataFrame:
    """Write ``df`` to a shared table and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    uri = uri or scratch(spark, name)
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def drop(spark: SparkSession, uri: str) -> None:
    """Delete a scratch folder through Spark's own file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; plain paths and file: are local (a shared mount)."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def writing(uri: str) -> Iterator:
    """Binary stream to ``uri``; the file appears there when the block ends without error."""
    files, path = resolve(uri)
    folder, _, _ = path.rpartition("/")
    files.create_dir(folder, recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with files.open_output_stream(part) as out:
            yield out
    except BaseException:
        with contextlib.suppress(OSError):
            files.delete_file(part)
        raise
    files.move(part, path)


@contextlib.contextmanager
def reading(uri: str) -> Iterator:
    """Random-access binary file at ``uri``."""
    files, path = resolve(uri)
    with files.open_input_file(path) as source:
        yield source


def file_size(uri: str) -> int:
    files, path = resolve(uri)
    return files.get_file_info(path).size
