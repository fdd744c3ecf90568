"""Places that the driver and every executor can see, and small Arrow helpers."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python worker expands into numpy arrays at once.
CHUNK_BYTES = 1 << 20
#: Rows of a few numbers each that are broadcast at most.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where it is unset, local mode takes a temporary one (as tests do); on a cluster it must be set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quorumrank-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a ``stored`` table that no later plan reads."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A ``stored`` table, marked for broadcast where it has so few rows; else joins shuffle it."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if rows is None else rows) else df


def tidy(act: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``act``, after which a Python worker gives memory that it doesn't need back to the system: workers live on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from act(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
                ctypes.CDLL(None).malloc_trim(0)

    return run


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so further columns of the input, whatever their names, can't clash."""
    return df.select(*[df[f"`{n}`"] for n in names])


def row_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each; one long text is a range of its own."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start, n = 0, len(sizes)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop
