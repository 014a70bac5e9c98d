"""Helpers of the operators in this subpackage: input tables, intermediate
tables in the shared folder, and Arrow text columns as flat byte arrays."""

from __future__ import annotations

import ctypes
import posixpath
import re
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelens.session import scratch_path

#: Text bytes that a task holds as flat arrays at a time (one longer text stands alone).
BATCH_BYTES = 1 << 18
#: Bytes of an Arrow batch on its way from the JVM to a task's Python, at most (one
#: longer row stands alone); both sides hold a batch whole.
ARROW_BYTES = 4 << 20
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that Spark's Parquet reader decodes at a time, at most: it holds their texts in
#: arrays of one column, which at its default of 4,096 rows take tens of MB a task.
READ_ROWS = 512
_READ_LIMIT = "spark.sql.parquet.columnarReaderBatchSize"
#: Bytes of a row group of tables between the steps: a writer holds one in memory.
GROUP_BYTES = 8 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks
    can import it wherever the driver found it; and hold the session's Arrow
    batches to ``ARROW_BYTES`` and its Parquet batches to ``READ_ROWS``, unless
    they are smaller."""
    if int(re.sub(r"\D", "", spark.conf.get(_ARROW_LIMIT))) > ARROW_BYTES:
        spark.conf.set(_ARROW_LIMIT, str(ARROW_BYTES))
    if int(spark.conf.get(_READ_LIMIT)) > READ_ROWS:
        spark.conf.set(_READ_LIMIT, str(READ_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="ridelens-")) / "ridelens_tasks.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder's path in the shared checkpoint folder, deleted by
    ``session.clear_scratch`` or when the process ends."""
    return scratch_path(spark, "llm", label)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back:
    cuts lineage, survives lost executors, and gives later joins a plain scan."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator reads, under fixed names, so that
    other columns of the input, whatever their names, never meet its own."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column as one uint8 array, and the n + 1
    offsets of its values. Null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    col = col.cast(pa.large_binary())
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give memory that Arrow and the allocator keep for later back to the
    system, so that a worker's size follows what it holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text_col: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into row ranges of about ``limit`` text bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
        del batch
        release()


def long_array(values: np.ndarray) -> pa.Array:
    """64-bit values, unsigned ones bit for bit, as an Arrow column of longs."""
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64, copy=False))
