"""Reading the tables, the shared scratch folder, and Arrow batch loops."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.llm.words import blocks, text_bytes
from quarry.session import ensure_checkpoint_dir

#: Bytes of text that a task works on at once.
BLOCK = 2 << 20
#: Rows up to which a table that the data decide about is broadcast; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder that the whole cluster shares;
    it goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


#: For tables of rows of some megabytes: row groups of a few rows, so that readers hold little at once.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the
    lineage, and a lost executor costs nothing that is in the table."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options or {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped_table(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that are not read again."""
    for df in tables:
        spark = df.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def binary_files(spark: SparkSession, path: str, folders: dict[str, str]) -> DataFrame:
    """Files below ``path`` with the values of their ``name=value`` folders,
    typed; no rows if nothing was written."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("length", "content", *((F.col(n) if n in files.columns else F.lit(None)).cast(kind).alias(n) for n, kind in folders.items()))


def checked_broadcast(df: DataFrame) -> DataFrame:
    """``df`` (a written table) for a broadcast join if it has at most
    BROADCAST_ROWS rows; else as it is, for a join by shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def text_blocks(batch: pa.RecordBatch, column: str = "text", most: int = BLOCK) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows of a batch with about ``most``
    bytes of text each."""
    raw, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
    for a, b in blocks(np.diff(at), most):
        yield slice(a, b), raw[at[a]: at[b]], at[a: b + 1] - at[a]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column from its concatenated values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def blobs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary column from concatenated values (any fixed-width dtype) and the
    number of values in each row."""
    data = np.ascontiguousarray(values)
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.asarray(counts, np.int64) * data.itemsize, out=offsets[1:])
    if offsets[-1] >= 2**31:
        raise ValueError("binary column over 2 GB: use smaller blocks")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data.tobytes())])


def _trim():
    import ctypes

    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def release() -> None:
    """Gives the memory of finished batches back to the system. Workers live
    on and are shared by stages; without this each keeps what its largest
    batch took."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``fn`` applied to each Arrow batch of ``df``; batches without rows are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
            del batch
            release()

    return df.mapInArrow(run, schema)


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
