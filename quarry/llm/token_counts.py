"""Token counts of documents in flat, unindexed token files.

A token file is nothing but ids (unsigned 16-bit, little-endian); every
document ends with the end id. Counting needs no index: files are cut into
blocks of a fixed number of bytes wherever that falls, each block is
searched for end ids with one vectorised comparison, and the blocks'
borders are stitched by a prefix scan: running sums of ids and of ends, and
the running maximum of the last end's position, give every block its
document number and the place where its first document began.

``write_files`` makes such files from texts with Spark's text writer (a row
is a file's ids, the line separator is the last end id), and beside each
the doc_ids in order, so that counts can be named.

Defined cases: null and empty texts count 0; a null doc_id is kept; ids
after the last end id of a file are a document that has not ended (``ended``
false); empty files have no documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.id_files import with_end
from quarry.llm.sp_viterbi import encode_block
from quarry.llm.tables import arrow_map, binary_files, lists, release, scratch, text_blocks

END_ID = 2
SEPARATOR = "\x02\x00"
BLOCK_BYTES = 1 << 20


def write_files(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Token files of (doc_id, text) below ``path``: kind=tokens and kind=doc_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [with_end(*encode_block(tokenizer, raw, at), END_ID)[0] for _, raw, at in text_blocks(batch)]
            names = batch.column(0)
            known = np.frombuffer(names.is_valid().cast(pa.uint8()).buffers()[1], np.uint8)[: batch.num_rows]
            values = names.fill_null(0).to_numpy().astype("<i8")
            tokens = np.concatenate(ids).astype("<u2")[:-1]  # the separator is the last end id
            yield pa.RecordBatch.from_arrays(
                [pa.array(["tokens", "doc_ids"]), pa.array([number, number]), pa.array([tokens.tobytes(), values.tobytes() + known.tobytes()], pa.binary())],
                names=["kind", "file", "data"],
            )
            del batch, ids, tokens, values, known, names
            release()
            number += 1

    files = docs.select("doc_id", "text").mapInArrow(run, "kind string, file long, data binary")
    files.select("kind", "file", F.col("data").cast("string").alias("value")).write.partitionBy("kind", "file").option("lineSep", SEPARATOR).text(path)


def _files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return binary_files(spark, path, {"kind": "string", "file": "long"}).where(F.col("kind") == kind).select("file", "length", "content")


def read_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, data) of the token files below ``path``."""
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("length") / block_bytes) - 1, F.lit(0)).cast("long")))
    return _files(spark, path, "tokens").select("file", number.alias("block"), "content").select(
        "file", "block", F.substring("content", (F.col("block") * block_bytes + 1).cast("int"), F.lit(block_bytes)).alias("data")
    )


def _scanned(end: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for r in range(batch.num_rows):
            ids = np.frombuffer(batch.column(2)[r].as_buffer(), "<u2")
            at = np.flatnonzero(ids == end)
            out.append((len(ids), at))
        last = [int(a[-1]) if len(a) else None for _, a in out]
        gaps = [None if not k else int(a[k] - a[k - 1] - 1) for _, a in out for k in range(len(a))]
        counts = np.array([len(a) for _, a in out])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([n for n, _ in out], pa.int64()), pa.array(counts, pa.int64()), pa.array(last, pa.int64()),
                lists(np.concatenate([a for _, a in out]), counts, pa.int64()), lists(gaps, counts, pa.int64()),
            ],
            names=["file", "block", "n", "ends", "last", "at", "gap"],
        )

    return run


def count_documents(blocks: DataFrame, end: int = END_ID) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document in the blocks
    (file, block, data); documents may cross any number of blocks."""
    scanned = arrow_map(blocks.select("file", "block", "data"), _scanned(end), "file long, block long, n long, ends long, last long, at array<long>, gap array<long>")
    by = Window.partitionBy("file").orderBy("block")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    placed = (
        scanned.withColumn("base", F.coalesce(F.sum("n").over(before), zero))
        .withColumn("ordinal", F.coalesce(F.sum("ends").over(before), zero))
        .withColumn("from", F.coalesce(F.max(F.col("base") + F.col("last")).over(before) + 1, zero))
        .withColumn("is_last", F.lead("block").over(by).isNull())
    )
    each = placed.where("ends > 0").select("file", "ordinal", "base", "from", F.posexplode(F.arrays_zip("at", "gap")).alias("i", "d"))
    end_at = F.col("base") + F.col("d.at")
    n_tokens = F.coalesce("d.gap", end_at - F.col("from"))  # the first end of a block closes what began before it
    ended = each.select("file", (F.col("ordinal") + F.col("i")).alias("ordinal"), (end_at - n_tokens).alias("start"), n_tokens.alias("n_tokens"), F.lit(True).alias("ended"))
    tail_from = F.when(F.col("ends") > 0, F.col("base") + F.col("last") + 1).otherwise(F.col("from"))
    tail = placed.where("is_last").select(
        "file", (F.col("ordinal") + F.col("ends")).alias("ordinal"), tail_from.alias("start"), (F.col("base") + F.col("n") - tail_from).alias("n_tokens"), F.lit(False).alias("ended")
    ).where("n_tokens > 0")
    return ended.unionAll(tail)


def _names(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for r in range(batch.num_rows):
        data = batch.column(1)[r].as_buffer()
        n = (len(data) - len(SEPARATOR)) // 9
        known = np.frombuffer(data, np.uint8, n, 8 * n).astype(bool)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, batch.column(0)[r].as_py())), pa.array(np.arange(n)), pa.array(np.frombuffer(data, "<i8", n), mask=~known)],
            names=["file", "ordinal", "doc_id"],
        )


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, file, ordinal, start, n_tokens) of each row of ``docs``
    (doc_id, text), counted in token files made from it."""
    spark = docs.sparkSession
    path = scratch(spark, "token-files")
    write_files(docs, path, tokenizer)
    counted = count_documents(read_blocks(spark, path))
    names = arrow_map(_files(spark, path, "doc_ids").select("file", "content"), _names, "file long, ordinal long, doc_id long")
    return names.join(counted, ["file", "ordinal"], "left").select("doc_id", "file", "ordinal", "start", "n_tokens")
