"""The objects of one large JSON array, read by many tasks (S3).

A feature collection is one JSON object, often on one line. Spark cuts it into
blocks at closing braces; each block is kept in cells of about ``CELL`` bytes in
the shared folder. What a brace means depends on all that stands before it:

1. Each cell reports how it changes the state (inside a string or not, depth of
   braces and of brackets), for both states of the string at its start.
2. These are added up over the cells of a file (a row a cell), which gives the
   state that each cell begins in.
3. Each cell then emits the objects at the array's depth that lie in it, and the
   end or the start of one that crosses its border. Those pieces, at most two a
   cell, are put together by (file, place of the object's start).

The file must end where its outermost object ends; a file that does not, and
one without the array, are errors. What stands between the objects of the array
is not checked further.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

CELL = 4 << 20
CELLS = "file_path string, block long, seq long, text binary, odd int, braces array<int>, brackets array<int>"
WHOLE, HEAD, TAIL, ARRAY = range(4)
#: kind: an object, the end of one, the start of one, or a top-level array's name
PARTS = "file_path string, block long, seq long, place int, kind int, value string"
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$')


def _quotes(raw: np.ndarray) -> np.ndarray:
    """Places of quotes that are not escaped. (A cell never begins after a backslash.)"""
    at = np.flatnonzero(raw == 34)
    other = np.flatnonzero(raw != 92)
    before = np.searchsorted(other, at) - 1
    last = np.where(before >= 0, other[np.maximum(before, 0)], -1)
    return at[(at - last - 1) % 2 == 0]


def _outside(raw: np.ndarray, quotes: np.ndarray, odd: bool) -> np.ndarray:
    """Which bytes are outside strings."""
    change = np.zeros(len(raw), np.int8)
    change[quotes] = 1
    return (np.cumsum(change, dtype=np.int64) + int(odd)) % 2 == 0


def _depths(raw: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Change of the depth of braces and of brackets at each byte."""
    step = lambda a, b: np.where(outside, (raw == a).astype(np.int8) - (raw == b).astype(np.int8), np.int8(0))
    return step(123, 125), step(91, 93)


def _cells(most: int):
    """Step 1: pieces (texts without the brace they end with) to cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size, seq = None, [], 0, 0

        def cell() -> pa.RecordBatch:
            raw = np.frombuffer(b"}".join([*held, b""]), np.uint8)
            quotes = _quotes(raw)
            both = [[int(d.sum()) for d in _depths(raw, _outside(raw, quotes, odd))] for odd in (False, True)]
            return pa.RecordBatch.from_pydict(
                {"file_path": [at[0]], "block": [at[1]], "seq": [seq], "text": [raw.tobytes()], "odd": pa.array([len(quotes) % 2], pa.int32()),
                 "braces": pa.array([[b[0] for b in both]], pa.list_(pa.int32())), "brackets": pa.array([[b[1] for b in both]], pa.list_(pa.int32()))}
            )

        for batch in batches:
            for value, path, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if (path, block) != at or size >= most:
                    if held:
                        yield cell()
                    seq = seq + 1 if (path, block) == at else 0
                    at, held, size = (path, block), [], 0
                held.append(value.encode())
                size += len(held[-1]) + 1
        if held:
            yield cell()

    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: objects of top-level arrays, from the cells with the state they begin in."""
    for batch in batches:
        for row in range(batch.num_rows):
            path, block, seq, text, odd, brace, bracket = (batch.column(c)[row].as_py() for c in range(7))
            raw = np.frombuffer(text, np.uint8)
            braces, brackets = _depths(raw, _outside(raw, _quotes(raw), bool(odd)))
            curly, square = brace + np.cumsum(braces, dtype=np.int64), bracket + np.cumsum(brackets, dtype=np.int64)
            starts = np.flatnonzero((braces == 1) & (curly == 2) & (square == 1))
            ends = np.flatnonzero((braces == -1) & (curly == 1) & (square == 1))
            opened = np.flatnonzero((brackets == 1) & (curly == 1) & (square == 1))
            out = [(int(p), ARRAY, m[1].decode() if (m := _KEY.search(text[: int(p)])) else "") for p in opened]
            inside = brace >= 2 and bracket >= 1
            if inside:
                end = int(ends[0]) + 1 if len(ends) and not (len(starts) and starts[0] < ends[0]) else len(text)
                out.append((-1, HEAD, text[:end].decode()))
                ends = ends[1:] if end < len(text) or len(ends) and ends[0] == len(text) - 1 else ends
            whole = min(len(starts), len(ends))
            out += [(a, WHOLE, text[a: b + 1].decode()) for a, b in zip(starts[:whole].tolist(), ends[:whole].tolist(), strict=True)]
            if len(starts) > whole:
                out.append((int(starts[-1]), TAIL, text[int(starts[-1]):].decode()))
            if out:
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n), pa.array([block] * n, pa.int64()), pa.array([seq] * n, pa.int64()), pa.array([p for p, _, _ in out], pa.int32()), pa.array([k for _, k, _ in out], pa.int32()), pa.array([v for _, _, v in out], pa.string())],
                    names=["file_path", "block", "seq", "place", "kind", "value"],
                )


def _last_bytes(spark: SparkSession, path: str, n: int = 256) -> bytes:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.open(target)
    try:
        stream.seek(max(0, files.getFileStatus(target).getLen() - n))
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def read_objects(spark: SparkSession, paths: Sequence[str], key: str) -> DataFrame:
    """(value, file_path) of the objects in the top-level array ``key`` of each file."""
    folder = f"{ensure_checkpoint_dir(spark)}/json-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    pieces = spark.read.option("lineSep", "}").text(list(paths))
    pieces = pieces.select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"))
    pieces.mapInArrow(_cells(CELL), CELLS).write.option("parquet.block.size", str(8 << 20)).option("parquet.block.size.row.check.min", "1").parquet(f"{folder}/cells")
    rows = spark.read.schema(CELLS).parquet(f"{folder}/cells")

    order = Window.partitionBy("file_path").orderBy("block", "seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    state = rows.select("file_path", "block", "seq", "odd", "braces", "brackets").withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    own = {c: F.get(F.col(c), F.col("inside").cast("int")) for c in ("braces", "brackets")}
    state = state.select("file_path", "block", "seq", "odd", "inside", *(v.alias(c) for c, v in own.items()))
    summed = state.select("file_path", "block", "seq", "inside", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_at") for c in own))
    for r in state.groupBy("file_path").agg(F.sum("odd").alias("odd"), F.sum("braces").alias("braces"), F.sum("brackets").alias("brackets")).collect():  # a row a file
        tail = _last_bytes(spark, r["file_path"])
        cut = not tail.rstrip().endswith(b"}")
        blank = 1 if tail.endswith((b" ", b"\n", b"\r", b"\t")) else 0  # a piece of blanks has no brace of its own
        if cut or r["odd"] % 2 or r["braces"] + blank or r["brackets"]:
            raise ValueError(f"{r['file_path']}: malformed, the outermost object does not end (FAILFAST)")
    ready = rows.select("file_path", "block", "seq", "text").join(summed, ["file_path", "block", "seq"])
    ready = ready.select("file_path", "block", "seq", "text", F.col("inside").cast("int"), F.col("braces_at").cast("int"), F.col("brackets_at").cast("int"))
    ready.mapInArrow(_parts, PARTS).write.parquet(f"{folder}/parts")
    parts = spark.read.schema(PARTS).parquet(f"{folder}/parts")

    arrays = parts.where(F.col("kind") == ARRAY).orderBy("file_path", "block", "seq", "place").collect()  # a row for each top-level array
    names = {r["file_path"] for r in rows.select("file_path").distinct().collect()}
    missing = sorted(names - {r["file_path"] for r in arrays if r["value"] == key})
    if missing or not names:
        raise ValueError(f"{missing or list(paths)}: a decoded file has no {key}")
    place = F.struct("block", "seq", "place")
    at = lambda r: F.struct(F.lit(r["block"]).cast("long"), F.lit(r["seq"]).cast("long"), F.lit(r["place"]).cast("int"))
    parts = parts.where(F.col("kind") != ARRAY)
    start = F.last(F.when(F.col("kind") == TAIL, place), ignorenulls=True).over(Window.partitionBy("file_path").orderBy("block", "seq", "place"))
    pieces = parts.where(F.col("kind") != WHOLE).withColumn("start", start).groupBy("file_path", "start")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "place", "value"))), lambda p: p["value"]), "")
    joined = pieces.agg(text.alias("value")).where("start is not null").select("value", "file_path", "start.block", "start.seq", "start.place")
    out = parts.where(F.col("kind") == WHOLE).select("value", "file_path", "block", "seq", "place").unionByName(joined)
    others = [(r, nxt) for r, nxt in zip(arrays, [*arrays[1:], None], strict=True) if r["value"] != key]
    for r, nxt in others:  # objects of another array
        after = (F.col("file_path") == r["file_path"]) & (place > at(r))
        out = out.where(~(after & (place < at(nxt)) if nxt is not None and nxt["file_path"] == r["file_path"] else after))
    return out.select("value", "file_path")
