"""Delimited text read by many tasks a file, line breaks in quotes included.

Spark cuts a file into blocks at line breaks. Whether a line break ends a
record depends on the quotes before it, in this block and all before:

1. Each block is scanned as if it began outside quotes. Its lines are joined
   to records, a record that is open at its end is kept as its tail, and the
   block reports its quote parity. Both go to a table in the shared folder.
2. The parities are added up over the blocks of a file (a row a block), which
   gives the state that each block really begins in.
3. Blocks that begin inside quotes are cut anew. Their lines up to the end of
   the open record belong to the record of an earlier block: such pieces, at
   most two a block, are put together by (file, block of the record's start).

Files without line breaks in quotes are done after step 2. The parity of quotes
is only right if quotes stand around whole fields (doubled inside). A block
also reports quotes that do not, for both states; files with any are listed
(``ill_quoted``), and left to the reader of whole files.

Records come without the line end (``\\n`` or ``\\r\\n``); empty lines are none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

WHOLE, HEAD, TAIL, SUMMARY = range(4)
#: kind: a record, the end of an open one, the start of one that goes on, or a block's summary
ROWS = "file_path string, block long, seq long, kind int, value string, parity int, odd_out int, odd_in int"


def _misplaced(raw: np.ndarray, at: np.ndarray, odd: bool, comma: int) -> bool:
    """Whether some quote at ``at`` neither opens nor closes a field; ``odd``: the bytes begin inside quotes."""
    before = np.where(at > 0, raw[np.maximum(at - 1, 0)], 10)
    after = np.where(at + 1 < len(raw), raw[np.minimum(at + 1, len(raw) - 1)], 10)
    opens = (np.arange(len(at)) % 2 == 0) != odd
    sides = np.where(opens, before, after)
    return bool((~np.isin(sides, [10, 13, 34, comma])).any())


class _Cutter:
    """Lines of one block to records, from a given state."""

    def __init__(self, odd: bool = False):
        self.odd, self.head = odd, odd  # head: the lines of an open record come first
        self.held: list[str] = []  # lines of a record that goes on

    def cut(self, lines: pa.Array) -> tuple[list[str], str | None]:
        """(records that end in these lines, the end of the record that was open at the block's start)."""
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        state = (np.cumsum(quotes) + int(self.odd)) % 2
        ends = np.flatnonzero(state == 0) + 1
        if not len(ends):
            self.held += lines.to_pylist()
            self.odd = bool(state[-1]) if len(state) else self.odd
            return [], None
        first = "\n".join([*self.held, *lines.slice(0, ends[0]).to_pylist()])
        offsets = pa.array(ends, pa.int32())
        rest = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n").to_pylist() if len(ends) > 1 else []
        self.held = lines.slice(ends[-1]).to_pylist()
        self.odd = bool(state[-1])
        if self.head:
            self.head = False
            return rest, first
        return [first, *rest], None

    def tail(self) -> str | None:
        return "\n".join(self.held) if self.held else None


def _batch(path: str, block: int, seq: int, kinds: list[int], values: list, parity=None, odd_out=None, odd_in=None) -> pa.RecordBatch:
    n = len(kinds)
    number = lambda v, kind=pa.int32(): pa.array([v] * n, kind)
    return pa.RecordBatch.from_arrays(
        [number(path, pa.string()), number(block, pa.int64()), pa.array(range(seq, seq + n), pa.int64()), pa.array(kinds, pa.int32()), pa.array(values, pa.string()), number(parity), number(odd_out), number(odd_in)],
        names=["file_path", "block", "seq", "kind", "value", "parity", "odd_out", "odd_in"],
    )


def _scan(skip: int, comma: int):
    """Step 1: records of each block as if it began outside quotes, and its summary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None  # (file, block) whose lines are being read
        cutter, seq, left, marks = _Cutter(), 0, 0, [False, False]

        def end() -> Iterator[pa.RecordBatch]:
            if at is not None:
                tail = cutter.tail()
                kinds, values = ([TAIL], [tail]) if tail is not None else ([], [])
                yield _batch(*at, seq, [*kinds, SUMMARY], [*values, None], int(cutter.odd), int(marks[0]), int(marks[1]))

        for batch in batches:
            if not batch.num_rows:
                continue
            path, block = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            new = np.flatnonzero(np.array([True, *(a != b for a, b in zip(path, path[1:], strict=False))]) | np.append(True, block[1:] != block[:-1]))
            for a, b in zip(new, [*new[1:], batch.num_rows], strict=True):
                here = (path[a], int(block[a]))
                if here != at:
                    yield from end()
                    at, cutter, seq, left, marks = here, _Cutter(), 0, skip if here[1] == 0 else 0, [False, False]
                drop = min(left, b - a)  # the file's first lines
                left -= drop
                lines = batch.column(0).slice(a + drop, b - a - drop)
                if not len(lines):
                    continue
                was = cutter.odd
                raw = np.frombuffer("\n".join(lines.to_pylist()).encode(), np.uint8)
                quotes = np.flatnonzero(raw == 34)
                marks = [m or _misplaced(raw, quotes, was != odd, comma) for m, odd in zip(marks, (False, True), strict=True)]
                records, _ = cutter.cut(lines)
                if records:
                    yield _batch(*at, seq, [WHOLE] * len(records), records)
                    seq += len(records)
        yield from end()

    return run


def _recut(table: pa.Table) -> pa.Table:
    """Step 3: the rows of a block that begins inside quotes."""
    rows = table.sort_by("seq")
    rows = rows.filter(pc.not_equal(rows.column("kind"), SUMMARY))
    lines = [line for value in rows.column("value").to_pylist() for line in value.split("\n")]
    path, block = table.column("file_path")[0].as_py(), table.column("block")[0].as_py()
    cutter = _Cutter(odd=True)
    records, head = cutter.cut(pa.array(lines, pa.string())) if lines else ([], None)
    kinds, values = [WHOLE] * len(records), list(records)
    tail = cutter.tail()
    if head is not None:
        kinds, values = [HEAD, *kinds], [head, *values]
    if tail is not None:  # without a head the block is the middle of one record
        kinds, values = [*kinds, TAIL if head is not None else HEAD], [*values, tail]
    return pa.Table.from_batches([_batch(path, block, 0, kinds, values, int(cutter.odd) if head is not None or tail is None else None)])


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(list(paths))
    return raw.select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"))


def read_records(spark: SparkSession, paths: Sequence[str], skip: int = 0, delimiter: str = ",") -> tuple[DataFrame, list[str]]:
    """(records (value, file_path, block, seq) of the files, without the first
    ``skip`` lines of each; the files with quotes inside a field, whose records
    are not among them)."""
    path = f"{ensure_checkpoint_dir(spark)}/blocks-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    _lines(spark, paths).mapInArrow(_scan(skip, ord(delimiter)), ROWS).write.parquet(path)
    rows = spark.read.schema(ROWS).parquet(path)
    order = Window.partitionBy("file_path").orderBy("block")
    before = F.coalesce(F.sum("parity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    states = rows.where(F.col("kind") == SUMMARY).withColumn("inside", before == 1)
    odd = F.when(F.col("inside"), F.col("odd_in")).otherwise(F.col("odd_out")) == 1
    # a row for each block that begins inside quotes, and each file that is ill quoted
    found = states.withColumn("odd", odd).where("inside or odd").select("file_path", "block", "inside", "odd").collect()
    ill = sorted({r["file_path"] for r in found if r["odd"]})
    inside = [(r["file_path"], r["block"]) for r in found if r["inside"] and not r["odd"] and r["file_path"] not in ill]
    good = rows.where(F.col("kind") != SUMMARY).where(~F.col("file_path").isin(ill)) if ill else rows.where(F.col("kind") != SUMMARY)
    if inside:
        of = F.broadcast(spark.createDataFrame(inside, "file_path string, block long").withColumn("inside", F.lit(True)))
        marked = good.join(of, ["file_path", "block"], "left")
        again = marked.where("inside").drop("inside").groupBy("file_path", "block").applyInArrow(_recut, ROWS)
        good = marked.where("inside is null").drop("inside").unionByName(again)
    whole = good.where(F.col("kind") == WHOLE).select("value", "file_path", "block", "seq")
    parts = good.where(F.col("kind") != WHOLE)
    start = F.last(F.when(F.col("kind") == TAIL, F.struct("block", "seq")), ignorenulls=True).over(Window.partitionBy("file_path").orderBy("block", "kind"))
    open_ = parts.withColumn("start", start).groupBy("file_path", "start")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", F.col("kind") == HEAD, "value"))), lambda p: p["value"]), "\n")
    joined = open_.agg(text.alias("value")).select("value", "file_path", F.col("start.block").alias("block"), F.col("start.seq").alias("seq"))
    out = whole.unionByName(joined)
    return out.select(F.regexp_replace("value", "\r$", "").alias("value"), "file_path", "block", "seq").where("value <> ''"), ill


def parse(records: DataFrame, names: Sequence[str], corrupt: str) -> DataFrame:
    """Text columns ``names`` of records, and the record itself in ``corrupt``
    if it has another number of fields (its fields are NULL then)."""
    ddl = ", ".join(f"c{i} STRING" for i in range(len(names))) + ", corrupt STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt", "nullValue": "\u0000", "quote": '"', "escape": '"'}
    parsed = records.select(F.from_csv("value", ddl, options).alias("r"), "file_path")
    return parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)], F.col("r.corrupt").alias(corrupt), "file_path")
