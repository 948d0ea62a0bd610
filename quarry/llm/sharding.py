"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (equal texts) are taken by falling size; each enters the bin with
the least remaining room that still holds it, found in a balanced tree of
the open bins; if none holds it, a bin is opened.

The packing itself sees a histogram, not the groups: sizes are rounded up
to ``PRECISION`` significant bits, so there are at most a few ten thousand
size classes whatever the input. Equal sizes follow one another in the
falling order and, once a bin is the tightest, the next equal item finds it
the tightest again; so a run of equal items fills bin after bin, and one
step packs many groups. Rounding up never overfills a bin. The groups are
then dealt to the (class, from, to, bin) intervals by their rank in the
class, with Spark joins and windows whose partitions are bounded: large
classes are salted and the salts' offsets added up.

For a given number of shards the capacity is searched: the smallest found
that packs into that many bins. A group larger than an equal share gets a
bin of its own and the rest is packed into the others.

Defined cases: a null text has 8 bytes and crc 0, null texts are equal to
one another but not to empty ones; repeated rows are copies; null ids are
dealt like others; an empty table gives no rows.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.tables import written

PRECISION = 12  # significant bits of a size class
CLASS_RUN = 20_000  # groups of a class that are ranked together
SLOT_RUN = 5_000  # rows of a shard that are numbered together


class Treap:
    """Balanced tree of (room, bin); ``take`` removes the tightest fit."""

    def __init__(self) -> None:
        self.root = None
        self.random = random.Random(1)

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._join(self._join(low, [key, self.random.random(), None, None]), high)

    def take(self, room: int) -> tuple[int, int] | None:
        """The smallest (room, bin) with at least that much room."""
        low, rest = self._split(self.root, (room, -1))
        if rest is None:
            self.root = low
            return None
        path, node = [], rest
        while node[2] is not None:
            path.append(node)
            node = node[2]
        if path:
            path[-1][2] = node[3]
        else:
            rest = node[3]
        self.root = self._join(low, rest)
        return node[0]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b


def pack(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """(size, bin, how many) by best-fit decreasing, from (size, how many);
    None if more than ``most`` bins would be needed. Sizes over the capacity
    get bins of their own."""
    tree, bins, out = Treap(), 0, []
    for size, count in sorted(sizes, reverse=True):
        while count:
            fit = tree.take(size)
            if fit is None:
                if bins == most:
                    return None
                fit = (max(capacity, size), bins)
                bins += 1
            room, bin_ = fit
            n = min(count, room // size) if size else count
            out.append((size, bin_, n))
            count -= n
            if room - n * size or not size:
                tree.add((room - n * size, bin_))
    return out


def pack_into(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Packs into ``shards`` bins of nearly equal size."""
    left = sorted(((s, c) for s, c in sizes if c), reverse=True)
    alone: list[tuple[int, int, int]] = []
    bins = shards
    while left and bins > 1 and left[0][0] * bins > sum(s * c for s, c in left):
        size, count = left[0]
        alone.append((size, shards - bins, 1))
        bins -= 1
        left = ([(size, count - 1)] if count > 1 else []) + left[1:]
    total = sum(s * c for s, c in left)
    low, high = -(-total // bins), -(-total // bins) + (left[0][0] if left else 0)
    best = None
    while low <= high:
        mid = (low + high) // 2 if best is not None else low
        packed = pack(left, mid, bins)
        if packed is None:
            low = mid + 1
            if best is None:  # open the search from the equal share upwards
                step = max(1, total // bins // 4096)
                while best is None:
                    packed = pack(left, mid + step, bins)
                    if packed is None:
                        low, step = mid + step + 1, step * 2
                    else:
                        best, high = packed, mid + step - 1
        else:
            best, high = packed, mid - 1
        if best is not None and high - low < max(1, total // bins // 65536):
            break
    first = shards - bins
    return alone + [(s, b + first, n) for s, b, n in best or []]


def size_class(size):
    """Size rounded up to PRECISION significant bits."""
    bits = F.greatest(F.floor(F.log2(F.greatest(size, F.lit(1)))) - (PRECISION - 1), F.lit(0)).cast("int")
    step = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
    return (F.ceil(size / step) * step).cast("long")


def shards_by_bytes(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row
    of ``docs`` (doc_id, text): equal texts share a shard, shards are nearly
    equal in bytes, slots are gapless from 0."""
    spark = docs.sparkSession
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0)).alias("text_crc32"),
            F.xxhash64("text", F.col("text").isNull()).alias("h"),
        ),
        "sizes",
    )
    same = ["h", "text_crc32", "size"]
    groups = rows.groupBy(same).agg(F.count("*").alias("copies")).select(*same, size_class(F.col("size") * F.col("copies")).alias("cls"))
    groups = written(groups, "groups")
    classes = written(groups.groupBy("cls").agg(F.count("*").alias("n")), "classes")  # bounded by PRECISION
    packed = pack_into([(r["cls"], r["n"]) for r in classes.collect()], shards)
    seen: dict[int, int] = {}
    runs = []
    for size, bin_, n in packed:
        lo = seen.get(size, 0)
        runs.append((size, lo, lo + n, bin_))
        seen[size] = lo + n
    runs_df = F.broadcast(spark.createDataFrame(runs, "cls long, lo long, hi long, shard int"))

    salted = groups.join(F.broadcast(classes), "cls").select(*same, "cls", F.pmod("h", F.ceil(F.col("n") / CLASS_RUN)).alias("salt"))
    before = Window.partitionBy("cls").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("cls", "salt").agg(F.count("*").alias("n")).select("cls", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("cls", "salt").orderBy(*same)
    ranked = salted.withColumn("nth", F.row_number().over(order)).join(offsets, ["cls", "salt"]).withColumn("rank", F.col("offset") + F.col("nth") - 1)
    placed = ranked.join(runs_df, "cls").where("rank >= lo and rank < hi").select(*same, "shard")

    dealt = written(rows.join(placed, same), "dealt")
    total = dealt.count()
    buckets = max(1, total // (shards * SLOT_RUN))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    up_to = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row"))
    return (
        dealt.withColumn("nth", nth)
        .join(starts, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
