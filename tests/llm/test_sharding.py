import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm.sharding import pack, pack_into, shards_by_bytes, size_class
from quarry.llm.tables import table


def naive(sizes, capacity):
    rooms = []
    for s in sorted((s for s, c in sizes for _ in range(c)), reverse=True):
        fits = [(r, k) for k, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits)[1]] -= s
        else:
            rooms.append(max(capacity, s) - s)
    return rooms


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 6), max_size=12), st.integers(1, 100))
def test_pack_is_best_fit_decreasing(sizes, capacity):
    got = Counter()
    for s, b, n in pack(list(sizes.items()), capacity):
        got[b] += s * n
    rooms = naive(sizes.items(), capacity)
    assert len(got) == len(rooms)
    assert sorted(got.values()) == sorted(Counter({k: max(capacity, 0) - r for k, r in enumerate(rooms)}.values()).elements()) or max(sizes) > capacity
    placed = Counter()
    for s, _, n in pack(list(sizes.items()), capacity):
        placed[s] += n
    assert placed == Counter(sizes)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 5000), st.integers(1, 9), min_size=1, max_size=40), st.integers(1, 9))
def test_pack_into_places_all(sizes, shards):
    placed, load = Counter(), Counter()
    for s, b, n in pack_into(list(sizes.items()), shards):
        placed[s] += n
        load[b] += s * n
    assert placed == Counter(sizes) and set(load) <= set(range(shards))
    share = sum(s * c for s, c in sizes.items()) / shards
    assert max(load.values()) <= share + max(sizes)


def check(rows, docs, shards=24):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(shards))
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t in docs)
    assert {r.law for r in rows} <= {"bytes"} and all(r.grown_shard is None for r in rows)


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    rows = shards_by_bytes(docs, 24).collect()
    text = dict(map(tuple, docs.collect()))
    check(rows, list(text.items()))
    load, where = Counter(), defaultdict(set)
    for r in rows:
        load[r.shard] += r["size"]
        where[text[r.doc_id]].add(r.shard)
    assert max(load.values()) <= 1.001 * min(load.values()) and all(len(s) == 1 for s in where.values())


def test_hot_group_and_defined_cases(spark):
    docs = [(i, "hot text " * 50) for i in range(400)] + [(1000 + i, f"t{i}") for i in range(300)] + [(None, None), (5000, None), (5001, ""), (5001, "")]
    rows = shards_by_bytes(spark.createDataFrame([(i, t, 3) for i, t in docs], "doc_id long, text string, shard int"), 6).collect()
    check(rows, docs, 6)
    assert len({r.shard for r in rows if r["size"] == 458}) == 1 and len({r.shard for r in rows}) == 6
    assert shards_by_bytes(spark.createDataFrame([], "doc_id long, text string"), 6).count() == 0


def test_many_groups_of_one_size(spark, monkeypatch):
    from quarry.llm import sharding

    monkeypatch.setattr(sharding, "CLASS_RUN", 50)
    monkeypatch.setattr(sharding, "SLOT_RUN", 20)
    docs = [(i, f"{i:05d}") for i in range(1000)]
    rows = shards_by_bytes(spark.createDataFrame(docs, "doc_id long, text string"), 7).collect()
    check(rows, docs, 7)
    load = Counter(r.shard for r in rows)
    assert max(load.values()) - min(load.values()) <= 7


def test_size_class(spark):
    got = spark.range(1, 20_000, 7).select("id", size_class(F.col("id")).alias("c")).collect()
    assert all(r.id <= r.c <= r.id * (1 + 2**-10) for r in got) and all(r.c == r.id for r in got if r.id < 4096)
