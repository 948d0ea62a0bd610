import itertools
import re
from collections import Counter

import pytest

from quarry.llm import near_dedup
from quarry.llm.components import components
from quarry.llm.near_dedup import near_duplicates
from quarry.llm.tables import table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = {}
    for i, s in sets.items():
        for g in s:
            inverted.setdefault(g, []).append(i)
    common = Counter(p for ids in inverted.values() for p in itertools.combinations(sorted(ids), 2))
    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(spark, rows):
    df = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}
    assert got == brute(rows)


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    check(spark, [tuple(r) for r in docs.collect()])


def test_edited_copies_of_one_text(spark):
    """Copies edited in different degrees: only some link to the centre."""
    base = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(60):
        words = list(base)
        for j in range(k % 12):
            words[(37 * k + 13 * j) % 150] = f"e{k}x{j}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(base[: 150 - 4 * k])) for k in range(20)]  # cut shorter step by step
    check(spark, rows)


def test_defined_cases(spark):
    long = " ".join(f"v{i % 7919}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One TWO"), (6, "one two three"), (7, long), (8, long + " tail"), (9, "a b c d e"), (9, "a b c d e")]
    df = spark.createDataFrame([(i, t, "k", True) for i, t in rows] + [(None, "one two", "k", True)], "doc_id long, text string, keys string, kept boolean")
    got = Counter(tuple(r) for r in near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect())
    n = len(shingles(long))
    assert got == Counter([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, n, 7, True), (8, n + 1, 7, False),
        (9, 1, 9, True), (9, 1, 9, True), (None, 1, None, None),
    ])


def test_one_id_on_two_texts(spark):
    """Rows of one id stand for their own text each, and neither loses its links."""
    a, b = ([f"{k}{i}" for i in range(120)] for k in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (5, " ".join(a[:-3])), (6, " ".join(b[:-3])), (7, " ".join(b)), (7, "x y z"), (8, "x y z")]
    got = Counter(tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == Counter([(1, 116, 1, True), (1, 116, 1, True), (5, 113, 1, False), (6, 113, 1, False), (7, 116, 1, False), (7, 1, 7, True), (8, 1, 7, False)])


def test_pages_of_one_frame_are_not_paired(spark, monkeypatch):
    """Pages that share 84 % pairwise, just under the threshold: no link, and
    no pair from what all of them share."""
    seen = []
    around = near_dedup._around_centres

    def counted(open_, sets):
        pairs = around(open_, sets)
        seen.append((open_.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(near_dedup, "_around_centres", counted)
    frame = [f"w{i}" for i in range(500)]
    rows = [(k, " ".join(frame + [f"p{k}x{j}" for j in range(48)])) for k in range(300)]
    near = [(1000 + k, " ".join(frame + [f"p{k}x{j}" for j in range(40)])) for k in range(0, 300, 50)]  # each near one page
    check(spark, rows + near)
    assert seen and seen[0][0] > 100
    assert seen[0][1] <= 10 * seen[0][0]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("edges", [
    [], [(5, 5)], [(i, i + 1) for i in range(40)], [(100, i) for i in range(30)] + [(i, i + 50) for i in range(0, 30, 3)], [(1, 2), (2, 1), (3, 4), (4, 9), (9, 3)],
])
def test_components(spark, edges):
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
