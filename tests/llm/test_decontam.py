import hashlib
import re

from quarry.llm import decontam
from quarry.llm.decontam import build_index, contamination, search
from quarry.llm.tables import table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12)) if w else []:
            windows.setdefault(tuple(w[k:k + 13]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    found |= windows[tuple(w[k:k + n])]
                    hit.update(range(k, k + n))
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def check(spark, docs, items):
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(docs, items), key=key)


def test_table(spark):
    docs = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "benchmark").select("item_id", "text").collect()]
    check(spark, docs, items)


def test_defined_cases(spark):
    item = " ".join(f"q{i}" for i in range(16))
    long = "pad " * 50_000
    docs = [(1, None), (2, ""), (3, "..."), (4, "x " + item + " y"), (5, item.upper().replace(" ", "-")), (6, long + item), (7, "short item"), (8, "ab ab ab ab"),
            (9, item[:20]), (10, item.rsplit(" ", 1)[0]), (10, item), (None, item), (11, "q0 q1 q2 q3 q4 q5 q6"), (12, "q7 q8 q9 q10 q11 q12 q13")]
    items = [(10, item), (2, item), (2, item), (3, None), (4, ""), (5, "Short ITEM"), (6, "ab ab"), (None, "x q0")]
    check(spark, docs, items)
    check(spark, docs, [])
    check(spark, [], items)


def test_phrase_does_not_cross_documents(spark):
    check(spark, [(1, "a b c"), (2, "d e f")], [(1, "c d"), (2, "b c")])


def test_blocks_of_items_unite(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    items = table(spark, "/root/testdata/sf0.001", "benchmark")
    index = build_index(docs)
    norm = lambda df: sorted((r.doc_id, r.n_words, tuple(r.starts), tuple(r.ends), tuple(sorted(set(r["items"])))) for r in df.collect())
    assert norm(search(index, items, block_words=100)) == norm(search(index, items))


def near_brute(docs, items, slack):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12)) if w else []:
            windows.setdefault((len(w[k:k + 13]), frozenset(w[k:k + 13])), set()).add(i)
    out = []
    for d, t in docs:
        w, found = words(t), set()
        for (n, terms), ids in windows.items():
            if terms <= set(w) and any(terms <= set(w[k:k + n + slack]) for k in range(len(w))):
                found |= ids
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(names), hashlib.sha256(",".join(names).encode()).hexdigest()))
    return out


def check_near(spark, docs, items, slack):
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), slack=slack)
    key = lambda r: tuple(str(x) for x in r)
    rows = sorted(((r.doc_id, r.n_near, r.near_sha256) for r in got.collect()), key=key)
    assert rows == sorted(near_brute(docs, items, slack), key=key)
    return rows


def test_proximity(spark):
    docs = [(1, "a x b y c"), (2, "c z z z z z z b a"), (3, "c b a"), (4, "a b"), (5, "c b"), (6, "a"), (None, "b a c"), (7, None), (8, "")]
    rows = check_near(spark, docs, [(1, "a b c"), (1, "a b c"), (2, None), (3, "z z a"), (None, "a")], 2)
    assert [r[0] for r in rows if r[1]] == [1, 2, 3, None]
    check_near(spark, docs, [], 2)


def test_proximity_of_moved_and_inserted_words(spark):
    item = [f"q{i}" for i in range(16)]
    spread = " pad ".join(item)
    docs = [(1, " ".join(reversed(item))), (2, " ".join(item[:6] + ["new", "words"] + item[6:])), (3, spread), (4, "common " * 3000 + " ".join(item[3:])),
            (5, " ".join(item[:8])), (6, " ".join(item[8:]))]
    items = [(1, " ".join(item)), (2, "common q3 q5"), (3, "common common q3")]
    check_near(spark, docs, items, 7)
    check_near(spark, docs, items, 0)


def test_proximity_on_table(spark):
    docs = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "benchmark").select("item_id", "text").collect()]
    check_near(spark, docs, items, decontam.SLACK)


def test_proximity_runs_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ANCHORS", 2)
    w = decontam.W.scan
    text = ("a b x a x x x b a x x x x b " * 5).encode()
    import numpy as np
    seg = decontam.Segment.of(w(np.frombuffer(text, np.uint8), np.array([0, len(text)]), decontam.W.ALNUM))
    other = seg.find(w(np.frombuffer(b"a b", np.uint8), np.array([0, 3]), decontam.W.ALNUM).hash)
    tokens = text.decode().split()
    rare = "a" if tokens.count("a") <= tokens.count("b") else "b"
    want = [p for p, t in enumerate(tokens) if t == rare and any({"a", "b"} <= set(tokens[s:s + 3]) and s <= p < s + 3 for s in range(len(tokens)))]
    assert sorted(seg.near(*other, 3)) == want
