import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import sp_viterbi as V
from quarry.llm.tables import table, tokenizer_file
from quarry.llm.token_counts import count_documents, token_counts
from quarry.llm.words import text_bytes

PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    return V.model(PATH)[0]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def best_sum(lattice, text):
    """A full search for the largest sum of scores."""
    best, back = [0.0], [None]
    for end in range(1, len(text) + 1):
        top = None
        for start in range(max(0, end - lattice.longest), end):
            hit = lattice.pieces.get(text[start:end])
            if hit:
                option = (best[start] + hit[1], start, [hit[0]])
            elif start == end - 1:
                option = (best[start] + lattice.unknown, start, [lattice.byte_ids[b] for b in text[start].encode()])
            else:
                continue
            if top is None or option[0] > top[0]:
                top = option
        best.append(top[0])
        back.append(top[1:])
    out, p = [], len(text)
    while p:
        p, ids = back[p]
        out = ids + out
    return out


def encoded(texts):
    raw, at = text_bytes(pa.array(texts, pa.string()))
    ids, n = V.encode_block(PATH, raw, at)
    back, back_at = V.decode_block(PATH, ids, n)
    ends = np.cumsum(n).tolist()
    assert [bytes(back[a:b]).decode() for a, b in zip(back_at[:-1], back_at[1:], strict=True)] == [t or "" for t in texts]
    return [ids[e - k: e].tolist() for e, k in zip(ends, n.tolist(), strict=True)]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet="theran  \né本🙂\x00.", max_size=60), max_size=4))
def test_parts_and_streaming_equal_the_library(lattice, library, texts):
    want = [library.encode(t) for t in texts]
    assert encoded(texts) == want
    assert [lattice.encode(" " + t if t else "") for t in texts] == want


def test_literal_space_sign_survives():
    encoded(["▁a ▁", "▁", " ▁▁ x"])


def test_table_equals_the_library(spark, library):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    assert encoded(texts) == [library.encode(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet="theran é本.", max_size=120))
def test_unigram_search_is_the_best_sum(lattice, text):
    pieces = {p: v for p, v in lattice.pieces.items() if len(p) < 6}
    unigram = V.Lattice(pieces, lattice.byte_ids, len(lattice.lengths), bpe=False)
    assert unigram.encode(text) == best_sum(unigram, text)


@pytest.mark.parametrize("bpe", [True, False])
def test_long_text_commits_in_a_bounded_window(lattice, library, bpe):
    model = V.Lattice(lattice.pieces, lattice.byte_ids, len(lattice.lengths), bpe)
    text = " " + "internationalization" * 300
    runs = list(model.search(text))
    assert len(runs) > 50 and max(map(len, runs)) <= 4 * model.longest
    assert [i for r in runs for i in r] == (library.encode(text[1:]) if bpe else best_sum(model, text))


def test_table_and_token_counts(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = V.digests(docs, PATH).collect()
    ids = {r.doc_id: list(r.ids) for r in V.encode(docs, PATH).collect()}
    counts = {r.doc_id: r.n_tokens for r in token_counts(docs, PATH).collect()}
    assert len(rows) == len(text) == len(counts)
    for r in rows:
        assert r.exact and r.decoded_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert r.n_tokens == len(ids[r.doc_id]) == counts[r.doc_id] and r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes())


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "tab\tand  ▁ é"), (3, "tab\tand  ▁ é"), (4, "long " * 40_000), (5, "</s><s>\x02")]
    df = spark.createDataFrame([(i, t, [7]) for i, t in rows], "doc_id long, text string, ids array<int>")
    got = V.encode(df, PATH).collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows] and all(r.exact for r in got)
    assert [r.n_tokens for r in got][:2] == [0, 0] and 2 not in {i for r in got for i in r.ids}
    counts = token_counts(df, PATH)
    assert sorted((str(r.doc_id), r.n_tokens) for r in counts.collect()) == sorted((str(r.doc_id), r.n_tokens) for r in got)
    for empty in (V.encode(df.where("false"), PATH), V.digests(df.where("false"), PATH), token_counts(df.where("false"), PATH)):
        assert empty.count() == 0


@pytest.mark.parametrize("block", [2, 6, 10, 64])
def test_documents_cross_blocks(spark, block):
    files = {1: [5, 2, 2, 9, 9, 9, 9, 9, 9, 9, 9, 9, 9, 9, 2, 7, 7], 2: [2], 3: [], 4: [8] * 40, 5: [8] * 31 + [2]}
    rows = []
    for f, ids in files.items():
        data = np.array(ids, "<u2").tobytes()
        rows += [(f, k, bytearray(data[a: a + block])) for k, a in enumerate(range(0, max(len(data), 1), block))]
    got = sorted(tuple(r) for r in count_documents(spark.createDataFrame(rows, "file long, block long, data binary").repartition(3)).collect())
    want = []
    for f, ids in files.items():
        start, k = 0, 0
        for p, i in enumerate(ids):
            if i == 2:
                want.append((f, k, start, p - start, True))
                start, k = p + 1, k + 1
        if start < len(ids):
            want.append((f, k, start, len(ids) - start, False))
    assert got == want
