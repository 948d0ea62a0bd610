import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import memo
from quarry.llm.id_files import EliasFano, IdFile, encode_and_read, pack, word_ids
from quarry.llm.tables import table, tokenizer_file
from quarry.llm.words import text_bytes

PATH = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=80))
def test_elias_fano(steps):
    values = np.cumsum(np.array(steps, np.int64))
    ef = EliasFano.of(values)
    assert ef.select(np.arange(len(values))).tolist() == values.tolist()
    if len(values):
        bits = 8 * (len(ef.low) + len(ef.upper))
        assert bits <= len(values) * (3 + max(1, int(values[-1]) // len(values)).bit_length()) + 24


def test_file_round_trip():
    ids = np.arange(10, dtype=np.uint16)
    f = IdFile(memoryview(pack([None, 4, 9], np.array([1, 0, 9]), ids) + b"\nEND\n"))
    assert f.doc_ids == [None, 4, 9]
    assert [f.doc(i).tolist() for i in range(3)] == [[0], [], list(range(1, 10))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé'«×!$ \n1<|>́日 \x1c", max_size=25), max_size=4))
def test_units_encode_like_whole_texts(tok, rows):
    ids, n = word_ids(PATH, *text_bytes(pa.array(rows, pa.string())))
    ends = np.cumsum(n).tolist()
    got = [ids[e - k: e].tolist() for e, k in zip(ends, n.tolist(), strict=True)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in rows]


def test_memo_overflows_and_collides():
    m = memo.Memo(lambda new: [[len(b), b[0]] for b in new], slots=2)
    from quarry.llm.words import scan

    for _ in range(3):
        raw, at = text_bytes(pa.array(["aa b ccc aa d eeee b"]))
        ids, n = m.ids(raw, scan(raw, at))
        assert ids.tolist() == [2, 97, 1, 98, 3, 99, 2, 97, 1, 100, 4, 101, 1, 98] and n.tolist() == [2] * 7


def brute(tok, rows):
    out, start = [], 0
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_table(spark, tok):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    got = sorted(map(tuple, encode_and_read(docs.repartition(3), PATH).collect()))
    assert got == brute(tok, rows)


def test_defined_cases(spark, tok):
    rows = [(None, "null id"), (3, None), (5, ""), (7, "word " * 50_000), (8, "<|endoftext|> it's"), (8, "<|endoftext|> it's")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows[::-1]], "doc_id long, text string, shard int")
    got = sorted(map(tuple, encode_and_read(df, PATH).collect()), key=lambda r: r[1])
    assert got == brute(tok, rows)
    assert encode_and_read(df.where("false"), PATH).count() == 0


def test_select_directory_is_small_and_exact():
    rng = np.random.default_rng(5)
    cases = [rng.integers(0, 900, 100_000), rng.integers(0, 2, 5_000), np.zeros(2_000, int), np.ones(512, int), np.ones(513, int),
             np.concatenate([np.ones(700, int), [3_000_000], np.ones(900, int)]), np.array([0]), np.array([7])]
    for counts in cases:
        values = np.cumsum(counts)
        ef = EliasFano.of(values)
        places = rng.integers(0, len(values), 3_000)  # in any order, repeated
        assert ef.select(places).tolist() == values[places].tolist()
        assert ef.select(np.arange(len(values))).tolist() == values.tolist()
        assert ef.select(np.zeros(0, int)).tolist() == []
        tables = [x for x in vars(ef).values() if isinstance(x, np.ndarray)]
        assert all(x.dtype.itemsize <= 4 for x in tables)
        if len(values) > 4_000:
            assert 10 * ef._noted.nbytes < ef.low.nbytes + ef.upper.nbytes
    assert EliasFano.of(np.zeros(0, int)).select(np.zeros(0, int)).tolist() == []
