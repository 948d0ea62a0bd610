import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import words as W

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE_WORDS = re.compile("[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aBz9é本 \t\n\x0b\x1c.'_", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_scan_matches_regex(rows):
    raw, at = W.text_bytes(pa.array(rows, pa.string()))
    for inside, pattern in ((W.NOT_SPACE, SPACE_WORDS), (W.ALNUM, ALNUM_WORDS)):
        w = W.scan(raw, at, inside)
        got = [[bytes(raw[s:e]).decode().translate(LOWER) for s, e in zip(w.start[a:b], w.end[a:b], strict=True)]
               for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        assert got == [pattern.findall((t or "").translate(LOWER)) for t in rows]
        seen = {}
        for word, h in zip([x for r in got for x in r], w.hash.tolist(), strict=True):
            assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_hash_does_not_depend_on_place_or_pieces(monkeypatch):
    text = ["x" * 500 + " ab cd " + "ab " * 300, "ab"]
    raw, at = W.text_bytes(pa.array(text))
    whole = W.scan(raw, at).hash
    monkeypatch.setattr(W, "PIECE", 64)
    assert (W.scan(raw, at).hash == whole).all()
    assert whole[1] == whole[-1] == whole[5]


def test_windows_of_short_and_long_rows():
    raw, at = W.text_bytes(pa.array(["a b c d", "a b", "", None, "a b c"]))
    w = W.scan(raw, at)
    at_, row = W.windows(w, 3)
    assert row.tolist() == [0, 0, 1, 4]
    h, row = W.run_hashes(w, 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 3
    assert np.array_equal(W.windows(w, 3)[0], at_)
