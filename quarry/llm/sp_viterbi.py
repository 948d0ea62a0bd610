"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes through a text once and keeps, for every position, one
surviving path: the piece that ends there and a backpointer. It looks back
over ``longest`` positions only, since no piece reaches further. Whenever
the paths of all positions that a later piece can start from meet in one
boundary, the ids up to it can no longer change: they are committed and
forgotten.

Which path survives follows from the kind of the model:

* unigram: the one with the largest sum of scores (equal sums go to the
  longer last piece);
* bpe: the one that merging pairs by score would give. Of two neighbouring
  pieces such a path is the merge of their own text; a path all of whose
  neighbours are so is the merge of the whole, and for each position there
  is exactly one. Neighbours are checked once and remembered. Sums of the
  scores (which are merge ranks in these models) would give other ids than
  the model was made for.

Some boundaries are certain beforehand: where two bytes meet that stand
beside each other in no piece (a letter before a space, say, or a line
break and anything), every path has a boundary. Texts are cut there, and
each distinct part is searched once per worker (``Memo``, bounded).

Rules: a space is put before every text that is not empty; a character
without a piece becomes its UTF-8 bytes (byte pieces), in unigram models at
the lowest piece score less ``UNKNOWN``. Decoding joins the pieces and
takes the first space away again, so it returns every text exactly (a
literal U+2581 is sent as bytes).

Defined cases: null and empty texts have no ids and decode to the empty
text; null or repeated doc_ids are carried along row by row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.memo import Memo
from quarry.llm.tables import arrow_map, lists, text_blocks
from quarry.llm.words import Words, units

UNKNOWN = 10  # below the lowest score
NEIGHBOURS = 1 << 18  # pairs of pieces remembered at once
SPACE = "▁"


class Lattice:
    """Pieces and scores of a model, with the streaming search."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], size: int, bpe: bool):
        self.pieces, self.byte_ids, self.bpe = pieces, byte_ids, bpe
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN
        self.reach: dict[str, int] = {}  # the longest piece by its last three characters
        self.joined = np.zeros(1 << 16, bool)  # bytes beside each other in a piece or a character
        self.joined.reshape(256, 256)[:, 0x80:0xC0] = True
        for p in pieces:
            self.reach[p[-3:]] = max(len(p), self.reach.get(p[-3:], 0))
            b = np.frombuffer(p.encode(), np.uint8).astype(np.int64)
            self.joined[b[:-1] << 8 | b[1:]] = True
        self.text = {i: p for p, (i, _) in pieces.items()}
        self.neighbours: dict[tuple[int, int], bool] = {}
        text = [b""] * size
        for p, (i, _) in pieces.items():
            text[i] = p.encode()
        for b, i in enumerate(byte_ids):
            text[i] = bytes([b])
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.lengths = np.array([len(t) for t in text], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    @classmethod
    def load(cls, path: str) -> Lattice:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.ModelProto.FromString(sp.serialized_model_proto()).trainer_spec
        ids = range(sp.get_piece_size())
        odd = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        pieces = {sp.id_to_piece(i).replace(SPACE, " "): (i, sp.get_score(i)) for i in ids if i not in odd}
        return cls(pieces, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], len(ids), spec.model_type == spec.BPE)

    def merged(self, text: str) -> list[str]:
        """A short text by merging the best-scored pair again and again, the
        first of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                hit = self.pieces.get(parts[k] + parts[k + 1])
                if hit is not None and (best is None or hit[1] > best):
                    best, at = hit[1], k
            if best is None:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def beside(self, left: int, right: int) -> bool:
        """Whether merging the joint text of two pieces gives these two again;
        no left piece (-1): whether it gives the right one."""
        if len(self.neighbours) >= NEIGHBOURS:
            self.neighbours.clear()
        pair = [self.text[i] for i in (left, right) if i >= 0]
        known = self.neighbours[left, right] = self.merged("".join(pair)) == pair
        return known

    def search(self, text: str) -> Iterator[list[int]]:
        """Committed ids of ``text``, run by run."""
        get, reach, known = self.pieces.get, self.reach.get, self.neighbours.get
        base, best, back, ids = 0, [0.0], [0], [-1]  # from the last committed boundary on, its last piece first
        n = len(text)
        for pos in range(1, n + 1):
            top, at, piece = None, pos - 1, -1  # unless a piece fits: the character's bytes
            low = pos - reach(text[pos - 3 if pos > 3 else 0: pos], 2)
            for start in range(low if low > base else base, pos):  # the longest piece first
                hit = get(text[start:pos])
                if hit is None:
                    continue
                if self.bpe:
                    pair = ids[start - base], hit[0]
                    if known(pair) or known(pair) is None and self.beside(*pair):
                        at, piece = start, hit[0]
                        break
                else:
                    score = best[start - base] + hit[1]
                    if top is None or score > top:
                        top, at, piece = score, start, hit[0]
            if not self.bpe:
                if text[pos - 1] not in self.pieces and (top is None or best[-1] + self.unknown > top):
                    top, at, piece = best[-1] + self.unknown, pos - 1, -1
                best.append(top)
            back.append(at)
            ids.append(piece)
            if pos - base >= 2 * self.longest and pos < n:
                meet = self._meeting(back, base, pos)
                if meet > base:
                    yield self._path(text, back, ids, base, meet)
                    keep = meet - base
                    del best[:keep], back[:keep], ids[:keep]
                    base = meet
        if n > base:
            yield self._path(text, back, ids, base, n)

    def _meeting(self, back: list[int], base: int, pos: int) -> int:
        """The last boundary on the paths of all positions that a later piece can start from."""
        alive = set(range(max(base, pos + 1 - self.longest), pos + 1))
        while len(alive) > 1:
            p = max(alive)
            alive.remove(p)
            alive.add(max(back[p - base], base))
        return alive.pop()

    def _path(self, text: str, back: list[int], ids: list[int], base: int, end: int) -> list[int]:
        out: list[int] = []
        p = end
        while p > base:
            i = ids[p - base]
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.byte_ids[b] for b in reversed(text[p - 1].encode()))
            p = back[p - base]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Ids of a part of a text, spaces as they stand."""
        return [i for run in self.search(text) for i in run]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the pieces, one after another."""
        n = self.lengths[ids]
        take = np.arange(int(n.sum())) + np.repeat(self.starts[ids] - (np.cumsum(n) - n), n)
        return self.bytes[take]


def spaced(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space before each that is not empty."""
    some = np.diff(offsets) > 0
    return np.insert(raw, offsets[:-1][some], 0x20), offsets + np.concatenate([[0], np.cumsum(some)])


def parts(lattice: Lattice, raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Parts of (spaced) texts between certain boundaries."""
    begin = np.zeros(len(raw), bool)
    begin[1:] = ~lattice.joined[raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:]]
    return units(raw, begin, offsets)


_models: dict[str, tuple[Lattice, Memo]] = {}


def model(path: str) -> tuple[Lattice, Memo]:
    """The model of a file and the ids found so far, once for each worker."""
    if path not in _models:
        lattice = Lattice.load(path)
        size = np.uint16 if len(lattice.lengths) <= 1 << 16 else np.uint32
        _models[path] = lattice, Memo(lambda new: [lattice.encode(b.decode(errors="replace")) for b in new], size)
    return _models[path]


def encode_block(path: str, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids of each text) of some whole texts."""
    lattice, memo = model(path)
    text, at = spaced(raw, offsets)
    p = parts(lattice, text, at)
    ids, n = memo.ids(text, p)
    ends = np.concatenate([[0], np.cumsum(n)])
    return ids, ends[p.first[1:]] - ends[p.first[:-1]]


def decode_block(path: str, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts of some id sequences."""
    lattice, _ = model(path)
    text = lattice.decode(ids.astype(np.int64))
    size = np.concatenate([[0], np.cumsum(lattice.lengths[ids.astype(np.int64)])])
    ends = np.cumsum(counts)
    at = np.concatenate([[0], size[ends]]) if len(counts) else np.zeros(1, np.int64)
    some = np.diff(at) > 0
    plain = np.delete(text, at[:-1][some])
    return plain, at - np.concatenate([[0], np.cumsum(some)])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with the ids of its text: (doc_id, ids, n_tokens, exact);
    ``exact`` tells that decoding gave the text back."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in text_blocks(batch):
            ids, n = encode_block(path, raw, at)
            back, back_at = decode_block(path, ids, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(rows.start, rows.stop - rows.start), lists(ids.astype(np.int32), n, pa.int32()), pa.array(n), pa.array(_same(raw, at, back, back_at))],
                names=["doc_id", "ids", "n_tokens", "exact"],
            )

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>, n_tokens long, exact boolean")


def _same(raw: np.ndarray, at: np.ndarray, back: np.ndarray, back_at: np.ndarray) -> list[bool]:
    if np.array_equal(at, back_at) and np.array_equal(raw, back):
        return [True] * (len(at) - 1)
    return [np.array_equal(raw[a:b], back[c:d]) for a, b, c, d in zip(at[:-1], at[1:], back_at[:-1], back_at[1:], strict=True)]


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, decoded_crc32, exact): checksums of the
    ids (little-endian unsigned 32-bit) and of the decoded UTF-8 text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in text_blocks(batch):
            ids, n = encode_block(path, raw, at)
            back, back_at = decode_block(path, ids, n)
            wide = memoryview(ids.astype("<u4").tobytes())
            ends = 4 * np.concatenate([[0], np.cumsum(n)])
            crc = [zlib.crc32(wide[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            text = memoryview(back.tobytes())
            decoded = [zlib.crc32(text[a:b]) for a, b in zip(back_at[:-1].tolist(), back_at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(rows.start, rows.stop - rows.start), pa.array(n), pa.array(crc, pa.int64()), pa.array(decoded, pa.int64()), pa.array(_same(raw, at, back, back_at))],
                names=["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "exact"],
            )

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, exact boolean")
