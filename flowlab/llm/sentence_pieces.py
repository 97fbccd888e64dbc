"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text is cut into marked words (a run of word marks and what follows), since no piece crosses
the cut. The distinct words of a slice of texts are sorted, which is a depth-first walk of their
trie: going from one word to the next, the forward states of their common prefix are reused and
only the new characters are computed. A state says which piece ends at that character.

For a unigram model it is the piece of the best score. In a byte-pair model the merges decide,
not a sum of scores: a piece may follow another only if merging their characters gives back just
these two, and exactly one piece that ends at a character may follow the state it starts from.
That rule makes the same forward walk give the library's pieces exactly; characters without a
piece become byte pieces."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.chunk_ids import ChunkIds, in_parts, remembered, take_over
from flowlab.llm.common import byte_slices

MARK = "▁"
#: Score of a character without a piece, below the lowest piece's (unigram models).
UNKNOWN_PENALTY = 10.0
#: Bytes of words that a worker remembers: one that it does not costs a walk in Python.
CACHE_BYTES = 80 << 20
_READERS = remembered({})


class PieceModel:
    """Pieces of a model file (``sentencepiece`` reads it); ``kind`` is 'bpe' or 'unigram'."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        pieces = {i: sp.id_to_piece(i) for i in range(size)}
        plain = {p: i for i, p in pieces.items() if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        byte_ids = {int(pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self._prepare(plain, {p: sp.get_score(i) for p, i in plain.items()}, byte_ids, sp.unk_id(), kind, size)

    @classmethod
    def of(cls, pieces: dict[str, int], scores: dict[str, float], byte_ids: dict[int, int], unknown_id: int, kind: str):
        m = cls.__new__(cls)
        m._prepare(pieces, scores, byte_ids, unknown_id, kind, 1 + max([*pieces.values(), *byte_ids.values(), unknown_id]))
        return m

    def _prepare(self, pieces, scores, byte_ids, unknown_id, kind, size):
        self.ids, self.scores, self.byte_ids, self.unknown_id, self.kind = pieces, scores, byte_ids, unknown_id, kind
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece crosses a word's beginning: texts can't be cut at words")
        self.longest = max(map(len, pieces), default=1)
        self.least = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        # characters that no longer piece holds are words of their own
        held = set("".join(p for p in pieces if len(p) > 1)) | {MARK, " "}
        self._words = re.compile(("[ ]+[^ \n]*|\n|[^ \n]+" if "\n" not in held else "[ ]+[^ ]*|[^ ]+").encode())
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.follows: dict[tuple[str, str], bool] = {}
        if kind == "bpe":
            # pieces that merging their own characters does not give are never used
            self.rank = {p: r for r, p in enumerate(sorted(pieces, key=lambda p: -scores[p]))}
            self.usable = {p for p in pieces if len(p) == 1 or self._merge(p)}
        else:
            self.usable = set(pieces)
        self.bytes = [b""] * size
        for p, i in pieces.items():
            self.bytes[i] = p.replace(MARK, " ").encode()
        for b, i in byte_ids.items():
            self.bytes[i] = bytes([b])
        self.bytes[unknown_id] = b" \xe2\x81\x87 "

    def _merge(self, piece: str) -> bool:
        """Whether merging gives ``piece`` whole; keeps the two parts of its last merge."""
        symbols = list(piece)
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.rank.get(symbols[i] + symbols[i + 1], 1 << 60))
            pair = symbols[best] + symbols[best + 1]
            if pair not in self.rank:
                return False
            if len(symbols) == 2:
                self.parts[piece] = (symbols[0], symbols[1])
            symbols[best:best + 2] = [pair]
        return True

    def may_follow(self, a: str, b: str) -> bool:
        """Whether merging the characters of ``a`` and ``b`` gives back ``a`` and ``b``: undo the
        later of their merges step by step; no earlier merge may join the two across the border."""
        known = self.follows.get((a, b))
        if known is not None:
            return known
        x, y, before, answer = a, b, 1 << 60, True
        while True:
            if self.rank.get(x + y, 1 << 60) < before:
                answer = False
                break
            rx, ry = (self.rank[z] if z in self.parts else -1 for z in (x, y))
            if rx < 0 and ry < 0:
                break
            if rx > ry:
                before, x = rx, self.parts[x][1]
            else:                      # of equal merges the left one comes first, so this one loses the tie
                before, y = ry + 1, self.parts[y][0]
        if len(self.follows) > 2_000_000:
            self.follows.clear()
        self.follows[a, b] = answer
        return answer

    def words(self, text: bytes) -> list[bytes]:
        """Marked words of a text; spaces stand for marks, one is put before the text."""
        if not text:
            return []
        return self._words.findall(b" " + text.replace(MARK.encode(), b" "))

    def encode_sorted(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct words in ascending order, sharing the forward states of prefixes."""
        out, path, last = [], [(0.0, 0, "")], ""                 # a state: score, where its piece begins, the piece
        usable, longest, bpe = self.usable, self.longest, self.kind == "bpe"
        for raw in words:
            w = raw.decode().replace(" ", MARK)
            keep = 0
            for x, y in zip(w, last):
                if x != y:
                    break
                keep += 1
            del path[keep + 1:]
            for end in range(keep + 1, len(w) + 1):
                state = None
                for begin in range(max(0, end - longest), end):
                    piece = w[begin:end]
                    if piece not in usable and begin + 1 < end:
                        continue
                    before = path[begin]
                    if bpe:
                        if begin == 0 or self.may_follow(before[2], piece):
                            state = (before[0] + self.scores.get(piece, self.least), begin, piece)
                            break
                    else:
                        score = before[0] + self.scores.get(piece, self.least)
                        if state is None or score > state[0]:
                            state = (score, begin, piece)
                path.append(state)
            ids, end = [], len(w)
            while end:
                _, begin, piece = path[end]
                i = self.ids.get(piece)
                if i is not None:
                    ids.append(i)
                elif self.byte_ids:
                    ids.extend(self.byte_ids[b] for b in reversed(piece.encode()))
                else:
                    ids.append(self.unknown_id)
                end = begin
            out.append(ids[::-1])
            last = w
        return out

    def decode(self, ids) -> str:
        """The text of ids: marks are spaces, the one before the text goes."""
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace").removeprefix(" ")


def reader(path: str, kind: str) -> tuple[PieceModel, ChunkIds]:
    """One for each Python worker."""
    if (path, kind) not in _READERS:
        take_over()
        m = PieceModel(path, kind)
        _READERS[path, kind] = (m, ChunkIds(lambda new: in_parts(new, m.encode_sorted, 1 << 15), CACHE_BYTES, ordered=True))
    return _READERS[path, kind]


def encode(docs: DataFrame, model_path: str, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every row, from the scan, without a shuffle. Null and empty texts have no
    ids; repeated rows are encoded alike; other columns are not looked at. Empty in, empty out."""
    def run(batches):
        m, chunks = reader(model_path, kind)
        for b in batches:
            for lo, hi, texts in byte_slices(b.column(1), 4 << 20):
                ids, ends = chunks([m.words(t) for t in texts])
                offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, model_path: str, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded_sha256 and same_text of every row, from the scan, without a shuffle:
    the ids as :func:`encode` gives them, the SHA-256 of the text that they decode to, and whether
    that is the text (null counts as empty). Repeated rows are coded alike; other columns are not
    looked at. Empty in, empty out."""
    def run(batches):
        m, chunks = reader(model_path, kind)
        for b in batches:
            for lo, hi, texts in byte_slices(b.column(1), 4 << 20):
                ids, ends = chunks([m.words(t) for t in texts])
                digests, same, begin = [], [], 0
                for t, end in zip(texts, ends.tolist()):
                    back, begin = m.decode(ids[begin:end].tolist()).encode(), end
                    digests.append(hashlib.sha256(back).hexdigest())
                    same.append(back == t)
                offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))),
                                                  pa.array(digests, pa.string()), pa.array(same, pa.bool_())], names=["doc_id", "ids", "decoded_sha256", "same_text"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string")) \
        .mapInArrow(run, "doc_id long, ids array<int>, decoded_sha256 string, same_text boolean")


def decode(encoded: DataFrame, model_path: str, kind: str = "bpe", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids give a null text. Word marks (U+2581) of the
    original come back as spaces, as the model can't tell them apart."""
    def run(batches):
        m, _ = reader(model_path, kind)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([None if x is None else m.decode(x) for x in part.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].cast("array<int>")).mapInArrow(run, "doc_id long, text string")
