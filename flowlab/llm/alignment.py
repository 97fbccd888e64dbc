"""Alignment of two tokenizers over whole texts, as an Arrow pipeline.

The tokens of a slice of documents lie in two flat lists, with the parent (document) of each
token. Cumulative sums of token bytes, started anew at each document, are the places where
tokens end; an Acero join of both sides' (document, end) keys finds where both end at once. Two
such ends enclose a group, and any two tokens of both sides that overlap share exactly one
stretch between neighbouring ends of either side: those stretches are the links.

How many documents hold an id pair linked is counted in each slice by ``Table.group_by`` and
summed by Spark. A slice keeps its links as places in its own list of pairs, so what travels is
one row for each distinct pair of a slice, there and back, and the links once."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.chunk_ids import ChunkIds, flattened, in_parts, remembered, take_over
from flowlab.llm.common import byte_slices
from flowlab.llm.model_store import new_folder
from flowlab.llm.sentence_pieces import MARK

#: Bytes of text in a slice (about; a longer document is a slice of its own).
SLICE_BYTES = 1 << 20
#: Slices whose rows of one pair may meet under one key; more are dealt over more keys.
SLICES_PER_KEY = 1 << 20
#: Bytes that a worker's table of chunks remembers.
CACHE_BYTES = 32 << 20
_CODERS = remembered({})
MARK_BYTES = MARK.encode()
_SECOND = np.uint32(1 << 31)                                     # marks the ids of the second tokenizer where both lie in one list
_MARKS = [",", "|", ";", ""]                                     # what follows a token in a document's list of groups


def _byte_of_sign() -> dict[str, int]:
    """The signs that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself,
    the others in order from U+0100 (fixed rule)."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def _bytes_of_ids(by_id: dict[int, bytes]) -> pa.Array:
    return pa.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], pa.large_binary())


class _Coder:
    """Both encoders of a worker, with the bytes of their tokens. Texts are encoded by their
    :func:`joint_chunks`, as neither tokenizer has a token across such a cut."""

    def __init__(self, byte_level_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(byte_level_path)
        tok.encode_special_tokens = True                         # their strings are ordinary text
        with open(byte_level_path, encoding="utf-8") as f:
            special = {t["id"] for t in json.load(f).get("added_tokens", [])}
        sign = _byte_of_sign()
        self.a_bytes = _bytes_of_ids({i: t.encode() if i in special else bytes(sign[c] for c in t) for t, i in tok.get_vocab().items()})
        sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = {i: sp.id_to_piece(i) for i in range(sp.get_piece_size())}
        self.b_bytes = _bytes_of_ids({i: bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode()
                                      for i, p in pieces.items() if not (sp.is_control(i) or sp.is_unknown(i))})
        mark, mask = [i for i, p in pieces.items() if p == MARK], int(_SECOND)

        def one_by_one(chunks):
            a = [e.ids for e in tok.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]
            # the library puts the first space itself, but not before nothing
            b = [mark if c == b" " else ids for c, ids in zip(chunks, sp.encode([c[1:].decode() for c in chunks], num_threads=1))]
            return [[i | mask for i in y] + x for x, y in zip(a, b)]

        def encode(chunks):
            """Many chunks as one text, whose tokens end where they end."""
            plain, other = [], []
            for c in chunks:
                (plain if _cut_behind(c) and c[:1] == b" " and MARK_BYTES not in c else other).append(c)
            for i in range(0, len(plain), 4096):
                part = plain[i:i + 4096]
                text, ends = b"".join(part).decode(), np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
                a = np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                b = np.array(sp.encode(text[1:], num_threads=1), np.uint32)
                cuts = [_cuts(ids, size, ends) for ids, size in ((a, a_size), (b, b_size))]
                if any(c is None for c in cuts):
                    yield from in_parts(part, one_by_one)
                    continue
                n_a, n_b = cuts
                sizes = n_a + n_b
                first = np.cumsum(sizes) - sizes
                flat = np.empty(len(a) + len(b), np.uint32)
                flat[np.arange(len(b)) + np.repeat(np.cumsum(n_a) - n_a, n_b)] = b | _SECOND
                flat[np.arange(len(a)) + np.repeat(first + n_b - (np.cumsum(n_a) - n_a), n_a)] = a
                yield part, flat, sizes
            yield from in_parts(other, one_by_one)

        a_size, b_size = (pc.binary_length(t).to_numpy() for t in (self.a_bytes, self.b_bytes))
        self.both = ChunkIds(encode, CACHE_BYTES)
        signs = [f"{i}{m}".encode() for i in range(max(len(self.a_bytes), len(self.b_bytes))) for m in _MARKS]
        self.shown = pa.array(signs, pa.large_binary())

    def __call__(self, texts: list[bytes]):
        """(ids, ends of the texts) by either tokenizer; a space stands before each text."""
        ids, ends = self.both.of(*all_joint_chunks(texts))
        second = ids >= _SECOND
        before = np.concatenate(([0], np.cumsum(second)))[ends]
        return (ids[~second], ends - before), (ids[second] ^ _SECOND, before)


def _cut_behind(text: bytes) -> bool:
    """Whether a text may be cut before a space that follows this: behind a visible ASCII character
    or one of U+00C0 to U+00FF (so never behind white space)."""
    return bool(text) and (0x20 < text[-1] < 0x7F or text[-2:-1] == b"\xc3")


def _cuts(ids: np.ndarray, size: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
    """How many tokens each stretch up to one of ``ends`` (in bytes) has; None if a token crosses one."""
    token_ends = np.cumsum(size[ids])
    at = np.searchsorted(token_ends, ends, side="right")
    if not len(ids) or token_ends[-1] != ends[-1] or not (token_ends[at - 1] == ends).all():
        return None
    return np.diff(at, prepend=0)


def joint_chunks(text: bytes) -> list[bytes]:
    """``text`` cut before each space where :func:`_cut_behind` allows it."""
    out, held = [], []
    for w in text.split(b" "):
        if held and _cut_behind(held[-1]):
            out.append(b" ".join(held))
            held = [b"", w]
        else:
            held.append(w)
    out.append(b" ".join(held))
    return [c for c in out if c]


def all_joint_chunks(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The :func:`joint_chunks` of a space and each text, in a row, and the ends of the texts in
    it; an empty text has none."""
    if any(b"\0" in t for t in texts):                           # the mark of a cut below
        return flattened([joint_chunks(b" " + t) if t else [] for t in texts])
    spaced = pa.array([b" " + t if t else None for t in texts], pa.string())
    lists = pc.split_pattern(pc.replace_substring_regex(spaced, "([\x21-\x7e\u00c0-\u00ff]) ", "\\1\0 "), "\0")
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten().cast(pa.binary()), np.cumsum(sizes, dtype=np.int64)


def coder(byte_level_path: str, piece_path: str) -> _Coder:
    """One for each Python worker."""
    key = (byte_level_path, piece_path)
    if key not in _CODERS:
        take_over()
        _CODERS[key] = _Coder(*key)
    return _CODERS[key]


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int64()), pa.array(ids.astype(np.int32)))


def _joined(ids: pa.Array, table: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens' bytes in a row, and where each token ends in it."""
    taken = table.take(ids)
    offsets = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8)
    data = taken.buffers()[2]
    return (np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data and len(taken) else np.zeros(0, np.uint8)), offsets[1:] - offsets[0]


def lossless(ids: np.ndarray, ends: np.ndarray, table: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Which texts the bytes of their tokens give back, with the space before them."""
    data, token_ends = _joined(pa.array(ids.astype(np.int32)), table)
    stops = np.concatenate(([0], token_ends))[np.concatenate(([0], ends))]
    whole = data.tobytes()
    return np.array([bool(t) and whole[s:e] == b" " + t for t, s, e in zip(texts, stops[:-1].tolist(), stops[1:].tolist())], bool)


def _kept(ids: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(np.concatenate(([0], ends)))
    return ids[np.repeat(keep, sizes)], np.cumsum(np.where(keep, sizes, 0))


def _ends_in_document(lists: pa.Array, table: pa.Array) -> pa.Table:
    """A row for each token: doc, id, at (its place in the slice), end (bytes of its document up
    to and with it)."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    running = pc.cumulative_sum(pc.binary_length(table.take(ids)).cast(pa.int64()))
    last = np.array(lists.offsets)[:-1] - np.array(lists.offsets)[0]
    before = np.concatenate(([0], running.to_numpy(zero_copy_only=False)))[last]
    end = pc.subtract(running, pa.array(before, pa.int64()).take(doc))
    return pa.table({"doc": doc, "end": end, "id": ids, "at": pa.array(np.arange(len(ids)))})


def align(a: pa.Array, b: pa.Array, a_bytes: pa.Array, b_bytes: pa.Array) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Links of the documents whose tokens are in the lists ``a`` and ``b``: a row for each in the
    order of the text (doc, a_id, b_id, group_end: whether a group ends there), and for each token
    of either side the number of groups that end before it."""
    left, right = _ends_in_document(a, a_bytes), _ends_in_document(b, b_bytes)
    both = left.join(right, ["doc", "end"], join_type="full outer", left_suffix="_a", right_suffix="_b", use_threads=False) \
        .sort_by([("doc", "ascending"), ("end", "ascending")])
    # a stretch belongs to the tokens that end with it or after it
    at_a, at_b = (pc.fill_null_backward(both[c].combine_chunks()) for c in ("at_a", "at_b"))
    common = pc.and_(pc.is_valid(both["at_a"]), pc.is_valid(both["at_b"])).combine_chunks()
    stretches = pa.table({"doc": both["doc"], "a_id": left["id"].take(at_a), "b_id": right["id"].take(at_b), "group_end": common})
    shut = common.to_numpy(zero_copy_only=False)
    group = np.cumsum(shut) - shut                               # groups of the slice before each stretch
    of_a, of_b = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
    of_a[at_a.to_numpy(zero_copy_only=False)] = group
    of_b[at_b.to_numpy(zero_copy_only=False)] = group
    return stretches, of_a, of_b


def _group_texts(shown: pa.Array, a_ids, b_ids, of_a, of_b, a_ends, b_ends) -> list[bytes | memoryview]:
    """`a1,a2|b1;a3|b2,b3` of each document: all its tokens in this order, each with the mark
    behind it."""
    n_a, n_b = len(a_ids), len(b_ids)
    if not n_a:
        return [b""] * len(a_ends)
    groups = int(of_a[-1]) + 1
    a_in, b_in = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    place_a = np.arange(n_a) + (np.cumsum(b_in) - b_in)[of_a]
    place_b = np.arange(n_b) + np.cumsum(a_in)[of_b]
    mark_a, mark_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    mark_a[np.cumsum(a_in) - 1] = 1
    mark_b[np.cumsum(b_in) - 1] = 2
    mark_b[b_ends[np.diff(np.concatenate(([0], b_ends))) > 0] - 1] = 3
    line = np.zeros(n_a + n_b, np.int64)
    line[place_a], line[place_b] = a_ids.astype(np.int64) * len(_MARKS) + mark_a, b_ids.astype(np.int64) * len(_MARKS) + mark_b
    data, ends = _joined(pa.array(line), shown)
    stops = np.concatenate(([0], ends))[np.concatenate(([0], a_ends + b_ends))]
    whole = memoryview(data.tobytes())
    return [whole[s:e] for s, e in zip(stops[:-1].tolist(), stops[1:].tolist())]


_SLICE = ("slice string, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
          "links binary, pair_a array<int>, pair_b array<int>, pair_docs array<int>")


def _slice_row(c: _Coder, name: str, doc_ids: list, texts: list[bytes]) -> dict:
    (a_ids, a_ends), (b_ids, b_ends) = c(texts)
    keep = lossless(a_ids, a_ends, c.a_bytes, texts) & lossless(b_ids, b_ends, c.b_bytes, texts)
    (a_ids, a_ends), (b_ids, b_ends) = _kept(a_ids, a_ends, keep), _kept(b_ids, b_ends, keep)
    links, of_a, of_b = align(_lists(a_ids, a_ends), _lists(b_ids, b_ends), c.a_bytes, c.b_bytes)
    doc = links["doc"].to_numpy()
    groups = np.bincount(doc[links["group_end"].to_numpy()], minlength=len(texts))
    key = pc.add(pc.shift_left(links["a_id"].cast(pa.int64()), 32), links["b_id"].cast(pa.int64())).combine_chunks()
    coded = key.dictionary_encode()
    held = pa.table({"pair": coded.indices, "doc": links["doc"]}).group_by(["pair", "doc"], use_threads=False).aggregate([])
    counts = held.group_by("pair", use_threads=False).aggregate([([], "count_all")])
    docs = np.zeros(len(coded.dictionary), np.int32)
    docs[counts["pair"].to_numpy()] = counts["count_all"].to_numpy()
    pairs = coded.dictionary.to_numpy()
    shown = _group_texts(c.shown, a_ids, b_ids, of_a, of_b, a_ends, b_ends)
    return {"slice": name, "doc_id": doc_ids, "n_a": np.diff(a_ends, prepend=0), "n_b": np.diff(b_ends, prepend=0), "n_groups": groups,
            "n_links": np.bincount(doc, minlength=len(texts)), "groups_sha256": [hashlib.sha256(s).hexdigest() if k else "" for s, k in zip(shown, keep.tolist())],
            "links": zstandard.ZstdCompressor(level=1).compress(coded.indices.to_numpy().astype("<i4").tobytes()), "pair_a": pairs >> 32, "pair_b": pairs & 0xFFFFFFFF, "pair_docs": docs}


_TYPES = {"slice": pa.string(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
          "groups_sha256": pa.string(), "links": pa.binary(), "pair_a": pa.int32(), "pair_b": pa.int32(), "pair_docs": pa.int32()}


def _one_row(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[k]], t) if k in ("slice", "links") else pa.ListArray.from_arrays([0, len(row[k])], pa.array(row[k], t))
                                       for k, t in _TYPES.items()], names=list(_TYPES))


def slices(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each slice of documents: their figures, their links as places in the slice's own
    list of id pairs, and in how many of its documents each pair is linked."""
    def run(batches):
        from pyspark import TaskContext

        c, part, n = coder(byte_level_path, piece_path), TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for lo, hi, own in byte_slices(b.column(1), SLICE_BYTES):
                ids, texts, size = ids + doc_ids[lo:hi], texts + own, size + sum(map(len, own))
                if size >= SLICE_BYTES:
                    yield _one_row(_slice_row(c, f"{part}-{n}", ids, texts))
                    ids, texts, size, n = [], [], 0, n + 1
        if ids:
            yield _one_row(_slice_row(c, f"{part}-{n}", ids, texts))

    return docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")).mapInArrow(run, _SLICE)


def _pairs(rows: DataFrame) -> DataFrame:
    """A row for each pair of each slice, with its place in the slice's list."""
    zipped = F.explode(F.arrays_zip("pair_a", "pair_b", "pair_docs", F.sequence(F.lit(0), F.size("pair_a") - 1).alias("place")))
    return rows.where(F.size("pair_a") > 0).select("slice", zipped.alias("p")).select("slice", "p.*")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a_id, b_id, docs, best) of the rows of :func:`slices`: how many documents hold the pair
    linked, and whether no pair of its ``a_id`` is in more."""
    counts = _pairs(rows).groupBy(F.col("pair_a").alias("a_id"), F.col("pair_b").alias("b_id")).agg(F.sum("pair_docs").cast("long").alias("docs"))
    top = counts.groupBy(F.col("a_id").alias("top_id")).agg(F.max("docs").alias("top"))
    return counts.join(top, F.col("a_id") == F.col("top_id")).select("a_id", "b_id", "docs", (F.col("docs") == F.col("top")).alias("best"))


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _segment_sums(values: pa.Array, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], pc.cumulative_sum(values).to_numpy(zero_copy_only=False)))
    return np.diff(total[np.concatenate(([0], ends))])


def _finish(batches):
    """Rows of slices with their pairs' counts -> a row for each document."""
    for b in batches:
        for r in range(b.num_rows):
            def column(name, b=b, r=r):
                return b.column(name)[r].values

            def packed(b=b, r=r):
                return zstandard.ZstdDecompressor().decompress(b.column("links")[r].as_py(), max_output_size=1 << 40)

            scored = column("scored")
            place = scored.field("place").to_numpy()
            docs, best = (np.zeros(len(place), np.int64) for _ in range(2))
            docs[place], best[place] = scored.field("docs").to_numpy(), scored.field("best").to_numpy(zero_copy_only=False)
            links, ends = pa.array(np.frombuffer(packed(), "<i4")), np.cumsum(column("n_links").to_numpy())
            count_sum, n_best = (_segment_sums(pa.array(v).take(links), ends) for v in (docs, best))
            yield pa.RecordBatch.from_arrays(
                [*(column(k) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(n_best), pa.array(count_sum), column("groups_sha256")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def alignments(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(a row for each document, the corpus's :func:`pair_counts`). Documents: doc_id, n_a, n_b,
    n_groups, n_links, n_best (links whose pair is the most frequent of its A id, ties included),
    count_sum (its links' counts), groups_sha256 (of `a1,a2|b1;a3|b2,b3`; '' without tokens).

    Null and empty texts, and those whose tokens of either side do not give back the text with a
    space before it, have no tokens: zeros. Repeated rows and tied or null ids are documents of
    their own, each counted; other columns are not looked at. Empty in, empty out. The slices are
    written to the shared folder once, as three steps read them."""
    spark = docs.sparkSession
    folder = new_folder(spark, "alignment")
    slices(docs, byte_level_path, piece_path, id_col, text_col).write.parquet(folder)
    rows = spark.read.parquet(folder)
    counts, salts = pair_counts(rows), 1 + rows.count() // SLICES_PER_KEY
    salted = counts.select("a_id", "b_id", "docs", "best", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    own = _pairs(rows).withColumn("own_salt", F.pmod(F.xxhash64("slice"), F.lit(salts)).cast("int"))
    scored = own.join(salted, (own.pair_a == salted.a_id) & (own.pair_b == salted.b_id) & (own.own_salt == salted.salt)) \
        .groupBy(F.col("slice").alias("of_slice")).agg(F.collect_list(F.struct("place", "docs", "best")).alias("scored"))     # the slice's own pairs: bounded
    none = F.expr("cast(array() as array<struct<place: int, docs: bigint, best: boolean>>)")
    joined = rows.join(scored, rows.slice == scored.of_slice, "left") \
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", F.coalesce("scored", none).alias("scored"))
    return joined.mapInArrow(_finish, _OUT), counts
