"""Packing documents into fixed-length sequences by cutting-stock column generation.

Every document is encoded once, on the executors; pieces longer than a sequence are cut there.
What is left is a histogram of piece lengths, exact for short pieces and in classes of a few
tokens for longer ones: a table whose size does not depend on the corpus. For the longer ones, a linear program over patterns (how many pieces of each
class share a sequence) is solved by column generation: the duals of the current patterns price
a new one by an unbounded knapsack (dynamic programming over the sequence length). The
rounded-down pattern counts plus first-fit patterns for the rest say how many sequences of each
pattern to fill. Short pieces fill what these leave, largest first, and what remains of them is
planned the same way by exact length. Documents ranked inside their class take the slots in order.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.chunk_ids import ChunkIds, in_parts, remembered, take_over, words_of
from flowlab.llm.common import text_slices
from flowlab.operators.ranking import rank_within_group
from flowlab.session import cut_lineage

SEQUENCE = 4096
#: Tokens of the widest length class.
CLASS_TOKENS = 16
#: Lengths up to this are classes of their own.
EXACT_TOKENS = 256
#: Rooms that the knapsack fills at a time.
BLOCK = 16
#: The linear program may stop this close (relatively) to its lower bound; the last thousandth takes half the columns.
GAP = 1e-3

_ENCODERS = remembered({})
# one run of ASCII or Latin-1 letters: one word of the tokenizer
_WORD = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# a full stop or comma between a letter and white space: a word of its own
_STOP = r"([a-z])([.,])([ \n]|$)"


def word_encoder(path: str) -> ChunkIds:
    """Encoder of white-space separated chunks for a tokenizer file (``tokenizers`` library) that
    drops white space and marks the ends of words; one for each Python worker."""
    if path not in _ENCODERS:
        take_over()
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        vocabulary = tok.get_vocab()
        ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

        def direct(chunks):
            return [e.ids for e in tok.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]

        def encode(chunks):
            plain, other = [], []
            for c in chunks:
                (plain if _WORD.fullmatch(c) else other).append(c)
            for i in range(0, len(plain), 2048):              # many words as one text, cut where words end
                part = plain[i:i + 2048]
                ids = np.array(tok.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, np.uint32)
                cut = np.flatnonzero(ends_word[ids]) + 1
                if len(cut) == len(part):
                    yield part, ids, np.diff(cut, prepend=0)
                else:
                    yield from in_parts(part, direct)
            yield from in_parts(other, direct)

        _ENCODERS[path] = ChunkIds(encode)
    return _ENCODERS[path]


def chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """White-space separated chunks of all texts in a row, and the ends of the texts in it."""
    # the tokenizer lower-cases and parts a word from the stop behind it; doing so first makes more
    # chunks equal, unless the text may hold a special token, which is matched as written
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), _STOP, r"\1 \2\3")
    return words_of(pc.if_else(pc.match_substring(texts, "<|"), texts, plain))


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, sequence: int = SEQUENCE,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and cut: doc_id, start, length, ids_crc32, doc_tokens (and the ids, if asked)."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def run(batches):
        encode = word_encoder(tokenizer_path)
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for lo, hi, texts in text_slices(b.column(1), 2 << 20):
                ids, ends = encode.of(*chunks(texts))
                rows, begin = [], 0
                for doc, end in zip(doc_ids[lo:hi], ends.tolist()):
                    own = np.append(ids[begin:end], np.uint32(end_id)).astype("<u4")
                    begin = end
                    for s in range(0, len(own), sequence):
                        part = own[s:s + sequence]
                        rows.append((doc, s, len(part), zlib.crc32(part.tobytes()), len(own)) + ((part.astype(np.int32),) if with_ids else ()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.list_(pa.int32()) if i == 5 else pa.int64()) for i, c in enumerate(zip(*rows))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(rows[0])])

    return docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")).mapInArrow(run, schema)


def _best_pattern(sizes: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most worthwhile counts of ``sizes`` (ascending) within ``room``. Sizes
    of a block of rooms or more are put in block by block; a smaller one for all rooms at once: of
    those that differ by its multiples, the running best of what it costs."""
    used = np.flatnonzero(worth > 0)
    if not len(used):
        return 0.0, np.zeros(len(sizes))
    large, small = used[sizes[used] >= BLOCK], used[sizes[used] < BLOCK]
    best = np.zeros(room + 1)
    if len(large):
        pad = int(sizes[large[-1]])
        padded = np.concatenate((np.full(pad, -np.inf), best))   # no room below zero
        at, v = pad + np.arange(BLOCK)[:, None] - sizes[large], worth[large]
        for w in range(BLOCK, room + 1, BLOCK):
            n = min(BLOCK, room + 1 - w)
            got = (padded[at[:n] + w] + v).max(axis=1)
            padded[pad + w:pad + w + n] = np.maximum.accumulate(np.maximum(got, padded[pad + w - 1]))
        best = padded[pad:]
    for s, v in zip(sizes[small].tolist(), worth[small].tolist()):
        rows = -(-(room + 1) // s)
        grid = np.full(rows * s, -np.inf)
        grid[:room + 1] = best
        paid = v * np.arange(rows)
        best = (np.maximum.accumulate(np.ascontiguousarray(grid.reshape(rows, s).T) - paid, axis=1) + paid).T.ravel()[:room + 1]
    best = np.maximum.accumulate(best)
    counts, w = np.zeros(len(sizes)), room
    while True:
        fits = used[sizes[used] <= w]
        if not len(fits):
            break
        v = best[w - sizes[fits]] + worth[fits]
        i = int(v.argmax())
        if v[i] < best[w] - 1e-9:                                # only room that stays empty
            w -= 1
            continue
        counts[fits[i]] += 1
        w -= int(sizes[fits[i]])
    return float(counts @ worth), counts


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # without the threads of a linear-algebra library, which may wait for ever in a driver that
    # has forked (its JVM is a child process)
    return np.einsum("ij,j...->i...", a, b)


def cutting_stock(histogram: dict[int, int], room: int, gap: float = GAP, max_columns: int = 20_000) -> list[tuple[dict[int, int], int]]:
    """Patterns and how often to use them, so that all pieces of ``histogram`` (size -> number)
    have a slot in a bin of ``room``. Sizes are 1 to ``room``."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n), int)
    if not len(sizes):
        return []
    need = np.array([histogram[s] for s in sizes], float)
    m = len(sizes)
    patterns = np.diag((room // sizes).astype(float))           # a column for each size, alone
    inverse = np.diag(1 / (room // sizes))
    used = _times(inverse, need)
    bound = 0.0
    for step in range(max_columns):
        duals = inverse.sum(axis=0)                              # costs are all one
        value, column = _best_pattern(sizes, np.maximum(duals, 0), room)
        total = used.sum()
        bound = max(bound, total / max(value, 1))                # no packing has fewer bins
        if total - bound <= gap * total:
            break
        d = _times(inverse, column)
        up = d > 1e-10
        ratio = np.full(m, np.inf)
        ratio[up] = np.maximum(used[up], 0) / d[up]
        row = int(ratio.argmin())
        patterns[:, row] = column
        inverse[row] /= d[row]
        rest = np.arange(m) != row
        inverse[rest] -= np.outer(d[rest], inverse[row])
        if step % 200 == 199:                                    # one Newton step takes the rounding errors out
            inverse = _times(inverse, 2 * np.eye(m) - _times(patterns, inverse))
        used = _times(inverse, need)
    whole = np.floor(np.maximum(used, 0) + 1e-6).astype(int)
    left = need.astype(int).copy()
    plan = []
    for j in np.argsort(-whole, kind="stable"):
        n, p = int(whole[j]), patterns[:, j].astype(int)
        if n:
            took = np.minimum(p * n, left)                       # rounding noise never takes more than there is
            left -= took
            plan.append(({int(s): int(c) for s, c in zip(sizes, p) if c}, n))
    bins: list[list] = []                                        # the rest, a bounded number: first fit, largest first
    for i in range(m - 1, -1, -1):
        for _ in range(left[i]):
            s = int(sizes[i])
            b = next((b for b in bins if b[0] >= s), None)
            if b is None:
                bins.append(b := [room, {}])
            b[0] -= s
            b[1][s] = b[1].get(s, 0) + 1
    return plan + [(b[1], 1) for b in bins]


def fill(plan: list[tuple[dict[int, int], int]], short: dict[int, int], room: int) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Pieces of ``short`` (size -> number) put into what the bins of ``plan`` leave, largest first,
    and those without a slot. Bins of a pattern stay together until a size runs out."""
    left, out = {s: n for s, n in short.items() if n}, []
    todo = [(dict(p), n, room - sum(s * c for s, c in p.items())) for p, n in plan]
    todo.sort(key=lambda x: -x[2])
    while todo:
        pattern, times, free = todo.pop()
        for s in sorted((s for s in left if s <= free), reverse=True):
            each = min(free // s, left[s] // times)
            if each:
                pattern[s] = pattern.get(s, 0) + each
                free -= each * s
                left[s] -= each * times
            if 0 < left[s] < times and s <= free:               # one more in some of the bins
                todo.append((dict(pattern), times - left[s], free))
                pattern[s], times, free = pattern.get(s, 0) + 1, left[s], free - s
                left[s] = 0
            if not left[s]:
                del left[s]
        out.append((pattern, times))
    return out, left


def plan_sequences(histogram: dict[int, int], sequence: int = SEQUENCE, class_tokens: int = CLASS_TOKENS) -> list[tuple[dict[int, int], int]]:
    """Patterns of classes (:func:`length_class`) and how often to use them."""
    long = {s // class_tokens: n for s, n in histogram.items() if s > EXACT_TOKENS}
    plan = [({s * class_tokens: c for s, c in p.items()}, n) for p, n in cutting_stock(long, sequence // class_tokens)]
    plan, left = fill(plan, {s: n for s, n in histogram.items() if s <= EXACT_TOKENS}, sequence)
    return plan + cutting_stock(left, sequence)


def length_class(length, class_tokens: int = CLASS_TOKENS):
    """The longest length of a piece's class."""
    return F.when(length <= EXACT_TOKENS, length).otherwise(F.ceil(length / class_tokens) * class_tokens).cast("int")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, sequence: int = SEQUENCE, class_tokens: int = CLASS_TOKENS,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and
    ids, if asked). Only documents longer than a sequence are cut. A null or empty text is its
    end id alone; repeated rows are packed as often as they occur; null ids rank first; other
    columns are not looked at. Empty in, empty out."""
    if sequence % class_tokens:
        raise ValueError("a sequence must hold a whole number of classes")
    own = cut_lineage(pieces(docs, tokenizer_path, end_id, sequence, id_col, text_col, with_ids)
                      .withColumn("size", length_class(F.col("length"), class_tokens)))
    histogram = {r["size"]: r["count"] for r in own.groupBy("size").count().collect()}   # bounded by the number of classes
    plan = plan_sequences(histogram, sequence, class_tokens)
    slots, first, seen = [], 0, {}
    for pattern, times in plan:
        for s, each in pattern.items():
            lo = seen.get(s, 0)
            slots.append((s, lo, lo + each * times, each, first))
            seen[s] = lo + each * times
        first += times
    ranked = rank_within_group(own, "size", ["doc_id", "start", "ids_crc32"], rank_col="rank", size_col="of")
    spark = docs.sparkSession
    table = spark.createDataFrame(slots, "psize int, lo long, hi long, each long, first long")
    placed = ranked.join(F.broadcast(table), (F.col("size") == F.col("psize")) &             # bounded by the patterns' slots
                         (F.col("rank") > F.col("lo")) & (F.col("rank") <= F.col("hi"))) \
        .withColumn("sequence_id", F.expr("first + (rank - 1 - lo) div each"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))
