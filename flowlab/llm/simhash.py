"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each distinct fingerprint emits the variants within half the radius; two fingerprints within
the radius share a variant, so a shuffle on variants brings every linked pair together, and
colliding pairs are verified on all 64 bits. For an odd radius the two halves differ: by the
parity of its bit count a fingerprint takes the smaller half (even) or the larger (odd), which
is enough as fingerprints an odd distance apart differ in parity. For radius 3 the outer shell
of the larger half needs only flips of two bits of the same 32-bit word, as two of any three
bits share a word: 65 or 1057 variants a fingerprint, and still no pair is missed.

Variants travel as sorted packed blocks, one per (task, variant range), 10 bytes each. Equal
fingerprints are one fingerprint, so a variant has at most a ball of members however many
copies the corpus holds.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.components import SALTS, components
from flowlab.session import cut_lineage

#: Distinct fingerprints expanded at a time in a task (radius 3: at most 2.2 million variants).
CHUNK = 2048
#: Variants aimed at for one range of the shuffle.
RANGE_VARIANTS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """64-bit SimHash of one text: majority of the bits of XXH64 (seed 42) over word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # ASCII: A-Z and the six white-space bytes
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[k - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text", with_key: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. No words (or null): zero. If asked, also
    text_key, that of :func:`text_key`."""
    names = ["doc_id", "fp"] + ["text_key"] * with_key

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=names)

    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("t"), *([text_key(text).alias("text_key")] if with_key else [])) \
        .mapInArrow(run, "doc_id long, fp long" + ", text_key binary" * with_key)


def text_key(text):
    """Tells the texts of one id apart; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def flips(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit masks of the variants that even and odd fingerprints emit, by rising weight."""
    def ball(r, outer=None):
        out = [0]
        for w in range(1, r + 1):
            sets = combinations(range(64), w)
            if w == r and outer:
                sets = (s for s in sets if outer(s))
            out += [sum(1 << i for i in s) for s in sets]
        return np.array(out, np.uint64)

    low, high = radius // 2, (radius + 1) // 2
    return ball(low), ball(high, (lambda s: s[0] // 32 == s[1] // 32) if radius == 3 else None)


def _emit(radius: int, range_bits: int):
    even, odd = flips(radius)

    def block(fps):
        parity = np.bitwise_count(fps) & 1
        mixed, flip = [], []
        for masks, own in ((even, fps[parity == 0]), (odd, fps[parity == 1])):
            mixed.append(((own[:, None] ^ masks[None, :]) * _MIX).ravel())
            flip.append(np.tile(np.arange(len(masks), dtype=np.uint16), len(own)))
        mixed, flip = np.concatenate(mixed), np.concatenate(flip)
        order = np.argsort(mixed)
        mixed, flip = mixed[order], flip[order]
        cut = np.searchsorted(mixed, np.arange(1 << range_bits, dtype=np.uint64) << np.uint64(64 - range_bits))
        cut = np.append(cut, len(mixed))
        rows = [(p, mixed[a:b].view(np.uint8).reshape(-1, 8).T.tobytes(), flip[a:b].view(np.uint8).reshape(-1, 2).T.tobytes())
                for p, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
                                          names=["part", "variants", "flips"])

    def run(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fps), CHUNK):
                yield block(fps[i:i + CHUNK])

    return run


def _meet(radius: int):
    masks = flips(radius)[1]        # the even list is its beginning

    def plane(col, width, kind):
        return np.concatenate([np.ascontiguousarray(np.frombuffer(x.as_py(), np.uint8).reshape(width, -1).T).view(kind).ravel() for x in col])

    def run(table):
        mixed, flip = plane(table.column("variants"), 8, np.uint64), plane(table.column("flips"), 2, np.uint16)
        order = np.argsort(mixed)
        mixed, flip = mixed[order], flip[order]
        same = mixed[1:] == mixed[:-1]
        in_run = np.append(same, False) | np.append(False, same)
        v, flip = mixed[in_run] * _UNMIX, flip[in_run]
        fps = v ^ masks[flip]
        order = np.lexsort((fps, np.bitwise_count(v ^ fps), v))  # in each variant, its nearest fingerprint first
        v, fps = v[order], fps[order]
        first = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64)
        centre = np.repeat(fps[first], np.diff(np.append(first, len(v))))
        linked = (centre != fps) & (np.bitwise_count(centre ^ fps) <= radius)
        ends = np.unique(np.stack([np.minimum(centre, fps)[linked], np.maximum(centre, fps)[linked]], 1), axis=0) \
            if linked.any() else np.zeros((0, 2), np.uint64)
        return pa.table({c: np.ascontiguousarray(ends[:, i]).view(np.int64) for i, c in enumerate(("fa", "fb"))})

    return run


def links(distinct_fps: DataFrame, max_distance: int = 3) -> DataFrame:
    """Verified links (fa, fb) that connect every two of ``distinct_fps`` (fp) within
    ``max_distance`` bits, directly or through others. In a variant its nearest fingerprint is
    linked to the rest; a pair for which no variant has that form meets in another variant."""
    spark = distinct_fps.sparkSession
    per_fp = sum(map(len, flips(max_distance))) / 2
    need = distinct_fps.count() * per_fp / RANGE_VARIANTS
    range_bits = max(6, int(np.ceil(np.log2(max(1, need)))))
    blocks = distinct_fps.select("fp").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "fp") \
        .mapInArrow(_emit(max_distance, range_bits), "part long, variants binary, flips binary")
    return blocks.groupBy("part").applyInArrow(_meet(max_distance), "fa long, fb long").distinct()


def simhash_components(docs: DataFrame, shingle_words: int = 3, max_distance: int = 3,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest id
    reachable over links of at most ``max_distance`` bits, itself included).

    Null and word-less texts have fingerprint zero and link like any other; equal fingerprints
    are linked; a null id never names a component (a group of null ids has component null).
    Other columns are not looked at. Empty in, empty out."""
    return _components(docs, shingle_words, max_distance, id_col, text_col).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _components(docs: DataFrame, shingle_words: int, max_distance: int, id_col: str, text_col: str, with_key: bool = False) -> DataFrame:
    """The columns of :func:`fingerprints` and component_id. Components are those of fingerprints:
    an id that comes with several texts does not link them."""
    if not 1 <= max_distance <= 4:
        raise ValueError("max_distance must be 1 to 4: the balls grow with its half")
    fps = cut_lineage(fingerprints(docs, shingle_words, id_col, text_col, with_key))
    reps = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    pairs = links(reps, max_distance)
    comp = components(pairs.select(F.col("fa").alias("a"), F.col("fb").alias("b")))
    linked = cut_lineage(reps.join(comp, reps.fp == comp.node).select("fp", "component", "rep"))   # only fingerprints with a link
    least = linked.groupBy("component").agg(F.min("rep").alias("least")) \
        .select("component", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))     # a component may hold most fingerprints
    named = linked.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")).join(least, ["component", "salt"]) \
        .select(F.col("fp").alias("node"), "least")
    of_fp = reps.join(named, reps.fp == named.node, "left") \
        .select(F.col("fp").alias("__fp"), F.coalesce("least", "rep").alias("component_id"))
    return fps.join(of_fp, fps.fp == F.col("__fp"), "left").drop("__fp")


def drop_near_copies(docs: DataFrame, shingle_words: int = 3, max_distance: int = 3,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id; rows without an
    id stay, as do the rows of the kept id in that component. Rows that go are told by id and
    text, as an id may come with several texts. All columns stay."""
    gone = _components(docs, shingle_words, max_distance, id_col, text_col, with_key=True) \
        .where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__gone_text")).distinct()
    keyed = docs.withColumns({"__near_id": docs[id_col].cast("long"), "__near_text": text_key(docs[text_col])})
    return keyed.join(gone, (F.col("__near_id") == F.col("__gone")) & (F.col("__near_text") == F.col("__gone_text")), "left_anti") \
        .drop("__near_id", "__near_text")
