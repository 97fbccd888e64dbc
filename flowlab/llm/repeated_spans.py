"""Removal of long repeated substrings by a hash-compared suffix sort.

A byte goes if it lies in a window of ``length`` bytes that also starts earlier in the corpus.
Whole copies of a text are told by its SHA-256, so each distinct text is looked at once, in
slices that are written to the shared folder.

Equal windows hold the same anchor, the least hashed gram of half their length, at the same
place. Windows with one anchor follow each other, a run; where runs of one anchor are equal, all
windows of the later ones go, and the windows of the different ones are suffixes to be sorted,
anchor by anchor (``suffix_sort.py``). A slice first does so by itself, so a passage that a third
of all documents hold leaves a slice at most once in each of its contexts; anchors that other
slices hold too (told by their hashes, which is all that travels at first) are then dealt by
their hash and sorted together. Nothing is told by a hash alone: runs and neighbouring suffixes
are compared byte by byte."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm import model_store
from flowlab.llm.common import byte_slices
from flowlab.llm.suffix_sort import PrefixHashes, mixed, sort_buckets

#: Bytes a window has.
LENGTH = 100
#: Bytes of text in a slice (about; a longer document is a slice of its own).
SLICE_BYTES = 1 << 20
#: Window starts looked at together.
PIECE = 1 << 19
#: Hashes, and bytes of runs, that one group of the two shuffles holds (about).
GROUP_HASHES, GROUP_BYTES = 1 << 20, 2 << 20
#: Slices that one task goes through, at most.
TASK_SLICES = 64
_FIRST = -(1 << 63)                                              # a null id comes before all others


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of the least one, the first if tied."""
    value, place, have = h, np.arange(len(h), dtype=np.int64), 1
    while have < width:
        shift = min(have, width - have)
        a, b = value[:-shift], value[shift:]
        left = a <= b
        value, place = np.where(left, a, b), np.where(left, place[:-shift], place[shift:])
        have += shift
    return place


def runs(text: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """The runs of all windows of documents that lie in ``text`` one after the other: start, number
    of windows, lead (from the start to the anchor), anchor (hash)."""
    gram = length // 2
    width = length - gram + 1
    out = []
    for x in range(0, len(text) - length + 1, PIECE):
        piece = text[x:x + PIECE + length - 1]
        h = PrefixHashes(piece).windows(gram)
        place = _least(h, width)
        starts = np.arange(len(place))
        doc = np.searchsorted(ends, starts + x, side="right")
        fits = starts + x + length <= ends[np.minimum(doc, len(ends) - 1)]
        starts, place, doc = starts[fits], place[fits], doc[fits]
        if len(starts):
            new = np.append(True, (starts[1:] != starts[:-1] + 1) | (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))
            first = np.flatnonzero(new)
            s = starts[first]
            out.append((s + x, np.diff(np.append(first, len(starts))), place[first] - s, h[place[first]]))
    names = ("start", "n", "lead", "anchor")
    kinds = (np.int64, np.int64, np.int64, np.uint64)
    return {k: np.concatenate([o[i] for o in out]) if out else np.zeros(0, t) for i, (k, t) in enumerate(zip(names, kinds))}


def _equal_runs(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes at ``a`` equal those at ``b``, byte by byte."""
    out = np.ones(len(a), bool)
    for lo in range(0, len(a), 8192):
        s = size[lo:lo + 8192]
        last = np.cumsum(s)
        inside = np.arange(int(last[-1])) - np.repeat(last - s, s)
        other = text[np.repeat(a[lo:lo + 8192], s) + inside] != text[np.repeat(b[lo:lo + 8192], s) + inside]
        out[lo:lo + 8192] = ~np.logical_or.reduceat(other, last - s)
    return out


def later_copies(hashes: PrefixHashes, r: dict[str, np.ndarray], length: int) -> np.ndarray:
    """Which runs are the same, in bytes and anchor, as one before them. Runs are in the order of
    the corpus."""
    n = len(r["start"])
    if not n:
        return np.zeros(0, bool)
    size = r["n"] + length - 1
    content = hashes.of(r["start"], size)
    order = np.lexsort((np.arange(n), r["lead"], size, content, r["anchor"]))
    same = np.append(False, np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in (r["anchor"], content, size, r["lead"])]))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    told = np.flatnonzero(same)
    out = np.zeros(n, bool)
    me, first = order[told], order[head[told]]
    out[me] = _equal_runs(hashes.text, r["start"][me], r["start"][first], size[me])
    return out


def repeated_windows(hashes: PrefixHashes, r: dict[str, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, window of the run) of every window that equals one of an earlier run of its anchor.
    Runs are in the order of the corpus."""
    order = np.argsort(r["anchor"], kind="stable")
    a = r["anchor"][order]
    shared = np.append(False, a[1:] == a[:-1]) | np.append(a[1:] == a[:-1], False) if len(a) else np.zeros(0, bool)
    own = np.sort(order[shared])
    if not len(own):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = r["n"][own]
    last = np.cumsum(n)
    run = np.repeat(own, n)
    window = np.arange(int(last[-1])) - np.repeat(last - n, n)
    # equal windows have their anchor at the same place
    _, anchor = np.unique(r["anchor"][own], return_inverse=True)
    bucket = np.repeat(anchor, n) * (2 * length) + (np.repeat(r["lead"][own], n) - window)
    by = np.argsort(bucket, kind="stable")
    bucket = bucket[by]
    both = np.append(False, bucket[1:] == bucket[:-1])
    both |= np.append(both[1:], False)
    by, bucket = by[both], bucket[both]
    sorted_, repeats = sort_buckets(hashes, (r["start"][run] + window)[by], bucket, length)
    gone = by[sorted_[repeats]]
    return run[gone], window[gone]


def _stretches(start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places as (start, number) of their stretches."""
    start = np.unique(start)
    first = np.flatnonzero(np.append(True, start[1:] != start[:-1] + 1)) if len(start) else np.zeros(0, np.int64)
    return start[first], np.diff(np.append(first, len(start)))


def _expand(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    last = np.cumsum(n)
    return np.repeat(start, n) + np.arange(int(last[-1]) if len(last) else 0) - np.repeat(last - n, n)


def _load(folder: str, name: str) -> dict[str, np.ndarray]:
    a = {k: np.array(v) for k, v in model_store.load(folder, name, mapped=False).items()}
    a["text"] = np.frombuffer(zstandard.ZstdDecompressor().decompress(a.pop("packed").tobytes(), max_output_size=1 << 40), np.uint8)
    return a


_PART = "slice string, n_docs long, hashes array<long>"


def _cut(folder: str, length: int):
    """Distinct texts (id, digest, text) -> slices in the folder, and a row for each with the
    distinct hashes of its anchors."""
    def part(name, ids, digests, texts):
        order = sorted(range(len(texts)), key=lambda i: (_FIRST if ids[i] is None else ids[i], digests[i]))
        ids, digests, texts = ([x[i] for i in order] for x in (ids, digests, texts))
        ends = np.cumsum([len(t) for t in texts])
        whole = b"".join(texts)
        r = runs(np.frombuffer(whole, np.uint8), ends, length)
        packed = np.frombuffer(zstandard.ZstdCompressor(level=1).compress(whole), np.uint8)
        model_store.save(folder, name, {
            "packed": packed, "ends": ends, "id": np.array([_FIRST if i is None else i for i in ids], np.int64), "null": np.array([i is None for i in ids], np.uint8),
            "digest": np.frombuffer(b"".join(digests), np.uint8), "start": r["start"].astype(np.uint32 if len(whole) < 1 << 32 else np.int64),
            "n": r["n"].astype(np.uint16), "lead": r["lead"].astype(np.uint16)})
        hashes = np.unique(r["anchor"]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(texts)], pa.int64()), pa.ListArray.from_arrays([0, len(hashes)], pa.array(hashes))],
                                          names=["slice", "n_docs", "hashes"])

    def run(batches):
        ids, digests, texts, size = [], [], [], 0                # names of an attempt's own: its rows tell which files count
        for b in batches:
            b_ids, b_digests = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi, own in byte_slices(b.column(2), SLICE_BYTES):
                ids, digests, texts, size = ids + b_ids[lo:hi], digests + b_digests[lo:hi], texts + own, size + sum(map(len, own))
                if size >= SLICE_BYTES:
                    yield part(uuid.uuid4().hex, ids, digests, texts)
                    ids, digests, texts, size = [], [], [], 0
        if ids:
            yield part(uuid.uuid4().hex, ids, digests, texts)

    return run


def _by_group(groups: int):
    """A slice's hashes, dealt over groups."""
    def run(batches):
        for b in batches:
            for name, found in zip(b.column(0).to_pylist(), b.column(1)):
                h = found.values.to_numpy(zero_copy_only=False).view(np.uint64)
                group = group_of(h, groups)
                order = np.argsort(group, kind="stable")
                h, cut = h[order], np.searchsorted(group[order], np.arange(groups + 1))
                some = np.flatnonzero(np.diff(cut))
                offsets = np.append(cut[some], len(h)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([name] * len(some), pa.string()),
                                                  pa.ListArray.from_arrays(offsets, pa.array(h.view(np.int64)))], names=["group", "slice", "hashes"])

    return run


def group_of(h: np.ndarray, groups: int) -> np.ndarray:
    """Anchors are the least hashes of their windows, so they are mixed anew before they are dealt."""
    return ((mixed(h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _shared(table: pa.Table) -> pa.Table:
    """Of a group's hashes, for each slice those that another slice has too."""
    lists = table.column("hashes").combine_chunks()
    h = lists.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    keep = count[inverse] > 1
    ends = np.cumsum(np.bincount(owner[keep], minlength=len(lists)))
    return pa.table({"slice": table.column("slice"), "hashes": pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(h[keep]))})


_SENT = ("slice string, group long, anchor array<long>, lead array<int>, n array<int>, id array<long>, digest array<long>, at array<long>, place array<long>, body binary, "
         "gone array<long>, gone_n array<int>")
_SENT_TYPES = {"slice": pa.string(), "group": pa.int64(), "anchor": pa.list_(pa.int64()), "lead": pa.list_(pa.int32()), "n": pa.list_(pa.int32()), "id": pa.list_(pa.int64()),
               "digest": pa.list_(pa.int64()), "at": pa.list_(pa.int64()), "place": pa.list_(pa.int64()), "body": pa.binary(), "gone": pa.list_(pa.int64()), "gone_n": pa.list_(pa.int32())}


def _sent_row(**row) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row.get(k)], t) for k, t in _SENT_TYPES.items()], names=list(_SENT_TYPES))


def _send(folder: str, length: int, groups: int):
    """A slice by itself: the windows that go already, and the runs whose anchors others hold."""
    def run(batches):
        for b in batches:
            for name, shared in zip(b.column(0).to_pylist(), b.column(1)):
                a = _load(folder, name)
                text = a["text"]
                hashes = PrefixHashes(text)
                r = {k: a[k].astype(np.int64) for k in ("start", "n", "lead")}
                gram = length // 2
                r["anchor"] = np.zeros(len(r["start"]), np.uint64)
                if len(r["start"]):
                    r["anchor"] = mixed(hashes.of(r["start"] + r["lead"], gram))
                copy = later_copies(hashes, r, length)
                gone = [_expand(r["start"][copy], r["n"][copy])]
                r = {k: v[~copy] for k, v in r.items()}
                lists = shared.values
                out = np.zeros(0, np.uint64) if lists is None or not len(lists) else np.concatenate([x.values.to_numpy(zero_copy_only=False) for x in lists]).view(np.uint64)
                ship = np.isin(r["anchor"], out)
                inner = {k: v[~ship] for k, v in r.items()}
                run_, window = repeated_windows(hashes, inner, length)
                gone.append(inner["start"][run_] + window)
                start, n = _stretches(np.concatenate(gone))
                yield _sent_row(slice=name, gone=start, gone_n=n)
                r = {k: v[ship] for k, v in r.items()}
                group = group_of(r["anchor"], groups)
                doc = np.searchsorted(a["ends"], r["start"], side="right")
                digest = a["digest"].reshape(-1, 32)[:, :8].copy().view(">u8").ravel().astype(np.uint64).view(np.int64)
                begins = a["ends"] - np.diff(a["ends"], prepend=0)
                order = np.argsort(group, kind="stable")
                cut = np.searchsorted(group[order], np.arange(groups + 1))
                for g in np.flatnonzero(np.diff(cut)).tolist():
                    i = order[cut[g]:cut[g + 1]]
                    body = text[_expand(r["start"][i], r["n"][i] + length - 1)]
                    yield _sent_row(slice=name, group=g, anchor=r["anchor"][i].view(np.int64), lead=r["lead"][i], n=r["n"][i], id=a["id"][doc[i]], digest=digest[doc[i]],
                                    at=r["start"][i] - begins[doc[i]], place=r["start"][i], body=body.tobytes())

    return run


_GONE = "slice string, gone array<long>, gone_n array<int>"


def _resolve(length: int):
    """Runs of some anchors from all slices -> for each slice the windows that go."""
    def run(table):
        table = table.sort_by("slice")
        rows = {k: table.column(k).combine_chunks() for k in ("anchor", "lead", "n", "id", "digest", "at", "place")}
        sizes = np.diff(np.asarray(rows["n"].offsets))
        flat = {k: v.flatten().to_numpy(zero_copy_only=False) for k, v in rows.items()}
        owner = np.repeat(np.arange(len(sizes)), sizes)
        text = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint8)
        size = flat["n"].astype(np.int64) + length - 1
        order = np.lexsort((flat["at"], flat["digest"].view(np.uint64), flat["id"]))        # the corpus's order
        r = {"start": (np.cumsum(size) - size)[order], "n": flat["n"].astype(np.int64)[order], "lead": flat["lead"].astype(np.int64)[order],
             "anchor": flat["anchor"].view(np.uint64)[order]}
        hashes = PrefixHashes(text)
        place, owner = flat["place"][order], owner[order]
        copy = later_copies(hashes, r, length)
        gone, of = [_expand(place[copy], r["n"][copy])], [np.repeat(owner[copy], r["n"][copy])]
        left = np.flatnonzero(~copy)
        run_, window = repeated_windows(hashes, {k: v[left] for k, v in r.items()}, length)
        gone, of = np.concatenate([*gone, place[left[run_]] + window]), np.concatenate([*of, owner[left[run_]]])
        names, out = table.column("slice").to_pylist(), []
        by = np.argsort(of, kind="stable")
        cut = np.searchsorted(of[by], np.arange(len(names) + 1))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            out.append((names[k], *_stretches(gone[by[cut[k]:cut[k + 1]]])))
        return pa.table({"slice": pa.array([o[0] for o in out], pa.string()), "gone": pa.array([o[1] for o in out], pa.list_(pa.int64())),
                         "gone_n": pa.array([o[2] for o in out], pa.list_(pa.int32()))})

    return run


_KEPT = "id long, digest binary, removed array<struct<start:long,end:long>>, kept_sha256 string"


def _finish(folder: str, length: int, with_kept: bool):
    """A slice and all its windows that go -> the removed spans and what is kept of each text."""
    def run(batches):
        for b in batches:
            for name, found in zip(b.column(0).to_pylist(), b.column(1)):
                a = _load(folder, name)
                text, ends = a["text"], a["ends"]
                change = np.zeros(len(text) + 1, np.int32)
                for part in found.values if found.values is not None else []:
                    start = np.array(part["gone"].as_py(), np.int64)
                    np.add.at(change, start, 1)
                    np.add.at(change, start + np.array(part["gone_n"].as_py(), np.int64) + length - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                begins = ends - np.diff(ends, prepend=0)
                before = np.append(False, gone[:-1])
                after = np.append(gone[1:], False)
                full = ends > begins
                before[begins[full]] = False
                after[ends[full] - 1] = False
                first, last = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
                doc = np.searchsorted(ends, first, side="right")
                spans = pa.StructArray.from_arrays([pa.array(first - begins[doc]), pa.array(last - begins[doc])], names=["start", "end"])
                offsets = np.append(0, np.cumsum(np.bincount(doc, minlength=len(ends)))).astype(np.int32)
                kept = memoryview(text[~gone].tobytes())
                stops = np.append(0, np.cumsum(~gone))[np.append(0, ends)].tolist()
                bodies = [kept[s:e] for s, e in zip(stops[:-1], stops[1:])]
                digests = a["digest"].tobytes()
                cols = {"id": pa.array(a["id"], mask=a["null"].astype(bool)), "digest": pa.array([digests[i:i + 32] for i in range(0, len(digests), 32)], pa.binary()),
                        "removed": pa.ListArray.from_arrays(offsets, spans), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in bodies])}
                if with_kept:
                    cols["kept"] = pa.array([bytes(x) for x in bodies], pa.binary())
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, removed (its maximal removed spans, [start, end) in
    UTF-8 bytes), kept_sha256 (hex, of the bytes that stay) and, if asked, kept (those bytes).

    Documents are in the order of doc_id, null ids first; rows that share an id in that of their
    text's SHA-256; of equal rows one comes first and the others are copies. A null text is empty;
    texts shorter than ``length`` keep all bytes. Other columns are not looked at. Empty in, empty
    out."""
    spark = docs.sparkSession
    folder = model_store.new_folder(spark, "repeats")
    cores = spark.sparkContext.defaultParallelism
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    owner = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))
    distinct = rows.groupBy("digest").agg(owner.alias("o"), F.first("text").alias("text")).select("o.doc_id", "digest", F.col("text").cast("binary"))
    distinct.mapInArrow(_cut(f"{folder}/slices", length), _PART).write.parquet(f"{folder}/parts")
    parts = spark.read.parquet(f"{folder}/parts")
    n_slices, n_hashes = parts.agg(F.count("*"), F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()
    tasks = max(1, min(n_slices, max(cores, -(-n_slices // TASK_SLICES))))

    groups = max(1, min(cores, n_slices), -(-n_hashes // GROUP_HASHES))
    shared = parts.select("slice", "hashes").mapInArrow(_by_group(groups), "group long, slice string, hashes array<long>") \
        .groupBy("group").applyInArrow(_shared, "slice string, hashes array<long>").where(F.size("hashes") > 0)
    shared.write.parquet(f"{folder}/shared")
    shared = spark.read.parquet(f"{folder}/shared")
    n_shared = shared.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]

    groups = max(1, min(cores, n_slices), -(-n_shared * (length + length // 4) // GROUP_BYTES))
    for_slice = shared.groupBy("slice").agg(F.collect_list("hashes").alias("shared"))         # the slice's own anchors: bounded
    todo = parts.select("slice").join(for_slice, "slice", "left").select("slice", "shared").repartition(tasks, "slice")
    todo.mapInArrow(_send(f"{folder}/slices", length, groups), _SENT).write.parquet(f"{folder}/sent")
    sent = spark.read.parquet(f"{folder}/sent")

    resolved = sent.where("group is not null").groupBy("group").applyInArrow(_resolve(length), _GONE)
    gone = sent.where("group is null").select("slice", "gone", "gone_n").unionByName(resolved)
    gone = gone.groupBy("slice").agg(F.collect_list(F.struct("gone", "gone_n")).alias("parts"))   # the slice's own windows: bounded
    schema = _KEPT + ", kept binary" * with_kept
    kept = gone.select("slice", "parts").repartition(tasks, "slice").mapInArrow(_finish(f"{folder}/slices", length, with_kept), schema)

    narrow = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = [F.when(F.col("n_bytes") < length, F.col("text")).cast("binary").alias("short")] if with_kept else []
    counted = narrow.select("doc_id", "digest", "n_bytes", *short)
    counted = counted.groupBy(*counted.columns).agg(F.count("*").alias("times"))
    found = counted.join(kept, counted.doc_id.eqNullSafe(kept.id) & (counted.digest == kept.digest), "left") \
        .select("doc_id", counted.digest, "n_bytes", "removed", "kept_sha256", *(["kept", "short"] if with_kept else []), F.explode(F.expr("sequence(1L, times)")).alias("nth"))
    own = (F.col("nth") == 1) & F.col("kept_sha256").isNotNull()
    long = F.col("n_bytes") >= length
    span = F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    nothing = hashlib.sha256(b"").hexdigest()
    out = found.select("doc_id", "n_bytes", F.when(own, F.col("removed")).when(long, F.array(span)).otherwise(none).alias("removed"),
                       F.when(own, F.col("kept_sha256")).when(long, F.lit(nothing)).otherwise(F.lower(F.hex("digest"))).alias("kept_sha256"),
                       *([F.when(own, F.col("kept")).otherwise(F.coalesce("short", F.lit(bytearray()))).alias("kept")] if with_kept else []))
    return out
