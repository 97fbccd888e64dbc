"""Exact deduplication by Patricia-trie owners.

Texts are compared after each white-space run became one space. Every scan task inserts its
texts into a trie of its own, so copies meet before the shuffle and a group that holds a third
of all rows shrinks to one row per task. The distinct texts are then dealt by (byte length,
content hash) and inserted, as full byte strings, into the trie of their partition; terminal
nodes keep the smallest identifier and the number of copies. Narrow rows (no text) bring the
owners back to all documents.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import SPACE_RUN
from flowlab.llm.patricia import PatriciaOwners

#: Bytes of text that one task's trie holds before it spills a subtree.
TRIE_BYTES = 192 << 20
#: Bytes of text that a scan task combines before it hands them on.
COMBINE_BYTES = 64 << 20


def normalised(text):
    """Null counts as empty; each run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE_RUN, " ")


_LOCAL = "n_bytes int, content_hash long, body binary, owner long, copies long"
_OWNERS = "n_bytes int, text_sha256 string, keep_id long, group_size long"


def _combine(batches):
    """Scan side: one trie after the other, each of at most COMBINE_BYTES."""
    def out(trie, keys):
        rows = list(trie.items())
        for i in range(0, len(rows), 2000):
            part = rows[i:i + 2000]
            yield pa.RecordBatch.from_arrays([
                pa.array([len(t) for t, _, _ in part], pa.int32()), pa.array([keys[t] for t, _, _ in part], pa.int64()),
                pa.array([t for t, _, _ in part], pa.binary()), pa.array([o for _, o, _ in part], pa.int64()),
                pa.array([c for _, _, c in part], pa.int64())],
                names=["n_bytes", "content_hash", "body", "owner", "copies"])

    trie, keys, held = PatriciaOwners(1 << 62), {}, 0
    for b in batches:
        for i, h, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            trie.insert(body, i)
            if body not in keys:
                keys[body] = h
                held += len(body)
            if held > COMBINE_BYTES:
                yield from out(trie, keys)
                trie, keys, held = PatriciaOwners(1 << 62), {}, 0
    yield from out(trie, keys)


def _own(batches):
    """Owner side: the trie of one (length, content hash) partition; owners of texts with copies."""
    trie = PatriciaOwners(TRIE_BYTES)
    for b in batches:
        for body, owner, copies in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            trie.insert(body, owner, copies)
    rows = [(len(t), hashlib.sha256(t).hexdigest(), o, c) for t, o, c in trie.items() if c > 1]
    yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(
        zip(*rows) if rows else [()] * 4, (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
        names=["n_bytes", "text_sha256", "keep_id", "group_size"])


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts that occur more than once: n_bytes, text_sha256, keep_id, group_size."""
    body = normalised(docs[text_col])
    local = docs.select(docs[id_col].cast("long").alias("owner"), F.xxhash64(body).alias("content_hash"),
                        body.cast("binary").alias("body")).mapInArrow(_combine, _LOCAL)
    return local.repartition("n_bytes", "content_hash").select("body", "owner", "copies").mapInArrow(_own, _OWNERS)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and so equal each other; a null id is larger than any id, and a
    group of null ids only keeps them (keep_id null, kept true). Repeated rows of the kept id
    are all marked kept. Other columns of ``docs`` are not looked at. Empty in, empty out."""
    body = normalised(docs[text_col])
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), F.octet_length(body).alias("n_bytes"),
                         F.sha2(body, 256).alias("text_sha256"))
    joined = narrow.join(owners(docs, id_col, text_col), ["n_bytes", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                         F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has an owner with a smaller id; all columns stay.
    Only the rows that go are joined, by id and text, as an id may come with several texts.
    Repeated rows of a kept id and text stay."""
    gone = exact_dedup(docs, id_col, text_col).where("not kept") \
        .select(F.col("doc_id").alias("__gone"), F.unhex("text_sha256").alias("__gone_text")).distinct()
    keyed = docs.withColumns({"__exact_id": docs[id_col].cast("long"), "__exact_text": F.unhex(F.sha2(normalised(docs[text_col]), 256))})
    return keyed.join(gone, F.col("__exact_id").eqNullSafe(F.col("__gone")) & (F.col("__exact_text") == F.col("__gone_text")), "left_anti") \
        .drop("__exact_id", "__exact_text")
