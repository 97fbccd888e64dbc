"""Language-model scoring with an n-gram trie of Elias-Fano levels.

Words are told apart by 64-bit hashes; sorted, a hash's rank is the word's id. Every level of
the trie keeps, for all nodes of the level above in order, the ids of their successors as one
rising list (each context's ids are lifted above those before it), monotone pointers to the
contexts' ranges, and the quantised smoothed probability of each node. A query goes down from
a context node: its successors are searched, relative to the context, in the list's bucket.

Spark builds it: counts are pre-aggregated in the tasks that scan the text and shuffled to the
shard of their first word, of which there are as many as the corpus has tokens for; each shard is
one file for each level in the shared folder, which a worker maps when it first needs it. First
the counts of a shard are merged into its file, then, with one discount from the counts of counts
of all shards, the level is built from it. Nothing of it passes through the driver but a few
numbers for each shard. Lower levels guide the next: an n-gram is only counted if both its ends are in the trie
(all n-grams seen fewer than ``min_count`` times are left to the smoothing, none is sampled).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm import model_store
from flowlab.llm.chunk_ids import remembered, sums, take_over
from flowlab.llm.common import text_slices
from flowlab.llm.elias_fano import PARTS, EliasFano
from flowlab.llm.word_hashes import hashes, lowered, word_places
from flowlab.session import cut_lineage

#: n-grams of two words and more seen fewer times are left to the smoothing.
MIN_COUNT = 2
#: Tokens of the corpus, and so different n-grams of a level at most, aimed at for one shard.
SHARD_TOKENS = 1 << 20
#: Distinct n-grams that a counting task holds before it hands them on.
HELD = 1_000_000
#: Words whose id and count a worker remembers at most (a power of two).
SLOTS = 1 << 19
#: The end of a text, and what comes before its first word: no word has white space.
END = b" "
_WORD_BITS = 31


def words(text: bytes) -> list[bytes]:
    """Tokens of a text in UTF-8: words, A-Z lower-cased, and one end."""
    return text.lower().split() + [END]


def _hash(chunks) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(c) for c in chunks), np.uint64, len(chunks))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the :func:`words` of all texts in a row, and the ends of the texts."""
    low, text_ends = lowered(texts)
    begins, ends, last = word_places(low, text_ends)
    return np.insert(hashes(low, begins, ends), last, _hash([END])[0]), last + np.arange(1, len(last) + 1)


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of ``a``, ascending, and the place of each value among them."""
    if (a[1:] < a[:-1]).any():
        return np.unique(a, return_inverse=True)
    new = np.append(np.ones(min(len(a), 1), bool), a[1:] != a[:-1])
    return a[new], np.cumsum(new) - 1


class _Counter:
    """Counts of integer keys, merged as they come; single keys wait until there are many to sort at once."""

    def __init__(self):
        self.clear()

    def add(self, keys: np.ndarray) -> None:
        self.single.append(keys)
        self.waiting += len(keys)
        if self.waiting > 2 * HELD:
            self._count()
            if self.held > HELD:
                self.keys, self.counts = ([x] for x in self.merged())
                self.held = len(self.keys[0])

    def _count(self) -> None:
        if self.waiting:
            k = np.concatenate(self.single)
            self.single, self.waiting = [], 0
            k.sort()
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            self.keys.append(k[first])
            self.counts.append(np.diff(first, append=len(k)))
            self.held += len(first)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        self._count()
        if len(self.keys) == 1:
            return self.keys[0], self.counts[0]
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return _sum_by_key(np.concatenate(self.keys), np.concatenate(self.counts))

    def full(self) -> bool:
        return self.held > HELD // 2

    def clear(self) -> None:
        self.single, self.keys, self.counts = [], [], []
        self.waiting = self.held = 0


class _Remembered:
    """Id and count by hash, in ``SLOTS`` places: a new hash takes the place of one that ends alike."""

    def __init__(self, compute):
        """``compute``: distinct hashes -> (ids, counts)."""
        self.compute = compute
        self.keys = ~np.arange(SLOTS, dtype=np.uint64)          # these belong elsewhere: nothing is known yet
        self.columns = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)

    def __call__(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = (asked & np.uint64(SLOTS - 1)).astype(np.int64)
        out = tuple(column.take(slot) for column in self.columns)
        new = np.flatnonzero(self.keys.take(slot) != asked)
        if len(new):
            distinct, inverse = np.unique(asked[new], return_inverse=True)
            slot = (distinct & np.uint64(SLOTS - 1)).astype(np.int64)
            self.keys[slot] = distinct                             # of those that share a place the last stays, here as below
            for got, column, values in zip(out, self.columns, self.compute(distinct)):
                got[new], column[slot] = values[inverse], values
        return out


def _count_words(batches):
    c = _Counter()

    def out():
        keys, counts = c.merged()
        c.clear()
        for i in range(0, len(keys), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + (1 << 17)].view(np.int64)), pa.array(counts[i:i + (1 << 17)])], names=["h", "n"])

    for b in batches:
        for _, _, texts in text_slices(b.column(0)):
            c.add(_tokens(texts)[0])
        if c.full():
            yield from out()
    yield from out()


def _planes(a: np.ndarray) -> bytes:
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _from_planes(b: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def _narrow(counts: np.ndarray) -> np.ndarray:
    top = int(counts.max()) if len(counts) else 0
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.int64)


def _quantise(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte for each value and the 256 values they stand for: equally many in every bin."""
    if not len(logs):
        return np.zeros(0, np.uint8), np.zeros(256, np.float32)
    s = np.sort(logs)
    edges = s[np.linspace(0, len(s), 257).astype(int)[1:-1].clip(0, len(s) - 1)]
    code = np.searchsorted(edges, logs, side="right").astype(np.uint8)
    n = np.bincount(code, minlength=256)
    return code, (np.bincount(code, logs, 256) / np.maximum(n, 1)).astype(np.float32)


class Trie:
    """Reader of the levels built so far. Files: ``1-<shard>``, ``2-<shard>``, ..., mapped when they
    are first needed."""

    def __init__(self, folder: str, shards: int, starts: list[list[int]], min_count: int):
        self.folder, self.shards, self.starts, self.min_count = folder, shards, [np.array(s) for s in starts], min_count
        # for every run of 1 << shift nodes of a level, the shard of its first
        self._shifts = [max(int(s[-1]).bit_length() - 13, 0) for s in self.starts]
        self._first = [np.searchsorted(s, np.arange((int(s[-1]) >> shift) + 2) << shift, side="right") - 1 for s, shift in zip(self.starts, self._shifts)]
        self._files: dict[tuple[int, int], dict] = {}
        self._lists: dict[tuple[int, int], dict] = {}

    def file(self, level: int, shard: int) -> dict[str, np.ndarray]:
        if (level, shard) not in self._files:
            self._files[level, shard] = model_store.load(self.folder, f"{level + 1}-{shard}")
        return self._files[level, shard]

    def lists(self, level: int, shard: int) -> dict[str, EliasFano]:
        if (level, shard) not in self._lists:
            f = self.file(level, shard)
            self._lists[level, shard] = {key: EliasFano({p: f[f"{key}.{p}"] for p in PARTS})
                                         for key in (["keys"] if level == 0 else ["keys", "pointers"])}
        return self._lists[level, shard]

    def _by_shard(self, shard: np.ndarray):
        cut = np.append(0, np.cumsum(np.bincount(shard, minlength=self.shards)))
        order = None
        if (shard[1:] < shard[:-1]).any():                       # few bits are sorted by counting
            order = np.argsort(shard.astype(np.uint16) if self.shards <= 1 << 16 else shard, kind="stable")
        for s in np.flatnonzero(np.diff(cut)).tolist():
            at = slice(cut[s], cut[s + 1])
            yield s, at if order is None else order[at]

    def shard_of(self, level: int, nodes: np.ndarray) -> np.ndarray:
        first = self._first[level]
        shard = first.take(np.minimum(nodes >> self._shifts[level], len(first) - 1))
        ends = np.append(self.starts[level][1:], np.iinfo(np.int64).max)
        while (later := nodes >= ends.take(shard)).any():
            shard += later
        return shard

    def _spread(self, level: int, nodes: np.ndarray):
        """(shard, where its nodes are in ``nodes``) for each shard of ``level`` that has some."""
        if (nodes[1:] < nodes[:-1]).any():
            yield from self._by_shard(self.shard_of(level, nodes))
            return
        cut = np.append(np.searchsorted(nodes, self.starts[level]), len(nodes))
        for s in np.flatnonzero(np.diff(cut)).tolist():
            yield s, slice(cut[s], cut[s + 1])

    def word_ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, count) of words by hash."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        bits = self.shards.bit_length() - 1
        shard = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
        for s, at in self._by_shard(shard):
            found = self.lists(0, s)["keys"].find(hashes[at] - (np.uint64(s) << np.uint64(64 - bits) if bits else np.uint64(0)))
            hit = found >= 0
            ids[at] = np.where(hit, found + self.starts[0][s], -1)
            if hit.any():
                counts[at] = np.where(hit, self.file(0, s)["count"][found * hit], 0)
        return ids, counts

    def children(self, level: int, nodes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Node of ``level`` (1: bigrams) that extends each node of the level above by a word, or -1."""
        out = np.full(len(nodes), -1, np.int64)
        for s, at in self._spread(level - 1, nodes):
            lists = self.lists(level, s)
            own, inverse = _distinct(nodes[at] - self.starts[level - 1][s])
            begin, end = (p.astype(np.int64) for p in lists["pointers"].get_next(own))
            base = np.zeros(len(own), np.uint64)
            later = begin > 0
            base[later] = lists["keys"].get(begin[later] - 1) + np.uint64(1)
            found = lists["keys"].find(base[inverse] + ids[at].astype(np.uint64))
            hit = (found >= begin[inverse]) & (found < end[inverse])
            out[at] = np.where(hit, found + self.starts[level][s], -1)
        return out

    def values(self, level: int, nodes: np.ndarray, name: str) -> np.ndarray:
        """The dequantised ``name`` ('p': log10 probability, 'b': log10 back-off weight) of nodes."""
        out = np.zeros(len(nodes))
        for s, at in self._spread(level, nodes):
            f = self.file(level, s)
            out[at] = f[f"{name}.book"][np.asarray(f[name])[nodes[at] - self.starts[level][s]]]
        return out


def _ngram_nodes(trie: Trie, ids: np.ndarray, common: np.ndarray, ends: np.ndarray, end_id: int, depth: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For k = 1 to ``depth``: the node of the k words before each token (-1 if not in the trie), and
    for each k but the last what was found for these and the token (see :func:`_unique_children`). Before the
    first word of a text stands the end of another."""
    begins = np.zeros(len(ids), bool)
    begins[np.concatenate(([0], ends[:-1]))] = True
    before = np.where(begins, end_id, np.concatenate(([-1], ids[:-1])))
    ok = np.where(begins, end_id >= 0, np.concatenate(([False], common[:-1])))
    out, own = [np.where(ok, before, -1)], []
    for k in range(1, depth):
        node = np.full(len(ids), -1, np.int64)
        ask = np.flatnonzero((out[-1] >= 0) & common & (ids >= 0))
        own.append((ask, *_unique_children(trie, k, out[-1][ask], ids[ask])))
        node[ask] = own[-1][1][own[-1][2]]                       # with its token, the next one's longer context
        out.append(np.where(begins, -1, np.concatenate(([-1], node[:-1]))))
    return out, own


def _unique_children(trie: Trie, level: int, nodes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the different pairs of node and word (-1 if not in the trie), and the place of each pair's among them."""
    keys, inverse = _distinct((nodes.astype(np.uint64) << np.uint64(_WORD_BITS)) | ids.astype(np.uint64))
    return trie.children(level, (keys >> np.uint64(_WORD_BITS)).astype(np.int64), (keys & np.uint64((1 << _WORD_BITS) - 1)).astype(np.int64)), inverse


_TRIES = remembered({})


def _reader(spec) -> tuple[Trie, _Remembered]:
    """The trie built so far and the (id, count) of words by hash: one of each for a Python worker."""
    folder, shards, starts, min_count = spec
    if (folder, len(starts)) not in _TRIES:
        take_over()
        trie = Trie(*spec)

        table = _Remembered(trie.word_ids)
        _TRIES[folder, len(starts)] = (trie, table)
    return _TRIES[folder, len(starts)]


def _count_ngrams(spec, level: int, end_id: int):
    """Counts of (context node of ``level`` words, word), in one block for each shard."""
    def run(batches):
        (trie, table), c = _reader(spec), _Counter()

        def out():
            keys, counts = c.merged()
            c.clear()
            shard = trie.shard_of(level - 1, (keys >> np.uint64(_WORD_BITS)).astype(np.int64))
            cut = np.searchsorted(shard, np.arange(trie.shards + 1))
            rows = [(s, _planes(np.diff(keys[a:b], prepend=np.uint64(0))), _planes(counts[a:b].astype(np.uint32)))
                    for s, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if b > a]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["shard", "keys", "counts"])

        for b in batches:
            for _, _, texts in text_slices(b.column(0)):
                hashed, ends = _tokens(texts)
                ids, counts = table(hashed)
                common = counts >= trie.min_count
                context = _ngram_nodes(trie, ids, common, ends, end_id, level)[0][-1]
                ask = (context >= 0) & common
                c.add((context[ask].astype(np.uint64) << np.uint64(_WORD_BITS)) | ids[ask].astype(np.uint64))
            if c.full():
                yield from out()
        yield from out()
    return run


def _build_words(folder: str):
    def run(key, table):
        s = key[0].as_py()
        h, n = table.column("h").to_numpy().view(np.uint64), table.column("n").to_numpy()
        order = np.argsort(h)
        h, n = h[order], n[order]
        bits = table.column("bits")[0].as_py()
        arrays = {f"keys.{p}": a for p, a in EliasFano.of(h - (np.uint64(s) << np.uint64(64 - bits) if bits else np.uint64(0))).arrays.items()}
        model_store.save(folder, f"1-{s}", arrays | {"count": _narrow(n)})
        return pa.table({"shard": pa.array([s], pa.int32()), "n": pa.array([len(h)], pa.int64())})
    return run


def _merge_counts(folder: str, level: int, min_count: int):
    """Merge the counts of one shard into its file, drop the rare; counts of counts."""
    def run(key, table):
        s = key[0].as_py()
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for k, c in zip(table.column("keys"), table.column("counts")):
            held.append((np.cumsum(_from_planes(k.as_py(), np.uint64), dtype=np.uint64), _from_planes(c.as_py(), np.uint32).astype(np.int64)))
            if sum(len(x) for x, _ in held) > max(HELD, len(keys)):
                keys, counts = _sum_by_key(np.concatenate([keys, *(x for x, _ in held)]), np.concatenate([counts, *(x for _, x in held)]))
                held = []
        keys, counts = _sum_by_key(np.concatenate([keys, *(x for x, _ in held)]), np.concatenate([counts, *(x for _, x in held)]))
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        keep = counts >= min_count
        packed = zstandard.ZstdCompressor(level=1).compress(_planes(np.diff(keys[keep], prepend=np.uint64(0))))
        model_store.save(folder, f"{level + 1}-{s}", {"merged": np.frombuffer(packed, np.uint8), "count": _narrow(counts[keep])})
        return pa.table({"shard": pa.array([s], pa.int32()), "n": pa.array([int(keep.sum())], pa.int64()), "once": pa.array([once], pa.int64()), "twice": pa.array([twice], pa.int64())})
    return run


def _build_level(spec, level: int, stats):
    """Smooth and quantise the merged counts of each shard, write the level's file in their place."""
    def one(trie, s):
        merged = model_store.load(trie.folder, f"{level + 1}-{s}", mapped=False)
        if "merged" not in merged:                               # built by an earlier attempt
            return
        keys = np.cumsum(_from_planes(zstandard.ZstdDecompressor().decompress(merged["merged"].tobytes(), max_output_size=1 << 40), np.uint64), dtype=np.uint64)
        counts = merged["count"].astype(np.int64)
        first = trie.starts[level - 1]
        begin = first[s]
        n_contexts = (first[s + 1] if s + 1 < trie.shards else stats["sizes"][level - 1]) - begin
        context, ids = (keys >> np.uint64(_WORD_BITS)).astype(np.int64) - begin, (keys & np.uint64((1 << _WORD_BITS) - 1)).astype(np.int64)
        pointers = np.append(0, np.cumsum(np.bincount(context, minlength=n_contexts)))
        # how often each context was seen, and the lower-order probability of each successor
        above = trie.file(level - 1, s)["count"].astype(float)
        lower = _lower(trie, level, context + begin, ids, stats)
        discount = stats["discounts"][level]
        freed = np.ones(n_contexts)
        np.subtract.at(freed, context, (counts - discount) / above[context])
        p = (counts - discount) / above[context] + freed[context] * lower
        p_code, p_book = _quantise(np.log10(np.maximum(p, 1e-30)))
        b_code, b_book = _quantise(np.log10(np.maximum(freed, 1e-12)))
        # each context's ids lifted above the last of the contexts before it
        last = np.zeros(n_contexts, np.uint64)
        has = pointers[1:] > pointers[:-1]
        last[has] = ids[pointers[1:][has] - 1].astype(np.uint64) + np.uint64(1)
        lift = np.cumsum(last) - last
        arrays = {f"keys.{k}": a for k, a in EliasFano.of(ids.astype(np.uint64) + lift[context]).arrays.items()}
        arrays |= {f"pointers.{k}": a for k, a in EliasFano.of(pointers).arrays.items()}
        model_store.save(trie.folder, f"{level + 1}-{s}", arrays | {"count": _narrow(counts), "p": p_code, "p.book": p_book, "b": b_code, "b.book": b_book})

    def run(batches):
        trie = _reader(spec)[0]                                  # as the counting left it in this worker
        for b in batches:
            for s in b.column(0).to_pylist():
                one(trie, s)
            yield b

    return run


def _unigram(counts: np.ndarray, stats) -> np.ndarray:
    return np.where(counts > 0, (counts - stats["discount"]) / stats["tokens"], stats["discount"] * stats["words"] / stats["tokens"])


def _lower(trie: Trie, level: int, context: np.ndarray, ids: np.ndarray, stats) -> np.ndarray:
    """Probability of each word after the context without its first word."""
    counts = np.zeros(len(ids))
    for s, at in trie._spread(0, ids):
        counts[at] = trie.file(0, s)["count"][ids[at] - trie.starts[0][s]]
    if level == 1:
        return _unigram(counts, stats)
    # context nodes were reached through their parents: the last word alone is found again by its bigram
    parents, last = _last_words(trie, level - 1, context)
    if level == 2:
        logs = _conditional(trie, [last], ids, counts, stats)
        return 10 ** logs
    raise ValueError("orders above three are not built")


def _last_words(trie: Trie, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent node, last word id) of nodes of ``level``."""
    parent, word = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    for s, at in trie._spread(level, nodes):
        own, inverse = _distinct(nodes[at] - trie.starts[level][s])
        lists = trie.lists(level, s)
        pointers = lists["pointers"].get(np.arange(lists["pointers"].n)).astype(np.int64)
        p = np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))[own]
        base = np.zeros(len(own), np.uint64)
        later = pointers[p] > 0
        base[later] = lists["keys"].get(pointers[p][later] - 1) + np.uint64(1)
        parent[at] = (p + trie.starts[level - 1][s])[inverse]
        word[at] = (lists["keys"].get(own) - base).astype(np.int64)[inverse]
    return parent, word


def _conditional(trie: Trie, contexts: list[np.ndarray], ids: np.ndarray, counts: np.ndarray, stats, nodes=()) -> np.ndarray:
    """log10 probability of each word after its contexts (by length, -1: none), longest first
    found, with the back-off weights of the longer contexts passed on the way. ``nodes``: what
    :func:`_ngram_nodes` found for the shorter contexts with the word, if known already."""
    log = np.log10(_unigram(counts, stats))
    for k, context in enumerate(contexts, start=1):
        if k <= len(nodes):
            ask, found, inverse = nodes[k - 1]
        else:
            ask = np.flatnonzero((context >= 0) & (ids >= 0) & (counts >= trie.min_count))
            found, inverse = _unique_children(trie, k, context[ask], ids[ask])
        hit = np.flatnonzero(found >= 0)
        value = np.full(len(found), np.nan)
        value[hit] = trie.values(k, found[hit], "p")
        value = value[inverse]
        new = np.isnan(value)
        missed = context >= 0
        missed[ask] = new
        missed = np.flatnonzero(missed)
        log[ask] = np.where(new, log[ask], value)
        # a context of k words keeps its weight with its successors, in the file of level k
        log[missed] += _backoff(trie, k, context[missed])
    return log


def _backoff(trie: Trie, level: int, context: np.ndarray) -> np.ndarray:
    out = np.zeros(len(context))
    for s, at in trie._spread(level - 1, context):
        f = trie.file(level, s)
        out[at] = f["b.book"][f["b"][context[at] - trie.starts[level - 1][s]]]
    return out


class Model:
    """What a scoring task needs to know: where the trie is, and the numbers of the whole corpus."""

    def __init__(self, spec, stats, order: int, end_id: int):
        self.spec, self.stats, self.order, self.end_id = spec, stats, order, end_id


def fit(docs: DataFrame, text_col: str = "text", order: int = 2, min_count: int = MIN_COUNT) -> Model:
    """Count, build and write the trie for ``docs`` (all rows; null texts are empty texts)."""
    if order not in (1, 2, 3):
        raise ValueError("order must be 1, 2 or 3")
    spark = docs.sparkSession
    folder = model_store.new_folder(spark, "ngrams")
    texts = docs.select(docs[text_col].cast("string"))
    vocabulary = cut_lineage(texts.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    n_words, tokens, once, twice = vocabulary.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    if n_words >= 1 << _WORD_BITS:
        raise ValueError("more words than word ids")
    bits = max(4, (int(tokens) // SHARD_TOKENS).bit_length())
    shards = 1 << bits
    keyed = vocabulary.select("h", "n", F.shiftrightunsigned("h", 64 - bits).cast("int").alias("shard"), F.lit(bits).alias("bits"))
    empty = {f"keys.{p}": a for p, a in EliasFano.of(np.zeros(0, np.uint64)).arrays.items()}

    def sizes(got, level):
        for s in set(range(shards)) - got.keys():              # shards without rows
            more = {"count": np.zeros(0, np.int64)}
            if level:
                n = starts[level - 1][s + 1] - starts[level - 1][s] if s + 1 < shards else totals[level - 1] - starts[level - 1][s]
                more |= {f"pointers.{p}": a for p, a in EliasFano.of(np.zeros(n + 1, np.uint64)).arrays.items()}
                more |= {"p": np.zeros(0, np.uint8), "p.book": np.zeros(256, np.float32), "b": np.zeros(n, np.uint8), "b.book": np.zeros(256, np.float32)}
            model_store.save(folder, f"{level + 1}-{s}", empty | more)
        each = [got.get(s, 0) for s in range(shards)]
        starts.append(np.concatenate(([0], np.cumsum(each)[:-1])).astype(int).tolist())
        totals.append(sum(each))

    starts, totals = [], []
    built = keyed.groupBy("shard").applyInArrow(_build_words(folder), "shard int, n long").collect()        # a number for each shard
    sizes({r.shard: r.n for r in built}, 0)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    stats = {"tokens": max(int(tokens), 1), "words": n_words, "discount": discount, "discounts": {}, "sizes": totals}
    spec = (folder, shards, starts, min_count)
    end_id = int(Trie(*spec).word_ids(_hash([END]))[0][0])
    for level in range(1, order):
        spec = (folder, shards, [*starts], min_count)
        counted = texts.mapInArrow(_count_ngrams(spec, level, end_id), "shard int, keys binary, counts binary")
        merged = counted.groupBy("shard").applyInArrow(_merge_counts(folder, level, min_count), "shard int, n long, once long, twice long").collect()
        once, twice = sum(r.once for r in merged), sum(r.twice for r in merged)
        stats["discounts"][level] = once / (once + 2 * twice) if once and twice else 0.5
        own = spark.createDataFrame([(r.shard,) for r in merged], "shard int")
        if merged:
            own.repartition(shards, "shard").mapInArrow(_build_level(spec, level, stats | {"sizes": [*totals]}), "shard int").count()
        sizes({r.shard: r.n for r in merged}, level)
    return Model((folder, shards, starts, min_count), stats | {"tokens": int(tokens)}, order, end_id)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score (add-one unigram,
    log10), score (the trie's log10 probability of the text, its end included).

    Null and empty texts have one token, the end. A word that training did not hold gets the
    mass that the discount freed. An empty training corpus gives base scores of add-one over no
    token and scores of 0. Repeated rows are scored alike; other columns are not looked at."""
    spec, stats, order, end_id = model.spec, model.stats, model.order, model.end_id

    def run(batches):
        trie, table = _reader(spec)
        safe = stats | {"tokens": max(stats["tokens"], 1)}
        for b in batches:
            known, base, own, size = [], [], [], []
            for _, _, texts in text_slices(b.column(1)):
                hashed, ends = _tokens(texts)
                ids, counts = table(hashed)
                contexts, nodes = _ngram_nodes(trie, ids, counts >= trie.min_count, ends, end_id, order - 1) if order > 1 and end_id >= 0 else ([], [])
                log = _conditional(trie, contexts, ids, counts, safe, nodes) if stats["tokens"] else np.zeros(len(ids))
                plain = np.log10((counts + 1) / (stats["tokens"] + stats["words"] + 1))
                for into, each in ((known, counts > 0), (base, plain), (own, log)):
                    into += sums(each[:, None], ends)[:, 0].tolist()
                size += np.diff(ends, prepend=0).tolist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(known).cast(pa.int64()), pa.array([stats["tokens"]] * len(size), pa.int64()),
                 pa.array(base, pa.float64()), pa.array(own, pa.float64())],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
