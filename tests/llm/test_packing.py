import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowlab.llm.packing import cutting_stock, pack, plan_sequences, word_encoder, chunks

PATH = public_tokenizers.path("word_bpe_49k.json")


def want_ids(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [2]


def test_chunk_encoding_equals_the_tokenizer():
    tok, enc = Tokenizer.from_file(PATH), word_encoder(PATH)
    texts = ["", " ", "Plain words, and more. Again!", "don't DON'T we'll", "á ÉTÉ. ×. ÷, x×.", "İstanbul ΣΣ ΟΣ.",
             "tab\tand\x0bvt\x1cfs nbsp em", "<|endoftext|> A<|STARTOFTEXT|>b <|startoftext|>.", "...,,, a.. b.,", "12 3a4 你好。 \U0001f600.",
             "é. ẛ̣,", "ª. º, µ."]
    ids, ends = enc.of(*chunks(pa.array(texts, pa.string())))
    for t, a, b in zip(texts, [0, *ends.tolist()], ends.tolist()):
        assert ids[a:b].tolist() == tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("seed", range(4))
def test_cutting_stock_gives_every_piece_a_slot_and_is_tight(seed):
    rng = random.Random(seed)
    hist = {s: rng.randint(1, 400) for s in rng.sample(range(1, 65), 30)}
    plan = cutting_stock(hist, 64)
    slots = defaultdict(int)
    for p, n in plan:
        assert sum(s * c for s, c in p.items()) <= 64
        for s, c in p.items():
            slots[s] += c * n
    assert all(slots[s] >= n for s, n in hist.items())
    bins = []                                    # first fit, largest first: a good plain packing
    for s in sorted(hist, reverse=True):
        for _ in range(hist[s]):
            i = next((i for i, room in enumerate(bins) if room >= s), None)
            if i is None:
                bins.append(64 - s)
            else:
                bins[i] -= s
    assert sum(n for _, n in plan) <= len(bins) + 2
    assert cutting_stock({}, 64) == [] and cutting_stock({64: 3}, 64) == [({64: 1}, 3)]


def test_pack_places_each_id_once_without_gaps(spark):
    rng = random.Random(3)
    words = ["alpha", "bete", "Gamma.", "delta,", "epsilon!", "x9y"]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 40, 300, 900])))) for i in range(300)]
    rows += [(1000, " ".join(rng.choices(words, k=30_000))), (1001, None), (1002, ""), (7, "again"), (7, "again"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, sequence_id int")
    got = pack(docs, PATH, end_id=2, with_ids=True).collect()
    tok = Tokenizer.from_file(PATH)
    want, have = defaultdict(list), defaultdict(list)
    for i, t in rows:
        want[i].append(want_ids(tok, t))
    seqs = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        have[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(have) == set(want)
    for i, lists in want.items():
        if len(lists) == 1:
            assert sum((ids for _, ids, _ in sorted(have[i])), []) == lists[0] and {n for _, _, n in have[i]} == {len(lists[0])}
        else:
            assert sorted(ids for _, ids, _ in have[i]) == sorted(lists)
    used = padded = 0
    for parts in seqs.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 4096
        used += end
        padded += end if end & (end - 1) == 0 else 4096
    assert padded <= used * 1.03 + 2 * 4096
    assert pack(docs.limit(0), PATH, end_id=2).count() == 0


def test_a_small_memory_gives_the_same_ids():
    from flowlab.llm.chunk_ids import ChunkIds, in_parts

    rng = random.Random(1)
    texts = [[str(min(int(rng.expovariate(0.05)), 300)).encode() for _ in range(rng.randint(0, 30))] for _ in range(400)]
    enc = ChunkIds(lambda new: in_parts(new, lambda cs: [[int(c), *range(int(c) % 4)] for c in cs], 7), max_bytes=20 * 160)
    for i in range(0, 400, 5):
        ids, ends = enc(texts[i:i + 5])
        want = [[x for c in t for x in (int(c), *range(int(c) % 4))] for t in texts[i:i + 5]]
        assert ids.tolist() == sum(want, []) and ends.tolist() == np.cumsum(list(map(len, want))).tolist()
        assert len(enc.index) <= 20 + 150


def test_the_memory_is_bounded_in_bytes():
    """Texts without white space are one chunk each: what is remembered of them has a bound too."""
    from flowlab.llm.chunk_ids import CACHE_BYTES, ChunkIds, ChunkTable, in_parts

    enc = ChunkIds(lambda new: in_parts(new, lambda cs: [list(c[:8]) * 500 for c in cs]))
    table = ChunkTable(lambda new: np.array([[len(c), c[0]] for c in new], float), 2)
    for i in range(60):
        texts = [[f"{i}-{k}-".encode() + b"x" * 10_000] for k in range(200)]
        ids, ends = enc(texts)
        assert ids[:8].tolist() == list(texts[0][0][:8]) and (np.diff(ends) == 4000).all()
        rows, _ = table(texts)
        assert rows[:, 0].tolist() == [len(t[0]) for t in texts]
        for t in (enc, table):
            held = sum(map(len, t.index))
            assert held <= CACHE_BYTES + 200 * 11_000 and t.cost >= held
    assert 4 * enc.used <= CACHE_BYTES


@pytest.mark.parametrize("sizes", [(1, 31), (17, 18), (1, 2), (40, 61), (1, 257)])
def test_short_texts_leave_little_padding(spark, sizes):
    rng = random.Random(sizes[0])
    rows = [(i, " ".join(["the"] * (rng.randrange(*sizes) - 1))) for i in range(20_000 if sizes[1] < 100 else 4_000)]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, end_id=2).collect()
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 4096
    used = sum(r.length for r in got)
    assert len(got) == len(rows) and used == sum(len(t.split()) + 1 for _, t in rows)
    assert len(seqs) * 4096 <= used * 1.01 + 2 * 4096


@pytest.mark.parametrize("seed", range(4))
def test_plans_of_short_and_long_pieces(seed):
    rng = random.Random(seed)
    hist = {s: rng.randint(1, 3000) for s in rng.sample(range(1, 257), 60)} | {16 * s: rng.randint(1, 40) for s in rng.sample(range(17, 257), 80)}
    plan, slots = plan_sequences(hist), defaultdict(int)
    for p, n in plan:
        assert n > 0 and sum(s * c for s, c in p.items()) <= 4096
        for s, c in p.items():
            slots[s] += c * n
    assert all(slots[s] >= n for s, n in hist.items())
    assert sum(n for _, n in plan) * 4096 <= sum(s * n for s, n in hist.items()) * 1.01 + 3 * 4096
