import random

import numpy as np
import pytest
import xxhash

from flowlab.llm.components import components
from flowlab.llm.simhash import drop_near_copies, fingerprint, links, simhash_components


def brute_components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def test_fingerprint_matches_the_plain_definition(spark):
    texts = ["", "a", "A b", "a b c", "x\x1cy z\u00a0w q", "\u00c9t\u00e9 A\u0130 b c d e f", "one two  three\tfour\nfive " * 40]
    for t in texts + [None]:
        assert fingerprint(t) == plain_fingerprint(t)
    h = spark.sql("select xxhash64('a b c') h").first().h % (1 << 64)
    assert h == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_links_connect_what_brute_force_connects(spark, radius):
    rng = random.Random(radius)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for _ in range(6):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 5)):
                g ^= 1 << b
            fps.append(g)
            f = g if rng.random() < 0.5 else f
    fps = sorted(set(fps) | {0, 1, 3, 7})
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    got = [(r.fa % (1 << 64), r.fb % (1 << 64)) for r in links(df, radius).collect()]
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in got)
    want = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= radius]
    assert brute_components(got, fps) == brute_components(want, fps)


def test_components_of_paths_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(1, 1), (300, 301), (301, 300), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(200, 260)} == {7} and got[301] == 300 and 1 not in got


def test_documents_with_nulls_ties_repeats_and_clashing_columns(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base, "x"), (3, base + " tail", "x"), (9, None, None), (2, "", "y"), (2, "", "y"), (None, " \n", "z"),
            (11, "quite other words here", "q"), (None, "further words that are alone", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    ids = [i for i, _, _ in rows]
    cls = brute_components([(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3], range(len(rows)))
    want = sorted(((ids[i], f"{fps[i]:016x}", min((ids[j] for j in cls if cls[j] == cls[i] and ids[j] is not None), default=None))
                   for i in range(len(rows))), key=str)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash_components(docs).collect()), key=str)
    assert got == want
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _, c in want if i is None or i == c)
    assert simhash_components(docs.limit(0)).count() == 0


def test_tied_ids_do_not_link_or_drop_other_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(400)) for x in "ab")
    near_a, near_b = a + " tail", b + " tail"
    for x, y in ((a, a), (b, b), (a, near_a), (b, near_b)):
        assert (plain_fingerprint(x) ^ plain_fingerprint(y)).bit_count() <= 3
    assert (plain_fingerprint(a) ^ plain_fingerprint(b)).bit_count() > 9
    for a2, b2 in ((a, b), (near_a, near_b)):
        rows = [(3, a), (5, a2), (5, b), (8, b2)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted((r.doc_id, r.component_id) for r in simhash_components(docs).collect()) == [(3, 3), (5, 3), (5, 5), (8, 5)]
        assert sorted(map(tuple, drop_near_copies(docs).collect())) == [(3, a), (5, b)]
    docs = spark.createDataFrame([(None, "p q"), (7, ""), (7, "p q"), (2, None)], "doc_id long, text string")
    assert sorted(map(str, map(tuple, drop_near_copies(docs).collect()))) == sorted(map(str, [(None, "p q"), (7, "p q"), (2, None)]))
