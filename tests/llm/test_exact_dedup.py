import re
from collections import defaultdict
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st

from flowlab.llm.exact_dedup import drop_exact_copies, exact_dedup
from flowlab.llm.patricia import PatriciaOwners


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=7), st.one_of(st.none(), st.integers(0, 9))), max_size=60), st.sampled_from([1, 900, 1 << 30]))
def test_trie_owners_equal_a_dictionary_with_and_without_spill(rows, memory):
    trie, want = PatriciaOwners(memory), defaultdict(lambda: [None, 0])
    for t, i in rows:
        trie.insert(t.encode(), i)
        w = want[t.encode()]
        w[0] = i if w[0] is None else w[0] if i is None else min(w[0], i)
        w[1] += 1
    assert sorted(trie.items(), key=str) == sorted(((k, *v) for k, v in want.items()), key=str)


def test_whole_rows_nulls_empties_ties_repeats_and_clashes(spark):
    long = "very long " * 60_000
    rows = [(4, "a  b"), (2, "a b"), (9, "a\n\tb"), (1, None), (7, ""), (8, " "), (3, "a b "), (None, "a b"), (None, "alone"),
            (6, long), (5, long), (12, "twice"), (12, "twice"), (13, "a\x1cb"), (14, "a\u00a0b")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, keep_id string")
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), n in zip(rows, norm):
        groups[n].append(i)
    want = []
    for (i, _), n in zip(rows, norm):
        keep = min((x for x in groups[n] if x is not None), default=None)
        want.append((i, keep, len(groups[n]), i == keep, sha256(n.encode()).hexdigest()))
    got = [tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in exact_dedup(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if w[3])
    assert exact_dedup(docs.limit(0)).count() == 0


def test_tied_ids_with_different_texts_keep_every_text(spark):
    rows = [(3, "A a"), (5, "A  a"), (5, "B b"), (8, "B\tb"), (9, "C"), (9, "D"), (None, "D"), (None, "E"), (2, None), (4, ""), (4, "F")]
    kept = drop_exact_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [
        (3, "A a"), (5, "B b"), (9, "C"), (9, "D"), (None, "E"), (2, None), (4, "F")]))
