"""Entities from dictionaries and patterns, resolved to disjoint spans."""

import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowlab.operators import entities as en

TERMS = [("new york", "LOCATION", 0.9), ("York", "LOCATION", 0.7), ("new", "OTHER", 0.2), ("York Times", "ORGANIZATION", 0.8), ("new york times", "ORGANIZATION", 0.95),
         ("acme", "ORGANIZATION", 0.9), ("Acme", "ORGANIZATION", 0.5), ("2020-01-02 report", "TITLE", 0.99), ("é", "OTHER", 0.3), ("", "OTHER", 1.0), ("gone", None, 1.0)]
TEXTS = ["The New York Times and ACME of York, newyork news", "acmes acme-acme 2020-01-02 report", "card 4111111111111111 and 4111111111111112 end", None, "",
         "mail a.b@acme.com or see http://acme.com/x 10 kg é café", "nothing here"]


def frames(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    return docs, spark.createDataFrame(TERMS, "term string, type string, score double")


def brute_terms(text):
    out = set()
    for term, kind, _ in TERMS:
        if not term or not kind:
            continue
        for m in re.finditer(f"(?=({re.escape(term.lower())}))", text.lower()):
            b, e = m.start(), m.start() + len(term)
            if not (b and text[b - 1].isalnum() and text[b].isalnum()) and not (e < len(text) and text[e].isalnum() and text[e - 1].isalnum()):
                out.add((kind, text[b:e], b, e))
    return out


@pytest.mark.parametrize("block", [1, 3, 100])
def test_the_automaton_finds_every_term(spark, block):
    docs, terms = frames(spark)
    got = {}
    for r in en.dictionary_entities(docs, terms, block_terms=block).collect():
        got.setdefault(r.doc_id, []).append((r.Type, r.Text, r.BeginOffset, r.EndOffset))
    for i, t in enumerate(TEXTS):
        assert sorted(got.get(i, [])) == sorted(brute_terms(t or ""))


def test_spans_are_disjoint_and_card_numbers_checked(spark):
    docs, terms = frames(spark)
    rows = {}
    for r in en.resolved_entities(docs, terms).collect():
        rows.setdefault(r.doc_id, []).append(r)
    for i, own in rows.items():
        own.sort(key=lambda r: r.BeginOffset)
        assert all(a.EndOffset <= b.BeginOffset for a, b in zip(own, own[1:]))
        assert all(TEXTS[i][r.BeginOffset:r.EndOffset] == r.Text for r in own)
    assert [r.Text for r in rows[0]] == ["New York Times", "ACME", "York"] and rows[0][1].Score == 0.9
    assert [(r.Type, r.Text) for r in rows[1]] == [("ORGANIZATION", "acme"), ("ORGANIZATION", "acme"), ("TITLE", "2020-01-02 report")]
    assert [r.Text for r in rows[2] if r.Type == "CARD_NUMBER"] == ["4111111111111111"]
    assert {r.Type for r in rows[5]} >= {"EMAIL", "URL"} and not {3, 4, 6} & set(rows)
    assert en.resolved_entities(docs.limit(0), terms).collect() == []
    assert {r.Type for r in en.resolved_entities(docs, terms.limit(0)).collect()} >= {"EMAIL", "URL", "DATE"}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 6), st.integers(1, 9)), max_size=9))
def test_the_kept_spans_weigh_most(items):
    spans = [(b, b + n, float(w)) for b, n, w in items]

    def disjoint(idx):
        s = sorted(spans[i][:2] for i in idx)
        return all(x[1] <= y[0] for x, y in zip(s, s[1:]))

    kept = en.best_disjoint(spans)
    best = max((sum(spans[i][2] for i in c) for k in range(len(spans) + 1) for c in itertools.combinations(range(len(spans)), k) if disjoint(c)), default=0.0)
    assert disjoint(kept) and sum(spans[i][2] for i in kept) == best


def test_check_digits(spark):
    rng = random.Random(1)
    numbers = ["4111111111111111", "79927398713", "79927398710", "0", "18"] + ["".join(rng.choices("0123456789", k=16)) for _ in range(50)]

    def plain(s):
        return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0

    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    assert all(r.ok == plain(r.n) for r in df.select("n", en.luhn(df.n).alias("ok")).collect())
