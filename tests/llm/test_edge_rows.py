"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, where the
other files do not cover them."""

import hashlib
import random

import public_tokenizers
import sentencepiece
import tiktoken

import corpus_pipeline
from flowlab.llm.sentence_pieces import round_trip
from flowlab.llm.simhash import simhash_components
from flowlab.llm.token_counts import encoding, length_histogram, length_report, token_lengths

from .test_simhash import plain_fingerprint

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LONG = " ".join(random.Random(4).choices(["alpha", "beta", "Gamma", "naïve", "42", "x"], k=120_000))


def test_round_trip_edges(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(1, None), (2, ""), (3, "two  spaces "), (3, "two  spaces "), (None, "a b"), (4, "▁ mark"), (5, LONG)]
    docs = spark.createDataFrame([(i, t, [9], "x", True) for i, t in rows], "doc_id long, text string, ids array<int>, decoded_sha256 string, same_text boolean")
    got = sorted(((r.doc_id, r.ids, r.decoded_sha256, r.same_text) for r in round_trip(docs, PIECES).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = sp.encode(t or "")
        back = sp.decode(ids)
        want.append((i, ids, hashlib.sha256(back.encode()).hexdigest(), back == (t or "")))
    assert got == sorted(want, key=repr)
    assert round_trip(docs.limit(0), PIECES).collect() == []


def test_simhash_of_a_very_long_text(spark):
    rows = [(7, LONG, "f"), (8, LONG + " ", "f"), (9, "short text of a few words", "f"), (9, None, "f")]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash_components(spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")).collect()]
    fp = f"{plain_fingerprint(LONG):016x}"
    assert sorted(got)[:2] == [(7, fp, 7), (8, fp, 7)] and len(got) == 4


def test_token_counts_of_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, LONG, 5), (1, LONG, 5), (2, None, 5), (3, "", 5), (None, "a b", 5)], "doc_id long, text string, n_tokens int")
    n = len(encoding(RANKS, PATTERN).encode_ordinary(LONG))
    lengths = token_lengths(docs, RANKS, PATTERN)
    assert sorted(r.n_tokens for r in lengths.collect()) == [0, 0, 2, n, n]
    top = {r.n_tokens: r for r in length_report(length_histogram(lengths)).collect()}
    assert top[n].tokens_up_to == 2 * n + 2 and top[2].docs_over == 2 and isinstance(encoding(RANKS, PATTERN), tiktoken.Encoding)


def test_the_pipeline_on_odd_rows(spark, tmp_path):
    """Every stage in turn on nulls, empty and very long texts, ties, repeated rows and more columns."""
    rng = random.Random(2)
    words = {"en": ["the", "house", "and", "river", "of", "green", "hills"], "de": ["das", "haus", "und", "der", "fluss", "im", "tal"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=40)), lang, "s", 0) for i in range(120) for lang in ("en", "de")]          # tied ids
    rows += [(500, None, "en", "s", 0), (501, "", "en", "s", 0), (502, "12 34 !!", "de", "s", 0), (None, " ".join(words["en"] * 5), "en", None, 0),
             (600, " ".join(rng.choices(words["en"], k=60_000)), "en", "s", 0), (601, "the house and river", None, None, 0), (601, "the house and river", None, None, 0)]
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id int, `__pipeline_lang` double")
    spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now, seen = docs, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / f"{k}"))
        now = spark.read.parquet(str(tmp_path / f"{k}"))
        seen.append(now.count())
        if name != "packing":
            assert now.columns == docs.columns
    kept = {r.doc_id for r in now.select("doc_id").distinct().collect()}
    assert 600 in kept and not {500, 501, 502} & kept and seen[0] >= seen[1] >= seen[2] >= seen[3] > 0
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
