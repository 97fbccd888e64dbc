"""The registered queries on the small tables: against DuckDB where SQL can say it, else against
plain versions; and the pipeline, stage by stage."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from flowlab.llm.queries import ORACLES, QUERIES

from .test_simhash import brute_components, plain_fingerprint

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def run(spark, name, sf=SF):
    return {r.doc_id: r for r in QUERIES[name](spark, sf).collect()}


def test_all_are_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(i) for i in range(1, 14)}
    assert set(QUERIES) <= set(E.queries()) and "pipeline" in E.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "exact_dedup", "simhash_near_dedup", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    r = con.execute(ORACLES[name])
    cols = [d[0] for d in r.description]
    assert sorted(cols) == sorted(df.columns)
    rows = r.fetchall()
    assert sorted(map(repr, (tuple(x[c] for c in cols) for x in df.collect()))) == sorted(map(repr, rows)) and rows


def brute_simhash(docs):
    fps = {i: plain_fingerprint(t) for i, t in docs.items()}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    return fps, brute_components(near, sorted(fps))


def test_simhash(spark):
    fps, comp = brute_simhash({i: r["text"] for i, r in DOCS.items()})
    got = run(spark, "op1_simhash")
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{fps[i]:016x}", comp[i]) for i in fps}


def test_sentence_pieces(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = run(spark, "op2_sentence_pieces")
    assert all(got[i].ids == sp.encode(r["text"]) and got[i].n_tokens == len(got[i].ids) for i, r in DOCS.items()) and len(got) == len(DOCS)


def test_sentence_pieces_are_decoded(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = run(spark, "op2_sentence_pieces")
    for i, r in DOCS.items():
        back = sp.decode(got[i].ids)
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest() and got[i].same_text == (back == r["text"])
    assert any(r.same_text for r in got.values())


def test_toxicity_and_language_on_held_out_rows(spark):
    docs = {r["doc_id"]: r for r in pq.read_table(f"{SF2}/documents.parquet").to_pylist()}
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF2}/labels.parquet").to_pylist()}
    got = run(spark, "op3_toxicity", SF2)
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(labels[i], r.predicted) for i, r in got.items() if r.held_out and i in labels]
    assert np.mean([p for y, p in held if y == 0]) < 0.05 and np.mean([p for y, p in held if y == 1]) > 0.6
    lang = run(spark, "op8_language_id", SF2)
    assert np.mean([docs[i]["lang"] == r.lang_pred for i, r in lang.items() if r.held_out]) > 0.97 and len(lang) == len(docs)


def check_packing(rows, texts):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in texts.items()}
    seqs, covered = defaultdict(list), Counter()
    for r in rows:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
        covered[r.doc_id] += r.length
        seqs[r.sequence_id].append((r.offset, r.length))
    assert covered == {i: len(x) for i, x in want.items()}
    for parts in seqs.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 4096


def test_packing(spark):
    check_packing(QUERIES["op6_packing"](spark, SF).collect(), {i: r["text"] for i, r in DOCS.items()})


def test_lm_base_and_gain(spark):
    def words(t):
        return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    train = Counter(w for i, r in DOCS.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in words(r["text"]))
    n, v = sum(train.values()), len(train)
    got = run(spark, "op7_lm_score")
    for i, r in DOCS.items():
        w, g = words(r["text"]), got[i]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(w), sum(x in train for x in w), n)
        assert abs(g.base_score - sum(log10((train[x] + 1) / (n + v + 1)) for x in w)) < 1e-6 * len(w)
    held = [g for g in got.values() if g.held_out]
    assert held and sum(g.score for g in held) > 0.9 * sum(g.base_score for g in held)


def test_lm_uses_every_trigram(spark):
    from flowlab.llm.ngram_lm import fit, score

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2"), order=3, min_count=1)
    want = {r.doc_id: r.score for r in score(docs, model).collect()}
    got = run(spark, "op7_lm_score")
    assert set(got) == set(want) and all(abs(g.score - want[i]) < 1e-6 * max(1, abs(want[i])) for i, g in got.items())
    train = [[None, *re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")), None] for i, r in DOCS.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    assert model.stats["sizes"][1] == len({(a, b) for w in train for a, b in zip(w, w[1:])})


def test_token_counts(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [len(enc.encode_ordinary(r["text"])) for r in DOCS.values()]
    for r in QUERIES["op9_token_counts"](spark, SF).collect():
        assert (r.docs, r.tokens_up_to, r.truncated_total) == (want.count(r.n_tokens), sum(x for x in want if x <= r.n_tokens), sum(min(x, r.n_tokens) for x in want))


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Every stage on what its predecessor kept, with nulls, ties, repeats and extra columns."""
    base = spark.read.parquet(f"{SF2}/documents.parquet")
    odd = spark.createDataFrame([(90_001, None, "en", "s", 0), (90_002, "", "en", "s", 0), (90_003, "12 34", None, None, None), (None, "the and of that with", None, "s", 20),
                                 (90_004, "the and of that is  with", "en", "s", 5), (90_005, "the and of that is with", "en", "s", 5), (90_005, "the and of that is with", "en", "s", 5)], base.schema)
    docs = base.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        out = stage(spark, docs, SF2)
        assert out.columns == base.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        kept = Counter(map(tuple, after))
        assert not kept - Counter(map(tuple, before)), name                                # rows are kept as they are
        if name == "language_id":
            lost = {r.doc_id for r in before} - {r.doc_id for r in after}
            assert {90_001, 90_002, 90_003} <= lost and len(lost) < 0.02 * len(before)
        elif name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF2}/labels.parquet").to_pylist()}
            lost = {r.doc_id for r in before} - {r.doc_id for r in after}
            assert len([i for i in lost if labels.get(i) == 0]) < 0.02 * len(before) and sum(labels.get(i) == 1 for i in lost) > 25
        elif name == "exact_dedup":
            norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t)
            least = {}
            for r in before:
                k = norm(r.text)
                least[k] = min(least.get(k, 1 << 60), r.doc_id if r.doc_id is not None else 1 << 60)
            assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if (1 << 60 if r.doc_id is None else r.doc_id) == least[norm(r.text)])
        else:
            fps, comp = brute_simhash({r.doc_id: r.text for r in before if r.doc_id is not None})
            assert {r.doc_id for r in after} - {None} == {i for i in comp if comp[i] == i}
            assert any(r.doc_id is None for r in after)
    docs = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(corpus_pipeline.pack(spark, docs, SF2).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_pipeline_leaves_foreign_columns_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("toxicity", __import__("pyspark").sql.functions.lit("mine")).withColumnRenamed("source", "component_id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.where("toxicity <> 'mine'").count() == 0


def test_run_gives_packed_pieces(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.doc_id for r in rows} <= set(DOCS) and len({r.sequence_id for r in rows}) <= len(DOCS)
