"""Tokenizer alignment against the libraries' own tokens, aligned byte by byte."""

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flowlab.llm import alignment
from flowlab.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}

    def tokens(text):
        a = tok.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        a = [(i, bytes(sign[c] for c in tok.id_to_token(i))) for i in a]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in b]
        whole = (" " + text).encode()
        return (a, b) if text and all(b"".join(x for _, x in s) == whole for s in (a, b)) else ([], [])

    def rows(texts):
        parts, pairs = [], Counter()
        for text in texts:
            a, b = tokens(text or "")
            spans = []
            for side in (a, b):
                at, out = 0, []
                for i, x in side:
                    out.append((i, at, at + len(x)))
                    at += len(x)
                spans.append(out)
            links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if max(s, t) < min(e, f)] if len(a) < 400 else sweep(*spans)
            cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
            shown, before = [], 0
            for c in cuts:
                shown.append("|".join(",".join(str(i) for i, s, e in side if before < e <= c) for side in spans))
                before = c
            parts.append((len(a), len(b), cuts, links, hashlib.sha256(";".join(shown).encode()).hexdigest() if a else ""))
            pairs.update(set(links))
        top = Counter()
        for (i, _), n in pairs.items():
            top[i] = max(top[i], n)
        return [(n_a, n_b, len(cuts), len(links), sum(pairs[p] == top[p[0]] for p in links), sum(pairs[p] for p in links), digest)
                for n_a, n_b, cuts, links, digest in parts]

    return rows


def sweep(a, b):
    out, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            out.append((i, b[k][0]))
            k += 1
    return out


def result(rows):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows]


def test_the_query_gives_the_definition(spark, plain):
    src = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    short = {r["doc_id"]: r["text"] for r in src}
    got = {r.doc_id: r for r in QUERIES["op11_tokenizer_alignment"](spark, SF).collect()}
    assert len(got) == len(src)
    ids = sorted(short)
    assert result(got[i] for i in ids) == plain([short[i] for i in ids])


ODD = ["", None, "a", " a", "a ", "  two  spaces   three ", "tab\tand\nnew\n\nlines \n x", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁mark ▁▁", "naïve café déjà vu",
       "日本語のテキスト、空白なし。", "a　b c  d  e", "emoji 👩‍👩‍👧 🇫🇷 ok", "I'll won't we've 'tis 1234567 3.14", "\x00nul \x01 x\x7f y", " ", "   ", "\n", "x" * 3000,
       "the the the the", "é combining", "café ​ zero", "ÿ ÷ ×y é  z", "\r\n mixed \r line"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, slice string, links int, n_a string")


def test_odd_texts_repeats_and_clashing_columns(spark, plain):
    texts = ODD + ["the the the the", "a", None]
    rows = [(i if i % 7 else None, t, "s", 3, "n") for i, t in enumerate(texts)] + [(3, " a", "s", 3, "n")]
    got, counts = alignment.alignments(frame(spark, rows), A, B)
    want = plain(texts + [" a"])
    assert sorted(map(repr, result(got.collect()))) == sorted(map(repr, want))
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None and r.doc_id != 3}
    assert all(result([by_id[i]])[0] == want[i] for i in by_id)
    assert want[ODD.index("▁mark ▁▁")] == (0, 0, 0, 0, 0, 0, "") and min(r.docs for r in counts.collect()) >= 1


def test_very_long_texts_many_slices_and_salts(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_BYTES", 300)
    monkeypatch.setattr(alignment, "SLICES_PER_KEY", 3)
    texts = [f"word {i} of the number {i % 7} naïve" for i in range(120)] + ["long tail " * 5000]
    got, _ = alignment.alignments(frame(spark, [(i, t, "", 0, "") for i, t in enumerate(texts)]), A, B)
    got = {r.doc_id: r for r in got.collect()}
    want = plain(texts)
    assert result(got[i] for i in range(120)) == want[:120]
    assert result([got[120]])[0] == want[120]


def test_empty_table(spark):
    got, counts = alignment.alignments(frame(spark, []), A, B)
    assert got.collect() == [] and counts.collect() == []


def test_both_ways_to_cut_agree():
    texts = [t.encode() for t in ODD if t is not None and "\0" not in t] + [b"x  y z", "é ü ñ a".encode()]
    chunks, ends = alignment.all_joint_chunks(texts)
    begin = 0
    for t, end in zip(texts, ends.tolist()):
        assert chunks.to_pylist()[begin:end] == (alignment.joint_chunks(b" " + t) if t else [])
        begin = end
