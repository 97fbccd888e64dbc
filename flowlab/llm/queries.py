"""The registered queries of this subpackage: each applies its operator, with production
parameters, to its whole table; ``ORACLES`` holds DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.llm.common import documents, fold

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return deco


@_query(r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)""")
def op5_exact_dedup(spark, sf_dir):
    from flowlab.llm.exact_dedup import exact_dedup

    return exact_dedup(documents(spark, sf_dir))


@_query()
def op1_simhash(spark, sf_dir):
    from flowlab.llm.simhash import simhash_components

    return simhash_components(documents(spark, sf_dir), shingle_words=3, max_distance=3)


@_query()
def op6_packing(spark, sf_dir):
    import public_tokenizers

    from flowlab.llm.packing import pack

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2, sequence=4096)


@_query()
def op8_language_id(spark, sf_dir):
    from flowlab.llm.language_id import fit, with_language

    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held_out))
    return with_language(docs.select("doc_id", "text", held_out.alias("held_out")), model) \
        .select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@_query()
def op3_toxicity(spark, sf_dir):
    from flowlab.llm.toxicity import fit, with_toxicity

    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 3) == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    model = fit(docs.where(~held_out), labels)
    return with_toxicity(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
        F.size("toxic_passages").alias("passages"))


@_query()
def op7_lm_score(spark, sf_dir):
    from flowlab.llm.ngram_lm import fit, score

    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 7) == 2
    scored = score(docs, fit(docs.where(~held_out), order=3, min_count=1))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _tree_sql(text: str) -> str:
    def cut(x, after):
        return rf"string_split(regexp_replace({x}, '({after})', '\1' || chr(1), 'g'), chr(1))"
    return (f"list_transform({cut(text, chr(92) + 'n{2,}')}, lambda s: list_transform({cut('s', chr(92) + 'n+')}, lambda p: list_transform(list_filter(flatten("
            f"list_transform({cut('p', '[.!?]+ +')}, lambda q: {cut('q', '(?:[^ ]+ +){5}')})), lambda x: x <> ''), lambda x: md5(x))))")


def _fingerprint_sql(text: str, nodes: str) -> str:
    def join(x, sep):
        return f"coalesce(array_to_string({x}, '{sep}'), '')"

    def digest(x):
        return f"md5({join(x, '')})"
    paragraph = f"substr({digest('p')}, 1, 16) || '[' || {join('list_transform(p, lambda x: substr(x, 1, 8))', '.')} || ']'"
    pars = f"list_transform(s, lambda p: {digest('p')})"
    shown = f"list_transform(s, lambda p: {paragraph})"
    section = f"substr({digest(pars)}, 1, 16) || '(' || {join(shown, ',')} || ')'"
    secs = f"list_transform({nodes}, lambda s: {digest(pars)})"
    shown_secs = f"list_transform({nodes}, lambda s: {section})"
    return f"md5(md5({text}) || {join(secs, '')}) || ':' || {join(shown_secs, '/')}"


def _likeness_sql(a: str, b: str) -> str:
    la, lb = (f"list_distinct(list_transform(flatten(flatten({t})), lambda x: substr(x, 1, 8)))" for t in (a, b))
    return f"CASE WHEN greatest(len({la}), len({lb})) = 0 THEN 1.0 ELSE len(list_intersect({la}, {lb})) / greatest(len({la}), len({lb})) END"


# the paragraphs (section i, paragraph j, from 1) at which the trees a and b differ
_BRANCHES_SQL = ("flatten(list_transform(list_filter(range(1, greatest(len(a), len(b)) + 1), lambda i: a[i] IS DISTINCT FROM b[i]), lambda i: "
                 "list_transform(list_filter(range(1, greatest(coalesce(len(a[i]), 1), coalesce(len(b[i]), 1)) + 1), lambda j: a[i][j] IS DISTINCT FROM b[i][j]), "
                 "lambda j: struct_pack(i := i, j := j))))")


@_query(f"""
WITH o AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS n_t
           FROM documents WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT doc_id, t, n_t, length(t) AS n_chars, substr(t, 1, length(t) - length(t) // 2) || substr(n_t, 1, length(t) // 2) AS e FROM o),
k AS (SELECT *, {_tree_sql('t')} AS a, {_tree_sql('e')} AS b, {_tree_sql('n_t')} AS c FROM e)
SELECT doc_id, n_chars, sha256(e) AS edited_sha256, {_fingerprint_sql('t', 'a')} AS fingerprint, {_fingerprint_sql('e', 'b')} AS edited_fingerprint,
       {_likeness_sql('a', 'b')} AS near_edited, {_likeness_sql('a', 'c')} AS near_next, len({_BRANCHES_SQL}) AS branches_edited,
       coalesce(({_BRANCHES_SQL})[1].i - 1, -1) AS first_section, coalesce(({_BRANCHES_SQL})[1].j - 1, -1) AS first_paragraph FROM k""")
def op10_document_fingerprints(spark, sf_dir):
    from flowlab.llm.merkle import edit_report

    return edit_report(documents(spark, sf_dir))


@_query(r"""
WITH c AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn) AS l FROM conversations GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, count(*) AS copies, l FROM c GROUP BY l)
SELECT conv_id, len(l) AS turns, copies,
       array_to_string(list_transform(l, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)), '') AS rendered
FROM u a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.l[1] = a.l[1] AND len(b.l) > len(a.l) AND b.l[1:len(a.l)] = a.l)""")
def op4_chat_format(spark, sf_dir):
    from flowlab.llm.chat import render_chats

    return render_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@_query()
def op9_token_counts(spark, sf_dir):
    import public_tokenizers

    from flowlab.llm.token_counts import length_histogram, length_report, token_lengths

    lengths = token_lengths(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return length_report(length_histogram(lengths))


@_query()
def op2_sentence_pieces(spark, sf_dir):
    import public_tokenizers

    from flowlab.llm.sentence_pieces import round_trip

    coded = round_trip(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), kind="bpe")
    return coded.select("doc_id", F.size("ids").alias("n_tokens"), "ids", "decoded_sha256", "same_text")


@_query()
def op13_embedding_whitening(spark, sf_dir):
    from flowlab.llm.whitening import fit, whiten

    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    white = whiten(embeddings, fit(embeddings, components=16))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


@_query()
def op11_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers

    from flowlab.llm.alignment import alignments

    return alignments(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]


@_query()
def op12_repeated_spans(spark, sf_dir):
    from flowlab.llm.repeated_spans import remove_repeats

    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(documents(spark, sf_dir), length=100).select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")
