"""Token counts from an exact length histogram.

Documents are encoded once and only their lengths kept: a histogram with a row for each length
that occurs. Running and suffix sums over it answer totals, quantiles and truncated totals for
every context limit, exactly, however many documents there are."""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import byte_slices
from flowlab.session import cut_lineage

#: Lengths in one block of the two-step sums.
BLOCK = 1024
_ENCODINGS: dict = {}


def encoding(ranks_path: str, pattern: str):
    """The ``tiktoken`` encoding of a ranks file; one for each Python worker."""
    if ranks_path not in _ENCODINGS:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODINGS[ranks_path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[ranks_path]


def token_lengths(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row; null and empty texts have none. Strings of special tokens
    are ordinary text."""
    def run(batches):
        encode = encoding(ranks_path, pattern).encode_ordinary
        for b in batches:
            lengths = [len(encode(t.decode())) for _, _, texts in byte_slices(b.column(1)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lengths, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string")).mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs): how many documents have each length; null lengths are left out."""
    return lengths.where("n_tokens is not null").groupBy("n_tokens").agg(F.count("*").alias("docs"))


def length_report(histogram: DataFrame) -> DataFrame:
    """The histogram with its sums, one row per length L: docs_up_to and tokens_up_to (lengths up
    to L), docs_over and tokens_over (longer ones), truncated_total (tokens left if every
    document is cut to L) and share_up_to (the quantile rank of L). The histogram is written once,
    as rows and block totals read it. Sums go by blocks of lengths, so no task sees the whole
    histogram, only a row for each block."""
    h = cut_lineage(histogram).withColumn("block", F.expr(f"n_tokens div {BLOCK}")).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    per = h.groupBy("block").agg(F.sum("docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)       # a row for each block
    all_rows = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per.select(F.col("block").alias("o_block"), F.coalesce(F.sum("b_docs").over(before), F.lit(0)).alias("o_docs"),
                         F.coalesce(F.sum("b_tokens").over(before), F.lit(0)).alias("o_tokens"),
                         F.sum("b_docs").over(all_rows).alias("all_docs"), F.sum("b_tokens").over(all_rows).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    j = h.withColumn("i_docs", F.sum("docs").over(inside)).withColumn("i_tokens", F.sum("tokens").over(inside)) \
        .join(offsets, F.col("block") == F.col("o_block")) \
        .withColumn("docs_up_to", F.col("o_docs") + F.col("i_docs")).withColumn("tokens_up_to", F.col("o_tokens") + F.col("i_tokens"))
    over = F.col("all_docs") - F.col("docs_up_to")
    return j.select("n_tokens", "docs", "docs_up_to", "tokens_up_to", over.alias("docs_over"), (F.col("all_tokens") - F.col("tokens_up_to")).alias("tokens_over"),
                    (F.col("tokens_up_to") + F.col("n_tokens") * over).alias("truncated_total"), (F.col("docs_up_to") / F.col("all_docs")).alias("share_up_to"))


def truncated_totals(histogram: DataFrame, limits) -> DataFrame:
    """(max_tokens, docs_cut, truncated_total) for each of a short list of context limits."""
    n, d = F.col("n_tokens"), F.col("docs")
    one = histogram.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(f"{k}{i}") for i, limit in enumerate(limits) for k, x in (
        ("c", F.when(n > limit, d)), ("t", F.least(n, F.lit(limit).cast("long")) * d))])
    return one.select(F.explode(F.array(*[F.struct(F.lit(limit).cast("long").alias("max_tokens"), F.col(f"c{i}").alias("docs_cut"), F.col(f"t{i}").alias("truncated_total"))
                                          for i, limit in enumerate(limits)])).alias("x")).select("x.*")


def quantiles(report: DataFrame, shares) -> DataFrame:
    """(share, n_tokens): the smallest length that at least ``share`` of the documents do not exceed."""
    one = report.agg(*[F.min(F.when(F.col("share_up_to") >= q, F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(shares)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, q in enumerate(shares)])).alias("x")).select("x.*")
