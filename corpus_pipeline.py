"""A corpus pipeline over ``documents``: language ID, toxicity, exact dedup, SimHash near-dedup,
packing. Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all
but the last return the columns of ``documents``.

Nulls: a null text has no language and goes with the first stage; a null id can't be a label's
and never names a group of copies; null lang and source are kept as they are. Tied ids and
repeated rows stay together until the text decides. Empty tables give empty results. Columns
that ``docs`` has besides those of ``documents`` stay untouched, whatever their names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowlab.llm import exact_dedup, language_id, packing, simhash, toxicity
from flowlab.llm.common import documents
from flowlab.llm.model_store import new_folder

#: A document goes if the best language's score is lower.
LEAST_LANGUAGE_SCORE = 0.5
#: A document goes if its toxicity is at least this.
TOXIC = 0.7
#: Columns the stages add for their decisions and drop again.
_LANG, _SCORE, _TOXICITY, _PASSAGES = "__pipeline_lang", "__pipeline_lang_score", "__pipeline_toxicity", "__pipeline_passages"


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled languages of its input; texts without a letter, and texts between
    languages, go."""
    scored = language_id.with_language(docs, language_id.fit(docs), lang_out=_LANG, score_out=_SCORE)
    kept = (scored[_LANG] != language_id.UNDETERMINED) & (scored[_SCORE] >= LEAST_LANGUAGE_SCORE)
    return scored.where(kept).select(*[f"`{c}`" for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the rows of ``labels`` that its input still holds."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_toxicity(docs, model, score_out=_TOXICITY, passages_out=_PASSAGES)
    return scored.where(scored[_TOXICITY] < TOXIC).select(*[f"`{c}`" for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs, shingle_words=3, max_distance=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, sequence=4096)


STAGES = [
    ("language_id", keep_known_language),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("packing", pack),
]

#: Fitted models and tokenizers have no SQL twin: the pipeline is tested against its operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage kept is written to the shared folder and read
    again, so a lost executor costs at most one stage's tasks."""
    folder, docs = new_folder(spark, "pipeline"), documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
