"""Language identification, words first: a known word scores by its log frequency in each
language; an unseen one falls back to the longest of its character n-grams that are known.

The model is fitted on a bounded sample of the labelled rows (about ``LABEL_ROWS`` different ones
of each language, by a hash of id and text), so its size has a bound too; every text is scored whole, from the scan,
without a shuffle."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm import model_store
from flowlab.llm.chunk_ids import SMALL_BYTES, ChunkTable, sums, take_over, words_of
from flowlab.llm.common import text_slices
from flowlab.llm.model_store import HashedRows

#: Different labelled rows of each language expected in the sample that the model is fitted on.
LABEL_ROWS = 1000
#: Longest character n-gram.
NGRAM = 5
#: Added to every count.
SMOOTHING = 0.5
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def label_sample(rows: DataFrame, label_rows: int) -> DataFrame:
    """Of rows (id, label, text) with a label and a text: about ``label_rows`` different ones of each
    label, drawn by a hash of id and text; all of them if there are fewer. What is drawn of a label
    is one row for each label, as the model has a column for each, and so broadcast."""
    hashed = rows.withColumn("__hash", F.xxhash64("id", "text", F.lit("sample")))
    share = hashed.groupBy(F.col("label").alias("__label")).agg((label_rows / F.approx_count_distinct("__hash")).alias("__share"))
    drawn = F.pmod(F.col("__hash"), F.lit(1 << 32)) / float(1 << 32)
    return hashed.join(F.broadcast(share), (F.col("label") == F.col("__label")) & (drawn < F.col("__share"))) \
        .groupBy("label", "__hash").agg(F.first("text").alias("text")).select("label", "text")


def _words(text: str) -> list[str]:
    return [w for w in _LETTERS.findall(text.lower()) if any(c.isalpha() for c in w)]


def _grams(word: str, n: int) -> list[str]:
    w = f" {word} "
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _count(batches):
    """(lang, size, gram, n): size 0 for words, else the length of the n-gram; one length of one
    language after the other, so a task holds no more than the words and one list of n-grams."""
    take_over()
    for b in batches:
        counts = defaultdict(Counter)
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts[lang].update(_words(text))
        for lang, words in counts.items():
            for size in range(NGRAM + 1):
                found = words
                if size:
                    found = Counter()
                    for w, n in words.items():
                        for g in _grams(w, size):
                            found[g] += n
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array([size] * len(found), pa.int32()), pa.array(list(found), pa.string()),
                                                      pa.array(list(found.values()), pa.int64())], names=["lang", "size", "gram", "n"])


class LanguageModel:
    """Log frequencies of words and n-grams by language."""

    def __init__(self, rows):
        """``rows``: (lang, size, gram, n)."""
        self.langs = sorted({r[0] for r in rows})
        at = {lang: i for i, lang in enumerate(self.langs)}
        # tables of log frequencies: of words, then of the n-grams of each length
        self.tables = []
        for size in range(NGRAM + 1):
            own = [(lang, gram, n) for lang, s, gram, n in rows if s == size]
            index = {k: i for i, k in enumerate(sorted({gram for _, gram, _ in own}))}
            m = np.zeros((len(index), len(self.langs)))
            for lang, gram, n in own:
                m[index[gram], at[lang]] += n
            self.tables.append(HashedRows(list(index), np.log((m + SMOOTHING) / (m.sum(axis=0) + SMOOTHING * (len(index) + 1)))))

    def evidence(self, words: list[str]) -> np.ndarray:
        """Scores of words by language: of a known word its own, else the mean of the longest of its
        n-grams that are known, else zero."""
        out = np.zeros((len(words), len(self.langs)))
        at = self.tables[0].find(words)
        known = np.flatnonzero(at >= 0)
        out[known] = self.tables[0].rows[at[known]]
        left = np.flatnonzero(at < 0).tolist()
        for size in range(NGRAM, 0, -1):
            grams, owner = [], []
            for i in left:
                own = _grams(words[i], size)
                grams += own
                owner += [i] * len(own)
            if not grams:
                continue
            at, owner = self.tables[size].find(grams), np.array(owner)
            hit = at >= 0
            n = np.bincount(owner[hit], minlength=len(words))
            np.add.at(out, owner[hit], self.tables[size].rows[at[hit]] / n[owner[hit], None])
            left = [i for i in left if not n[i]]
        return out

    def chunks(self, chunks: list[bytes]) -> np.ndarray:
        """For each chunk: the words' scores by language, then the number of words."""
        out = np.zeros((len(chunks), len(self.langs) + 1))
        words, owner = [], []
        for i, c in enumerate(chunks):
            for w in _words(c.decode()):
                words.append(w)
                owner.append(i)
        if words:
            owner = np.array(owner)
            np.add.at(out[:, :-1], owner, self.evidence(words))
            out[:, -1] = np.bincount(owner, minlength=len(chunks))
        return out

    def predict(self, totals: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score from the sums of :meth:`chunks`. The score is the posterior with the
        evidence of n words weighing as that of its square root, since words are not independent."""
        n = totals[:, -1]
        if not self.langs:
            return [UNDETERMINED] * len(n), np.zeros(len(n))
        logs = totals[:, :-1] / np.sqrt(np.maximum(n, 1))[:, None]
        p = np.exp(logs - logs.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return [self.langs[k] if m else UNDETERMINED for k, m in zip(best, n)], np.where(n > 0, p[np.arange(len(n)), best], 0.0)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        label_rows: int = LABEL_ROWS) -> LanguageModel:
    """Fit on rows with a text and a language. What comes to the driver is bounded by the sample."""
    rows = labelled.where(labelled[lang_col].isNotNull() & labelled[text_col].isNotNull()) \
        .select(labelled[id_col].alias("id"), labelled[lang_col].cast("string").alias("label"), labelled[text_col].cast("string").alias("text"))
    counts = label_sample(rows, label_rows).mapInArrow(_count, "lang string, size int, gram string, n long") \
        .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    return LanguageModel(list(zip(*(c.to_pylist() for c in counts.toArrow().columns))))


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text",
                  lang_out: str = "lang_pred", score_out: str = "lang_score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1) behind their columns, from the
    scan, without a shuffle. Null texts and texts without a letter: 'und', score 0. Equal scores
    go to the first language in alphabetical order. A column that has the name of an output is
    replaced. Repeated rows are scored alike; empty in, empty out."""
    from pyspark.sql import types as T

    docs = docs.drop(lang_out, score_out)
    place = model_store.put(docs.sparkSession, "languages", model)
    schema = T.StructType(docs.schema.fields + [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches):
        m = model_store.get(place)
        table = ChunkTable(m.chunks, len(m.langs) + 1, SMALL_BYTES)
        for b in batches:
            for lo, hi, texts in text_slices(b.column(at)):
                langs, scores = m.predict(sums(*table.of(*words_of(texts))))
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 names=[*b.schema.names, lang_out, score_out])

    return docs.mapInArrow(run, schema)
