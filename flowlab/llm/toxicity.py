"""Toxicity by maximum-scoring segments.

Token weights are log-odds of toxic against clean labelled texts, shrunk by a Dirichlet prior:
the prior of a word is the rate of its first letters, theirs the rate of the corpus. Every word
of the sample keeps its weight, negative ones too. A cost for each token makes the expected
weight of clean text negative, so a linear scan (all maximal scoring segments) finds the passages
that stand out. Extreme-value statistics, fitted to clean texts, say how large a segment a clean
text of that length would show by chance; the segments that chance does not explain are summed
up, and the least likely sum of the r best ones is mapped to a probability on labelled rows that
the weights were not learned from.

Fitted on a bounded sample of labelled rows (``CLASS_ROWS`` toxic and as many clean ids, by a
hash of the id, one text each); every text is scored whole, from the scan, without a shuffle."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.llm import model_store
from flowlab.llm.chunk_ids import SMALL_BYTES, ChunkTable, take_over, words_of
from flowlab.llm.common import text_slices
from flowlab.llm.model_store import HashedRows
from flowlab.session import cut_lineage

#: Labelled ids of either class expected in the sample: two thirds for the weights, one third for calibration.
CLASS_ROWS = 6_000
#: Strength of the Dirichlet prior, as a share of the texts that the weights are learned from.
PRIOR_SHARE = 0.06
#: Letters of a word's beginning that serve as its prior.
STEM = 5
#: Cost of every token, and how far below zero clean tokens must weigh on average.
TOKEN_COST, DRIFT = 0.5, 0.25
#: Segments with an expected number by chance below this are significant.
EXPECTED_BY_CHANCE = 0.05
#: Those that are shown as passages are expected less often.
SHOWN_BY_CHANCE = 0.001
_LETTERS = re.compile(r"[^\W\d_]+")


def _words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _count(batches):
    take_over()
    for b in batches:
        by = (Counter(), Counter())
        for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            by[toxic].update(set(_words(text)))          # texts, not tokens: one text's repetitions prove nothing
        keys = sorted(by[0].keys() | by[1].keys())
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([by[1][k] for k in keys], pa.int64()), pa.array([by[0][k] for k in keys], pa.int64())],
                                             names=["word", "toxic", "clean"])


def maximal_segments(weights: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last + 1) in one pass: every positive token
    starts as a segment and joins the nearest earlier one that begins lower and ends lower."""
    after = np.cumsum(weights)
    out: list[tuple[float, float, int, int, int]] = []          # (sum before, sum after, first, end, nearest earlier one that begins lower)
    for k in np.flatnonzero(weights > 0).tolist():
        left, right, first, j = float(after[k] - weights[k]), float(after[k]), k, len(out) - 1
        while True:
            while j >= 0 and out[j][0] >= left:
                j = out[j][4]                                   # those between begin no lower: the pass stays linear
            if j < 0 or out[j][1] >= right:
                break
            left, first, below = out[j][0], out[j][2], out[j][4]
            del out[j:]
            j = below
        out.append((left, right, first, k + 1, j))
    return [(r - l, a, b) for l, r, a, b, _ in out]


@dataclass
class ToxicityModel:
    words: HashedRows           # a weight for each word of the sample
    stems: HashedRows           # and for each beginning, for other words
    cost: float = TOKEN_COST
    decay: float = 1.0          # lambda of the extreme-value law of segment scores
    spread: float = 1.0         # its K
    bias: float = -3.0
    slope: float = 1.0

    def weights(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        at = self.words.find(words)
        known = at >= 0
        out[known] = self.words.rows[at[known]]
        other = np.flatnonzero(~known)
        at = self.stems.find([words[i][:STEM] for i in other.tolist()])
        out[other[at >= 0]] = self.stems.rows[at[at >= 0]]
        return out

    def chunks(self, chunks: list[bytes]) -> np.ndarray:
        """A chunk weighs as its weightiest word."""
        found = [_words(c.decode()) for c in chunks]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        out, some = np.zeros(len(chunks)), np.flatnonzero(sizes)
        if len(some):
            flat = self.weights([w for ws in found for w in ws])
            out[some] = np.maximum.reduceat(flat, (np.cumsum(sizes) - sizes)[some])
        return (out - self.cost)[:, None]

    def evidence(self, scores, n: int) -> np.ndarray:
        """For each segment score minus the log of the number expected by chance in ``n`` tokens."""
        return self.decay * np.asarray(scores, float) - np.log(self.spread * max(n, 1))

    def total(self, evidence: np.ndarray) -> float:
        """Over the segments that chance shows less than once in twenty texts: minus the log of the
        chance of the least likely sum of the r best, exp(-T) T^(r-1) / (r! (r-1)!) for a sum T,
        with a half for each further r."""
        t = np.sort(evidence[evidence > -np.log(EXPECTED_BY_CHANCE)])[::-1].cumsum()
        if not len(t):
            return 0.0
        r = np.arange(1, len(t) + 1)
        logs = np.log(r).cumsum()                                # of r!
        return float((t - (r - 1) * np.log(t) + 2 * logs - np.log(r) - (r - 1) * np.log(2)).max())

    def probability(self, total: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.slope * total, -50, 50))))


def _weights(counts, toxic_tokens: int, clean_tokens: int, prior_texts: float) -> tuple[HashedRows, HashedRows]:
    """``counts``: (word, toxic texts, clean texts) -> log-odds of all words, and of all beginnings
    for the words that are not among them."""
    rate = (toxic_tokens + 1) / (toxic_tokens + clean_tokens + 2)

    def odds(r):
        return float(np.log(r / (1 - r)) - np.log(rate / (1 - rate)))

    stems: dict[str, list] = {}
    for w, t, c in counts:
        s = stems.setdefault(w[:STEM], [0, 0])
        s[0] += t
        s[1] += c
    shrunk = {s: (t + prior_texts * rate) / (t + c + prior_texts) for s, (t, c) in stems.items()}
    words = {}
    for w, t, c in counts:
        prior = shrunk[w[:STEM]] if len(w) > STEM else rate
        words[w] = odds((t + prior_texts * prior) / (t + c + prior_texts))
    whole = [s for s in shrunk if len(s) == STEM]
    return HashedRows(list(words), np.array(list(words.values()))), HashedRows(whole, np.array([odds(shrunk[s]) for s in whole]))


def _extreme_value_law(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Lambda and K of clean texts with the best segment scores ``best`` and ``n`` tokens, by
    maximum likelihood: P(best <= s) = exp(-K n exp(-lambda s))."""
    def fitted(decay):
        spread = len(best) / float((n * np.exp(-decay * best)).sum())
        return float((np.log(decay * spread * n) - decay * best - spread * n * np.exp(-decay * best)).sum()), decay, spread

    return max(fitted(d) for d in np.exp(np.linspace(-4, 3, 300)))[1:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope (not negative) by Newton steps with a weak prior; a step that does not raise
    the likelihood is halved, as a bare Newton step may overshoot where all is nearly certain."""
    def gain(t):
        z = t[0] + t[1] * x
        return float((y * z - np.logaddexp(0, z)).sum() - 5e-3 * (t[0] ** 2 + t[1] ** 2))

    t = np.array([np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(t[0] + t[1] * x, -500, 500)))
        w = p * (1 - p)
        gb, ga = (y - p).sum() - 1e-2 * t[0], ((y - p) * x).sum() - 1e-2 * t[1]
        hbb, hab, haa = w.sum() + 1e-2, (w * x).sum(), (w * x * x).sum() + 1e-2
        det = hbb * haa - hab * hab
        step, now = np.array([haa * gb - hab * ga, hbb * ga - hab * gb]) / det, gain(t)
        while gain(t + step) < now and np.abs(step).max() > 1e-9:
            step /= 2
        t = t + step
        if np.abs(step).max() < 1e-8:
            break
    return float(t[0]), float(max(t[1], 0.0))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, class_rows: int) -> DataFrame:
    """(__id, __toxic, __text) of about ``class_rows`` labelled ids of either class, or all of them."""
    known = labels.where(labels[label_col].isin(0, 1) & labels[id_col].isNotNull()) \
        .groupBy(labels[id_col].cast("long").alias("__id")).agg(F.max(labels[label_col].cast("int")).alias("__toxic"))
    texts = docs.where(docs[text_col].isNotNull()).select(docs[id_col].cast("long").alias("__id"), docs[text_col].cast("string").alias("__text"))
    known = known.join(texts.select("__id").distinct(), "__id", "left_semi")                # a label may have no text here
    share = {r["__toxic"]: min(1.0, class_rows / r["count"]) for r in known.groupBy("__toxic").count().collect()}
    drawn = F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1 << 32)) / float(1 << 32)
    sample = known.where(drawn < F.when(F.col("__toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    # an id may come with very many rows: one text of each
    return texts.join(F.broadcast(sample), "__id").groupBy("__id", "__toxic") \
        .agg(F.min_by("__text", F.struct(F.xxhash64("__text"), "__text")).alias("__text"))      # about 2 * class_rows narrow rows are broadcast


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        class_rows: int = CLASS_ROWS) -> ToxicityModel:
    """Fit on the rows of ``docs`` that ``labels`` (id, 0 or 1) covers. Labels of repeated ids
    count once (the larger), as do the rows of one id; null labels, ids and texts are left out.
    The driver gets the words of the sample and its calibration rows, both bounded by it."""
    spark = docs.sparkSession
    rows = cut_lineage(_sample(docs, labels, id_col, text_col, label_col, class_rows))
    part = F.pmod(F.xxhash64("__id", F.lit("part")), F.lit(3))
    learn = rows.where(part != 0)
    counts = learn.select("__toxic", "__text").mapInArrow(_count, "word string, toxic long, clean long") \
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    counts = list(zip(*(c.to_pylist() for c in counts.columns)))
    model = ToxicityModel(*_weights(counts, sum(t for _, t, _ in counts), sum(c for _, _, c in counts), max(1.0, PRIOR_SHARE * learn.count())))

    def scan(segments: bool):
        """(toxic, tokens, their weight, segment scores) of the other rows."""
        place = model_store.put(spark, "toxicity", model)

        def run(batches):
            table = ChunkTable(model_store.get(place).chunks, 1, SMALL_BYTES)
            for b in batches:
                out = []
                for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    w = table([text.encode().split()])[0][:, 0]
                    out.append((toxic, len(w), float(w.sum()), [s for s, _, _ in maximal_segments(w)] if segments else []))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64())))],
                                                 names=["toxic", "n", "weight", "segments"])

        return rows.where(part == 0).select("__toxic", "__text").mapInArrow(run, "toxic int, n int, weight double, segments array<double>").collect()

    clean = [r for r in scan(False) if not r.toxic]
    if clean:
        mean = sum(r.weight for r in clean) / max(sum(r.n for r in clean), 1)
        model.cost += max(0.0, mean + DRIFT)
    got = scan(True)
    if not got:
        return model
    clean = [(max(r.segments, default=0.0), max(r.n, 1)) for r in got if not r.toxic]
    if clean:
        model.decay, model.spread = _extreme_value_law(*(np.array(c, float) for c in zip(*clean)))
    x = np.array([model.total(model.evidence(r.segments, r.n)) for r in got])
    model.bias, model.slope = _logistic(x, np.array([r.toxic for r in got], float))
    return model


def with_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_out: str = "toxicity",
                  passages_out: str = "toxic_passages") -> DataFrame:
    """``docs`` with the probability of being toxic and the significant passages (begin, end in
    white-space separated tokens, evidence) behind their columns; no shuffle. Null and empty
    texts have no passage and the score of that; repeated rows are scored alike. A column that has the name of an output is
    replaced. Empty in, empty out."""
    docs = docs.drop(score_out, passages_out)
    place = model_store.put(docs.sparkSession, "toxicity", model)
    passage = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("evidence", T.DoubleType())]))
    schema = T.StructType(docs.schema.fields + [T.StructField(score_out, T.DoubleType()), T.StructField(passages_out, passage)])
    at = docs.columns.index(text_col)
    arrow = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))

    def run(batches):
        m = model_store.get(place)
        table = ChunkTable(m.chunks, 1, SMALL_BYTES)
        for b in batches:
            for lo, hi, texts in text_slices(b.column(at)):
                rows, ends = table.of(*words_of(texts))
                scores, passages, begin = [], [], 0
                for end in ends.tolist():
                    w, begin = rows[begin:end, 0], end
                    segments = maximal_segments(w) if (w > 0).any() else []
                    evidence = m.evidence([s for s, _, _ in segments], len(w))
                    scores.append(m.probability(m.total(evidence)))
                    passages.append([{"begin": a, "end": z, "evidence": float(e)} for (_, a, z), e in zip(segments, evidence) if e > -np.log(SHOWN_BY_CHANCE)])
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64()), pa.array(passages, arrow)], names=[*b.schema.names, score_out, passages_out])

    return docs.mapInArrow(run, schema)
