import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.llm.common import fold_of
from flowlab.llm.language_id import fit as fit_language, with_language
from flowlab.llm.toxicity import fit as fit_toxicity, maximal_segments, with_toxicity

SF = "/root/testdata/sf0.01"


def brute_segments(w):
    """Maximal scoring segments by their definition: take the best of the range, recurse on both sides."""
    best = max(((sum(w[a:b]), -(b - a), -a, a, b) for a in range(len(w)) for b in range(a + 1, len(w) + 1)), default=None)
    if not best or best[0] <= 0:
        return []
    a, b = best[3:]
    return brute_segments(w[:a]) + [(best[0], a, b)] + [(s, x + b, y + b) for s, x, y in brute_segments(w[b:])]


@pytest.mark.parametrize("seed", range(30))
def test_maximal_segments_match_their_definition(seed):
    rng = np.random.default_rng(seed)
    w = rng.normal(-0.3, 1.0, 25)                # no ties
    got = [(round(s, 6), a, b) for s, a, b in maximal_segments(w)]
    assert got == [(round(s, 6), a, b) for s, a, b in brute_segments(list(w))]


def test_segments_of_nothing():
    assert maximal_segments(np.zeros(0)) == [] and maximal_segments(np.full(9, -1.0)) == []


def test_language_of_held_out_documents_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_language(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    rows = with_language(docs, model).collect()
    held = [r for r in rows if fold_of(r.doc_id, 4) == 2]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and all(0 <= r.lang_score <= 1 for r in rows)
    long = "und der die ungheit " * 50_000
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 34 !! ___", "x"), (4, long, "x"), (5, "Ω", None), (5, "Ω", None), (None, "the and", "k")],
                                "doc_id long, text string, lang_pred string")
    got = {(r.doc_id, r.text): (r.lang_pred, r.lang_score) for r in with_language(odd, model).collect()}
    assert got[1, None] == got[2, ""] == got[3, "12 34 !! ___"] == ("und", 0.0)
    assert got[4, long][0] == "de" and got[None, "the and"][0] == "en" and got[5, "Ω"][0] in model.langs
    assert with_language(docs.limit(0), model).count() == 0
    assert {r.lang_pred for r in with_language(odd, fit_language(docs.limit(0))).collect()} == {"und"}


def plain_backoff(rows, text):
    """The score by definition: mean log frequencies, words first, else their longest known n-grams."""
    import math
    import re
    from collections import Counter

    langs = sorted({lang for lang, _ in rows})
    def words(t):
        return re.findall(r"[^\W\d_]+", t.lower())
    counts = [{lang: Counter() for lang in langs} for _ in range(6)]
    for lang, t in rows:
        for w in words(t):
            counts[0][lang][w] += 1
            for n in range(1, 6):
                for i in range(len(w) + 3 - n):
                    counts[n][lang][f" {w} "[i:i + n]] += 1
    known = [set().union(*c.values()) for c in counts]

    def log(n, lang, g):
        return math.log((counts[n][lang][g] + 0.5) / (sum(counts[n][lang].values()) + 0.5 * (len(known[n]) + 1)))

    total, found = dict.fromkeys(langs, 0.0), words(text)
    for w in found:
        if w in known[0]:
            for lang in langs:
                total[lang] += log(0, lang, w)
            continue
        for n in range(5, 0, -1):
            grams = [g for i in range(len(w) + 3 - n) if (g := f" {w} "[i:i + n]) in known[n]]
            if grams:
                for lang in langs:
                    total[lang] += sum(log(n, lang, g) for g in grams) / len(grams)
                break
    if not found:
        return "und", 0.0
    top = {lang: v / math.sqrt(len(found)) for lang, v in total.items()}
    p = {lang: math.exp(v - max(top.values())) for lang, v in top.items()}
    best = max(langs, key=lambda lang: (p[lang], [-ord(c) for c in lang]))
    return best, p[best] / sum(p.values())


def test_language_scores_by_definition(spark):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    train = [(r.lang, r.text) for r in docs[:90] if r.lang and r.text]
    tables = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(train)], "doc_id long, text string, lang string")
    model = fit_language(tables)
    ask = [(r.doc_id, r.text) for r in docs[90:130]] + [(-1, "zzzz qqq"), (-2, "the der le"), (-3, ""), (-4, "Ünseen wörds hapax " * 3)]
    got = {r.doc_id: r for r in with_language(spark.createDataFrame(ask, "doc_id long, text string"), model).collect()}
    for i, t in ask:
        lang, score = plain_backoff(train, t or "")
        assert got[i].lang_pred == lang and got[i].lang_score == pytest.approx(score, abs=1e-9)
    once = [w for w, n in __import__("collections").Counter(w for _, t in train for w in t.lower().split() if w.isalpha()).items() if n == 1]
    assert once and (model.tables[0].find(once) >= 0).all()             # words seen once are kept


def test_every_language_and_class_is_sampled(spark, monkeypatch):
    from flowlab.llm.language_id import label_sample

    rows = [(i, "en", f"text {i}") for i in range(3000)] + [(i, "xx", f"rare {i}") for i in range(9000, 9012)] + [(None, "de", "same")] * 2000 + [(7, "fr", "x")] * 2000
    df = spark.createDataFrame(rows, "id long, label string, text string")
    got = [r.label for r in label_sample(df, 50).collect()]
    n = {x: got.count(x) for x in set(got)}
    assert 25 <= n.pop("en") <= 80 and n == {"xx": 12, "de": 1, "fr": 1}
    model = fit_language(spark.createDataFrame([(i, t, lang) for i, lang, t in rows], "doc_id long, text string, lang string"), label_rows=50)
    assert model.langs == ["de", "en", "fr", "xx"]


def test_mild_words_and_repeated_rows(spark):
    """Texts of many mildly toxic words, each four times as frequent as in clean texts: no single
    word is proof, all together are."""
    rng = random.Random(3)
    mild, other = [f"mild{chr(97 + i // 7)}{chr(97 + i % 7)}" for i in range(48)], [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    rows = []
    for i in range(2400):
        toxic = i % 5 == 0
        rows.append((i, " ".join(rng.choice(mild if rng.random() < (0.6 if toxic else 0.15) else other) for _ in range(rng.randint(60, 160))), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = fit_toxicity(docs, docs.where("doc_id < 1600").select("doc_id", F.col("label").alias("toxic")))
    got = {r.doc_id: r.toxicity for r in with_toxicity(docs, model).collect()}
    test = [(i, t) for i, _, t in rows if i >= 1600]
    assert np.mean([got[i] >= 0.7 for i, t in test if t]) > 0.9
    assert np.mean([got[i] >= 0.7 for i, t in test if not t]) < 0.02
    assert model.words.rows.min() < 0 and len(model.words) >= 440      # the log-odds of all words
    again = with_toxicity(docs.where("doc_id < 5").unionAll(docs.where("doc_id < 5")), model).collect()
    assert len(again) == 10 and all(r.toxicity == got[r.doc_id] for r in again)
    ties = docs.withColumn("doc_id", F.lit(1).cast("long"))               # one id for all rows: one text of it is learned from
    one = fit_toxicity(ties, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert len(one.words)


def test_scores_by_definition(spark):
    """The score of a text from the model's own weights, by plain loops."""
    import math

    model, plain, rng = planted(spark)

    def own(w):
        for table, key in ((model.words, w), (model.stems, w[:5])):
            if table.find([key])[0] >= 0:
                return float(table.rows[table.find([key])[0]])
        return 0.0

    texts = [" ".join(rng.choices(plain + ["zork", "blurgh"], k=rng.randint(1, 80))) for _ in range(40)] + ["zork vexil, grubo!", ""]
    got = {r.doc_id: r for r in with_toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        weights = []
        for chunk in text.split():
            found = [w for w in __import__("re").findall(r"[^\W\d_]+", chunk.lower())]
            weights.append(max((own(w) for w in found), default=0.0) - model.cost)
        facts = [model.decay * s - math.log(model.spread * max(len(weights), 1)) for s, _, _ in brute_segments(weights)]
        facts = sorted((e for e in facts if e > -math.log(0.05)), reverse=True)
        sums = [sum(facts[:r]) for r in range(1, len(facts) + 1)]
        best = max((t - (r - 1) * math.log(t) + math.lgamma(r + 1) + math.lgamma(r) - (r - 1) * math.log(2) for r, t in enumerate(sums, 1)), default=0.0)
        want = 1 / (1 + math.exp(-max(-50, min(50, model.bias + model.slope * best))))
        assert got[i].toxicity == pytest.approx(want, abs=1e-9)


def test_toxicity_of_planted_documents(spark):
    rng = random.Random(5)
    plain = ["".join(rng.choices("abdeghilmnorstu", k=rng.randint(2, 8))) for _ in range(1500)]
    bad = ["zork", "blurgh", "vexil", "grubo"]
    rows, labels = [], []
    for i in range(1500):
        w = rng.choices(plain, k=rng.randint(20, 200))
        toxic = rng.random() < 0.15
        if toxic:
            at = rng.randrange(len(w) - 4)
            w[at:at] = rng.choices(bad, k=rng.randint(2, 5))
        rows.append((i, " ".join(w), float(toxic)))
        if i < 1200:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity double")
    lab = spark.createDataFrame(labels + [(0, None), (None, 1), (3, labels[3][1])], "doc_id long, toxic int")
    model = fit_toxicity(docs, lab)
    got = {r.doc_id: r for r in with_toxicity(docs, model).collect()}
    test = [(i, bool(t)) for i, _, t in rows if i >= 1200]
    assert np.mean([got[i].toxicity >= 0.7 for i, t in test if t]) > 0.95
    assert np.mean([got[i].toxicity >= 0.7 for i, t in test if not t]) < 0.01
    for i, t in test:
        if got[i].toxic_passages:
            words = rows[i][1].split()
            assert any(b in words[p.begin:p.end] for p in got[i].toxic_passages for b in bad)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "zork " * 100_000), (None, "zork vexil"), (4, "!!")], "doc_id long, text string")
    scores = {r.doc_id: r.toxicity for r in with_toxicity(odd, model).collect()}
    assert scores[1] == scores[2] and scores[1] < 0.5 and scores[None] > 0.7 and all(0 <= s <= 1 for s in scores.values())
    none = fit_toxicity(docs, lab.limit(0))
    assert all(r.toxicity < 0.7 for r in with_toxicity(odd, none).collect())


def planted(spark):
    """A model of four toxic words in texts of 1,500 plain ones, and the plain ones."""
    rng = random.Random(11)
    plain = ["".join(rng.choices("abdeghilmnorstu", k=rng.randint(2, 8))) for _ in range(1500)]
    rows = []
    for i in range(1500):
        w = rng.choices(plain, k=rng.randint(20, 200))
        if i % 7 == 0:
            at = rng.randrange(len(w) - 4)
            w[at:at] = rng.choices(["zork", "blurgh", "vexil", "grubo"], k=rng.randint(2, 5))
        rows.append((i, " ".join(w), int(i % 7 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return fit_toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic")), plain, rng


def test_toxic_passages_of_words_seen_before(spark):
    model, plain, rng = planted(spark)

    def clean(n):
        return rng.choices(plain, k=n)
    bad = ["zork", "blurgh", "vexil", "grubo"]
    repeated = clean(300) + bad + clean(300) + bad + clean(300)
    scattered = sum(([b] + clean(150) for b in bad), []) + bad + clean(100)
    texts = {1: repeated, 2: scattered, 3: ["zork"] * 100_000, 4: clean(900)}
    got = {r.doc_id: r for r in with_toxicity(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string"), model).collect()}

    def covers(i, a, b):
        return any(p.begin <= a and p.end >= b for p in got[i].toxic_passages)
    assert covers(1, 300, 304) and covers(1, 604, 608) and len(got[1].toxic_passages) == 2
    assert covers(2, 604, 608)
    assert [(p.begin, p.end) for p in got[3].toxic_passages] == [(0, 100_000)]
    assert min(got[i].toxicity for i in (1, 2, 3)) > 0.7 > got[4].toxicity and not got[4].toxic_passages


def test_many_scattered_weights_take_linear_time():
    w = np.tile([1.0] + [-0.5] * 4, 200_000)
    begun = __import__("time").process_time()
    got = maximal_segments(w)
    assert len(got) == 200_000 and __import__("time").process_time() - begun < 20
