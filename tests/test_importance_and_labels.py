"""FRD13 by permutation, IMG2 over blocks, file names of SRC5 and runs of SRC11."""

import random

import pytest
from pyspark.sql import functions as F

from flowlab.operators import fraud as fr
from flowlab.operators import labels as lb
from flowlab.sources import readers as rd


def card_events(spark, unit=1.0, n=1500):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        amt, fraud = rng.uniform(1, 100), rng.random()
        label = "fraud" if amt + rng.gauss(0, 15) > 75 else "legit"
        rows.append((f"t{i}", amt * unit, rng.uniform(0, 1), rng.choice(["a", "b"]), label if i % 50 else None, fraud))
    return spark.createDataFrame(rows, "trans_num string, amt double, lat double, category string, EVENT_LABEL string, other double")


SPEC = [v for v in fr.CARD_VARIABLES if v.name in ("trans_num", "amt", "category")]


def importance(spark, unit):
    ev = card_events(spark, unit)
    model = fr.train_fraud_model(ev, SPEC, buckets=16, max_iter=30)
    return model, ev, {r.variable: (r.auc, r.importance) for r in fr.variable_importance(model, ev, SPEC).collect()}


def test_importance_does_not_depend_on_units(spark):
    model, ev, a = importance(spark, 1.0)
    _, _, b = importance(spark, 1000.0)
    assert set(a) == set(b) == {"amt", "category"}
    assert a["amt"][1] > 0.3 and abs(a["category"][1]) < 0.02        # the one counts, the other is of no use
    assert all(abs(a[v][1] - b[v][1]) < 0.01 for v in a)
    # by hand: the same permutation, the same scores, AUC over all pairs
    names = ["amt", "category"]
    rows = fr.permuted_variants(ev.where("EVENT_LABEL is not null").select("trans_num", "EVENT_LABEL", *names), names, "trans_num")
    got = fr.insight_score(model.transform(rows), "probability").collect()
    base = {r.trans_num: r for r in got if r["__variant"] == 0}
    for i, name in enumerate(names, 1):
        mine = [r for r in got if r["__variant"] == i]
        assert sorted(r[name] for r in mine) == sorted(r[name] for r in base.values()) and len(mine) == len(base)
        other = "category" if name == "amt" else "amt"
        assert all(r[other] == base[r.trans_num][other] for r in mine)
        assert sum(r[name] != base[r.trans_num][name] for r in mine) > 0.4 * len(mine)
        pos, neg = ([r.fraud_model_insightscore for r in mine if (r.EVENT_LABEL == "fraud") == y] for y in (True, False))
        auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg)
        assert abs(a[name][0] - auc) < 1e-9


def test_variables_are_hashed_before_the_variants_are_made(spark):
    """Scores equal those of the whole model over all variants; hashing sees each event twice, not once a variant."""
    ev = card_events(spark, n=200)
    model = fr.train_fraud_model(ev, SPEC, buckets=16, max_iter=3)
    rows, names = ev.where("EVENT_LABEL is not null").select("trans_num", "EVENT_LABEL", "amt", "category"), ["amt", "category"]
    got = fr.scored_variants(model, rows, names, "trans_num")
    want = model.transform(fr.permuted_variants(rows, names, "trans_num"))

    def collected(df):
        return sorted((r["__variant"], r.trans_num, r.amt, r.category, r.features.toArray().tolist(), r.probability.toArray().tolist()) for r in df.collect())

    assert collected(got) == collected(want) and got.count() == 3 * rows.count()
    plan = fr.insight_score(got, "probability").select("__variant", "fraud_model_insightscore")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    variants = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    hashing = [i for i, line in enumerate(plan) if "UDF(struct(category" in line]
    assert hashing and min(hashing) > variants


def test_importance_of_one_and_no_event(spark):
    ev = card_events(spark)
    model = fr.train_fraud_model(ev, SPEC, buckets=16, max_iter=3)
    assert [r.importance for r in fr.variable_importance(model, ev.limit(1), SPEC).collect()] in ([None, None], [])
    assert fr.variable_importance(model, ev.limit(0), SPEC).collect() == []


@pytest.mark.parametrize("confidence", [0.0, 10.0, 60.0])
def test_blocks_of_labels_give_the_same_rows(spark, confidence):
    rng = random.Random(8)
    vec = spark.createDataFrame([(i if i % 9 else 5, i % 7, [rng.gauss(i % 7, 1.0) for _ in range(4)]) for i in range(120)], "vec_id long, label int, embedding array<float>")
    model = lb.train_labels(vec)

    def rows(block):
        out = lb.detect_labels(model, vec, confidence, temperature=0.5, block_labels=block).collect()
        return sorted((r.vec_id, r.label, [(x.Name, round(x.Confidence, 9)) for x in r.CustomLabels]) for r in out)

    one = rows(None)
    assert len(one) == 120 and one == rows(1) == rows(3) == rows(7)
    if confidence == 0.0:
        assert all(len(x) == 7 and abs(sum(c for _, c in x) - 100) < 1e-6 for *_, x in one)


def test_a_large_model_is_scored(spark, monkeypatch):
    monkeypatch.setattr(lb, "MODEL_NUMBERS", 6)                       # two labels of three dimensions
    vec = spark.createDataFrame([(i, i % 5, [float(i % 5), 0.0, 1.0]) for i in range(20)], "vec_id long, label int, embedding array<double>")
    got = lb.detect_labels(lb.train_labels(vec), vec, 50.0).collect()
    assert all([x.Name for x in r.CustomLabels] == [r.label] for r in got) and len(got) == 20


def test_unexpected_file_names_fail_the_read(spark, tmp_path):
    for name in ("daily_manning.csv", "daily_other.csv"):
        (tmp_path / name).write_text("a,b\n1,2\n")
    read = lambda **kw: rd.read_csv_matching(spark, str(tmp_path), "a int, b int", ".csv", r"_manning\.csv$", **kw)
    with pytest.raises(Exception, match="daily_other.csv"):
        read().collect()
    assert read(others="skip").count() == 1
    (tmp_path / "daily_other.csv").rename(tmp_path / "daily_other.txt")
    assert [tuple(r) for r in read().collect()] == [(1, 2)]


def test_the_newest_run_is_read_whole(spark, tmp_path):
    df = spark.range(40).select(F.col("id").cast("int").alias("x"))
    for run, add in (("one", 0), ("two", 100)):
        df.select((F.col("x") + add).alias("x")).repartition(4).write.option("header", True).csv(str(tmp_path / run))
    got = rd.latest_output(spark, str(tmp_path), "csv", "x int", whole_run=True, header="true", recursiveFileLookup="true")
    assert sorted(r.x for r in got.collect()) == list(range(100, 140))
