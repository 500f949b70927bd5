import random
import zlib

import numpy as np
from conftest import DATA
from pyspark.sql import functions as F

from llm import toxicity as tx
from llm.session import table


def planted(n=900, seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice(["th", "er", "on", "an", "re"]) for _ in range(rnd.randint(2, 4))) for _ in range(800)]
    rows = []
    for d in range(n):
        t = [rnd.choice(words) for _ in range(rnd.randint(3, 120))]
        toxic = int(rnd.random() < 0.2)
        if toxic:
            for _ in range(max(2, len(t) // 25)):
                t.insert(rnd.randrange(len(t)), rnd.choice(["blorg", "snarf", "gruntle" + rnd.choice(["s", "d", "r"])]))
        rows.append((d, " ".join(t), toxic))
    return rows


def test_learns_unknown_words_and_leaves_clean_texts_alone(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = tx.fit(df.select("doc_id", "text"), df.where(~tx.held_out(F.col("doc_id"))).select("doc_id", "toxic"))
    scored = tx.score_texts(df.where(tx.held_out(F.col("doc_id"))), model).collect()
    caught = [r.predicted for r in scored if r.toxic]
    clean = [r.predicted for r in scored if not r.toxic]
    assert sum(caught) >= 0.9 * len(caught) and sum(clean) <= 0.01 * len(clean)
    assert all(0 <= r.score <= 1 for r in scored)


def test_query_shape(spark):
    rows = tx.op3_toxicity(spark, DATA).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)


def test_held_out_labels_do_not_matter(spark):
    rows = planted(300, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    use = ~tx.held_out(F.col("doc_id"))
    a = tx.fit(df, df.where(use).select("doc_id", "toxic"))
    flipped = df.withColumn("toxic", F.when(use, F.col("toxic")).otherwise(1 - F.col("toxic")))
    b = tx.fit(df, flipped.where(use).select("doc_id", "toxic"))
    assert a.weights == b.weights and a.bias == b.bias


def test_label_model_finds_rates_and_discounts_repeats():
    rnd = np.random.default_rng(3)
    y = rnd.random(4000) < 0.3
    hit = lambda p, q: np.where(y, rnd.random(4000) < p, rnd.random(4000) < q)
    a = hit(0.8, 0.05)
    others = [hit(0.6, 0.05) for _ in range(5)]
    z, rates, weight = tx.label_model(np.stack([a, a, a, *others], axis=1), 0.3)
    assert ((z > 0) == y).mean() > 0.96
    assert abs(rates[1][3] - 0.6) < 0.07 and abs(rates[0][0] - 0.05) < 0.03
    assert weight[0] < 0.6 * weight[3]
    post, loss = tx.calibrated(z, y.astype(int))
    assert ((post > 0.5) == y).mean() > 0.96 and loss < 0.12


def test_posteriors_teach_as_well_as_labels(spark, monkeypatch):
    """Ablation: the classifier trained on the label model's posteriors against one trained on the labels."""
    rows = planted(1500, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    use = ~tx.held_out(F.col("doc_id"))

    def auc():
        model = tx.fit(df, df.where(use).select("doc_id", "toxic"))
        scored = [(model.score(t), y) for d, t, y in rows if zlib.crc32(str(d).encode()) % 3 == 1]
        good, bad = [s for s, y in scored if y], [s for s, y in scored if not y]
        return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))

    weak = auc()
    monkeypatch.setattr(tx, "calibrated", lambda z, gold: (gold.astype(float), 0.0))
    assert weak > 0.97 and weak > auc() - 0.02


def test_held_out_quality_on_the_table(spark):
    """At a scale of 0.01, with 33 toxic rows to learn from."""
    d = DATA.replace("0.001", "0.01")
    truth = {r.doc_id: r.toxic for r in table(spark, d, "labels").collect()}
    rows = [r for r in tx.op3_toxicity(spark, d).collect() if r.held_out and r.doc_id in truth]
    caught = [r.predicted for r in rows if truth[r.doc_id]]
    clean = [r.predicted for r in rows if not truth[r.doc_id]]
    assert sum(caught) >= 0.7 * len(caught) and sum(clean) <= 0.02 * len(clean)


def test_edges(spark):
    kind = "doc_id long, text string, score string, predicted string"
    df = spark.createDataFrame([(1, None, "a", "b"), (2, "", "a", "b"), (None, "stupid idiot", "a", "b"), (3, "word " * 50_000, "a", "b"), (3, "word " * 50_000, "a", "b")], kind)
    labels = spark.createDataFrame([(1, None), (2, 5), (None, 1)], "doc_id long, toxic int")
    model = tx.fit(df, labels)  # no usable labels: the public list decides
    got = {r.doc_id: r for r in tx.score_texts(df, model).collect()}
    assert got[1].score == got[2].score < 0.1 and got[None].predicted == 1 and got[3].predicted == 0
    assert tx.score_texts(df.limit(0), model).count() == 0
    left = tx.drop_toxic(df, model)
    assert left.columns == df.columns and sorted((r.doc_id, r.score, r.predicted) for r in left.collect()) == [(1, "a", "b"), (2, "a", "b"), (3, "a", "b"), (3, "a", "b")]
    assert tx.fit(df.limit(0), labels.limit(0)).bias == model.bias
