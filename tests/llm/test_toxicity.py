import random

import numpy as np
from pyspark.sql import functions as F

from riskframe.llm import toxicity

from helpers import empty_docs, odd_docs, prose


def rows_of(texts):
    doc, bucket, x = toxicity.terms(texts)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [(bucket[s:e], x[s:e]) for s, e in zip(cut, cut[1:])]


def auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_margin_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = toxicity.FactorizationMachine(0.3, rng.normal(size=8), rng.normal(size=(8, 3)))
    bucket, x = np.array([1, 4, 6]), np.array([0.5, 2.0, -1.0])
    want = 0.3 + (m.weight[bucket] * x).sum() + sum(
        m.factor[bucket[i]] @ m.factor[bucket[j]] * x[i] * x[j]
        for i in range(3) for j in range(i))
    assert np.isclose(m.margin(np.zeros(3, int), bucket, x, 1)[0], want)


def test_learns_an_interaction_that_weights_alone_miss():
    rng = random.Random(3)
    texts, y = [], []
    for i in range(1600):  # toxic if and only if both marks meet
        a, b = i % 2, (i // 2) % 2
        words = ["insult"] * a + ["group"] * b + [rng.choice("pqrs") * 3]
        rng.shuffle(words)
        texts.append(" ".join(words))
        y.append(a * b)
    y = np.array(y, float)
    m = toxicity.fit(rows_of(texts), y, factors=4, steps=1500, rate=0.5, l2=0)
    p = m.score(["insult group ppp", "insult ppp", "group ppp", "ppp"])
    assert p[0] > 0.7 > 0.4 > max(p[1:])
    doc, bucket, x = toxicity.terms(["insult group"])
    pair = m.factor[bucket].astype(float)
    assert (pair.sum(0) ** 2).sum() > 0  # the factors carry weight


def meetings(n, seed):
    """Long texts and labels: 1 where exactly one of two marks stands."""
    rng = random.Random(seed)
    texts, y = [], []
    for i in range(n):
        a, b = i % 2, (i // 2) % 2
        words = [f"w{rng.randrange(3000)}x" for _ in range(150)]
        words += ["insult"] * 4 * a + ["group"] * 4 * b
        rng.shuffle(words)
        texts.append(" ".join(words))
        y.append(a ^ b)
    return texts, np.array(y, float)


def test_defaults_learn_an_interaction_in_long_texts():
    texts, y = meetings(3000, 1)
    new, want = meetings(800, 2)
    rows = rows_of(texts)
    assert np.median([len(r[0]) for r in rows]) > 200
    quality = {k: auc(want, toxicity.fit(rows, y, **k_args).score(new))
               for k, k_args in (("pairs", {}), ("weights", {"factors": 0}))}
    assert quality["pairs"] > 0.95 and quality["weights"] < 0.6


def test_terms_that_the_fit_never_saw_have_no_factors():
    texts, y = meetings(200, 1)
    m = toxicity.fit(rows_of(texts), y)
    _, bucket, _ = toxicity.terms(["qqqqzz vvvvkk"])
    assert (m.factor[bucket] == 0).all() and (m.weight[bucket] == 0).all()


def test_held_out_quality_and_odd_rows(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        bad = rng.random() < 0.3
        words = prose(i, rng.randint(20, 60)).split()
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["scumzz", "idiotzz", "trashzz"]))
        rows.append((i, " ".join(words), int(bad)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    docs, labels = df.select("doc_id", "text"), df.select("doc_id", "toxic")
    model = toxicity.fit_on(docs, labels.filter(~toxicity.held_out()))
    got = toxicity.score(df, model, ["doc_id", "toxic"]).filter(toxicity.held_out()).toPandas()
    assert auc(got.toxic.to_numpy(), got.score.to_numpy()) > 0.97
    assert ((got.score >= 0.7) & (got.toxic == 0)).mean() < 0.02
    odd = odd_docs(spark, extra=True)
    out = toxicity.score(odd, model, odd.columns, score_col="p")
    assert out.columns == [*odd.columns, "p"] and out.count() == odd.count()
    assert all(0 <= r.p <= 1 for r in out.collect())
    assert toxicity.score(empty_docs(spark), model, ["doc_id"]).collect() == []


def test_fit_does_not_depend_on_the_order_of_rows(spark):
    df = spark.createDataFrame([(i, prose(i, 9) + " bad" * (i % 3 == 0), int(i % 3 == 0))
                                for i in range(90)], "doc_id bigint, text string, toxic int")
    one = toxicity.fit_on(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    two = toxicity.fit_on(df.select("doc_id", "text").repartition(5), df.select("doc_id", "toxic"))
    assert (one.weight == two.weight).all() and one.slope == two.slope


def test_without_labels_the_score_is_constant(spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit_on(odd_docs(spark).select("doc_id", "text"), labels)
    assert set(model.score(["a", "", "b c"]).tolist()) == {0.5}


def test_held_out_rule(spark):
    import zlib
    got = spark.range(50).select(F.col("id").alias("doc_id")).select(
        "doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
