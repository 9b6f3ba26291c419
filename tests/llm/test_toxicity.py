import math
import random

import numpy as np
from shared import clashing_documents, no_documents, odd_documents, rows_of

from spendlight.llm import toxicity


def labelled(spark, n=1500):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["Awful", "NASTY"])
        rows.append((i, " ".join(text), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    assert len(model.found) < 2000
    found = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 200
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.98
    kept = {r.doc_id for r in toxicity.clean(docs, model).collect()}
    assert kept == {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted == 0}


def test_held_out_labels_are_not_learned(spark):
    docs, labels = labelled(spark, 400)
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert one.found.tolist() == two.found.tolist() and one.weights.tolist() == two.weights.tolist()


def test_sample_is_bounded(spark):
    _, labels = labelled(spark)
    assert 0 < toxicity.drawn_labels(labels, 100).count() < 150
    learned = toxicity.drawn_labels(labels, 10**6)
    assert learned.count() == labels.where("crc32(cast(doc_id as string)) % 5 <> 0").count()
    assert toxicity.drawn_labels(labels.unionByName(labels), 10**6).count() == learned.count()


def test_features_do_not_depend_on_the_batch():
    texts = ["One two, three FOUR five", "", "é日本 x", "İstanbul ΑΣ word"]
    together = toxicity.feature_sets(texts)
    assert [s.tolist() for s in together] == [toxicity.feature_sets([t])[0].tolist() for t in texts]
    assert len(together[0]) == 5 + 4 + 3 + 2 and len(together[1]) == 0


def test_ftrl_keeps_rare_features_at_zero():
    state = toxicity.Ftrl()
    for i in range(200):
        state.learn(np.array([1 if i % 2 else 2, 1000 + i]), i % 2)
    weights = state.weights(slice(None))
    assert weights[1] > 0 > weights[2]
    assert not weights[1000:1200].any()


def test_odd_documents(spark):
    docs, labels = labelled(spark, 300)
    model = toxicity.fit(docs, labels)
    found = toxicity.score(odd_documents(spark), model)
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == 12
    assert rows[2].score == rows[3].score and 0 < rows[3].score < 1
    assert all(r.predicted == int(r.score >= 0.5) for r in rows.values())
    clashing = clashing_documents(spark)
    assert rows_of(toxicity.score(clashing, model)) == rows_of(found)
    assert toxicity.clean(clashing, model).columns == clashing.columns
    assert toxicity.score(no_documents(spark), model).collect() == []


def test_without_labels_nothing_is_rejected(spark):
    docs, labels = odd_documents(spark), spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {(r.score, r.predicted) for r in toxicity.score(docs, model).collect()} == {(0.0, 0)}
    assert toxicity.clean(docs, model).count() == 12


def test_weights_are_those_of_a_plain_dictionary():
    rng = random.Random(8)
    rows = [(sorted(rng.sample(range(1, 60), rng.randrange(0, 12))), rng.random()) for _ in range(600)]
    rows = [(found, int(7 in found or chance < 0.05)) for found, chance in rows]
    state, z, n = toxicity.Ftrl(), {}, {}
    alpha, beta, l1 = 3.0, 1.0, 4.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) * alpha / (beta + math.sqrt(n[i]))

    for found, label in rows:
        state.learn(np.array(found, np.int32), label)
        every = [*found, 1 << toxicity.FEATURE_BITS]
        before = {i: weight(i) for i in every}
        slope = 1 / (1 + math.exp(-sum(before.values()))) - label
        for i in every:
            old = n.get(i, 0.0)
            n[i] = old + slope**2
            z[i] = z.get(i, 0.0) + slope - (math.sqrt(n[i]) - math.sqrt(old)) / alpha * before[i]
    expected = [weight(i) for i in range(60)]
    assert any(expected) and not all(expected)
    assert np.allclose(state.weights(slice(0, 60)), expected, rtol=1e-9, atol=1e-12)
