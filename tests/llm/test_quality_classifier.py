import edge
import numpy as np
import pytest

from ledgerloom.llm import quality_classifier as q


def rows(n=200):
    random = np.random.default_rng(2)
    words = [f"word{k}" for k in range(80)]
    out = []
    for k in range(n):
        text = list(random.choice(words, random.integers(10, 60)))
        if k % 4 == 0:
            text = [w + "%%%" if random.random() < 0.5 else w for w in text]
        out.append((" ".join(text), int(k % 4 != 0)))
    return out


def score(weights, text):
    ids = q.feature_ids(text)
    return q.probability(weights[ids].sum(dtype=float) / max(1, len(ids)) ** 0.5 + weights[-1])


def test_learns_and_is_sparse():
    weights = q.train(rows())
    assert np.mean([(score(weights, t) >= 0.5) == y for t, y in rows()]) > 0.97
    assert (weights != 0).sum() < 20_000 and (weights == q.train(rows())).all()


def test_ftrl_is_the_closed_form():
    """The weights minimise the regularised sum of the linearised losses."""
    model, random = q.Ftrl(3), np.random.default_rng(0)
    gradients, sigmas, points = np.zeros(9), np.zeros(9), np.zeros(9)
    n = np.zeros(9)
    for _ in range(50):
        ids = np.unique(random.integers(0, 9, 4))
        values, y = random.random(len(ids)), int(random.integers(2))
        w = model.weights()
        g = np.zeros(9)
        g[ids] = (q.probability(float(w[ids] @ values)) - y) * values
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / model.alpha
        n += g * g
        gradients, sigmas, points = gradients + g, sigmas + sigma, points + sigma * w
        model.learn(ids, values, y, 1.0)
    linear = gradients - points
    curve = sigmas + model.beta / model.alpha + model.l2
    best = np.where(np.abs(linear) <= model.l1, 0, -(linear - np.sign(linear) * model.l1) / curve)
    assert model.weights() == pytest.approx(best)


def test_edges(spark):
    labels = [(i, int(i % 2), 1) for i in range(1, 11)] + [(None, 1, 1), (3, None, None)]
    out = q.quality_scores(edge.documents(spark), edge.labels(spark, labels)).toPandas()
    assert len(out) == len(edge.ROWS) and out.score.between(0, 1).all()
    assert out[out.doc_id.isin([2, 3])].score.nunique() == 1
    none = q.quality_scores(edge.documents(spark), edge.labels(spark)).toPandas()
    assert (none.score == 1).all() and (none.predicted == 1).all()
    assert q.quality_scores(edge.empty(spark), edge.labels(spark, labels)).count() == 0


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows(90))], "doc_id long, text string")
    known = [(k, y, 0) for k, (_, y) in enumerate(rows(90))]
    turned = [(k, 1 - y if __import__("zlib").crc32(str(k).encode()) % 3 == 1 else y, 0) for k, y, _ in known]
    a = q.quality_scores(docs, edge.labels(spark, known)).orderBy("doc_id").collect()
    assert a == q.quality_scores(docs, edge.labels(spark, turned)).orderBy("doc_id").collect()
