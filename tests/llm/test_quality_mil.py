import numpy as np
import pyarrow as pa

from quarry.llm import quality_mil as Q
from quarry.llm.tables import table
from quarry.llm.words import text_bytes


def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    p = {"w": rng.normal(size=(5, 4)), "wb": rng.normal(size=4), "v": rng.normal(size=(4, 3)), "u": rng.normal(size=(4, 3)), "a": rng.normal(size=3), "c": rng.normal(size=4), "cb": np.array(0.2)}
    x, n, label = rng.normal(size=(7, 5)), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])

    def loss(q):
        y = Q._forward(q, x, n)["y"]
        return -(label * np.log(y) + (1 - label) * np.log(1 - y)).mean() + Q.DECAY / 2 * sum((v**2).sum() for v in q.values())

    grad = Q._gradient(p, x, n, label)
    for name, value in p.items():
        for at in np.ndindex(value.shape):
            up = {k: v.copy() for k, v in p.items()}
            down = {k: v.copy() for k, v in p.items()}
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - np.asarray(grad[name])[at]) < 1e-6


def test_features_of_passages():
    text = [None, "", "a " * 64, "X1 " + "b c " * 64, "\n\nq"]
    x, n = Q.passage_features(*text_bytes(pa.array(text)))
    assert n.tolist() == [1, 1, 1, 3, 1] and x.shape == (7, Q.FEATURES) and np.isfinite(x).all()
    distinct, beside = Q.MEASURES - 4, Q.MEASURES - 3
    assert abs(x[2, distinct] - 1 / 64) < 1e-6 and abs(x[2, beside] - 63 / 64) < 1e-6
    assert abs(x[3, distinct] - 3 / 64) < 1e-6 and abs(x[5, distinct] - 1) < 1e-6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scores = Q.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
    m = scores.toPandas().merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    m = m[m.held_out]
    assert ((m.score >= 0) & (m.score <= 1)).all() and ((m.score >= 0.3) == (m.predicted == 1)).all()
    assert (m.predicted == m.quality).mean() >= 0.95
    assert (m[m.quality == 1].predicted == 1).mean() >= 0.98


def test_labels_of_held_out_rows_do_not_matter(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    assert sorted(Q.quality_scores(docs, labels).collect()) == sorted(Q.quality_scores(docs, turned).collect())


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "x y", 0.5), (3, "word " * 60_000, 0.5), (3, "word", 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id long, quality int")
    rows = Q.quality_scores(docs, labels).collect()
    assert len(rows) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    one = spark.createDataFrame([(3, 1), (6, 1)], "doc_id long, quality int")
    assert all(r.score > 0.5 for r in Q.quality_scores(docs, one).collect())
    assert Q.quality_scores(docs.where("false"), labels).count() == 0
    kept = Q.keep_good(docs, one)
    assert kept.columns == docs.columns and kept.count() == 5


def naive_score(model, text):
    """Gated attention over the passages of one text, passage by passage."""
    x, n = Q.passage_features(*text_bytes(pa.array([text], pa.string())))
    assert n.tolist() == [len(x)] == [max(1, -(-len((text or "").split()) // Q.PASSAGE))]
    p, weights, hidden = model.p, [], []
    for row in x:
        h = np.tanh(((row - model.mean) / model.scale) @ p["w"] + p["wb"])
        gate = 1 / (1 + np.exp(-(h @ p["u"])))
        weights.append(np.exp((np.tanh(h @ p["v"]) * gate) @ p["a"]))
        hidden.append(h)
    bag = sum(w / sum(weights) * h for w, h in zip(weights, hidden, strict=True))
    return 1 / (1 + np.exp(-(bag @ p["c"] + p["cb"])))


def test_scores_equal_a_naive_scorer(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    model = Q.fit(docs, labels)
    assert model.p is not None
    texts = dict(docs.collect())
    rows = Q.quality_scores(docs, labels, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert abs(r.score - naive_score(model, texts[r.doc_id])) < 1e-6
        assert r.predicted == int(r.score >= 0.3)
