import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from feedmart.llm import toxicity
from feedmart.llm.toxicity import Settings, detect, fit, held_out, risk_gradient

BAD = ["vilezor", "grubnak", "hatelix", "scornix"]


def corpus(n=1200, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 80))
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text)))
        if rng.random() < 0.6:
            labels.append((i, int(toxic)))
    return rows, labels, {i for i, t in rows if any(b in t for b in BAD)}


def test_gradient_is_the_slope_of_the_risk():
    rng = np.random.default_rng(1)
    s, y = rng.normal(size=30), np.arange(30) < 8
    risk = lambda s: 0.2 * np.logaddexp(0, -s[y]).mean() + np.logaddexp(0, s[~y]).mean() - 0.2 * np.logaddexp(0, s[y]).mean()
    step = np.eye(30) * 1e-5
    slope = np.array([(risk(s + d) - risk(s - d)) / 2e-5 for d in step])
    one = np.ones(30)
    assert np.allclose(risk_gradient(s, y, one, 0.2, 0.0), slope, atol=1e-6)
    low = np.where(y, 5.0, -5.0)  # the estimate for clean text is negative here: the step must raise it
    assert np.all(risk_gradient(low, y, one, 0.2, 0.0)[y] > 0) and np.all(risk_gradient(low, y, one, 0.2, 0.0)[~y] < 0)


def plain_fit(rows, n, prior, s):
    """The same descent row by row, with dense matrices and without weights; rows are taken as they are."""
    x = np.array([[float(j in found) for j in range(n)] for _, _, found in rows])
    y = np.array([toxic for toxic, _, _ in rows])
    w, m, v = np.append(np.zeros(n), np.log(prior / (1 - prior))), np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, s.steps + 1):
        z = x @ w[:-1] + w[-1]
        p, loss = 1 / (1 + np.exp(-z)), np.log(1 + np.exp(z))
        bracket = loss[~y].mean() - prior * loss[y].mean()
        g = np.where(y, -prior * p / y.sum(), p / (~y).sum())
        g = -g if bracket < -s.slack else g + np.where(y, -prior * (1 - p) / y.sum(), 0)
        grad = np.append(x.T @ g + s.penalty * w[:-1] / n, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def test_weights_stand_for_repeated_rows():
    rng, s = random.Random(3), Settings(steps=60)
    rows = [(rng.random() < 0.3, rng.randint(1, 4), [j for j in range(6) if rng.random() < 0.3]) for _ in range(50)]
    rows += [(True, 2, [1, 2]), (True, 3, [1, 2]), (False, 4, []), (False, 1, [])]
    model = fit(rows, list("abcdef"), 0.2, s)
    wanted = plain_fit([(y, 1, found) for y, weight, found in rows for _ in range(weight)], 6, 0.2, s)
    assert np.allclose([*model.weights.values(), model.bias], wanted, atol=1e-6)


def test_the_driver_sees_a_bounded_number_of_rows(spark, monkeypatch):
    """One id with thousands of texts, thousands of copies, and rows without id."""
    rows = [(1, f"vilezor word{i}") for i in range(3000)] + [(None, f"no id {i % 2500}") for i in range(5000)] + [(2, "grubnak")] * 4000
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda found, *rest: seen.extend(found) or fit(found, *rest))
    toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), labels, F.lit(True), Settings(max_positive=50, max_unlabelled=200, steps=2))
    assert 0 < sum(y for y, *_ in seen) <= 50 and len(seen) <= 50 + 240
    everything = []
    monkeypatch.setattr(toxicity, "fit", lambda found, *rest: everything.extend(found) or fit(found, *rest))
    toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), labels, F.lit(True), Settings(max_positive=10**6, max_unlabelled=10**6, steps=2))
    assert sum(weight for y, weight, _ in everything if y) == 7000 and sum(weight for y, weight, _ in everything if not y) == len(rows)


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels, toxic = corpus()
    odd = [(5000, None), (5001, ""), (None, "vilezor grubnak hatelix scornix"), (rows[0][0], rows[0][1]), (5002, "x " * 300_000 + BAD[0])]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").selectExpr("*", "1 as toxic", "0.0 as score", "true as held_out")
    frame = spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id long, toxic int").selectExpr("*", "'x' as text")
    got = detect(docs, frame).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id < 5000]
    hits = [(r.doc_id in toxic) == (r.predicted == 1) for r in held]
    assert sum(hits) / len(hits) > 0.97
    by_id = {r.doc_id: r for r in got}
    assert by_id[5000].score == by_id[5001].score and by_id[None].predicted == 1


def test_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r)[2:] for r in detect(docs, labels).collect()] == [(0.0, 0)]
    clean = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.learn(docs, clean, ~held_out(), Settings()) is None
    assert detect(docs.where("false"), labels).count() == 0
