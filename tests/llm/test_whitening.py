import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmart.llm.whitening import Settings, fit_spaces, polar, products, spectrum, whiten, whole_vectors

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=16):
    """Whitened rows with numpy's own eigenvectors: {vec_id: (n, deviation, values)}, and shares of the variance."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept])
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(k, int((values > 1e-9 * values[0]).sum()))
    white = (x - sums / n) @ (axes[:, :k] / np.sqrt(values[:k]))
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return kept, n, deviation, white, values[:k] / values.sum()


def check(got, rows, k=16):
    kept, n, deviation, white, explained = plain(rows, k)
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    count = white.shape[1]
    assert len(got) == len(kept) * count
    signs = np.zeros(count)
    for place, (vec_id, _) in enumerate(kept):
        for c in range(count):
            r = found[vec_id, c + 1][0]
            assert (r.n, int(r.deviation)) == (n, int(deviation[place]))
            assert r.explained == pytest.approx(explained[c], rel=1e-9)
            assert 0 <= r.identity_error < 1e-9
            if not signs[c] and abs(white[place, c]) > 1e-6:
                signs[c] = np.sign(white[place, c] * r.whitened)
            assert r.whitened == pytest.approx(signs[c] * white[place, c], abs=1e-7)


def vectors(n=300, d=24, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((d, d)) * (1.3 ** -np.arange(d))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.standard_normal((n, d)) @ mix + 3)]


def test_equals_numpy(spark):
    rows = vectors()
    rows += [(1000 + i, rows[i % 3][1]) for i in range(200)]  # copies do not weigh more
    check(whiten(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect(), rows)


def test_fewer_components_than_asked_for(spark):
    rows = vectors(60, 5)
    check(whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows)
    few = vectors(4, 24)  # three dimensions are spanned
    check(whiten(spark.createDataFrame(few, SCHEMA)).collect(), few)
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, SCHEMA)).collect() == []


def test_unusable_vectors_are_left_out(spark):
    rows = vectors(40, 4)
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0]), (903, [1.0, float("nan"), 0.0, 0.0]), (904, [float("-inf")] * 4), (905, [3e38] * 4)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<float>, VEC_ID string")
    check(whiten(frame).collect(), rows)
    assert whiten(spark.createDataFrame(bad, SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    nameless = whiten(spark.createDataFrame([*rows, (None, rows[0][1])], SCHEMA))
    assert nameless.where("vec_id is null").count() == 4


def test_lengths_are_whitened_apart(spark):
    short, long = vectors(30, 3), [(100 + i, v) for i, v in vectors(50, 6, 2)]
    got = whiten(spark.createDataFrame(short + long, SCHEMA)).collect()
    check([r for r in got if r.vec_id < 100], short)
    check([r for r in got if r.vec_id >= 100], long)


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(np.float32(v)) for v in (1e9 * i, -3e9 + i, 7e8 * (i % 3))]) for i in range(8)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    got = {r.vec_id: r.deviation for r in whiten(spark.createDataFrame(rows, SCHEMA)).where("component = 1").collect()}
    assert {i: int(v) for i, v in got.items()} == {i: sum((8 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}


def test_covariance_is_centred_exactly(spark):
    """A small spread far from the origin."""
    rows = [(i, [1_000_000.0 + i % 2, 1_000_000.0 - i % 3]) for i in range(6)]
    fit = whole_vectors(spark.createDataFrame(rows, SCHEMA)).select("x").distinct()
    space = fit_spaces(fit, Settings())[2]
    assert sorted(space.variances) == pytest.approx([64**2 / 4, 64**2 * 2 / 3], rel=1e-12)


@pytest.mark.parametrize("values", [
    np.geomspace(1, 1e-6, 20), np.r_[np.full(6, 3.0), np.full(6, 1.0), 0.5], np.r_[1.0, np.zeros(9)], np.full(7, 2.0), np.arange(33) - 16.0,
    np.r_[1.0, 1.0 + 1e-12, 1.0 - 1e-12, 5.0], np.array([4.0]),
])
def test_spectrum(values):
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found = list(spectrum(a))
    got, axes = np.array([v for v, _ in found]), np.array([x for _, x in found]).T
    assert np.allclose(got, np.sort(values)[::-1], atol=1e-13 * np.abs(values).max() * len(values))
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-12)
    assert np.linalg.norm(a @ axes - axes * got) < 1e-13 * np.linalg.norm(a) * len(values)


def test_polar_factor():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    values, axes = np.linalg.eigh(a)
    assert np.allclose(polar(a), axes @ np.diag(np.sign(values)) @ axes.T, atol=1e-12)


def test_products_are_exact():
    x = np.array([[1 << 40, 3], [-(1 << 41), 5]], np.int64)
    assert products(x).tolist() == [[5 << 80, (3 << 40) - (5 << 41)], [(3 << 40) - (5 << 41), 34]]


def test_only_one_row_per_place_and_task_is_shuffled(spark):
    frame = spark.createDataFrame(vectors(50, 3), SCHEMA)
    plan = whiten(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the result itself is one pass
    assert whiten(frame).agg(F.countDistinct("n")).first()[0] == 1
