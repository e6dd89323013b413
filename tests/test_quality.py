"""Column checks and the gate."""

import pytest

from feedmart.operators.quality import CHECKS, Check, QualityError, gate, run_checks


def _results(frame):
    return {(r.model, r.column, r.check): r.failures for r in frame.collect()}


@pytest.fixture
def model(spark):
    return spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, None), ("b", 3)], "author string, n int")


def test_counts(model):
    checks = [Check("m", "author", "not_null"), Check("m", "n", "not_null"), Check("m", "author", "unique"), Check("m", "n", "unique")]
    assert _results(run_checks({"m": model}, checks)) == {
        ("m", "author", "not_null"): 2, ("m", "n", "not_null"): 2, ("m", "author", "unique"): 1, ("m", "n", "unique"): 0,
    }


def test_empty_model_passes(model):
    results = run_checks({"m": model.limit(0)}, [Check("m", "author", "not_null"), Check("m", "author", "unique")])
    assert set(_results(results).values()) == {0}
    gate(results)


def test_gate_names_what_failed(model):
    with pytest.raises(QualityError, match=r"m.author not_null: 2, m.author unique: 1"):
        gate(run_checks({"m": model}, [Check("m", "author", "not_null"), Check("m", "author", "unique")]))


def test_unknown_check(model):
    with pytest.raises(ValueError):
        run_checks({"m": model}, [Check("m", "n", "positive")])


def test_standard_checks():
    assert len(CHECKS) == 12 and sum(c.kind == "unique" for c in CHECKS) == 1
