import math
from collections import Counter

import duckdb
import pytest

from feedmart.llm import mixing
from feedmart.llm.mixing import Settings, exponent, mix, word_count
from tests.compare import differences

SCHEMA = "doc_id long, source string, text string"


def rows():
    sizes = {"big": 300, "mid": 60, "small": 8, None: 20}
    out, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            out.append((i, source, "w " * (1 + (i * 7 + k) % 23)))
            i += 1
    return out + [(900, "big", None), (901, "mid", ""), (902, "empty", None), (None, "mid", "a b c"), (5, "big", "w " * 13), (5, "big", "w " * 13)]


def manifest(spark, data, s):
    docs = spark.createDataFrame(data, SCHEMA).withColumn("tokens", word_count()).drop("text")
    return mix(docs.selectExpr("*", "1 as total", "'k' as key", "'e' as Epoch"), "tokens", s=s)


@pytest.mark.parametrize("s", [
    Settings(block_tokens=50), Settings(block_tokens=200, min_entropy=0.99, max_repeats=3.5, budget=2.5), Settings(block_tokens=30, max_blocks=4, max_repeats=1.2),
])
def test_same_rows_as_sql(spark, s):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows())
    got = manifest(spark, rows(), s).select("doc_id", "source", "tokens", "epoch", "block", "start", "weight")
    assert differences(got, db, mixing.oracle(s)) == []


def test_budgets_are_met_and_passes_are_whole(spark):
    s = Settings(block_tokens=40, budget=2.0, min_entropy=0.95, max_repeats=6.0)
    got = manifest(spark, rows(), s).collect()
    total = sum(len((t or "").split()) for _, _, t in rows())
    assert {r.source for r in got} == {"big", "mid", "small", None}
    for source in ("big", "mid", "small", None):
        own = [r for r in got if r.source == source]
        quota = own[0].weight * total * 2
        assert quota - 23 <= sum(r.tokens for r in own) <= quota + 1
        copies = Counter(r.doc_id for r in own if r.doc_id != 5)
        assert max(copies.values()) - min(copies.values()) <= 1
        assert all(0 <= r.start < 1 for r in own)


def test_exponent_meets_its_targets(spark):
    totals = spark.createDataFrame([("a", 9000), ("b", 900), ("c", 100)], "key string, total long")
    share = [0.9, 0.09, 0.01]

    def entropy(e):
        w = [p**e for p in share]
        w = [x / sum(w) for x in w]
        return -sum(x * math.log(x) for x in w) / math.log(3)

    e = exponent(totals, Settings(min_entropy=0.8, max_repeats=None))
    assert entropy(e) == pytest.approx(0.8, abs=1e-4)
    e = exponent(totals, Settings(min_entropy=None, max_repeats=5.0))
    assert 0.01 ** (e - 1) / sum(p**e for p in share) == pytest.approx(5.0, rel=1e-3)
    assert exponent(totals, Settings(min_entropy=0.1, max_repeats=None)) == 1.0
    assert exponent(totals, Settings(min_entropy=None, max_repeats=None)) == 0.0
    assert exponent(totals.limit(1), Settings()) == 1.0


def test_empty_and_without_tokens(spark):
    assert manifest(spark, [], Settings()).count() == 0
    assert manifest(spark, [(1, "a", None), (2, None, "")], Settings()).count() == 0
