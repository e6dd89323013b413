import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmart.llm import fingerprints
from feedmart.llm.fingerprints import Settings, beside_edited, edited, likeness, likeness_of, sampled, terms

SCHEMA = "doc_id long, text string"


def plain_terms(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < n:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def jaccard(a, b):
    """Sum of smaller weights over the sum of larger ones."""
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def plain(rows):
    """(doc_id, n_chars, edited_sha256) in the order of the definition."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        out[doc_id] = (len(text), sha256(changed.encode()).hexdigest(), text, changed, following)
    return out


def corpus(n=80, seed=3):
    rng = random.Random(seed)
    words = [f"Wörd{i}" for i in range(300)]
    rows = [(i * 3, " ".join(rng.choices(words, k=rng.randint(1, 120)))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, " \t"), (1003, "x"), (1004, "ab cd"), (1005, rows[5][1]), (1006, rows[5][1])]


def test_counts_of_shingles():
    for _, text in corpus():
        for n in (1, 2, 5):
            assert sorted(terms(text, Settings(shingle=n))[1]) == sorted(plain_terms(text, n).values())


def test_collision_rate_is_the_generalised_jaccard_similarity():
    rng = np.random.default_rng(1)
    s = Settings(samples=4096)
    for _ in range(15):
        ids = np.unique(rng.integers(0, 1 << 63, 60, np.uint64))
        a = rng.integers(0, 6, len(ids))
        b = np.where(rng.random(len(ids)) < 0.5, a, rng.integers(0, 40, len(ids)))
        wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert likeness(sampled(ids[a > 0], a[a > 0], s), sampled(ids[b > 0], b[b > 0], s)) == pytest.approx(wanted, abs=0.04)


def test_terms_are_drawn_by_weight():
    s = Settings(samples=8192)
    ids = np.array([11, 12, 13], np.uint64)
    whole = sampled(ids, np.array([1, 2, 7]), s)
    for i, weight in enumerate([1, 2, 7]):
        assert likeness(whole, sampled(ids[i : i + 1], np.array([weight]), s)) == pytest.approx(weight / 10, abs=0.02)


def test_many_terms_go_block_by_block():
    rng = np.random.default_rng(2)
    ids, s = np.unique(rng.integers(0, 1 << 63, 3_000, np.uint64)), Settings()
    weights = rng.integers(1, 4, len(ids))
    parts = [sampled(ids[i : i + 700], weights[i : i + 700], s) for i in range(0, len(ids), 700)]
    whole = sampled(ids, weights, s)
    assert all(whole[j] in {p[j] for p in parts} for j in range(s.samples))


def test_equals_plain_texts_and_estimates(spark):
    rows = corpus()
    got = {r.doc_id: r for r in beside_edited(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    wanted = plain(rows)
    assert len(got) == len(rows)
    off = []
    for doc_id, (n, digest, text, changed, following) in wanted.items():
        row = got[doc_id]
        assert (row.n_chars, row.edited_sha256) == (n, digest)
        own, near, then = (plain_terms(t, 2) for t in (text, changed, following))
        for estimate, other in ((row.near_edited, near), (row.near_next, then)):
            exact = jaccard(own, other) if own or other else 1.0
            assert estimate == pytest.approx(exact, abs=0.25)
            off.append(estimate - exact)
    assert abs(np.mean(off)) < 0.02
    assert got[1005].fingerprint == got[1006].fingerprint == got[15].fingerprint and got[1006].near_next == 1.0
    assert got[1000].fingerprint == got[1002].fingerprint == "" and got[1001].near_next == 1.0


def test_rows_over_many_tasks(spark):
    """Whatever the number of tasks, every row is beside the next one."""
    rows = corpus(40)
    texts = {i: t or "" for i, t in rows}
    order = sorted(texts, reverse=True)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for parts in (1, 3, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got = {r.doc_id: r.edited_sha256 for r in beside_edited(spark.createDataFrame(rows, SCHEMA)).collect()}
            assert got == {a: sha256(edited(texts[a], texts[b]).encode()).hexdigest() for a, b in zip(order, order[1:] + order[:1])}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_odd_rows(spark):
    assert beside_edited(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = beside_edited(spark.createDataFrame([(7, "abcdef")], SCHEMA)).first()
    assert alone.edited_sha256 == sha256(b"abcdab").hexdigest() and alone.near_next == 1.0
    odd = [(None, "no id"), (None, "no id"), (3, "a b c"), (3, "a b c"), (3, "other words"), (4, "long " * 200_000), (9, None)]
    frame = spark.createDataFrame([(i, t, "x", i) for i, t in odd], "doc_id long, text string, TEXT string, print long")
    rows = beside_edited(frame).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in rows) == sorted((i or 0, len(t or "")) for i, t in odd)
    key = lambda r: (r.doc_id or 0, r.edited_sha256)
    assert sorted(rows, key=key) == sorted(beside_edited(frame.repartition(3)).collect(), key=key)


def test_prints_and_likeness_of_columns(spark):
    frame = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g"), (3, ""), (4, None)], SCHEMA)
    prints = {r.doc_id: r for r in fingerprints.fingerprints(frame).collect()}
    assert [prints[i].n_terms for i in (1, 2, 3, 4)] == [5, 5, 0, 0]
    pairs = spark.createDataFrame([(prints[a].fingerprint, prints[b].fingerprint) for a, b in ((1, 2), (1, 1), (1, 3), (3, 4))], "a string, b string")
    found = [r[0] for r in pairs.select(likeness_of(F.col("a"), F.col("b"))).collect()]
    samples = [fingerprints.read(prints[i].fingerprint) for i in (1, 2)]
    assert found == [likeness(*samples), 1.0, 0.0, 1.0]


def test_two_texts_drawn_together(spark):
    s = Settings()
    texts = [t for _, t in corpus(12)]
    for a, b in zip(texts, texts[1:]):
        wanted = [sampled(*terms(t, s), s).tolist() for t in (a, b)]
        assert [p.tolist() for p in fingerprints.both_sampled(terms(a, s), terms(b, s), s)] == wanted
