import random
import re

import numpy as np

from feedmart.llm.components import components
from feedmart.llm.near_duplicates import Settings, index_keys, linked, near_duplicates, one_of_each, shingle_set, signature, word_hashes

SCHEMA = "doc_id long, text string"


def plain_set(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n=2, percent=80):
    """(size, component) per row by trying all pairs."""
    sets = [plain_set(t, n) for _, t in rows]
    part = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= percent * len(a | b):
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if part[j] == part[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if sets[i] and doc_id is not None else doc_id))
    return out


def corpus(seed=9):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, next_id = [], 0

    def add(text):
        nonlocal next_id
        rows.append((next_id, text))
        next_id += 1

    for _ in range(60):
        add(" ".join(rng.choices(words, k=rng.randint(1, 80))))
    for _ in range(12):  # chains: each text a small edit of the one before, ends not alike
        text = rng.choices(words, k=rng.randint(20, 90))
        for _ in range(8):
            add(" ".join(text))
            text = list(text)
            for _ in range(max(1, len(text) // 22)):
                text[rng.randrange(len(text))] = rng.choice(words)
    base = rng.choices(words, k=100)
    for _ in range(60):  # one large group around a text
        text = list(base)
        for _ in range(rng.randint(0, 7)):
            text[rng.randrange(100)] = rng.choice(words)
        add(" ".join(text))
    for _ in range(10):
        add("Same TEXT again and again")
    rng.shuffle(rows)
    return rows


def check(spark, rows, settings=Settings()):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "'k' as set_key", "2 as component_id")
    got = sorted((tuple(r) for r in near_duplicates(frame, settings).collect()), key=repr)
    want = [(i, n, c, i is None or i == c) for i, n, c in brute(rows, settings.shingle, settings.percent)]
    assert got == sorted(want, key=repr)


def test_same_components_as_all_pairs(spark):
    rows = corpus() + [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "one"), (9004, "ONE"), (9005, "É x"), (9006, "é x"), (None, "one")]
    check(spark, rows)


def test_repeated_rows_and_long_texts(spark):
    rows = corpus(4)[:120]
    check(spark, rows + rows[:5], Settings(small_bucket=2, rare=2))
    long = " ".join(f"x{i % 5000}" for i in range(60_000))
    check(spark, [(1, long), (2, long + " tail"), (3, "a b c d e f g h"), (4, "b c d e f g h a")], Settings(shingle=5))


def test_a_group_of_far_copies_in_large_buckets(spark):
    rng = random.Random(21)
    words = [f"w{i}" for i in range(60)]
    base, rows = [f"b{i}" for i in range(90)], []
    for i in range(120):
        text = list(base)
        for _ in range(rng.randint(0, 14)):
            text[rng.randrange(90)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    for small, rare in ((4, 2), (4, 6), (8, 3)):
        check(spark, rows, Settings(small_bucket=small, rare=rare))


A, B = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))


def test_repeated_ids_with_other_texts(spark):
    """An id that stands on unlike texts ties nothing together."""
    check(spark, [(1, f"{A} z"), (5, A), (5, B), (9, f"{B} y"), (5, None), (5, "c d"), (9, A)])
    rows = corpus(6)
    check(spark, [(i % 40, text) for i, text in rows])


def kept_rows(spark, rows, schema):
    return sorted((tuple(r) for r in one_of_each(spark.createDataFrame(rows, schema)).collect()), key=repr)


def test_one_of_each_keeps_every_unlike_text(spark):
    rows = [(1, f"{A} z"), (5, A), (5, B), (9, f"{B} y"), (5, ""), (5, ""), (7, None), (None, A), (None, A)]
    want = [(1, f"{A} z"), (5, B), (5, ""), (7, None), (None, A), (None, A)]
    assert kept_rows(spark, rows, SCHEMA) == sorted(want, key=repr)


def test_one_of_each_with_ties_and_clashing_columns(spark):
    schema = "doc_id long, text string, _print long, _kept_id string, TEXT string, m map<string,int>"
    rows = [(3, A, 1, "x", "t", {"a": 1}), (3, A, 2, "y", "t", None), (3, A, 2, "y", "t", None), (3, A.upper(), 1, "x", "t", None), (4, f"{A} q", 0, "", "", None)]
    once = kept_rows(spark, rows, schema)
    assert len(once) == 1 and once[0] in rows and once[0][0] == 3
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        assert kept_rows(spark, rows, schema) == once


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, [(1, None), (2, "")])


def test_all_signatures_within_the_distance_meet():
    s, rng = Settings(), np.random.default_rng(3)
    a = rng.integers(0, 1 << 16, (1, 60)).astype(np.uint16)
    for _ in range(300):
        b = a.copy()
        places = rng.permutation(60)[:19]
        b[0, places] ^= rng.integers(1, 1 << 16, 19).astype(np.uint16)
        assert set(index_keys(a, s)[0]) & set(index_keys(b, s)[0])


def test_hashes_do_not_depend_on_the_cut_of_long_texts():
    text = " ".join(f"wörd{i}" for i in range(90_000)).encode()
    whole = word_hashes(text)
    assert len(whole) == 90_000 == len(set(whole.tolist()))
    assert whole[70_000] == word_hashes("wörd70000".encode())[0]
    assert len(signature(shingle_set("a b", 2), Settings())) == 60
    assert linked(shingle_set("a b c d e f", 2), shingle_set("a b c d e f g", 2), 80)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100} and len(got) == 71
