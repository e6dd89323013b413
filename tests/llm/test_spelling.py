import random
import re
import string
from collections import Counter
from zlib import crc32

import pytest

from feedmart.llm import spelling
from feedmart.llm.spelling import Settings, near_words, spelled, trie, variants

SCHEMA = "doc_id long, text string"


def plain_counts(rows, s):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in string.ascii_uppercase else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= s.length and n >= s.count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, s=Settings()):
    counts = plain_counts(rows, s)
    form, n_near = {}, {}
    for w, n in counts.items():
        others = [o for o in counts if o != w and near(w, o)]
        n_near[w] = len(others)
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= s.ratio * n else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], n_near[w], counts.get(form[w])))
    return out


def ours(spark, rows, s=Settings()):
    frame = variants(spark.createDataFrame(rows, SCHEMA), s)
    return {tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    s = Settings(length=3, count=1, ratio=2)
    stems = ["".join(rng.choices("abé", k=rng.randint(3, 8))) for _ in range(50)]
    rows = [(i, " ".join(rng.choices(stems, [1 / (j + 1) for j in range(50)], k=60))) for i in range(40)]
    got = ours(spark, rows, s)
    assert got == brute(rows, s)
    assert any(form and form != root for _, form, root, *_ in got)


def test_production_settings_and_odd_rows(spark):
    rows = [(1, None), (None, "Straße straße"), (2, ""), (3, "x" * 50_000 + " kitten"), (4, "kitten Kitten KITTEN kitten kitten kitten " * 9)]
    rows += [(5, "mitten " * 5 + "kittens " * 5 + "ÄPFELN äpfeln " * 6), (5, "kittens×÷ kitten"), (5, "kittens×÷ kitten")]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, []) == set()
    extra = spark.createDataFrame([(1, "kitten " * 5, "a")], "doc_id long, text string, TEXT string")
    assert [r.word for r in variants(extra).collect()] == ["kitten"]


def test_very_long_words(spark):
    long = "ab" * 20_000
    rows = [(i, f"{long} {long[:-1]}") for i in range(6)]
    assert ours(spark, rows) == brute(rows)


def test_letters_are_left_out_by_checksum():
    rows = [(i, "lettering") for i in range(2_000)]
    counts = Counter()
    for doc_id, text in rows:
        counts.update(spelled(text, doc_id, 6))
    assert counts == plain_counts(rows, Settings(count=1)) and len(counts) > 2


def test_tries_number_each_beginning_once(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(400)})
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(7)
    rows = trie(frame).collect()
    nodes = {}
    for row in rows:
        for depth, node in enumerate(row.path, 1):
            assert nodes.setdefault(row.word[:depth], node) == node
    assert len(set(nodes.values())) == len(nodes)
    assert [r.word for r in sorted(rows, key=lambda r: r.number)] == words


def test_groups_of_node_pairs_stay_small(spark):
    """A pair of nodes holds at most one word per letter, however many words there are."""
    words = [f"{a}{b}{c}{d}" for a in "abcdef" for b in "abcdef" for c in "abcdef" for d in "abc"]
    paths = {r.word: r for r in trie(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    back = {r.word[::-1]: r for r in trie(spark.createDataFrame([(w[::-1],) for w in words], "word string")).collect()}
    frame = spark.createDataFrame(
        [(paths[w].number, w, 5, paths[w].path, back[w].path) for w in words], "id long, word string, n long, path array<long>, back array<long>"
    )
    assert near_words(frame).count() == len(words) * (5 + 5 + 5 + 2)


def test_common_beginning():
    assert [spelling._common(a, b) for a, b in (("", "a"), ("abc", "abd"), ("ab", "abc"), ("x", "y"))] == [0, 2, 2, 0]
