import base64
import random
import tracemalloc
from collections import Counter

import numpy as np
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from feedmart.llm import quality_compression as qc
from feedmart.llm.quality_compression import compression_bands

SCHEMA = "doc_id long, text string"


def plain_counts(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def prose(rng, n):
    parts = ["the", "river", "stone", "a", "of", "light", "under", "morning", "walk", "ed", "ing", "bread", "and", "glass", "or"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def test_counts_and_verdicts(spark):
    rng = random.Random(3)
    texts = [
        None, "", " \n\t", "one word  x", "a b c a b c a", "a\n\nb \na\nb \n\x0b\n", prose(rng, 60), prose(rng, 900), prose(rng, 30_000),
        "#* $% &| <>", " ".join(f"w{i}" for i in range(3)) * 400, prose(rng, 100) + " " + base64.b64encode(rng.randbytes(40_000)).decode(),
        (prose(rng, 400) + "\n") * 40, "a a a a a a",
    ]
    rows = list(enumerate(texts)) + [(None, "x y z"), (6, texts[6])]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'k' as kept", "0 as n_words")
    got = compression_bands(frame).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in rows:
        r, want = by_id[doc_id], plain_counts(text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
    assert [by_id[i].kept for i in (6, 7, 8)] == [True] * 3
    assert not any(by_id[i].kept for i in (0, 1, 10, 11, 12))
    assert by_id[11].highest_chunk > 0.72 and not by_id[11].base_failed
    assert compression_bands(frame.where("false")).count() == 0


def plain_verdict(text, bands=qc.Bands()):
    """Kept or not, from the definition: chunks from the front, the last one from the end."""
    raw = (text or "").encode()
    words, _, _, _, repeat = plain_counts(text or "")
    if words < 50 or 2 * repeat > words:
        return False
    size = lambda part: len(zstandard.ZstdCompressor(level=bands.level).compress(part)) / len(part)
    low, high = next((b.low, b.high) for b in bands.whole if len(raw) <= b.up_to)
    cuts = [raw[i : i + bands.chunk] for i in range(0, len(raw), bands.chunk)] if len(raw) > bands.chunk else []
    if cuts:
        cuts[-1] = raw[-bands.chunk :]
    bad = [c for c in cuts if size(c) < bands.chunk_low or size(c) > bands.chunk_high]
    return low <= size(raw) <= high and len(bad) <= bands.bad_share * len(cuts)


def test_verdicts_of_the_definition(spark):
    """Lengths around every limit and around whole chunks; random, repetitive and mixed texts."""
    rng = random.Random(9)
    noise = lambda n: base64.b64encode(rng.randbytes(n)).decode()
    texts = [None, ""]
    for length in (511, 512, 513, 1024, 1025, 4095, 4096, 4097, 8192, 8193, 16384, 16385, 40_000):
        body = prose(rng, length // 4)
        texts += [body[:length], (prose(rng, 30) + " ") * (length // 60), " ".join(noise(6) for _ in range(length // 9)), body[: length // 2] + " " + noise(length // 3)]
    got = {r.doc_id: r.kept for r in compression_bands(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    assert got == {i: plain_verdict(t) for i, t in enumerate(texts)} and len(set(got.values())) == 2


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\v\u00a0é#"), max_size=60))
def test_counts_of_any_text(text):
    assert qc.base_counts(text) == plain_counts(text)


def test_windows_of_very_many_words():
    """With more different words than three of which fit into one number."""
    ids = np.random.default_rng(1).integers(0, 6, 500).astype(np.int32)
    assert qc._repeated(ids, 6) == qc._repeated(ids, 1 << 21) == plain_counts(" ".join(map(str, ids)))[4]


def test_memory_for_a_very_long_text():
    rng = random.Random(2)
    for text in (prose(rng, 200_000), "a b " * 500_000, "a\nb\n" * 400_000):
        tracemalloc.start()
        qc.base_counts(text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 20 * len(text), (peak / len(text), text[:4])
