"""Document fingerprints: consistent weighted samples of word shingles, whose collision rate is the generalised Jaccard similarity."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import pick, settle, sha256
from feedmart.llm.near_duplicates import _mix as mixed
from feedmart.llm.near_duplicates import word_hashes

_LEVELS = 1 << 16
_DIGITS = 4  # hexadecimal digits of one sample
_BLOCK = 1 << 9  # terms at a time: its arrays stay in the processor's cache


@dataclass(frozen=True)
class Settings:
    """Terms are shingles of `shingle` words, weighted by how often they occur; a fingerprint has `samples` samples.

    The rate at which two fingerprints agree estimates the sum of smaller weights
    over the sum of larger ones without bias, but for one in 65,536 samples that
    agree by chance; its standard error is at most `0.5 / sqrt(samples)`.
    """

    shingle: int = 2
    samples: int = 128
    seed: int = 13


# --- weighted terms ---------------------------------------------------------------------------


def terms(text: str | None, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a text as 64-bit hashes, in order, and how often each occurs.

    A-Z are lower-cased; words are runs without ASCII white space. Fewer words
    than a shingle has are one shingle; a text without words has none.
    """
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(words):
        return words, np.zeros(0, np.int64)
    if len(words) < s.shingle:
        words = np.concatenate((words, np.full(s.shingle - len(words), len(words), np.uint64)))
    found = np.zeros(len(words) - s.shingle + 1, np.uint64)
    for i in range(s.shingle):
        found = mixed(found * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - s.shingle + 1 + i])
    return np.unique(found, return_counts=True)


# --- consistent weighted samples --------------------------------------------------------------


@lru_cache(maxsize=1)
def _gammas() -> np.ndarray:
    """Values of the gamma distribution with shape 2 at evenly spaced probabilities, by bisection of 1 - (1 + x) exp(-x)."""
    wanted = (np.arange(_LEVELS) + 0.5) / _LEVELS
    low, high = np.zeros(_LEVELS), np.full(_LEVELS, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = -np.expm1(-middle) - middle * np.exp(-middle) < wanted
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


@lru_cache(maxsize=4)
def _draws(s: Settings) -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(s.seed)
    odd = rng.integers(0, 1 << 63, s.samples, np.uint64) * np.uint64(2) + np.uint64(1)
    gamma = _gammas()
    shape = (_BLOCK, s.samples)
    buffers = np.empty(shape, np.uint64), np.empty(shape, np.uint64), *(np.empty(shape, np.float32) for _ in range(3))
    return odd, gamma.astype(np.float32), np.log(gamma).astype(np.float32), *buffers


def _mix_in_place(x: np.ndarray, spare: np.ndarray) -> None:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        np.right_shift(x, np.uint64(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor:
            np.multiply(x, np.uint64(factor), out=x)


def drawn_from(shingles: np.ndarray, weights: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Per sample the least value of any term, and a hash of the term that has it and of the level of its weight.

    For each term and sample, gamma values r and c and a uniform b are drawn by
    the term's hash alone. The weight w is rounded down to a level
    exp(r (t - b)) with a whole t, and the term with the smallest
    c / (level exp(r)) is drawn. Both texts draw the same term at the same level
    with a probability of the sum of smaller over the sum of larger weights.
    """
    odd, gamma, log_gamma, bits, spare, r, gap, cost = _draws(s)
    least, name, every = np.full(s.samples, np.inf, np.float32), np.zeros(s.samples, np.uint64), np.arange(s.samples)
    for at in range(0, len(shingles), _BLOCK):
        some, weight = shingles[at : at + _BLOCK], weights[at : at + _BLOCK]
        n = len(some)
        np.multiply(some[:, None], odd, out=bits[:n])
        _mix_in_place(bits[:n], spare[:n])
        drawn = bits[:n].view(np.uint16).reshape(n, s.samples, 4)
        np.take(gamma, drawn[:, :, 0], out=r[:n], mode="clip")
        np.take(log_gamma, drawn[:, :, 1], out=cost[:n], mode="clip")
        np.multiply(drawn[:, :, 2], np.float32(-1 / _LEVELS), out=gap[:n], dtype=np.float32)
        np.add(gap[:n], np.float32(1 - 0.5 / _LEVELS), out=gap[:n])  # 1 - b
        heavy = np.flatnonzero(weight > 1)
        level = np.floor(np.log(weight[heavy]).astype(np.float32)[:, None] / r[heavy] + (1 - gap[heavy]))  # weight 1 is level 0
        np.multiply(gap[:n], r[:n], out=gap[:n])
        np.subtract(cost[:n], gap[:n], out=cost[:n])
        cost[heavy] -= r[heavy] * level
        best = cost[:n].argmin(axis=0)
        value = cost[best, every]
        place = np.searchsorted(heavy, best)
        t = np.zeros(s.samples, np.int64)
        if len(heavy):
            place = np.minimum(place, len(heavy) - 1)
            t = np.where(heavy[place] == best, level[place, every], 0).astype(np.int64)
        found = mixed(some[best] ^ (t.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        name = np.where(value < least, found, name)
        least = np.minimum(least, value)
    return least, name


def fingerprint(*parts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One 16-bit value per sample from what was drawn from the parts of a text's terms; empty if there are no terms."""
    least, name = parts[0]
    for other, other_name in parts[1:]:
        least, name = np.minimum(least, other), np.where(other < least, other_name, name)
    return (name >> np.uint64(48)).astype(np.uint16) if np.isfinite(least).all() else np.zeros(0, np.uint16)


def sampled(shingles: np.ndarray, weights: np.ndarray, s: Settings) -> np.ndarray:
    return fingerprint(drawn_from(shingles, weights, s))


def both_sampled(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of two texts by their terms; what they have in common with the same weight is drawn from once."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    same = a[1][at_a] == b[1][at_b]
    rest_a, rest_b = np.ones(len(a[0]), bool), np.ones(len(b[0]), bool)
    rest_a[at_a[same]] = rest_b[at_b[same]] = False
    common = drawn_from(a[0][~rest_a], a[1][~rest_a], s)
    return tuple(fingerprint(common, drawn_from(x[0][rest], x[1][rest], s)) for x, rest in ((a, rest_a), (b, rest_b)))


def written(samples: np.ndarray) -> str:
    """A fingerprint as text, four hexadecimal digits per sample; empty for a text without words."""
    return samples.astype(">u2").tobytes().hex()


def read(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u2").astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of samples that agree; two fingerprints without samples are alike, one beside another is not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float(np.count_nonzero(a == b)) / len(a)


def likeness_of(a: Column, b: Column) -> Column:
    """`likeness` of two columns of written fingerprints; null if either is null."""
    places = F.sequence(F.lit(1), F.length(a), F.lit(_DIGITS))
    equal = F.size(F.filter(places, lambda i: F.substring(a, i, F.lit(_DIGITS)) == F.substring(b, i, F.lit(_DIGITS))))
    return F.when(F.length(a) * F.length(b) == 0, (F.length(a) == F.length(b)).cast("double")).otherwise(equal / (F.length(a) / _DIGITS))


def fingerprints(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, n_terms, fingerprint) of every row of `docs` (doc_id, text); a null text is empty. Further columns are left out."""

    def run(batches):
        for batch in batches:
            found = [terms(text.as_py(), s) for text in batch.column(1)]
            prints = [written(sampled(*of, s)) for of in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(of[0]) for of in found], pa.int64()), pa.array(prints, pa.string())], ["doc_id", "n_terms", "fingerprint"]
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_terms long, fingerprint string")


# --- texts beside their edited versions -------------------------------------------------------


def edited(text: str, following: str) -> str:
    """The text whose last third of code points is replaced by as many first ones of the following text, or by all it has."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


class _Open:
    """A row whose next row has come by but not that one's fingerprint."""

    def __init__(self, doc_id: int | None, text: str, following: str, s: Settings):
        other = edited(text, following)
        self.own, self.changed = both_sampled(terms(text, s), terms(other, s), s) if other != text else [sampled(*terms(text, s), s)] * 2
        self.row = (doc_id, len(text), sha256(other))

    def closed(self, next_print: np.ndarray) -> tuple:
        prints = [samples.astype(">u2").tobytes() for samples in (self.own, self.changed)]
        return *self.row, *prints, likeness(self.own, self.changed), likeness(self.own, next_print)


def beside_edited(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its fingerprint, that of its edited text, and how alike they and the next row's are.

    The next row is the one after it by falling doc_id, rows without doc_id last
    and equal ids by a hash of the text and the text; after the last comes the
    first. A null text is empty. A single row follows itself. Further columns
    are left out.

    Rows are sorted over all tasks, so that a task meets its rows next to each
    other and keeps two texts at a time. The last row of each task waits for the
    first one of the next task: only these, one pair per task, are joined
    afterwards.
    """
    row = "doc_id long, n_chars long, edited_sha256 string, own binary, changed binary, near_edited double, near_next double"
    wait = "task int, waits_for int, text string"
    names = [part.split()[0] for part in f"{row}, {wait}".split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names[: len(columns)])

    def run(batches):
        task = TaskContext.get().partitionId()
        first = before = open_ = None
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                if before:
                    now = _Open(*before, text, s)
                    if open_:
                        rows.append((*open_.closed(now.own), None, None, None))
                    else:
                        first = before[1], now.own
                    open_ = now
                before = (doc_id, text)
            if rows:
                yield out(rows)
        if before:
            own = sampled(*terms(before[1], s), s)
            first = first or (before[1], own)
            rows = [(*open_.closed(own), None, None, None)] if open_ else []
            blank = (None,) * 3
            rows.append((None, None, None, first[1].astype(">u2").tobytes(), *blank, task, None, first[0]))
            rows.append((before[0], None, None, None, *blank, None, task, before[1]))
            yield out(rows)

    rows = pick(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("text").alias("print"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("print").asc_nulls_last()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    done = settle(ordered.mapInArrow(run, f"{row}, {wait}"), "fingerprints")
    heads = done.where("task is not null").select("task", F.col("text").alias("next_text"), F.col("own").alias("next_print"))
    tasks = sorted(row.task for row in heads.select("task").collect())  # one per task that has rows
    after = dict(zip(tasks, [*tasks[1:], *tasks[:1]]))
    follows = docs.sparkSession.createDataFrame(list(after.items()), "waits_for int, task int")
    tails = done.where("waits_for is not null").select("doc_id", "text", "waits_for").join(F.broadcast(follows), "waits_for").join(heads, "task")

    def last(batches):
        for batch in batches:
            rows = [
                _Open(doc_id, text, following, s).closed(np.frombuffer(print_, ">u2"))
                for doc_id, text, following, print_ in zip(*[c.to_pylist() for c in batch.columns])
            ]
            if rows:
                yield out(rows)

    ends = tails.select("doc_id", "text", "next_text", "next_print").mapInArrow(last, row)
    whole = done.where("task is null and waits_for is null").select(*names[:7]).unionByName(ends)
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("own")).alias("fingerprint"), F.lower(F.hex("changed")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
