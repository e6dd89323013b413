"""Toxicity from confirmed toxic examples and unlabelled text: non-negative positive-unlabelled learning in numpy."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import pick, settle, unit_hash

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and of the model.

    At most `max_positive` different texts of confirmed toxic rows and about
    `max_unlabelled` (never more than 1.2 times that) of all usable rows are
    learned from, chosen by hash, each with the number of its rows as weight; at most `max_features` features that
    occur in `min_rows` toxic rows and whose presence alone would make a text
    toxic with a probability of `min_precision`, going by the prior. `prior` is
    the share of toxic text; None takes it from the labels that may be used.
    Word beginnings of the lengths `prefixes` are features by how many distinct
    words of the text have them, from `levels` on. `slack` is how far below 0 the
    risk of clean text may be estimated before a step turns round, `penalty`
    keeps weights small, `threshold` decides `predicted`.
    """

    max_positive: int = 4000
    max_unlabelled: int = 12000
    max_features: int = 20000
    min_rows: int = 4
    min_precision: float = 0.5
    prefixes: tuple[int, ...] = (4, 5, 6)
    levels: tuple[int, ...] = (1, 2, 4)
    prior: float | None = None
    slack: float = 0.05
    penalty: float = 0.3
    steps: int = 400
    rate: float = 0.05
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float


def features(text: str, prefixes: tuple[int, ...], levels: tuple[int, ...]) -> set[str]:
    """The distinct words of the whole text in lower case, and `^beginning+n` where n distinct words begin so."""
    words = set(_WORD.findall(text.lower()))
    begin = Counter(w[:k] for w in words for k in prefixes if len(w) >= k)
    return words | {f"^{p}+{level}" for p, n in begin.items() for level in levels if n >= level}


def risk_gradient(scores: np.ndarray, positive: np.ndarray, weight: np.ndarray, prior: float, slack: float) -> np.ndarray:
    """Gradient of the non-negative risk with logistic loss by each row's score; `weight` is how many rows a row stands for.

    Risk: prior * (loss of positives as toxic) + max(0, loss of unlabelled as
    clean - prior * loss of positives as clean). Where the bracket falls below
    -slack, the step goes the other way on it, which undoes over-fitting.
    """
    p = 1 / (1 + np.exp(-scores))
    share = np.where(positive, weight / max(1, weight[positive].sum()), weight / max(1, weight[~positive].sum()))
    clean_loss = np.logaddexp(0, scores) * share
    bracket = clean_loss[~positive].sum() - prior * clean_loss[positive].sum()
    as_clean = np.where(positive, -prior * p, p) * share
    if bracket < -slack:
        return -as_clean
    return as_clean + np.where(positive, prior * (p - 1) * share, 0.0)


def fit(rows: list[tuple[bool, int, list[int]]], names: list[str], prior: float, settings: Settings = Settings()) -> Model:
    """A linear model over rows of (confirmed toxic, weight, indices into `names`).

    Rows with the same features are one row of their weights together, which
    changes neither the risk nor its shares. The order of the rows does not matter.
    """
    merged: Counter = Counter()
    for toxic, weight, found in rows:
        merged[toxic, tuple(sorted(found))] += weight
    kinds = sorted(merged)
    y, weight = np.array([toxic for toxic, _ in kinds], bool), np.array([merged[kind] for kind in kinds], float)
    at = np.repeat(np.arange(len(kinds)), [len(found) for _, found in kinds])
    column = np.fromiter((c for _, found in kinds for c in found), np.int64)
    prior = min(max(prior, 1e-4), 0.5)
    params = np.zeros(len(names) + 1)
    params[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, settings.steps + 1 if y.any() else 1):
        scores = np.bincount(at, params[column], len(kinds)) + params[-1]
        g = risk_gradient(scores, y, weight, prior, settings.slack)
        grad = np.append(np.bincount(column, g[at], len(names)) + settings.penalty * params[:-1] / len(names), g.sum())
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        params -= settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(dict(zip(names, params[:-1].tolist())), float(params[-1]))


def held_out(fourth: int = 2, of: int = 4) -> Column:
    """Whether crc32 of the id as text leaves `fourth`; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == fourth, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, usable: Column, settings: Settings = Settings()) -> Model | None:
    """A model from the rows where `usable` holds; None without a confirmed toxic row.

    Only ids of the bounded positive sample are broadcast. Feature counts are
    aggregated in Spark; the driver sees the chosen features and, per text of
    the sample, their indices: as many rows as the bounds say, however often an
    id or a text is repeated.
    """
    known = pick(labels, "doc_id", "toxic").where(usable & F.col("toxic").isNotNull())
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not share:
        return None
    prior = settings.prior if settings.prior is not None else share
    toxic = known.where("toxic = 1").select("doc_id").distinct()
    chosen = toxic.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_positive)
    usable_docs = pick(docs, "doc_id", "text").where(usable & F.col("text").isNotNull())
    n = usable_docs.select("doc_id").count()
    rate = min(1.0, settings.max_unlabelled / max(1, n))
    drawn = usable_docs.where(unit_hash(F.lit("unlabelled"), "doc_id", "text") < rate)
    sample = settle(
        _texts(usable_docs.join(F.broadcast(chosen), "doc_id", "left_semi"), True, settings.max_positive)
        .unionByName(_texts(drawn, False, settings.max_unlabelled * 6 // 5)),
        "toxicity-sample",
    )
    sizes = {row.toxic: row.n for row in sample.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos:
        return None

    def named(batches):
        for batch in batches:
            for toxic, text, weight in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                found = pa.array(list(features(text.as_py(), settings.prefixes, settings.levels)), pa.string())
                counts = [pa.array([weight * of] * len(found), pa.int64()) for of in (toxic, not toxic)]
                yield pa.RecordBatch.from_arrays([found, *counts], ["feature", "toxic", "drawn"])

    counts = sample.mapInArrow(named, "feature string, toxic long, drawn long").groupBy("feature").agg(
        F.sum("toxic").alias("p"), F.sum("drawn").alias("u")
    )
    precision = prior * (F.col("p") / n_pos) / ((F.col("u") + 1) / (n_unl + 1))
    best = (
        counts.where((F.col("p") >= settings.min_rows) & (precision >= settings.min_precision))
        .orderBy(F.desc("p"), "feature")
        .limit(settings.max_features)
    )
    names = sorted(r.feature for r in best.select("feature").collect())
    place = {name: i for i, name in enumerate(names)}

    def indexed(batches):
        for batch in batches:
            found = [
                [place[f] for f in features(t.as_py(), settings.prefixes, settings.levels) if f in place] for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["toxic", "weight", "found"]
            )

    rows = sample.mapInArrow(indexed, "toxic boolean, weight long, found array<int>").collect()
    return fit([(r.toxic, r.weight, r.found) for r in rows], names, prior, settings)


def _texts(rows: DataFrame, toxic: bool, most: int) -> DataFrame:
    """The different texts among `rows`, at most `most` by hash, each with the number of its rows.

    Copies are counted by hash before the shuffle; the texts follow for those chosen only.
    """
    prints = rows.select(F.xxhash64("text").alias("print"), "text")
    counts = prints.groupBy("print").agg(F.count("*").alias("weight"))
    chosen = counts.orderBy(F.xxhash64("print"), "print").limit(most)
    texts = prints.join(F.broadcast(chosen), "print").dropDuplicates(["print"])
    return texts.select(F.lit(toxic).alias("toxic"), "text", "weight")


def score(docs: DataFrame, model: Model | None, held: Column, settings: Settings = Settings()) -> DataFrame:
    """Per row of `docs` (doc_id, text): probability of being toxic from the whole text, and the decision.

    A null text counts as empty: it gets the score of a text without any known
    feature. Without a model all scores are 0. Repeated rows and null ids are
    scored like any other, further columns are left out. No shuffle.
    """
    weights, bias = (model.weights, model.bias) if model else ({}, -np.inf)
    words = {f: w for f, w in weights.items() if not f.startswith("^")}
    starts: dict[str, list[tuple[int, float]]] = {}
    for f, w in weights.items():
        if f.startswith("^"):
            begin, level = f[1:].split("+")
            starts.setdefault(begin, []).append((int(level), w))

    def total(text: str) -> float:
        found = set(_WORD.findall(text.lower()))
        hits = [words[w] for w in found if w in words]
        begin = Counter(p for k in settings.prefixes for p in (w[:k] for w in found) if p in starts and len(p) == k)
        hits += [w for p, n in begin.items() for level, w in starts[p] if n >= level]
        return bias + sum(sorted(hits))

    def run(batches):
        for batch in batches:
            sums = np.array([total(t.as_py() or "") for t in batch.column("text")])
            scores = 1 / (1 + np.exp(-np.clip(sums, -700, 700))) if model else np.zeros(len(sums))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("_held"), pa.array(scores, pa.float64()),
                 pa.array((scores >= settings.threshold).astype(np.int32), pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = pick(docs.withColumn("_held", held), "doc_id", "_held", "text")
    return rows.mapInArrow(run, SCHEMA)


def detect(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learns from the rows that are not held out and scores every row; see `learn` and `score`."""
    docs = pick(docs, "doc_id", "text")
    return score(docs, learn(docs, labels, ~held_out(), settings), held_out(), settings)
