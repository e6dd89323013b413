"""Language identification by a convolutional network over bytes, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import blocks, pick, unit_hash

UNKNOWN = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
_PAD = 256  # the symbol behind a text's end


@dataclass(frozen=True)
class Settings:
    """Size of the network and of its training sample.

    At most `max_languages` languages (the most frequent ones) are learned from
    about `per_language` documents each and never more than 1.2 times that in
    all; one window is taken of each, at a place chosen by hash.
    """

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embedding: int = 8
    per_language: int = 2000
    max_languages: int = 64
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    """Embedding, one filter bank per width, and the output layer."""

    languages: list[str]
    widths: tuple[int, ...]
    window: int
    embedding: np.ndarray  # (257, E)
    banks: list[np.ndarray] = field(default_factory=list)  # (width, E, F) each
    biases: list[np.ndarray] = field(default_factory=list)  # (F,) each
    out: np.ndarray | None = None  # (banks * F, languages)
    out_bias: np.ndarray | None = None

    def tables(self) -> list[list[np.ndarray]]:
        """For each place under each filter bank, what each byte adds: convolution becomes adding table rows."""
        return [[self.embedding @ place for place in bank] for bank in self.banks]

    def kernel(self) -> np.ndarray:
        """All filters as one matrix from `max(widths)` embedded bytes to filters; narrower ones end in zeros."""
        longest = max(self.widths)
        full = [np.pad(bank, ((0, longest - len(bank)), (0, 0), (0, 0))) for bank in self.banks]
        return np.concatenate([bank.reshape(-1, bank.shape[2]) for bank in full], axis=1).astype(np.float32)


def windows(text: str, size: int) -> np.ndarray:
    """The whole text in lower case as rows of `size` bytes, the last one padded."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(raw) // size))
    out = np.full(rows * size, _PAD, np.int16)
    out[: len(raw)] = raw
    return out.reshape(rows, size)


def pooled(net: Network, tables, x: np.ndarray):
    """Max over all places of each filter, after the bias, and where the maxima are; for training."""
    found, at = [], []
    steps = x.shape[1] - max(net.widths) + 1
    for bank, bias in zip(tables, net.biases):
        total = bank[0][x[:, :steps]]
        for j in range(1, len(bank)):
            total += bank[j][x[:, j : j + steps]]
        found.append(total.max(axis=1) + bias)
        at.append(total.argmax(axis=1))
    return np.concatenate(found, axis=1), at


def probabilities(net: Network, kernel: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The same forward pass as one matrix product over embedded neighbourhoods; `kernel` from `net.kernel()`."""
    size = net.embedding.shape[1]
    embedded = np.take(net.embedding, x, axis=0).reshape(len(x), -1)
    around = np.lib.stride_tricks.sliding_window_view(embedded, len(kernel), axis=1)[:, ::size]
    total = np.ascontiguousarray(around).reshape(-1, len(kernel)) @ kernel
    hidden = total.reshape(len(x), -1, kernel.shape[1]).max(axis=1) + np.concatenate(net.biases)
    return _softmax(np.maximum(hidden, 0) @ net.out + net.out_bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], settings: Settings = Settings()) -> Network | None:
    """A network trained on one window per text; None without texts. The order of the texts does not matter."""
    if not texts:
        return None
    order = sorted(range(len(texts)), key=lambda i: (labels[i], texts[i]))
    languages = sorted(set(labels))
    rng = np.random.default_rng(settings.seed)
    scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
    net = Network(languages, settings.widths, settings.window, rng.normal(0, 0.5, (257, settings.embedding)).astype(np.float32))
    for width in settings.widths:
        net.banks.append(scale(width, settings.embedding, settings.filters))
        net.biases.append(np.zeros(settings.filters, np.float32))
    net.out = scale(len(settings.widths) * settings.filters, len(languages))
    net.out_bias = np.zeros(len(languages), np.float32)
    x = np.stack([windows(texts[i], settings.window)[0] for i in order])
    y = np.array([languages.index(labels[i]) for i in order])
    weight = len(y) / (len(languages) * np.bincount(y, minlength=len(languages)))  # languages count alike
    params = [net.embedding, *net.banks, *net.biases, net.out, net.out_bias]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    step = 0
    for _ in range(settings.epochs):
        shuffled = rng.permutation(len(y))
        for start in range(0, len(y), settings.batch):
            rows = shuffled[start : start + settings.batch]
            step += 1
            for p, g, m, v in zip(params, _gradients(net, x[rows], y[rows], weight), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Of the mean weighted cross entropy, in the order of the parameters."""
    tables = net.tables()
    hidden, at = pooled(net, tables, x)
    active = np.maximum(hidden, 0)
    error = _softmax(active @ net.out + net.out_bias)
    error[np.arange(len(y)), y] -= 1
    error *= (weight[y] / len(y))[:, None].astype(np.float32)
    back = (error @ net.out.T) * (hidden > 0)
    embedding, banks, biases = np.zeros_like(net.embedding), [], []
    rows = np.arange(len(y))[:, None]
    filters = net.banks[0].shape[2]
    column = np.arange(filters)[None, :]
    for k, bank in enumerate(net.banks):
        part = back[:, k * filters : (k + 1) * filters]
        grads = []
        for j, place in enumerate(bank):
            table = np.zeros((257, filters), np.float32)
            np.add.at(table, (x[rows, at[k] + j], np.broadcast_to(column, part.shape)), part)
            grads.append(net.embedding.T @ table)
            embedding += table @ place.T
        banks.append(np.stack(grads))
        biases.append(part.sum(axis=0))
    return [embedding, *banks, *biases, active.T @ error, error.sum(axis=0)]


def training_sample(docs: DataFrame, usable: Column, settings: Settings = Settings()) -> tuple[list[str], list[str]]:
    """Window texts and labels of a bounded sample of the rows where `usable` holds and a label is present.

    The share taken of each language follows from its count, so frequent and
    rare languages give about as many rows. Only the windows leave the tasks.
    """
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = docs.where(usable & F.col("lang").isNotNull())
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.max_languages).collect()
    if not counts:
        return [], []
    draw = unit_hash(F.lit("draw"), "doc_id", "lang")
    share = F.lit(0.0)
    for lang, n in counts:
        share = F.when(F.col("lang") == lang, min(1.0, settings.per_language / n)).otherwise(share)
    longest = F.greatest(F.length("text") - settings.window, F.lit(0))
    place = F.floor(unit_hash(F.lit("place"), "doc_id") * (longest + 1)).cast("int") + 1
    taken = (
        rows.withColumn("_draw", draw)
        .where(F.col("_draw") < share)
        .select("_draw", "lang", F.substring(F.col("text"), place, F.lit(settings.window)).alias("part"))
        .orderBy("_draw", "lang", "part")
        .limit(int(1.2 * settings.per_language * len(counts)))
        .select("lang", "part")
        .toPandas()
    )
    return taken["part"].tolist(), taken["lang"].tolist()


def predict(docs: DataFrame, net: Network | None, held_out: Column) -> DataFrame:
    """Per row of `docs` (doc_id, text): the language whose probability, averaged over all bytes, is highest, and that average.

    Every byte of a text lies in a window. A text that is null or has no letter,
    and any text if nothing could be learned, is `und` with score 0. Ties go to
    the first language by name. Repeated rows and null ids are returned like any
    other, further columns are left out. No shuffle.
    """
    kernel = net.kernel() if net else None

    def run(batches):
        for batch in batches:
            ids, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            langs, scores = [], []
            for part in blocks([t.as_py() for t in batch.column(2)], lambda t: len(t or ""), 1 << 16):
                for lang, score in _judge(part, net, kernel):
                    langs.append(lang)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = pick(docs.withColumn("_held", held_out), "doc_id", "_held", "text")
    return rows.mapInArrow(run, SCHEMA)


_ROWS = 64  # windows at a time: the work arrays stay within the processor's cache


def _judge(texts: list[str | None], net: Network | None, kernel) -> list[tuple[str, float]]:
    judged = [net is not None and t is not None and any(map(str.isalpha, t)) for t in texts]
    if not any(judged):
        return [(UNKNOWN, 0.0)] * len(texts)
    cut = [windows(t, net.window) for t, ok in zip(texts, judged) if ok]
    x = np.concatenate(cut)
    p = np.concatenate([probabilities(net, kernel, x[i : i + _ROWS]) for i in range(0, len(x), _ROWS)]).astype(np.float64)
    bytes_in = (x != _PAD).sum(axis=1)
    starts = np.cumsum([0, *(len(c) for c in cut[:-1])])
    mean = np.add.reduceat(p * bytes_in[:, None], starts) / np.add.reduceat(bytes_in, starts)[:, None]
    found = iter([(net.languages[i], float(min(1.0, m[i]))) for m, i in zip(mean, mean.argmax(axis=1))])
    return [next(found) if ok else (UNKNOWN, 0.0) for ok in judged]


def held_out(third: int = 1, of: int = 3) -> Column:
    """Whether crc32 of the id as text leaves `third`; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == third, F.lit(False))


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learns from the labelled rows that are not held out and predicts every row; see `predict`.

    A null `lang` is never learned. With one language only, every text with a
    letter is of that language.
    """
    docs = pick(docs, "doc_id", "text", "lang")
    net = fit(*training_sample(docs, ~held_out(), settings), settings)
    return predict(docs, net, held_out())


def keep_known(docs: DataFrame, min_score: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs` whose language is known, with all columns.

    Rejected are texts that are null or have no letter, and those whose best
    language scores below `min_score`; learning is that of `identify`. If
    nothing can be learned, only texts without a letter are rejected.
    """
    net = fit(*training_sample(pick(docs, "doc_id", "text", "lang"), ~held_out(), settings), settings)
    kernel = net.kernel() if net else None

    def run(batches):
        for batch in batches:
            keep = []
            texts = [t.as_py() for t in batch.column(batch.schema.names.index("text"))]
            for part in blocks(texts, lambda t: len(t or ""), 1 << 16):
                if net is None:
                    keep += [t is not None and any(map(str.isalpha, t)) for t in part]
                else:
                    keep += [lang != UNKNOWN and score >= min_score for lang, score in _judge(part, net, kernel)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
