"""Quality by compression: texts that zstandard shrinks too well or hardly at all are rejected."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from feedmart.llm.common import WORD, pick

_WORD = re.compile(WORD)
# Texts are taken apart in pieces of whole words or lines, so that not all words of a long text are held at once.
_UP_TO_SPACE = re.compile(rf"(?s:.{{1,65536}})(?:{WORD})?")
_UP_TO_LINE_END = re.compile(r"(?s:.{1,65536})[^\n]*")
_SPACE = " \t\n\v\f\r"  # all that parts words
_SYMBOLS = "#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, lowest_chunk double, highest_chunk double, bad_chunks long, chunks long"
)


@dataclass(frozen=True)
class Limits:
    """Compressed over raw bytes that a text of up to `up_to` bytes may have."""

    up_to: float
    low: float
    high: float


@dataclass(frozen=True)
class Bands:
    """Limits for whole texts by length and for chunks of `chunk` bytes; at most `bad_share` of the chunks may miss theirs."""

    whole: tuple[Limits, ...] = (
        Limits(512, 0.35, 1.10),
        Limits(1024, 0.30, 0.95),
        Limits(4096, 0.25, 0.80),
        Limits(16384, 0.20, 0.72),
        Limits(float("inf"), 0.16, 0.68),
    )
    chunk: int = 4096
    chunk_low: float = 0.2
    chunk_high: float = 0.72
    bad_share: float = 0.5
    level: int = 3


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """How many places lie inside windows of three that occur twice."""
    if len(ids) < 4:
        return 0
    if distinct < 1 << 21:  # three numbers fit into one
        windows = (ids[:-2].astype(np.int64) * distinct + ids[1:-1]) * distinct + ids[2:]
    else:
        pairs = ids[:-2].astype(np.int64) * distinct + ids[1:-1]
        windows = np.searchsorted(np.unique(pairs), pairs) * distinct + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    starts = np.zeros(len(windows), bool)
    starts[order[1:][same]] = starts[order[:-1][same]] = True
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k : k + len(starts)] |= starts
    return int(inside.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words inside repeated windows of three words.

    Each different word and line is held once; places are numbers in arrays.
    """
    seen: dict[str, int] = defaultdict()
    seen.default_factory = seen.__len__
    ids = [np.fromiter(map(seen.__getitem__, _WORD.findall(piece)), np.int32) for piece in _UP_TO_SPACE.findall(text)]
    ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    word_chars = len(text) - sum(map(text.count, _SPACE))
    symbols = sum(map(text.count, _SYMBOLS))
    lines, different = 0, set()
    for piece in _UP_TO_LINE_END.findall(text) if "\n" in text else ():
        some = [line for line in piece.split("\n") if line.strip(_SPACE)]
        lines += len(some)
        different.update(some)
    return len(ids), word_chars, symbols, lines - len(different), _repeated(ids, len(seen))


def judge(raw: bytes, bands: Bands, zstd: zstandard.ZstdCompressor) -> tuple[bool, float, float, float, int, int]:
    """In the bands or not, whole ratio, lowest and highest chunk ratio, chunks outside their band, chunks."""
    if not raw:
        return False, 0.0, 0.0, 0.0, 0, 0
    ratio = len(zstd.compress(raw)) / len(raw)
    limits = next(x for x in bands.whole if len(raw) <= x.up_to)
    size = bands.chunk
    # Chunks have one size, so one band fits all; the last one ends where the text ends. A shorter text is its own chunk.
    starts = [*range(0, len(raw) - size, size), len(raw) - size] if len(raw) > size else []
    ratios = [len(zstd.compress(raw[s : s + size])) / size for s in starts]
    bad = sum(not bands.chunk_low <= r <= bands.chunk_high for r in ratios)
    inside = limits.low <= ratio <= limits.high and bad <= bands.bad_share * len(ratios)
    return inside, ratio, min(ratios, default=ratio), max(ratios, default=ratio), bad, len(ratios)


def compression_bands(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per row of `docs` (doc_id, text): base counts, ratios, and whether the text is kept.

    A text fails the base if it has under 50 words or more than half of its
    words stand in three-word windows that occur twice. A null text counts as
    empty: no words, not kept. Repeated rows are judged each for itself, a null
    id is carried through, other columns are not. Rows are judged one by one
    over their whole text: no shuffle.
    """

    def run(batches):
        zstd = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                counts = base_counts(text)
                failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
                inside, *ratios = judge(text.encode(), bands, zstd)
                out.append((doc_id, *counts, failed, inside and not failed, *ratios))
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield _batch(out, names)

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 3 + [pa.int64()] * 2
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
