"""Near duplicates: b-bit MinHash signatures, a multi-index Hamming join, and exact confirmation on whole shingle sets."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import pick, settle
from feedmart.llm.components import components

RESULT = "doc_id long, n_shingles long, component_id long, kept boolean"


@dataclass(frozen=True)
class Settings:
    """Shingles of `shingle` words, linked from `percent` of the union on.

    A signature has `chunks` x `chunk_hashes` MinHash values of `bits` bits.
    Two signatures that differ in fewer than `chunks * (errors + 1)` values
    differ in at most `errors` values of some chunk; each chunk is indexed once
    for every way of leaving out `errors` of its values, so all such pairs meet.
    With the defaults that is a distance of 19 of 60, and a pair that shares 80
    of 100 shingles meets with a probability above 0.9999, nearer ones more
    surely: the distance is no upper limit.

    The rest only steers the work, not the result (see `_joined`): up to which
    size all pairs of a bucket are tried at once, and in how many texts a shingle
    is rare.
    """

    shingle: int = 2
    percent: int = 80
    chunks: int = 10
    chunk_hashes: int = 6
    errors: int = 1
    bits: int = 16
    seed: int = 11
    small_bucket: int = 16
    rare: int = 32


# --- shingle sets -----------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SEGMENT = 1 << 18
_CUT = re.compile(rb"[\x20\x09-\x0D]")


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    step = np.full(n, base)
    back = np.full(n, inverse)
    step[0] = back[0] = 1
    return np.multiply.accumulate(step), np.multiply.accumulate(back)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text, in order; bytes are lower-cased already."""
    parts, at = [], 0
    while at < len(raw):
        end = at + _SEGMENT
        if end < len(raw):  # long texts go piece by piece, cut at white space
            cut = _CUT.search(raw, end)
            end = cut.start() if cut else len(raw)
        data = np.frombuffer(raw, np.uint8, min(end, len(raw)) - at, at)
        edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        step, back = _powers(1 << max(19, len(data).bit_length()))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * step[: len(data)])))
        value = (total[ends] - total[starts]) * back[starts]
        parts.append(_mix(value ^ (ends - starts).astype(np.uint64)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """The distinct shingles of `n` words as sorted 64-bit hashes; fewer words are one shingle, none are no shingle."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(words):
        return words
    if len(words) < n:
        words = np.concatenate((words, np.full(n - len(words), len(words), np.uint64)))
    shingles = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        shingles = _mix(shingles * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - n + 1 + i])
    return np.unique(shingles)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the intersection is at least `percent` of a hundred of the union."""
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


# --- signatures and their index ---------------------------------------------------------------


@lru_cache(maxsize=4)
def _constants(s: Settings) -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(s.seed)
    draw = lambda *shape: rng.integers(0, 1 << 63, shape, np.uint64) * np.uint64(2) + np.uint64(1)
    kept = s.chunk_hashes - s.errors
    chosen = list(combinations(range(s.chunk_hashes), kept))
    places = np.array([[c * s.chunk_hashes + i for i in places] for c in range(s.chunks) for places in chosen])
    n = s.chunks * s.chunk_hashes
    return draw(n), draw(n), places, draw(*places.shape), draw(len(places))


def signature(shingles: np.ndarray, s: Settings) -> np.ndarray:
    """The low `bits` bits of the smallest value of every hash function over the set."""
    factor, shift, *_ = _constants(s)
    least = np.full(len(factor), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 1 << 11):
        least = np.minimum(least, (shingles[at : at + (1 << 11), None] * factor + shift).min(axis=0))
    return (_mix(least) & np.uint64((1 << s.bits) - 1)).astype(np.uint16 if s.bits <= 16 else np.uint32)


def index_keys(signatures: np.ndarray, s: Settings) -> np.ndarray:
    """One key per signature, chunk and choice of values left out."""
    *_, places, factor, shift = _constants(s)
    return _mix((signatures.astype(np.uint64)[:, places] * factor).sum(axis=2, dtype=np.uint64) + shift)


def _signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """Per row its number of shingles, hashes of its text and of all its columns, a key of its set, and the set's signature; no key if it cannot be linked."""

    def run(batches):
        for batch in batches:
            rows, seen = [], {}
            for doc_id, text, *hashes in zip(batch.column(0).to_pylist(), batch.column(1), *(batch.column(i).to_pylist() for i in (2, 3))):
                found = shingle_set(text.as_py(), s.shingle)
                if not len(found) or doc_id is None:
                    rows.append((doc_id, len(found), *hashes, None, None))
                    continue
                key = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                if key not in seen:
                    seen[key] = signature(found, s).tobytes()
                rows.append((doc_id, len(found), *hashes, key, seen[key]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            columns = list(zip(*rows)) or [()] * 6
            names = ["doc_id", "n_shingles", "print", "whole", "set_key", "signature"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return _hashed(docs).mapInArrow(run, "doc_id long, n_shingles long, print long, whole long, set_key binary, signature binary")


def _hashed(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id and text with a hash of the text and one of the whole row; and with the columns `keep` of the numbered frame."""
    numbered = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    doc_id, text = (F.col(f"_{docs.columns.index(name)}") for name in ("doc_id", "text"))
    hashes = F.xxhash64(text).alias("print"), F.xxhash64(*[F.to_json(F.struct(c)) if _nested(numbered, c) else F.col(c) for c in numbered.columns]).alias("whole")
    return numbered.select(doc_id.alias("doc_id"), text.alias("text"), *hashes, *keep)


def _nested(df: DataFrame, name: str) -> bool:
    return "map<" in df.schema[name].dataType.simpleString()  # maps have no hash


def _index(classes: DataFrame, s: Settings) -> DataFrame:
    """(key, node): every class under each of its keys."""

    def run(batches):
        for batch in batches:
            nodes, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for at in range(0, len(nodes), 512):
                kind = np.uint16 if s.bits <= 16 else np.uint32
                some = np.stack([np.frombuffer(x, kind) for x in raw[at : at + 512]])
                keys = index_keys(some, s).view(np.int64)
                node = np.repeat(nodes[at : at + 512], keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node, pa.int64())], ["key", "node"])

    return classes.select("node", "signature").mapInArrow(run, "key long, node long")


# --- confirming and joining up ----------------------------------------------------------------


def _confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Those pairs (a, b) of nodes whose whole sets are linked."""
    fits = 100 * F.least("n_a", "n_b") >= s.percent * F.greatest("n_a", "n_b")
    sides = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("text").alias("text_a")), "a")
        .where(fits)
    )

    def run(batches):
        a_before, a_set = None, None
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep = np.zeros(len(a), bool)
            for i, (a_id, a_text, b_text) in enumerate(zip(a.to_pylist(), batch.column(2), batch.column(3))):
                text = a_text.as_py()
                if (a_id, text) != a_before:
                    a_before, a_set = (a_id, text), shingle_set(text, s.shingle)
                keep[i] = linked(a_set, shingle_set(b_text.as_py(), s.shingle), s.percent)
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep))

    return sides.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _joined(docs: DataFrame, classes: DataFrame, met: DataFrame, s: Settings) -> DataFrame:
    """Components of the classes that met under a key; exact, without the pairs of a group.

    First every bucket is tried around its smallest node. Of the buckets that
    then still hold several components, small ones are tried pair by pair. Large
    ones are near copies too far from each other, or texts that share a passage:

    - A shingle found in few texts (`rare`) makes pairs of exactly these texts.
    - Any other link across components can only use shingles that are neither
      rare nor confined to one component. A text with too few of them for the
      smallest text of its bucket needs no further try there.
    - The texts left are tried around the one that has most of such shingles.
    - Those then still outside the main component of their buckets are tried
      against every text for which they have enough of such shingles.

    A pair that is never tried is in one component already or cannot be linked.
    """
    nodes = met.select("node").distinct()
    wanted = classes.join(nodes, "node", "left_semi").select("node", "doc_id", "print", "n_shingles")
    rows = pick(docs, "doc_id", "text").where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("print"), "text")
    texts = settle(rows.join(wanted, ["doc_id", "print"]).dropDuplicates(["node"]), "near-texts").select("node", "n_shingles", "text")

    def tried(pairs: DataFrame, groups: DataFrame | None) -> DataFrame:
        found = _confirmed(pairs.distinct(), texts, s)
        if groups is not None:
            found = found.unionByName(groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")))
        return components(settle(found, "near-edges"))

    groups = tried(met.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")), None)
    sizes = texts.groupBy("node").agg(F.max("n_shingles").alias("n"))
    left = settle(_mixed(met.select("key", "node"), groups).join(sizes, "node"), "near-open")
    small = _across(left.where(F.col("size") <= s.small_bucket), s)
    large = left.where(F.col("size") > s.small_bucket).select("key", "node", "part", "n")
    if large.isEmpty():
        return groups if left.isEmpty() else tried(small, groups)
    spare = _spare(texts, large.select("node", "part").distinct(), s)
    used = spare.groupBy("node").agg(F.count("*").alias("spare"))
    common = F.col("n") - F.coalesce("spare", F.lit(0))
    info = settle(large.select("node", "n").distinct().join(used, "node", "left").select("node", "n", common.alias("common")), "near-common")
    least = large.groupBy("key").agg(F.min("n").alias("least"))
    able = settle(
        large.drop("n").join(least, "key").join(info, "node")
        .where(_enough(F.col("common"), F.col("n") + F.greatest("least", F.ceil(s.percent * F.col("n") / 100)), s))
        .select("key", "node", (F.col("common") / F.col("n")).alias("centre")),
        "near-able",
    )
    star = able.groupBy("key").agg(F.max_by("node", F.struct("centre", "node")).alias("a"))
    around = settle(able.join(star, "key").select("a", F.col("node").alias("b")).distinct(), "near-stars")
    part = groups.select("node", "component")
    across = (
        around.join(part.toDF("a", "part_a"), "a", "left").join(part.toDF("b", "part_b"), "b", "left")
        .where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")
    )
    groups = tried(small.unionByName(_rare_pairs(spare, info, s)).unionByName(across), groups)
    open_ = _mixed(able.select("key", "node"), groups).select("node", "part").distinct()
    outside = settle(_outside(open_, around, info, s), "near-outside")
    return groups if outside.isEmpty() else tried(outside, groups)


def _enough(common, sizes, s: Settings):
    """Whether so many common shingles can be `percent` of the union of two sets with so many shingles together."""
    return (100 + s.percent) * common >= s.percent * sizes


def _mixed(met: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of `met` under keys that hold several components, with their component `part` and the key's `size`."""
    known = met.join(groups, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    keys = known.groupBy("key").agg(F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high"))
    return known.join(keys.where("low < high").select("key", "size"), "key")


def _across(state: DataFrame, s: Settings) -> DataFrame:
    """All pairs of nodes of different components under one key whose sizes allow a link."""
    a = state.select("key", F.col("node").alias("a"), F.col("part").alias("part_a"), F.col("n").alias("n_a"))
    b = state.select("key", F.col("node").alias("b"), F.col("part").alias("part_b"), F.col("n").alias("n_b"))
    fits = 100 * F.least("n_a", "n_b") >= s.percent * F.greatest("n_a", "n_b")
    return a.join(b, "key").where((F.col("part_a") < F.col("part_b")) & fits).select("a", "b").distinct()


def _spare(texts: DataFrame, parts: DataFrame, s: Settings) -> DataFrame:
    """(shingle, node, part, shared): per node the shingles that are rare or confined to its component; shared if not confined.

    Shingles are counted before they are shuffled, so one that all texts have
    is one row per task.
    """

    def run(batches):
        for batch in batches:
            for node, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = shingle_set(text.as_py(), s.shingle).view(np.int64)
                of = pa.array(np.full(len(found), node)), pa.array(np.full(len(found), part))
                yield pa.RecordBatch.from_arrays([*of, pa.array(found)], ["node", "part", "shingle"])

    rows = texts.join(parts, "node").select("node", "part", "text").mapInArrow(run, "node long, part long, shingle long")
    rows = settle(rows, "near-shingles")
    counts = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high"))
    spare = counts.where((F.col("n") <= s.rare) | (F.col("low") == F.col("high")))
    return settle(rows.join(spare.select("shingle", (F.col("low") < F.col("high")).alias("shared")), "shingle"), "near-spare")


def _rare_pairs(spare: DataFrame, info: DataFrame, s: Settings) -> DataFrame:
    """Pairs across components that share rare shingles, enough of them together with the common ones."""
    some = spare.where("shared")
    a = some.select("shingle", F.col("node").alias("a"), F.col("part").alias("part_a"))
    b = some.select("shingle", F.col("node").alias("b"), F.col("part").alias("part_b"))
    both = a.join(b, "shingle").where("part_a < part_b").groupBy("a", "b").agg(F.count("*").alias("rare"))
    sided = both.join(info.toDF("a", "n_a", "common_a"), "a").join(info.toDF("b", "n_b", "common_b"), "b")
    most = F.least("common_a", "common_b") + F.col("rare")
    return sided.where(_enough(most, F.col("n_a") + F.col("n_b"), s)).select("a", "b")


def _outside(nodes: DataFrame, around: DataFrame, info: DataFrame, s: Settings) -> DataFrame:
    """Pairs of nodes (node, part) outside the main component of their buckets with all nodes of others they may be linked with.

    Buckets that share nodes are one block, so a pair comes up once and not
    under each key. Within a block, nodes are looked up by size: the sizes that
    a node has enough common shingles for are few.
    """
    block = components(around).select("node", F.col("component").alias("block"))
    rows = nodes.join(block, "node").join(info, "node")
    main = rows.groupBy("block", "part").count().groupBy("block").agg(F.max_by("part", F.struct("count", "part")).alias("main"))
    low = F.ceil(s.percent * F.col("n") / 100)
    high = F.least(F.floor(100 * F.col("n") / s.percent), F.floor((100 + s.percent) * F.col("common") / s.percent) - F.col("n"))
    probes = rows.join(main, "block").where((F.col("part") != F.col("main")) & (high >= low)).select(
        "block", F.col("node").alias("a"), F.col("part").alias("part_a"), F.col("n").alias("n_a"), F.explode(F.sequence(low, high)).alias("n_b")
    )
    others = rows.select("block", F.col("node").alias("b"), F.col("part").alias("part_b"), F.col("n").alias("n_b"), F.col("common").alias("common_b"))
    pairs = probes.join(others, ["block", "n_b"]).where(
        (F.col("part_a") != F.col("part_b")) & _enough(F.col("common_b"), F.col("n_a") + F.col("n_b"), s)
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per row of `docs` (doc_id, text): size of its shingle set, smallest doc_id of its component, whether it is that one.

    A-Z are lower-cased; words are runs without ASCII white space. Texts with
    equal sets are one class and never expanded into pairs. A text without words
    (null, empty) and a row without doc_id are linked with nothing: their
    component is their own doc_id and they are kept. Classes are told apart by
    their sets and not by ids, so rows that repeat a doc_id with another text go
    each by its own set, and ids tie no texts together. Sets hold 64-bit hashes
    of shingles. Further columns are left out.
    """
    return _placed(docs, s).select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row of `docs` for each component, with all columns; rows that are linked with nothing stay, repeated ones once.

    Of a component the row with the smallest doc_id stays; of several such rows
    the one with the smallest hash of its text, then of all its columns. Rows
    without doc_id all stay.
    """
    placed = _placed(docs, s).where("doc_id is not null")
    first = F.min(F.struct("doc_id", "print", "whole")).alias("first")
    linkable = placed.where("component is not null").groupBy("component").agg(first)
    alone = placed.where("component is null").groupBy("doc_id", "print").agg(first)
    keep = linkable.select("first.*").unionByName(alone.select("first.*"))
    columns = [f"_{i}" for i in range(len(docs.columns))]
    rows = _hashed(docs, *columns)
    once = rows.where("doc_id is not null").join(keep, ["doc_id", "print", "whole"], "left_semi").dropDuplicates(["doc_id", "print", "whole"])
    return once.unionByName(rows.where("doc_id is null")).select(*columns).toDF(*docs.columns)


def _placed(docs: DataFrame, s: Settings) -> DataFrame:
    """Per row also the hashes of its text and columns and the number of its component, null if it cannot be linked."""
    rows = settle(_signatures(docs, s), "near-signatures")
    linkable = rows.where(F.col("set_key").isNotNull())
    classes = settle(
        linkable.groupBy("set_key").agg(
            F.min(F.struct("doc_id", "print")).alias("first"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature")
        ).select("set_key", F.monotonically_increasing_id().alias("node"), "first.doc_id", "first.print", "n_shingles", "signature"),
        "near-classes",
    )
    index = _index(classes, s)
    shared = index.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("lead")).where("n > 1").select("key", "lead")
    met = settle(index.join(shared, "key"), "near-index")
    groups = _joined(docs, classes, met, s)
    by_set = classes.select("set_key", "node", "doc_id").join(groups, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component"), F.col("doc_id").alias("first_id")
    )
    least = by_set.groupBy("component").agg(F.min("first_id").alias("component_id"))
    placed = by_set.select("set_key", "component").join(least, "component")
    own = F.coalesce("component_id", "doc_id")
    return rows.join(placed, "set_key", "left").select(
        "doc_id", "print", "whole", "component", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )
