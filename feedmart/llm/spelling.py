"""Spelling variants: words one letter apart by pairs of trie nodes, each led to the spelling that is far more frequent."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import pick, settle

# What a run of letters is, and which runs lose a letter.
LETTERS = "A-Za-zÀ-ÿ"
LOSES = 199
# Numbers of trie nodes and words: the task in the high bits, the place within it in the low ones.
_TASK_BITS = 40
_FLUSH = 200_000


@dataclass(frozen=True)
class Settings:
    """Words have at least `length` code points and occur `count` times; a form occurs `ratio` times as often as its variant."""

    length: int = 6
    count: int = 5
    ratio: int = 5


# --- words ------------------------------------------------------------------------------------


def spelled(text: str | None, doc_id: int | None, length: int) -> Counter:
    """How often each word of at least `length` code points is in a text.

    Words are maximal runs of letters with A-Z lower-cased. Of every 199th pair
    of document and run, by a checksum, one letter is left out.
    """
    counts: Counter = Counter()
    lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(re.findall(f"[{LETTERS}]{{{length},}}", lowered)).items():
        h = crc32(run.encode("utf-8"), start)
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < length:
                continue
        counts[run] += n
    return counts


def word_counts(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(word, n) of every word that occurs often enough in all texts together. Tasks count before the shuffle, in bounded tables."""

    def run(batches):
        def rows(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.update(spelled(text.as_py(), doc_id, s.length))
                if len(counts) >= _FLUSH:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    found = pick(docs, "doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= s.count)


# --- tries ------------------------------------------------------------------------------------


def numbered(words: Iterator[str], task: int) -> Iterator[tuple[str, np.ndarray, int]]:
    """Words in order with the numbers of their trie nodes from depth 1 on; and the word's own number.

    A node gets its number when the first word below it comes by, so only the
    path of the word before has to be known.
    """
    base = (task + 1) << _TASK_BITS
    before, path, used = "", np.zeros(0, np.int64), 0
    for place, word in enumerate(words):
        known = _common(before, word)
        fresh = np.arange(used, used + len(word) - known, dtype=np.int64) + base
        path = np.concatenate((path[:known], fresh))
        used += len(fresh)
        before = word
        yield word, path, base + place


def _common(a: str, b: str) -> int:
    """The length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def trie(words: DataFrame) -> DataFrame:
    """(word, path, number): the trie nodes of distinct words from depth 1 on. `number` follows the words' order.

    Words are sorted over all tasks, and each task numbers the nodes of its own
    range. Only the beginnings that the first word of a range shares with the
    last one before it are numbered twice: those few, at most one path per task,
    are replaced by the number of the earlier range.
    """

    def run(batches):
        task = TaskContext.get().partitionId()
        texts = (word for batch in batches for word in batch.column(0).to_pylist())
        rows, size, first = [], 0, True

        def out(last: bool) -> pa.RecordBatch:
            ends = [(first and i == 0) or (last and i == len(rows) - 1) for i in range(len(rows))]
            paths = pa.ListArray.from_arrays(np.cumsum([0, *(len(r[1]) for r in rows)]).astype(np.int32), np.concatenate([r[1] for r in rows]))
            columns = [pa.array([r[0] for r in rows], pa.string()), paths, pa.array([r[2] for r in rows], pa.int64()), pa.array(ends)]
            return pa.RecordBatch.from_arrays(columns, ["word", "path", "number", "at_end"])

        for row in numbered(texts, task):
            if size > 1 << 20:
                yield out(False)
                rows, size, first = [], 0, False
            rows.append(row)
            size += 16 + len(row[0])
        if rows:
            yield out(True)

    ordered = words.select("word").repartitionByRange("word").sortWithinPartitions("word")
    nodes = settle(ordered.mapInArrow(run, "word string, path array<long>, number long, at_end boolean"), "spelling-trie")
    again = _twice(nodes.where("at_end").select("word", "path", "number").collect())  # the first and last word of each task
    if not len(again[0]):
        return nodes.drop("at_end")

    def renumbered(batches):
        old, new = again
        for batch in batches:
            if not len(batch):
                continue
            paths = batch.column(1)
            values = paths.flatten().to_numpy()
            at = np.minimum(np.searchsorted(old, values), len(old) - 1)
            fixed = np.where(old[at] == values, new[at], values)
            offsets = np.asarray(paths.offsets) - paths.offsets[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets.astype(np.int32), fixed), batch.column(2)], ["word", "path", "number"]
            )

    return nodes.select("word", "path", "number").mapInArrow(renumbered, "word string, path array<long>, number long")


def _twice(ends: list) -> tuple[np.ndarray, np.ndarray]:
    """The node numbers that stand for a node of an earlier range, in order, and the numbers of these."""
    old: dict[int, int] = {}
    before, path, task = "", [], None
    for row in sorted(ends, key=lambda row: row.number):
        now = [old.get(node, node) for node in row.path]
        if row.number >> _TASK_BITS != task:
            task = row.number >> _TASK_BITS
            for depth in range(_common(before, row.word)):
                old[row.path[depth]] = path[depth]
            now = [old.get(node, node) for node in row.path]
        before, path = row.word, now
    keys = sorted(old)
    return np.array(keys, np.int64), np.array([old[key] for key in keys], np.int64)


# --- neighbours -------------------------------------------------------------------------------


def _spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word the pairs of nodes around each of its letters, which is skipped, and around each gap."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        spots = np.array([len(before) for _, _, before, _ in rows])
        number, n = (np.repeat([row[i] for row in rows], spots) for i in (0, 1))
        skipped = np.concatenate([np.arange(size) < size // 2 for size in spots])
        columns = [number, n, np.concatenate([row[2] for row in rows]), np.concatenate([row[3] for row in rows]), skipped]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "n", "p", "q", "skipped"])

    rows, size = [], 0
    for batch in batches:
        for number, n, path, back in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
            p, q = (np.concatenate(([0], nodes.values.to_numpy())) for nodes in (path, back))
            letters = len(p) - 1
            rows.append((number, n, np.concatenate((p[:letters], p)), np.concatenate((q[letters - 1 :: -1], q[::-1]))))
            size += 2 * letters + 1
            if size > 1 << 16:
                yield out(rows)
                rows, size = [], 0
    if rows:
        yield out(rows)


def near_words(words: DataFrame) -> DataFrame:
    """(id, n, other, other_n): both directions of every pair of words (id, word, n, path) one code point apart.

    A word is found under the nodes of what stands before and behind each of its
    positions with the letter there skipped, and under those around each gap.
    Two words skipped under one pair differ by a replaced letter; a word skipped
    where another one has a gap is that one with a letter inserted. A pair of
    nodes has at most one word with a gap there and one skipped word per letter
    of the alphabet, so no group is large. `path` has the nodes of a word's
    beginnings and `back` those of its ends.
    """
    keys = words.select("id", "n", "path", "back").mapInArrow(_spots, "id long, n long, p long, q long, skipped boolean")
    word = F.struct("id", "n")
    groups = keys.groupBy("p", "q").agg(
        F.collect_set(F.when(F.col("skipped"), word)).alias("skips"), F.collect_set(F.when(~F.col("skipped"), word)).alias("gaps")
    ).where("size(skips) + size(gaps) > 1")
    both = F.expr("""
        concat(
          flatten(transform(skips, a -> transform(filter(skips, b -> b.id <> a.id), b -> struct(a, b)))),
          flatten(transform(gaps, a -> transform(skips, b -> struct(a, b)))),
          flatten(transform(gaps, a -> transform(skips, b -> struct(b AS a, a AS b)))))""")
    pairs = groups.select(F.explode(both).alias("pair")).select(
        F.col("pair.a.id").alias("id"), F.col("pair.a.n").alias("n"), F.col("pair.b.id").alias("other"), F.col("pair.b.n").alias("other_n")
    )
    return pairs.distinct()


def roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """(id, root) from (id, form): the end of each chain.

    A form is `ratio` times as frequent as what leads to it, so a chain is as
    long as the logarithm of `most` at most; each round doubles the step.
    """
    steps, longest = 1, 1
    while ratio ** longest <= most:
        longest += 1
    known = forms.select("id", F.col("form").alias("root"))
    while steps < longest:
        onward = known.select(F.col("id").alias("root"), F.col("root").alias("further"))
        known = settle(known.join(onward, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "spelling-roots")
        steps *= 2
    return known


def variants(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per word of all texts (doc_id, text): its form, the root its forms lead to, and the counts.

    `form` is the near word (one code point inserted, deleted or replaced) that
    occurs most often, the smallest of equals in code-point order, if it occurs
    at least `ratio` times as often as the word; else null. `root` follows forms
    to the last one. `n_near` counts near words. Null texts have no words; a null
    doc_id stands as an empty id in the checksum; repeated rows count again;
    further columns are left out.
    """
    counts = settle(word_counts(docs, s), "spelling-words")
    forward = trie(counts)
    back = trie(counts.select(F.reverse("word").alias("word"))).select(F.reverse("word").alias("word"), F.col("path").alias("back"))
    words = settle(forward.join(back, "word").join(counts, "word").select(F.col("number").alias("id"), "word", "n", "path", "back"), "spelling-nodes")
    # Numbers of words follow their order, so the smallest number is the smallest word.
    best = F.max(F.struct("other_n", (-F.col("other")).alias("first")))
    near = settle(
        near_words(words).groupBy("id", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
        .select("id", "n_near", *[F.when(F.col("best.other_n") >= s.ratio * F.col("n"), x).alias(a) for x, a in
                                  ((-F.col("best.first"), "form"), (F.col("best.other_n"), "form_n"))]),
        "spelling-near",
    )
    forms = near.where("form is not null").select("id", "form")
    most = counts.agg(F.max("n")).first()[0] or 0
    named = words.select("id", "word", "n")
    ends = roots(forms, most, s.ratio)
    return (
        named.join(near, "id", "left").join(ends, "id", "left")
        .join(named.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form", "left")
        .join(named.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root", "left")
        .select(
            "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n",
        )
    )


# --- the same as SQL --------------------------------------------------------------------------


def oracle(s: Settings = Settings()) -> str:
    """The words by a checksum over their bytes, neighbours by texts with one letter left out."""
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
        WITH RECURSIVE byte_table AS (
          SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: {bit}, i) AS c FROM range(256) r(i))
        ),
        runs AS (
          SELECT doc_id, run, count(*) AS n FROM (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
                   unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[{LETTERS}]+')) AS run
            FROM documents)
          WHERE length(run) >= {s.length} GROUP BY ALL
        ),
        checked AS (
          SELECT run, n, xor(4294967295, list_reduce(
                   flatten(list_transform(string_split(doc_id || ':' || run, ''),
                           lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195::BIGINT, CAST(unicode(x) - 64 AS BIGINT)] END)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS h
          FROM runs, byte_table
        ),
        words AS (
          SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT CASE WHEN h % {LOSES} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM checked)
          WHERE length(word) >= {s.length} GROUP BY word HAVING sum(n) >= {s.count}
        ),
        spots AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
        cut AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM spots),
        pairs AS (
          SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
        ),
        best AS (
          SELECT word, count(*) AS n_near, arg_max(other, other_n) AS any_other, max(other_n) AS form_n FROM pairs GROUP BY word
        ),
        placed AS (
          SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= {s.ratio} * w.n THEN b.form_n END AS form_n,
                 CASE WHEN b.form_n >= {s.ratio} * w.n THEN
                   (SELECT min(p.other) FROM pairs p WHERE p.word = w.word AND p.other_n = b.form_n) END AS form
          FROM words w LEFT JOIN best b ON w.word = b.word
        ),
        chain AS (
          SELECT word, word AS root, form AS next FROM placed
          UNION ALL SELECT c.word, p.word, p.form FROM chain c JOIN placed p ON p.word = c.next
        )
        SELECT p.word, p.form, c.root, p.n, p.n_near, p.form_n FROM placed p JOIN chain c ON c.word = p.word AND c.next IS NULL"""
