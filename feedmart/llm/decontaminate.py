"""Benchmark decontamination by templates: numbers, units and names become typed slots, windows of templates are joined.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import pick, settle

# What stands in front of a slot's value: a private character, so that no word starts like that by itself, and the type.
MARK, POINT = "", ""
NUMBER, UNIT, NAME = MARK + "n", MARK + "u", MARK + "w"
START = MARK + "s"  # a capitalised word that may open a sentence, so may be no name

# Words that open sentences and questions and are no names, beside all that the benchmark has in lower case.
OPENERS = (
    "a an the this that these those what which who whom whose when where why how if is are was were do does did can could will "
    "would should has have had in on at of to for from by with and or but so then there here he she it they we you his her its "
    "their our my your find solve compute calculate evaluate add given let suppose assume each every all some no not after before"
).split()

UNITS = (
    "mm cm dm km m mg kg g t lb oz ml cl dl l ms min h s hours hour minutes minute seconds second days day weeks week "
    "months month years year meters meter metres metre miles mile feet foot inches inch grams gram liters liter litres litre "
    "dollars dollar euros euro cents cent percent degrees degree"
).split()


@dataclass(frozen=True)
class Settings:
    """When a document is taken to hold a benchmark item.

    Windows are `window` template words, of which at least `literals` are no
    slots; shorter items are one window of their own length if they have
    `literals` words. An item is held if `coverage` of its windows are found, or
    `windows` of them (six windows of eight are thirteen words in a row). The
    index of the benchmark is broadcast up to `broadcast_rows` windows, and the words
    that open sentences up to as many. Items without such a window are looked for as a whole, see `contaminated`.
    """

    window: int = 8
    literals: int = 4
    coverage: float = 0.5
    windows: int = 6
    broadcast_rows: int = 500_000


def _marked(text: Column, joined: bool = False) -> Column:
    """The text with a mark in front of every number, of the unit behind it (or of nothing), and of every name.

    A name is a capitalised word that follows a small letter, a comma or a
    semicolon and one space, so not the first word of a sentence. A dot or comma
    between digits becomes one character that does not part words. `joined`: a
    number and its unit are one word, white space of any kind and length is one
    space, and other capitalised words are marked as well.
    """
    text = F.regexp_replace(text, r"[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{3000}]+", " ") if joined else text
    names = F.regexp_replace(text, r"(\p{Lu})(?<=[\p{Ll},;] \p{Lu})(\p{Ll}+)", f"{NAME}$1$2")
    if joined:  # the letter of a mark keeps a name from being marked again
        names = F.regexp_replace(names, r"(\p{Lu})(?<![\p{L}\p{N}]\p{Lu})(\p{Ll}+)", f"{START}$1$2")
    points = F.regexp_replace(F.lower(names), r"[.,](?<=\p{Nd}[.,])(?=\p{Nd})", POINT)
    unit = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    number = rf"(\p{{Nd}}+(?:{POINT}\p{{Nd}}+)*)(?:[ -]?({unit})(?![\p{{L}}\p{{N}}]))?"
    return F.regexp_replace(points, number, f" {NUMBER}$1{'' if joined else ' '}{UNIT}$2 ")


# Words are parted by ASCII and Latin-1 characters other than letters and digits, and by general and CJK punctuation.
_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\xBF\xD7\xF7 -⁯　-〿]+"


def words(text: Column, joined: bool = False) -> Column:
    """The words of a text in lower case; slots carry their mark and value.

    `joined` words that may open a sentence have a mark of their own, see `_decided`.
    """
    return F.array_remove(F.split(_marked(text, joined), _APART), "")


# How a window was found: as template words, as template words with joined units, as part of an item that has
# few plain words, word for word, word for word with the marks between.
TEMPLATE, JOINED, WHOLE, EXACT, MARKED = range(5)
_WORD_FOR_WORD = (EXACT, MARKED)


def signs(text: Column) -> Column:
    """The words of a text in lower case, numbers as they are written, and every mark as a word of its own."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.,][\p{N}]+)*|[^\p{L}\p{N}\p{M}\p{C}\p{Z}\s]"), F.lit(0))


def _prepared(df: DataFrame, keep: list[str], kinds: set[int], openers: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """Per row the hashes of its template words, of its words if a kind asks for them, and its slot values, see `_hashed`."""
    split = signs(F.col("text")) if MARKED in kinds else words(F.col("text"), TEMPLATE not in kinds)
    rows = df.select(*keep, split.alias("_words"))
    return _hashed(rows if openers is None else _decided(rows, keep, openers, limit), keep, kinds)


def _openers(items: DataFrame) -> DataFrame:
    """(word): the known openers, and the words that the items have both at such places and in lower case."""
    each = items.select(F.explode("_words").alias("w"))
    start = F.col("w").startswith(START)
    word = F.when(start, F.substring("w", 3, 1 << 30)).otherwise(F.col("w")).alias("word")
    both = each.where(start | ~F.col("w").startswith(MARK)).groupBy(word).agg(F.count_if(start).alias("a"), F.count_if(~start).alias("b"))
    known = items.sparkSession.range(1).select(F.explode(F.split(F.lit(" ".join(OPENERS)), " ")).alias("word"))
    return both.where("a > 0 and b > 0").select("word").unionByName(known).distinct()


def _cell(word: Column, cells: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(cells)).cast("int")


def _decided(rows: DataFrame, keep: list[str], openers: DataFrame, limit: int) -> DataFrame:
    """`rows` with every word that may open a sentence as a plain word if it is one of `openers`, else as a name.

    The openers are counted first. Up to `limit` they are one value that every
    task looks words up in: an array of about as many cells as words, a word's
    cell by its hash. Beyond that the rows' own openers are found by a join.
    """
    may_open = lambda w: w.startswith(START)
    bare = lambda w: F.substring(w, len(START) + 1, 1 << 30)
    n = openers.count()
    if n <= limit:
        cells = 1 << n.bit_length()
        each = openers.select(_cell(F.col("word"), cells).alias("at"), "word").groupBy("at").agg(F.collect_list("word").alias("words"))
        every = openers.sparkSession.range(cells).select(F.col("id").cast("int").alias("at")).join(each, "at", "left")
        table = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda c: c["words"]).alias("cells")).scalar()
        known = rows.withColumn("_cells", table)
        is_known = lambda w: F.coalesce(F.array_contains(F.get("_cells", _cell(w, cells)), w), F.lit(False))
    else:
        # By the hash of a text's words, so that the rows need no key and repeated texts are looked up once.
        rows = rows.withColumn("_text", F.xxhash64("_words"))
        asked = rows.select("_text", F.explode(F.filter("_words", may_open)).alias("w")).select("_text", bare(F.col("w")).alias("word")).distinct()
        own = asked.join(openers, "word").groupBy("_text").agg(F.collect_set("word").alias("_known"))
        known = rows.join(own, "_text", "left")
        is_known = lambda w: F.coalesce(F.array_contains("_known", w), F.lit(False))
    plain = lambda w: F.when(~may_open(w), w).when(is_known(bare(w)), bare(w)).otherwise(F.concat(F.lit(NAME), bare(w)))
    return known.select(*keep, F.transform("_words", plain).alias("_words"))


def _hashed(split: DataFrame, keep: list[str], kinds: set[int]) -> DataFrame:
    """Hashes of template words (`_template`) and of words (`_full`), null if no kind asks for them; slot values, null where a word is no slot and as a whole where none is."""
    slotted = split.select(*keep, "_words", F.exists("_words", lambda w: w.startswith(MARK)).alias("_slotted"))
    template = F.transform("_words", lambda w: F.xxhash64(F.when(w.startswith(MARK), F.substring(w, 1, 2)).otherwise(w)))
    full = F.transform("_words", lambda w: F.xxhash64(w))
    none = F.lit(None).cast("array<bigint>")
    return slotted.select(
        *keep,
        (F.when(F.col("_slotted"), template).otherwise(full) if kinds - {*_WORD_FOR_WORD} else none).alias("_template"),
        (full if kinds & {*_WORD_FOR_WORD} else none).alias("_full"),
        F.when(F.col("_slotted"), F.transform("_words", lambda w: F.when(w.startswith(MARK), w))).alias("_values"),
    )


def _windows(rows: DataFrame, sizes: list[tuple[bool, int]], at: str) -> DataFrame:
    """A row per window of each of `sizes` (word for word or not, words): where it starts, its size and its hash.

    The arrays are only looked into, not copied, and gone through once for all
    sizes. An outer explode, since for an inner one Spark would test the array in a
    filter below, and there take the texts apart a second time.
    """
    hashes = lambda exact: "_full" if exact else "_template"
    count = F.size(F.coalesce("_template", "_full"))
    last = count - min(n for _, n in sizes)
    starts = rows.withColumn(at, F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last)))).where(F.col(at).isNotNull())
    hashed = {size: F.xxhash64(*[F.get(hashes(size[0]), F.col(at) + k) for k in range(size[1])]) for size in sizes}
    if len(sizes) == 1:
        (exact, n), one = next(iter(hashed.items()))
        return starts.select("*", F.lit(exact).alias("exact"), F.lit(n).alias("length"), one.alias("hash"))
    each = F.array(*[
        F.when(F.col(at) + n <= count, F.struct(F.lit(exact).alias("exact"), F.lit(n).alias("length"), one.alias("hash")))
        for (exact, n), one in hashed.items()
    ])
    return starts.withColumn("_window", F.explode(each)).where(F.col("_window").isNotNull()).select("*", "_window.*").drop("_window")


def _values(at: str) -> Column:
    """The slot values of a window, null where a word is no slot."""
    inner = F.slice("_values", F.col(at) + 1, F.col("length"))
    return F.coalesce(inner, F.array_repeat(F.lit(None).cast("string"), F.col("length")))


def _items(benchmark: DataFrame) -> DataFrame:
    return pick(benchmark, "item_id", "text").where("text is not null and item_id is not null").distinct()


def _cut(items: DataFrame, s: Settings, shortest: int, exact: bool = False) -> DataFrame:
    """(item_id, length, hash, at, values) of all windows; an item shorter than `window` is one window of its length."""
    size = F.size(F.coalesce("_template", "_full"))
    windows = _windows(items.where(size >= shortest).withColumn("_size", size), [(exact, n) for n in range(shortest, s.window + 1)], "at")
    own = windows.where(F.col("length") == F.least("_size", F.lit(s.window)))
    return own.select("item_id", "length", "hash", "at", _values("at").alias("values"))


def _counted(rows: DataFrame, kind: int) -> DataFrame:
    counts = rows.groupBy("item_id").agg(F.count("*").alias("n_windows"))
    return rows.join(counts, "item_id").withColumn("kind", F.lit(kind))


def _plain() -> Column:
    """How many words of a window are no slots."""
    return F.col("length") - F.size(F.array_compact("values"))


def benchmark_index(benchmark: DataFrame, s: Settings) -> DataFrame:
    """(item_id, length, hash, at, values, n_windows, kind): the windows of all items; texts of equal words are indexed for each."""
    items = settle(_prepared(_items(benchmark), ["item_id"], {TEMPLATE}), "template-items")
    return _counted(_cut(items, s, s.literals).where(_plain() >= s.literals), TEMPLATE)


def joined_index(benchmark: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The same with joined units, and for items that have no window with `literals` plain words two more kinds; and the openers.

    These are all windows word for word, and those with a plain word as
    templates, if the item has `literals` template words.
    """
    items = _items(benchmark)
    marked = settle(items.select("item_id", words(F.col("text"), True).alias("_words")), "joined-words")
    openers = settle(_openers(marked), "openers")
    split = settle(_decided(marked, ["item_id"], openers, s.broadcast_rows), "joined-items")
    size = F.size("_words")
    rows = settle(_cut(_hashed(split, ["item_id"], {JOINED}), s, s.literals), "joined-windows")
    plenty = rows.where(_plain() >= s.literals)
    # A named unit is a word of the text, so a text of `literals` words may have fewer template words.
    said = size + F.size(F.filter("_words", lambda w: w.rlike(f"^{NUMBER}.*{UNIT}.")))
    few = settle(split.where(said >= s.literals).join(plenty.select("item_id").distinct(), "item_id", "left_anti"), "joined-few")
    whole = _cut(_hashed(few.where(size >= s.literals), ["item_id"], {WHOLE}), s, s.literals).where(_plain() >= 1)
    exact = _cut(_hashed(few, ["item_id"], {EXACT}), s, 1, exact=True)
    return _counted(plenty, JOINED).unionByName(_counted(whole, WHOLE)).unionByName(_counted(exact, EXACT)), openers


def marked_index(benchmark: DataFrame, s: Settings) -> DataFrame:
    """The same for items of fewer than `literals` words that have as many with their marks (`12 + 15 = ?`), word for word."""
    items = _items(benchmark).select("item_id", signs(F.col("text")).alias("_words"))
    said = F.size(F.filter("_words", lambda w: w.rlike(r"[\p{L}\p{N}]")))
    split = items.where((said > 0) & (said < s.literals) & (F.size("_words") >= s.literals))
    return _counted(_cut(_hashed(split, ["item_id"], {MARKED}), s, s.literals, exact=True), MARKED)


def matches(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings(), reading: int = TEMPLATE) -> DataFrame:
    """(doc_id, print, item_id, kind, shift, at, doc_values, item_values, n_windows): every window of a document that is also one of an item.

    All windows of all texts are tried, in one pass over the texts whatever the
    items' lengths. The benchmark's index is counted first:
    up to `broadcast_rows` windows it is broadcast and documents are not
    shuffled, beyond that windows are joined by shuffle. `print` is a hash of the
    text and tells documents with one id apart.
    """
    made, openers = {
        TEMPLATE: lambda: (benchmark_index(benchmark, s), None), JOINED: lambda: joined_index(benchmark, s), MARKED: lambda: (marked_index(benchmark, s), None),
    }[reading]()
    index = settle(made.withColumn("exact", F.col("kind").isin(*_WORD_FOR_WORD)), f"index-{reading}")
    # At most 2 x `window` rows.
    sizes = {(r.exact, r.length): r.n for r in index.groupBy("exact", "length").agg(F.count("*").alias("n")).collect()}
    small = sum(sizes.values()) <= s.broadcast_rows
    kinds = {reading, *([EXACT] if reading == JOINED and any(exact for exact, _ in sizes) else [])}
    rows = pick(docs, "doc_id", "text").where("text is not null").withColumn("print", F.xxhash64("text"))
    if not sizes:  # nothing to look for, so the texts are not read
        rows = rows.where("false")
    windows = _windows(_prepared(rows, ["doc_id", "print"], kinds, openers, s.broadcast_rows), sorted(sizes) or [(reading == MARKED, s.window)], "doc_at")
    key = ["hash", "length", "exact"] if len(sizes) > 1 else ["hash"]
    side = index.select(*key, "item_id", "kind", "at", F.col("values").alias("item_values"), "n_windows")
    doc_values = _values("doc_at").alias("doc_values")
    if small:
        met = windows.join(F.broadcast(side), key).withColumn("doc_values", doc_values)
    else:
        met = windows.select("doc_id", "print", "doc_at", *key, doc_values).join(side, key)
    return met.select(
        "doc_id", "print", "item_id", "kind", (F.col("doc_at") - F.col("at")).alias("shift"), "at", "doc_values", "item_values", "n_windows"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, matched, n_windows, coverage, slots, changed): the documents that hold an item, as it is or with other values.

    Windows of a document and an item at one distance (`shift`) belong to one
    occurrence. In an occurrence every slot value of the item must stand for one
    value of the document; windows that hold a value that does not are not
    counted. `slots` counts the different slot values of the item that were met
    and `changed` those whose value differs: above 0 the question was given
    other values.

    Null texts hold nothing. Rows that repeat an id with another text, and rows
    with a null id, are judged each by its own text; repeated rows give one row.
    Items that repeat are found each under its id. Items of fewer than
    `literals` words are looked for word for word if they have as many with
    their marks (`12 + 15 = ?`), else not: they say too little. An empty table on
    either side gives no rows.

    Texts are read a second time with a number and its unit as one word, any
    white space as one space, and capitalised words at any place as names; there
    words that open sentences and are no names (`OPENERS`, words that the
    benchmark has in lower case as well) stay plain words. A number without unit
    in the item may have one in the document. Items
    that have too many slots for a window with `literals` plain words are found
    there if all their windows with a plain word are met, with any consistent
    values, or word for word by the rule for other items; items of nothing but
    slots only word for word. A pair that both ways find has the figures of the first.
    """
    return _held(docs, benchmark, s).drop("print")


def _held(docs: DataFrame, benchmark: DataFrame, s: Settings) -> DataFrame:
    owner = ["doc_id", "print", "item_id", "kind"]
    keys = [*owner, "shift"]
    found = matches(docs, benchmark, s)
    for reading in (JOINED, MARKED):
        found = found.unionByName(matches(docs, benchmark, s, reading))
    slots = F.filter(F.arrays_zip("item_values", "doc_values"), lambda v: v["item_values"].isNotNull())
    # A blank unit stands for any: it is no value, nor is the unit that a document gives to a number without one.
    joined_blank = lambda v: v["item_values"].startswith(NUMBER) & v["item_values"].endswith(UNIT)
    alike = lambda v: F.struct(
        v["item_values"].alias("item_values"),
        F.when(joined_blank(v), F.concat(F.substring_index(v["doc_values"], UNIT, 1), F.lit(UNIT)))
        .when(v["item_values"] == UNIT, UNIT).otherwise(v["doc_values"]).alias("doc_values"),
    )
    windows = found.select(*keys, "at", "n_windows", F.transform(slots, alike).alias("pairs"))
    # A window of an occurrence once. Read twice below, so kept: the documents are gone through once per reading.
    met = settle(windows.groupBy(*keys, "at", "n_windows").agg(F.max("pairs").alias("pairs")), "template-windows")
    values = met.select(*keys, F.explode("pairs").alias("v")).groupBy(*keys, F.col("v.item_values").alias("item_value")).agg(
        F.min("v.doc_values").alias("low"), F.max("v.doc_values").alias("high")
    )
    per = values.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.collect_set(F.when(F.col("low") != F.col("high"), F.col("item_value"))).alias("torn"),
        F.count("*").alias("slots"),
        F.count(F.when((F.col("low") == F.col("high")) & (F.col("low") != F.col("item_value")), 1)).alias("changed"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    for k in keys[1:]:
        same = same & (F.col(k) == F.col(f"_{k}"))
    torn = F.exists("pairs", lambda v: F.array_contains("torn", v["item_values"]))
    counted = met.join(per, same, "left").where(~F.coalesce(torn, F.lit(False)))
    # Windows of an item that is only taken as a whole have to be met in one occurrence.
    one = F.when(F.col("kind") == WHOLE, F.col("shift")).alias("one")
    places = counted.groupBy(*owner, one, "at", "n_windows").agg(
        F.max(F.coalesce("slots", F.lit(0))).alias("slots"), F.min(F.coalesce("changed", F.lit(0))).alias("changed")
    )
    totals = places.groupBy(*owner, "one", "n_windows").agg(
        F.count("*").alias("matched"), F.max("slots").alias("slots"), F.max("changed").alias("changed")
    )
    coverage = F.col("matched") / F.col("n_windows")
    enough = F.when(F.col("kind") == WHOLE, F.col("matched") == F.col("n_windows")).otherwise(
        (coverage >= s.coverage) | (F.col("matched") >= s.windows)
    )
    figures = ["matched", "n_windows", "coverage", "slots", "changed"]
    held = totals.where(enough).withColumn("coverage", coverage)
    first = held.groupBy(*owner[:3]).agg(F.min_by(F.struct(*figures), F.struct("kind", "changed", "slots")).alias("_first"))
    return first.select(*owner[:3], *[F.col(f"_first.{c}").alias(c) for c in figures])


def clean(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all columns."""
    held = _held(docs, benchmark, s).select(F.col("doc_id").alias("_held_id"), F.col("print").alias("_held_print")).distinct()
    held = settle(held, "held")  # its size decides how the documents are joined
    same = docs["doc_id"].eqNullSafe(held["_held_id"]) & (F.xxhash64(docs["text"]) == held["_held_print"])
    return docs.join(held, same, "left_anti")
