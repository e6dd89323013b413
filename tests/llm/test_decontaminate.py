import random
import re
from collections import defaultdict

from feedmart.llm import decontaminate as dec
from feedmart.llm.decontaminate import Settings, clean, contaminated, words

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
QUESTION = "A train leaves Leeds at 9 and covers 120 km before it meets, near Hull, a second train that left at 9 with 300 passengers on board"


def plain_words(text):
    """The canonical words, one at a time."""
    text = re.sub(r"[A-ZÄÖÜÉ][a-zäöüßé]+", lambda m: "w" + m[0] if re.search(r"[a-zäöüßé,;] $", text[: m.start()]) else m[0], text).lower()
    text = re.sub(r"(?<=\d)[.,](?=\d)", "", text)
    unit = "|".join(sorted(dec.UNITS, key=lambda u: (-len(u), u)))
    text = re.sub(rf"(\d+(?:\d+)*)(?:[ -]?({unit})(?![^\W_]))?", lambda m: f" n{m[1]} u{m[2] or ''} ", text)
    return [w for w in re.split(r"[^\w]|_", text) if w]


def brute(docs, items, s):
    """Found pairs with matched windows, slots and changed values, from the definition."""
    out = {}
    slot = lambda w: w.startswith("")
    template = lambda ws: tuple(w[:2] if slot(w) else w for w in ws)
    for item_id, question in items:
        iw = plain_words(question or "")
        n = s.window if len(iw) >= s.window else len(iw)
        index = defaultdict(list)
        if n < s.literals:
            continue
        for i in range(len(iw) - n + 1):
            if sum(map(slot, iw[i : i + n])) <= n - s.literals:
                index[template(iw[i : i + n])].append(i)
        total = sum(map(len, index.values()))
        for doc_id, text in {d for d in docs if d[1] is not None}:
            dw, met = plain_words(text), defaultdict(set)
            for j in range(len(dw) - n + 1):
                for i in index.get(template(dw[j : j + n]), ()):
                    met[j - i].add(i)
            places = {}
            for shift, at in met.items():
                values = defaultdict(set)
                for i in at:
                    for k in range(i, i + n):
                        if slot(iw[k]):
                            values[iw[k]].add(dw[k + shift])
                changed = sum(len(v) == 1 and v != {w} for w, v in values.items())
                for i in at:
                    if all(len(values[w]) == 1 for w in iw[i : i + n] if slot(w)):
                        old = places.get(i, (0, 1 << 30))
                        places[i] = max(old[0], len(values)), min(old[1], changed)
            if places and (len(places) >= s.coverage * total or len(places) >= s.windows):
                key = (doc_id, item_id, len(places), total, max(p[0] for p in places.values()), max(p[1] for p in places.values()))
                out[key] = out.get(key, 0) + 1
    return out


def rows():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "ru") for b in ("n", "st", "ck", "le", "ra", "üb")]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(1, QUESTION), (2, prose(30) + "."), (3, "Only three words"), (4, "five plain words in here"), (5, None), (6, QUESTION), (7, prose(9))]
    changed = QUESTION.replace("120", "45,5").replace("Hull", "York").replace("at 9", "at 11")
    torn = QUESTION.replace("at 9 with", "at 10 with")
    docs = [
        (1, prose(40) + " " + QUESTION + " " + prose(20)), (2, prose(10) + ". " + changed), (3, torn), (4, prose(200)), (5, None), (6, ""),
        (7, "before. " + items[1][1].upper() + " after"), (8, " ".join(items[1][1].split()[:10]) + " " + prose(50)),
        (9, "and " + items[3][1] + " too"), (None, changed), (None, prose(20)), (1, prose(30)), (10, items[6][1]), (2, prose(10)),
        (11, ("the same line again " * 6 + QUESTION + " ") * 3), (12, "x " * 50_000 + items[1][1]),
    ]
    return docs + docs[:1], items


def test_same_as_the_definition(spark):
    docs, items = rows()
    for s in (Settings(), Settings(coverage=0.2, windows=3), Settings(broadcast_rows=0)):
        frame = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as item_id", "'h' as hash", "2 as at")
        got = contaminated(frame, spark.createDataFrame(items, ITEMS).selectExpr("*", "3 as doc_id"), s).collect()
        found = defaultdict(int)
        for r in got:
            found[(r.doc_id, r.item_id, r.matched, r.n_windows, r.slots, r.changed)] += 1
        assert found == brute(docs, items, s)
    by_pair = {(k[0], k[1]): k for k in brute(docs, items, Settings())}
    assert by_pair[1, 1][5] == 0 and by_pair[2, 1][5] > 0 and by_pair[2, 1][4] >= by_pair[2, 1][5]
    assert by_pair[3, 1][2] < by_pair[1, 1][2]


def test_words(spark):
    text = "Tom paid 3.5 km, then Anna saw 12kg of it. And then, Bob (aged 7) left 1,000 dollars!\nÜber ß_x"
    got = spark.createDataFrame([(text,)], "text string").select(words(dec.F.col("text"))).first()[0]
    assert got == plain_words(text) and "wbob" in got and "n35" in got and "ukg" in got


def test_clean_keeps_everything_else(spark):
    docs, items = rows()
    frame = spark.createDataFrame(docs, DOCS).selectExpr("*", "text as _held_id")
    kept = sorted(((r.doc_id, r.text) for r in clean(frame, spark.createDataFrame(items, ITEMS)).collect()), key=repr)
    held = {t for i, t in docs for k in brute([(i, t)], items, Settings())}
    assert kept == sorted(((i, t) for i, t in docs if t not in held), key=repr)
    assert (None, docs[10][1]) in kept and (None, docs[9][1]) not in kept


def test_empty_tables(spark):
    docs, items = rows()
    full_d, full_i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert contaminated(full_d.where("false"), full_i).count() == 0
    assert contaminated(full_d, full_i.where("false")).count() == 0
    assert clean(full_d, full_i.where("false")).count() == len(docs)


def test_no_python_and_one_pass_over_the_documents(spark):
    docs, items = rows()
    found = dec.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items[:2], ITEMS))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("regexp_replace(lower(") == 1


def reads(spark, items, reading, tmp_path):
    """How often the executed plan of a reading reads the documents."""
    docs, _ = rows()
    path = str(tmp_path / f"docs-{reading}")
    spark.createDataFrame(docs, DOCS).write.parquet(path)
    found = dec.matches(spark.read.parquet(path), spark.createDataFrame(items, ITEMS), reading=reading)
    return sum("FileScan" in line and path in line for line in found._jdf.queryExecution().executedPlan().toString().splitlines())


def test_one_read_per_reading_for_items_of_any_length(spark, tmp_path):
    plain = "the old mill stands near that quiet river bank"
    items = [(n, " ".join(plain.split()[:n])) for n in range(4, 10)] + [(20, "What is 12 + 15 + 7?"), (21, "1, 2, 3, 4, 5"), (22, "12 + 15 = ?"), (23, "3 * 4 = 12 ?")]
    assert [reads(spark, items, r, tmp_path) for r in (dec.TEMPLATE, dec.JOINED, dec.MARKED)] == [1, 1, 1]
    frame = spark.createDataFrame([(n, f"so: {text} it was") for n, text in items], DOCS)
    got = {(r.doc_id, r.item_id) for r in contaminated(frame, spark.createDataFrame(items, ITEMS)).collect()}
    assert {(n, n) for n, _ in items} <= got and not {(a, b) for a, b in got if a < 10 <= b or b < 10 <= a}


def test_items_of_few_words_are_found_with_their_marks(spark):
    items = [(1, "12 + 15 = ?"), (2, "What is 12?"), (3, "x = 3.5"), (4, "yes, no"), (5, "a b c"), (6, "??!!")]
    docs = [(1, "so 12+15 = ? is asked"), (2, "12 + 15 is 27"), (3, "he said: what is 12 ? now"), (4, "what is 12 of it"), (5, "12 + 16 = ?"), (6, "if x=3.5, x = 3"), (7, "yes, no, a b c ??!!"), (8, None)]
    for s in (Settings(), Settings(literals=3), Settings(broadcast_rows=0)):
        got = {(r.doc_id, r.item_id): r for r in contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), s).collect()}
        if s.literals == 4:
            assert set(got) == {(1, 1), (3, 2)} and got[1, 1].coverage == 1 and got[1, 1].slots == 0
        else:
            assert {(1, 1), (6, 3), (7, 4)} <= set(got) and (5, 1) not in got


def test_items_of_many_numbers(spark):
    items = [(1, "What is 12 + 15 + 7?"), (2, "What is 12 plus 15?"), (3, "1, 2, 3, 4"), (4, "What is 12 km"), (5, "What is 12?"), (6, "Compute 1 + 2 + 3 + 4 + 5 + 6 + 7 + 8 + 9 + 10 now")]
    docs = [
        (1, "so: What is 12 + 15 + 7? yes"), (2, "so what is 30 + 4 + 8, then"), (3, "asked what is 3 plus 4 of us"), (4, "rows 1, 2, 3, 4 end"),
        (5, "rows 5, 6, 7, 8 end"), (6, "what is 12 km off"), (7, "what is 13 km off and what is 12 of it"), (8, "compute 3 + 4 + 5 + 6 + 7 + 8 + 9 + 11 + 12 + 13 now"),
        (9, "what is plus 3"),
    ]
    for s in (Settings(), Settings(broadcast_rows=0)):
        got = {(r.doc_id, r.item_id): r for r in contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), s).collect()}
        assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 3), (6, 4), (8, 6)}
        assert got[1, 1].changed == 0 and got[2, 1].changed == 3 and got[2, 1].coverage == 1


def test_names_that_open_sentences_line_breaks_and_added_units(spark):
    items = [
        (1, "Tom has 5 apples. Anna gives him 3."), (2, "Between the hills and Leeds old farmers sold 9 and 12 apples each and 9 pears"),
        (3, "What does the bridge near the mill carry"), (4, "The bridge near what old mill carries 4 carts"),
    ]
    docs = [
        (1, "Well: Paul has 7 apples. Mary gives him 4. So."), (2, "between the hills and\nLeeds old  farmers sold 9 and 12 apples each and 9 pears"),
        (3, "between the hills and Leeds old farmers sold 9 km and 12 apples each and 9 pears"), (4, "Who does the bridge near the mill carry"),
    ]
    for s in (Settings(), Settings(broadcast_rows=0)):
        got = {(r.doc_id, r.item_id): r for r in contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), s).collect()}
        assert set(got) == {(1, 1), (2, 2), (3, 2)} and got[1, 1].changed == 4


def plain_decided(ws, openers):
    """Words that may open a sentence as plain words or names, one at a time."""
    return [w if not w.startswith(dec.START) else w[2:] if w[2:] in openers else dec.NAME + w[2:] for w in ws]


def test_openers_looked_up_and_joined_are_the_same(spark):
    """Words of all kinds, rows that repeat, no words, null; each word is decided as one at a time would be."""
    rng = random.Random(5)
    vocabulary = ["The", "the", "Cat", "dog", "Ärger", "ärger", "Tom", "x", "9 km"]
    texts = [". ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(60)] + ["The. The. Tom"] * 200 + [None, ""]
    marked = spark.createDataFrame(list(enumerate(texts)), DOCS).select("doc_id", words(dec.F.col("text"), True).alias("_words"))
    for openers in ([], ["the"], ["the", "ärger", "dog", *(f"word{i}" for i in range(900))]):
        frame = spark.createDataFrame([(w,) for w in openers], "word string")
        want = {r.doc_id: r._words if r._words is None else plain_decided(r._words, openers) for r in marked.collect()}
        for limit in (0, 10_000):
            got = dec._decided(marked, ["doc_id"], frame, limit).collect()
            assert len(got) == len(texts) and {r.doc_id: r._words for r in got} == want


def test_many_openers_do_not_grow_the_plan(spark):
    def plan(n):
        said = [f"w{''.join(chr(97 + int(d)) for d in str(i))}" for i in range(n)]
        items = [(i, " ".join(f". {w.capitalize()} and {w}" for w in said[i : i + 50])) for i in range(0, n, 50)] + [(-1, QUESTION)]
        found = dec.matches(spark.createDataFrame(rows()[0], DOCS), spark.createDataFrame(items, ITEMS), reading=dec.JOINED)
        return found._jdf.queryExecution().optimizedPlan().toString(), found.where("item_id = -1").count()

    (few, found), (many, found_too) = plan(100), plan(100_000)
    assert found == found_too > 0 and len(many) < 1.2 * len(few) and "waaa" not in many
