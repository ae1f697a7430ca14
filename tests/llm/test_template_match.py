import random

from pyspark.sql import functions as F

from meterframe.llm import template_match as tm

ITEMS = [
    (1, "If Maria has 12 apples and gives 5 apples to Tom. How many apples does Maria keep after 3 days?"),
    (2, "The train covers 120 km in 2 hours; what is the speed of the train over the whole trip today?"),
    (3, "one two three four five"),
    (4, "too short here"),
    (5, None),
    (6, ""),
    (None, "this item without any id says something rather plain about nothing"),
]


def found(spark, docs, items=ITEMS):
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int").repartition(2)
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, slots string")
    return sorted(((r.doc_id, r.item_id, r.kind) for r in tm.find(d, b).collect()), key=str)


def filler(seed, n=40):
    rng = random.Random(seed)
    return " ".join(f"f{rng.randrange(10**6)}x" for _ in range(n)) + ". "


def test_exact_and_reparameterised(spark):
    other = "If Anna has 7 apples and gives 4 apples to Karl. How many apples does Anna keep after 9 days?"
    mixed_up = "If Anna has 7 apples and gives 4 apples to Karl. How many apples does Otto keep after 9 days?"
    merged = "If Maria has 5 apples and gives 5 apples to Tom. How many apples does Maria keep after 3 days?"
    docs = [(1, filler(1) + ITEMS[0][1] + filler(2)), (2, filler(3) + other), (3, mixed_up), (4, merged), (5, filler(9, 300))]
    got = found(spark, docs)
    assert (1, 1, "exact") in got and (2, 1, "reparameterised") in got
    assert {i for i, _, _ in got} == {1, 2}


def test_units_and_marks(spark):
    text = "The train covers 95 miles in 3 days, what is the speed of the train over the whole trip today"
    assert found(spark, [(1, text)]) == [(1, 2, "reparameterised")]
    assert found(spark, [(1, ITEMS[1][1].upper())]) == [(1, 2, "reparameterised")] or found(spark, [(1, ITEMS[1][1].upper())]) == [(1, 2, "exact")]


def test_short_items_and_odd_rows(spark):
    docs = [(1, "x one two three, four five y"), (2, "too short here"), (3, None), (4, ""), (None, "one two three four five"), (1, "clean text of no interest to anybody at all")]
    assert found(spark, docs) == [(1, 3, "exact"), (None, 3, "exact")]
    assert found(spark, [(8, "so this item without any id says something rather plain about nothing")]) == [(8, None, "exact")]
    assert found(spark, []) == [] and found(spark, docs, []) == []


def test_numbers_alone_say_nothing(spark):
    assert found(spark, [(1, "1 2 3 4 5 6 7 8 9 10 11 12")], [(1, "5 6 7 8 9 10 11 12 13 14 15 16")]) == []


def test_long_text_and_repeats(spark):
    long = filler(5, 60000) + ITEMS[0][1] + filler(6, 60000)
    assert found(spark, [(1, long), (1, long)]) == [(1, 1, "exact")]


def test_filter_takes_the_rows_and_keeps_columns(spark):
    d = spark.createDataFrame(
        [(1, "a one two three four five", "s"), (1, "another text", "s"), (None, "one two three four five", "s"), (None, None, "s"), (2, "", "s")],
        "doc_id long, text string, text_hash string",
    )
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = tm.without_benchmark(d, b)
    assert kept.columns == d.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([(1, "another text", "s"), (None, None, "s"), (2, "", "s")], key=str)


def test_table_of_words_is_bounded(monkeypatch):
    text = "Anna has 7 apples. Otto ran 12 km " * 5
    plain = [x.tolist() for x in tm.Words().template(text)]
    monkeypatch.setattr(tm, "CACHED_WORDS", 3)
    small = tm.Words()
    small.template("other words fill it up now")
    assert [x.tolist() for x in small.template(text)] == plain


LONG = "On the first day Maria has 12 apples in a basket and the baker has 30 rolls on a shelf. On the next day she sells 5 apples at the market while the baker keeps all of the rolls for Tom, who visits the two of them after 7 days and asks how many apples are left in the basket."


def test_one_slot_that_does_not_fit(spark):
    changed = LONG.replace("5 apples", "12 apples")  # also the first number
    other = LONG.replace("12", "9").replace("30", "9").replace("Maria", "Anna")  # two new numbers are equal
    assert found(spark, [(1, filler(1) + changed), (2, filler(2) + other)], [(1, LONG)]) == [(1, 1, "exact"), (2, 1, "reparameterised")]


def test_exact_copies_of_short_and_slot_heavy_items(spark):
    items = [(1, "What is the capital city of France?"), (2, "5 km 6 km 7 km 8 km 9 km 10 km"), (3, "Anna Otto Karl Maria Tom Paul Eva Lena Nora")]
    docs = [(1, "Q7 " + items[0][1]), (2, "a heading\n" + items[0][1]), (3, filler(3) + items[1][1]), (4, "seen: " + items[2][1] + " there"), (5, "5 km 6 km 7 km 8 km 9 km 11 km")]
    assert found(spark, docs, items) == [(1, 1, "exact"), (2, 1, "exact"), (3, 2, "exact"), (4, 3, "exact")]


def removed(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {i for i, _ in docs} - {r.doc_id for r in tm.without_benchmark(d, b, **options).collect()}


def test_items_of_a_few_words(spark):
    items = [(1, "Name the capital of"), (2, "2+2 equals?"), (3, "..."), (4, "Why"), (5, "name two primes below ten")]
    docs = [
        (1, "name the capital of"), (2, "2+2 equals?"), (3, "A list: Name the capital of\nthe next line"), (4, "they name the capital of France"), (5, "That is so. 2+2 equals? Four."),
        (6, "we see that 2+2 equals four"), (7, "* * * ... ---\n***"), (8, "Why? Because."), (9, "nobody knows why it is so"), (10, "so name two primes below ten please"), (11, ""), (12, None),
    ]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.kind, r.covered, r.words) for r in tm.find(*frames, least_words=1).collect())
    assert got == [(1, 1, "exact", 4, 4), (2, 2, "exact", 2, 2), (3, 1, "exact", 4, 4), (5, 2, "exact", 2, 2), (8, 4, "exact", 1, 1), (10, 5, "exact", 5, 5)]
    assert removed(spark, docs, items, least_words=1) == {1, 2, 3, 5, 8, 10} and removed(spark, docs, items) == {10}


def test_one_share_rule(spark):
    item = "The old farm by the river keeps forty hens and each of the hens lays 12 eggs in every week of the long and quiet summer, so how many eggs are there?"
    other = item.replace("12", "9")
    cut = " ".join(item.split()[:9]) + " more than you would think, " + " ".join(item.split()[9:])
    odd = "All of them say that one of the hens lays 12 eggs in every week of the year."
    docs = [(1, filler(1) + item), (2, filler(2) + other), (3, odd), (4, filler(3) + cut), (5, " ".join(item.split()[:12])), (6, odd * 40)]
    assert removed(spark, docs, [(1, item)]) == {1, 2, 4}
    assert removed(spark, docs, [(1, item)], share=1) == {1, 2, 3, 4, 5, 6}
    long = " ".join(f"w{i}" for i in range(600))
    docs = [(1, filler(4) + " ".join(f"w{i}" for i in range(100, 160))), (2, filler(5) + " ".join(f"w{i}" for i in range(100, 130)))]
    assert removed(spark, docs, [(1, long)]) == {1}


def plainly(text):
    """(template word, kind, value) of each word."""
    out, first, number = [], True, False
    for w in text.split():
        bare = w.strip(tm.MARKS)
        kind = 0
        if tm.NUMERIC.fullmatch(bare):
            kind = 1
        elif number and bare.lower() in tm.UNITS:
            kind = 2
        elif not first and bare[:1].isupper() and bare[1:].islower():
            kind = 3
        out.append((kind or bare.lower(), kind, bare.lower()))
        first, number = w.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":") and w != "", kind == 1
    return out


def all_pairs(docs, items):
    """Items whose windows at one offset all fit, by comparing every window with every other."""
    found = set()
    for doc_id, text in docs:
        for item_id, item in items:
            d, i = plainly(text), plainly(item)
            for offset in range(-len(i), len(d)):
                pairs, hit = set(), False
                for a in range(len(i) - 7):
                    b = a + offset
                    if b < 0 or b + 8 > len(d) or [x[0] for x in i[a : a + 8]] != [x[0] for x in d[b : b + 8]]:
                        continue
                    if sum(x[1] == 0 for x in i[a : a + 8]) < 4:
                        continue
                    hit = True
                    pairs |= {(x[1], x[2], y[2]) for x, y in zip(i[a : a + 8], d[b : b + 8]) if x[1]}
                if hit and len({p[:2] for p in pairs}) == len(pairs) == len({(p[0], p[2]) for p in pairs}):
                    found.add((doc_id, item_id, all(p[1] == p[2] for p in pairs)))
    return {(d, i, "exact" if (d, i, True) in found else "reparameterised") for d, i, _ in found}


def test_slots_against_all_pairs(spark):
    rng = random.Random(4)
    names, plain = "Anna Otto Karl Maria".split(), "has gives the and then keeps more apples to of all days".split()

    def sentence(n):
        return " ".join(rng.choice([rng.choice(plain), rng.choice(plain), rng.choice(names), f"{rng.randrange(3)}", "5 km"]) for _ in range(n)) + ". "

    items = [(k, sentence(10) + sentence(8)) for k in range(12)]
    docs = []
    for k in range(80):
        words = rng.choice(items)[1].split()
        swap = dict(zip(names, rng.sample(names, 4))) if k % 2 else {}
        words = [swap.get(w.strip("."), w) + ("." if w.endswith(".") and w.strip(".") in swap else "") for w in words]
        if k % 3 == 0:
            words[rng.randrange(len(words))] = str(rng.randrange(9))
        docs.append((k, sentence(5) + " ".join(words[rng.randrange(4) :]) + " " + sentence(4)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = all_pairs(docs, items)
    got = {(r.doc_id, r.item_id, r.kind) for r in tm.find(d, b).collect()}
    assert len(expected) > 40 and {k for _, _, k in expected} == {"exact", "reparameterised"}
    assert expected <= got
    for doc_id, item_id, _ in got - expected:  # the rest agree in part only, and cover most of the item
        row = [r for r in tm.find(d.where(F.col("doc_id") == doc_id), b).collect() if r.item_id == item_id][0]
        assert 100 * row.covered > tm.SHARE * row.words


def test_each_word_is_mixed_once(monkeypatch):
    """Window hashes cost about one mixing a word, not one for each word of each window."""
    mixed, sizes = tm.mixed, []
    monkeypatch.setattr(tm, "mixed", lambda h: sizes.append(len(h)) or mixed(h))
    template, kind, _ = tm.Words().template(filler(4, 500))
    hashes, good = tm.window_hashes(template, kind, tm.WINDOW)
    assert len(hashes) == len(good) == 500 - tm.WINDOW + 1 and sum(sizes) <= 2 * 500


def test_words_numbered_at_once_are_those_numbered_alone(monkeypatch):
    words = ["5", "-3.5kg", "٣", "Tom.", "(Anna)", "end.\"", "two", "km", "...", "x!", "McX", "É", "a1"]
    together = tm.Words()
    at = together.numbers(words + words)
    for w, k in zip(words + words, at.tolist()):
        alone = tm.Words()
        assert alone.numbers([w]).tolist() == [0]
        assert [getattr(alone, f)[0] for f in ("hash", "kind", "unit", "ends")] == [getattr(together, f)[k] for f in ("hash", "kind", "unit", "ends")]
    assert together.kind[at[:4]].tolist() == [tm.NUMBER, tm.NUMBER, tm.NUMBER, tm.NAME] and together.ends[at[[3, 5, 9]]].all() and not together.ends[at[[6, 7]]].any()


def test_windows_that_do_not_fit_go_to_python_once(spark):
    """Two Python nodes in a task take two workers, which stay and are used by all later stages."""
    docs = spark.createDataFrame([(1, filler(1) + ITEMS[0][1])], "doc_id long, text string")
    there = tm.find(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert there._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("BatchEvalPython") == 1
