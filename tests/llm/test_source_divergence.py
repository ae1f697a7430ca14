import random
import re
from collections import Counter, defaultdict

import pytest

from meterframe.llm import source_divergence as sd

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def by_hand(rows, top):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang or "", source or "") for lang, source, _ in rows})
    for lang, source, text in rows:
        words = TERM.findall(lower(text or ""))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = set()
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)
        mine = [g for g in groups if g[0] == lang]
        whole = sum((counts[g] for g in mine), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p = shares(counts[lang, source])
        pairs = [(g[1], sum((p[t] - q) ** 2 // q for t, q in shares(counts[g]).items())) for g in mine if g[1] != source]
        q = shares(whole)
        terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, values, most in (("pair", pairs, None), ("term", terms, top)):
            values.sort(key=lambda v: (-v[1], v[0].encode()))
            out.update((lang, source, part, item, value, rank) for rank, (item, value) in enumerate(values[:most], 1))
    return out


def odd_rows(seed):
    rng = random.Random(seed)
    words = ["the", "The", "é", "É", "naïve", "x_y", "don't", "a1b", "日本", "\x7fz", "q\x00r", *[f"w{'abcdefghij'[k]}" for k in range(10)]]
    out = []
    for _ in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(0, 15)))
        out.append((rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "ſ", "Z", None]), text))
    return out + [("fr", "only", "one two"), ("fr", "other", None), ("es", "alone", "tres tres tres"), out[0], out[0], ("en", "s1", "wa " * 40_000)]


@pytest.mark.parametrize("seed, top", [(1, 200), (2, 4)])
def test_equals_brute_force(spark, seed, top):
    rows = odd_rows(seed)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS sid", "2 AS n", "3 AS `a.b`", "4 AS term", "5 AS path")
    got = {tuple(r) for r in sd.divergence(docs, top=top).collect()}
    assert got == by_hand(rows, top)


def test_shared_paths_are_one_node(spark):
    paths = [[(1, 2), (2, 1)], [(1, 2), (2, 1)], [(1, 2)], [(1, 2), (2, 1), (3, 5)], [(2, 1)]]
    rows = spark.createDataFrame([("en", p) for p in paths], "lang string, path array<struct<sid:int,n:bigint>>")
    nodes = {tuple(map(tuple, r.path)): r.times for r in sd.tree(rows).collect()}
    assert nodes == {((1, 2),): 4, ((1, 2), (2, 1)): 3, ((1, 2), (2, 1), (3, 5)): 1, ((2, 1),): 1}


def test_tables_are_handed_on(spark, monkeypatch):
    rows = odd_rows(4)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    whole = {(r.lang, r.source, r.term): (r.n, r.docs) for r in sd.term_counts(docs).collect()}
    monkeypatch.setattr(sd, "HELD_TERMS", 7)
    assert {(r.lang, r.source, r.term): (r.n, r.docs) for r in sd.term_counts(docs).collect()} == whole


def test_counts_beyond_64_bits(spark):
    """10^9 times a count of 10^12 is exact."""
    from pyspark.sql import functions as F

    one = spark.createDataFrame([(10**12, 3 * 10**12 + 7, 11)], "n bigint, total bigint, kept bigint")
    got = one.select(sd.share(F.col("n"), F.col("total"), F.col("kept"))).first()[0]
    assert got == 1 + 10**9 * (10**12 + 1) // (3 * 10**12 + 18)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert sd.divergence(docs).collect() == []
