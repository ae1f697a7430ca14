import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterframe.llm.suffix_dedup import digest, offsets_of, without_repeats


def by_hand(texts, length):
    """(bytes, removed, spans, sha256) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def check(spark, texts, length, **options):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in digest(docs, length, **options).collect()}
    expected = dict(enumerate(by_hand(texts, length)))
    assert got == expected


def texts_with_repeats(seed, n=40, length=30):
    rng = random.Random(seed)
    letters = "abé "
    passages = ["".join(rng.choices(letters, k=rng.randint(length // 2, 3 * length))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(letters + "xyz", k=rng.randint(0, 50))))
        out.append("".join(parts))
    return out + [None, "", "é", "a" * 5 * length, "ab" * 3 * length, out[0], out[1][:-1]]


@pytest.mark.parametrize("length, seed", [(8, 1), (30, 2), (30, 3), (64, 4)])
def test_equals_brute_force(spark, length, seed):
    check(spark, texts_with_repeats(seed, length=length), length)


def test_large_groups_are_parted(spark):
    """One passage with other words around it in every text: its outer anchors
    have as many contexts as there are texts."""
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdefgh ", k=150))
    texts = []
    for k in range(120):
        front, back = ("".join(rng.choices("klmnop ", k=rng.randint(20, 90))) for _ in "12")
        middle = passage if k % 3 else passage[: rng.randint(1, 140)] + "#" + passage[rng.randint(1, 140) :]
        texts.append(front + middle + back)
    check(spark, texts, 64, group_bytes=500)
    check(spark, texts, 64, group_bytes=1)


def test_long_texts_are_hashed_in_steps(spark):
    check(spark, texts_with_repeats(6), 30, step=97)


def test_rows_that_repeat_each_other(spark):
    rows = [(1, "x" * 10 + "abcdefgh" * 9), (1, "x" * 10 + "abcdefgh" * 9), (None, "q" * 5 + "nothing like it " * 2), (None, None), (None, "same text of some length, twice"), (None, "same text of some length, twice"), (1, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rid", "2 AS `g.c`", "3 AS place", "4 AS _doc", "5 AS text_hash")
    got = sorted(digest(docs, 20).collect(), key=str)
    expected = sorted([(r[0], *rest) for r, rest in zip(rows, by_hand([t for _, t in rows], 20))], key=str)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert digest(docs).collect() == []
    assert without_repeats(docs).collect() == []


def test_texts_without_repeats(spark):
    texts = ["one two three " + "é" * 20 + " four", "é" * 20 + " five", "nothing", None, "nothing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in without_repeats(docs, 20).collect()}
    assert got == {0: "one two three our", 1: "ive", 2: "nothing", 3: "", 4: "nothing"}


@pytest.mark.parametrize("length", [8, 30, 64, 200])
def test_offsets(length):
    width = offsets_of(length)
    assert width & (width - 1) == 0 and 3 <= length - width + 1


def test_default_length_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    expected = {r.doc_id: e for r, e in zip(rows, by_hand([r.text for r in rows], 200))}
    assert {r.doc_id: tuple(r)[1:] for r in digest(docs).collect()} == expected
    assert digest(docs).agg(F.sum("n_removed")).first()[0] > 0
