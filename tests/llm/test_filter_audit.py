import itertools
import random

import pytest
from pyspark.sql import functions as F

from meterframe.llm import filter_audit as fa

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def by_hand(rows, labels):
    """Each order and step over plain lists; rows are (doc_id, text, lang)."""
    marks = {}
    for doc_id, good, toxic in labels:
        if doc_id is not None:
            old = marks.get(doc_id, (False, False))
            marks[doc_id] = (old[0] or good == 1, old[1] or toxic == 1)
    judged = []
    for doc_id, text, lang in rows:
        text = text or ""
        fails = {f for f, bad in zip("ABCD", fa.fails_of(text)) if bad}
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
            fails.add("E")
        judged.append((lang or "", fails, *marks.get(doc_id, (False, False))))
    out = {}
    for part in {p for p, *_ in judged}:
        mine = [j for j in judged if j[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                failing = [j for j in mine if f in j[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(j[1] == {f} for j in mine), sum(j[2] for j in gone), sum(j[3] for j in gone)
                ]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return out


def odd_rows(seed, n=80):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = rng.choices(["some", "Words", "that", "VARY", "a", "little", "x%", "plain"] if rng.random() < 0.5 else [f"w{j}" for j in range(400)], k=rng.choice([0, 3, 99, 100, 120]))
        out.append((k, " ".join(words), rng.choice(["en", "de", None])))
    out += [(1, out[0][1], "en"), (None, out[2][1], "en"), (None, out[2][1], None), (90, None, "fr"), (91, "", "fr"), (92, "É É\x1f" * 50_000, "en"), (93, "A\tB\x0bC" * 70, "de")]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = odd_rows(seed)
    rng = random.Random(seed)
    labels = [(rng.choice([*range(95), None]), rng.randint(0, 1), rng.choice([0, 1, None])) for _ in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS rid", "2 AS part", "3 AS `a.b`", "true AS A", "7 AS good")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "5 AS part", "'x' AS `c.d`")
    got = {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in fa.filter_audit(docs, marks).collect()}
    assert got == by_hand(rows, labels)


def test_one_prefix(spark):
    rows = odd_rows(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = fa.judged(docs)
    failing = fa.failing_ids(judged)
    fails = {r.rid: {f for f in "ABCD" if r[f]} for r in judged.collect()}
    for r in failing["E"].collect():
        fails[r.rid].add("E")
    ids = judged.select("rid")
    assert {r.rid for r in fa.survivors(ids, failing, "BE").collect()} == {i for i, f in fails.items() if not f & {"B", "E"}}
    assert {r.rid for r in fa.removed(ids, failing, "BE", "A").collect()} == {i for i, f in fails.items() if "A" in f and not f & {"B", "E"}}
    assert {r.rid for r in fa.redundant(ids, failing, "BE", "A").collect()} == {i for i, f in fails.items() if "A" in f and f & {"B", "E"}}


def test_rows_meet_each_filter_once(spark):
    """The split reads rows once a filter, whatever the number of orders."""
    rows = spark.range(1000).withColumnRenamed("id", "rid").withColumn("part", F.lit("p"))
    tables = {f: rows.where(F.col("rid") % (k + 2) == 0).select("rid") for k, f in enumerate("ABC")}
    got = {r.failed: r.n for r in fa.classes(rows, tables, ["part"]).collect()}
    expected = {}
    for i in range(1000):
        key = "".join(f for k, f in enumerate("ABC") if i % (k + 2) == 0)
        expected[key] = expected.get(key, 0) + 1
    assert got == expected


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.filter_audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "x", "en")], "doc_id long, text string, lang string")
    got = fa.filter_audit(one, labels).where("filter_order = 'ABCDE'").orderBy("step").collect()
    assert [(r.kept, r.removed, r.good_lost) for r in got] == [(0, 1, 0)] + [(0, 0, 0)] * 4
