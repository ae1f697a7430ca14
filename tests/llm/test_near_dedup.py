import random

import pytest

from meterframe.llm import near_dedup
from meterframe.llm.components import components


def words_of(text):
    return [w for w in (text or "").encode().lower().split() if w]


def set_of(text):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows, percent):
    """doc_id -> (set size, component id), comparing all pairs."""
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    root[find(i)] = find(j)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if find(m) == find(k) and rows[m][0] is not None]
        least = min(ids) if ids and sets[k] else i
        out.append((i, len(sets[k]), least, i is not None and i == least))
    return sorted(out, key=str)


def linked(spark, rows, percent=85):
    docs = spark.createDataFrame([(i, t, b"x") for i, t in rows], "doc_id long, text string, cls binary").repartition(3)
    return sorted((tuple(r) for r in near_dedup.link(docs, percent).collect()), key=str)


def near_copies(rng, n, words, edits, start):
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    rows = []
    for k in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        rows.append((start + k, " ".join(copy)))
    return rows


def corpus(seed):
    rng = random.Random(seed)
    rows = near_copies(rng, 60, 200, 5, 0) + near_copies(rng, 12, 80, 2, 100) + near_copies(rng, 8, 400, 12, 200)
    rows += [(300 + k, " ".join(f"u{rng.randrange(10**5)}" for _ in range(rng.randint(1, 60)))) for k in range(80)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(400 + k, passage + " " + " ".join(f"q{rng.randrange(10**5)}" for _ in range(rng.randint(5, 90)))) for k in range(60)]
    return rows


EDGES = [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "One TWO"), (905, "one two three four five"), (906, "é " * 30), (907, "é " * 31), (3, "one two"), (903, "one two")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    rows = corpus(seed) + EDGES
    assert linked(spark, rows) == brute(rows, 85)


def test_large_nodes_and_blocks(spark, monkeypatch):
    """A dense group around the threshold, in nodes far larger than a leaf."""
    monkeypatch.setattr(near_dedup, "LEAF", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 9)
    rng = random.Random(7)
    rows = near_copies(rng, 150, 150, 9, 0) + near_copies(rng, 100, 150, 6, 1000)
    assert linked(spark, rows) == brute(rows, 85)


def test_threshold_is_exact(spark):
    a = " ".join(f"t{k}" for k in range(104))  # 100 shingles
    for extra, same in ((17, True), (18, False)):  # 100 / 117 and 100 / 118
        rows = [(1, a), (2, a + " " + " ".join(f"z{k}" for k in range(extra)))]
        assert linked(spark, rows) == brute(rows, 85)
        assert (linked(spark, rows)[1][2] == 1) == same


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (None, "x y z x y z"), (None, None)]
    assert linked(spark, rows) == brute(rows, 85)
    assert linked(spark, []) == []


def test_long_text(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60000))
    rows = [(1, long), (2, long + " more"), (3, long[: len(long) // 2])]
    assert linked(spark, rows) == brute(rows, 85)


def test_one_row_of_each_component_stays(spark):
    rows = corpus(3) + EDGES + [(None, "k l m n o p"), (None, "k l m n o p"), (None, "")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, component string")
    kept = near_dedup.without_near_duplicates(docs, 80)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    truth = brute(rows, 80)
    ids = sorted(i for i, n, _, keep in set(truth) if keep and n)
    assert sorted(i for i, t in got if i is not None and set_of(t)) == ids
    assert [t for i, t in got if i is None and set_of(t)] == ["k l m n o p"]
    blank = [(i, t) for i, t in rows if not set_of(t)]
    assert sorted(((i, t) for i, t in got if not set_of(t)), key=str) == sorted(blank, key=str)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 30)] + [(7, 7), (500, 400)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 1 for k in range(1, 30)}, 400: 400, 500: 400}
