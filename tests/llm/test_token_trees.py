import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterframe.llm import token_trees
from meterframe.llm.queries import tokenizer_file

FILE = tokenizer_file("byte_bpe_50k.tiktoken")
COUNTS = token_trees.PieceCounts(FILE, public_tokenizers.PATTERN)
ALPHABET = st.text(st.sampled_from(list("ab's 1\n\t.,é한 \x0b")), max_size=25)


def whole(text):
    return len(COUNTS.encoding.encode_ordinary(text))


@pytest.fixture(autouse=True, params=[2, 32])
def leaf(request, monkeypatch):
    monkeypatch.setattr(token_trees, "LEAF", request.param)


@settings(max_examples=500, deadline=None)
@given(ALPHABET, st.lists(st.tuples(st.integers(-3, 60), st.integers(-3, 60), ALPHABET), max_size=4))
def test_counts_after_edits_are_those_of_the_new_text(text, edits):
    tree = token_trees.build(text, COUNTS)
    assert tree.total[2] == whole(text)
    for start, end, new in edits:
        text, tree, _ = token_trees.edit(text, tree, start, end, new, COUNTS)
        assert tree.total.tolist() == [len(text), len(COUNTS.cut.findall(text)), whole(text)]
        again = token_trees.Tree.from_bytes(tree.to_bytes())
        assert all(np.array_equal(a, b) for a, b in zip(again.levels, tree.levels, strict=True))
        rebuilt = token_trees.Tree(tree.levels[0])
        assert all(np.array_equal(a, b) for a, b in zip(rebuilt.levels, tree.levels, strict=True))


def test_little_is_encoded_again():
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta", "it's", "x1", "\n\n"]) for _ in range(50000))
    tree = token_trees.build(text, COUNTS)
    for _ in range(20):
        at = rng.randrange(len(text))
        text, tree, work = token_trees.edit(text, tree, at, at + rng.randrange(5), rng.choice(["", " ", "new words", "\n"]), COUNTS)
        assert work < 2000
    assert tree.total[2] == whole(text)


def test_long_insertions_and_deletions():
    text = "one two " * 500
    tree = token_trees.build(text, COUNTS)
    for start, end, new in ((1000, 1000, "many more words " * 3000), (500, 40000, ""), (0, 10**9, ""), (0, 0, "back again")):
        text, tree, _ = token_trees.edit(text, tree, start, end, new, COUNTS)
        assert tree.total[2] == whole(text)


def test_rows(spark):
    texts = [(1, "some text here"), (1, "some text here"), (2, None), (3, ""), (None, "no id"), (4, "word " * 20000)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts], "doc_id long, text string, n_tokens int")
    kept = token_trees.keep(docs, FILE, public_tokenizers.PATTERN)
    steps = [(1, 2, 0, 4, None), (1, 1, 4, 9, " new"), (4, 0, 7, 7, "é"), (2, 0, 0, 0, "text"), (9, 0, 0, 1, "x")]
    edits = token_trees.listed(spark.createDataFrame(steps, "doc_id long, seq int, start int, `end` int, text string"))
    got = token_trees.follow(kept.join(edits, "doc_id", "left"), "edits", FILE, public_tokenizers.PATTERN).collect()
    seen = sorted(((r.doc_id, r.text, r.n_tokens, r.n_before) for r in got), key=str)
    new = {1: " new here", 2: "text", 4: "word weéord " + "word " * 19998}
    new[4] = ("word " * 20000)[:7] + "é" + ("word " * 20000)[7:]
    expected = [(i, new.get(i, t or ""), whole(new.get(i, t or "")), whole(t or "")) for i, t in texts]
    assert seen == sorted(expected, key=str)
    empty = docs.limit(0)
    assert token_trees.keep(empty, FILE, public_tokenizers.PATTERN).collect() == []
