"""The registered queries against brute force on a small table."""

import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from meterframe.llm import secret_scan, token_trees
from meterframe.llm.queries import tokenizer_file
from meterframe.llm.word_ids import WordEncoder

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op5(spark, texts):
    import public_tokenizers

    counts = token_trees.PieceCounts(tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    from meterframe.llm.queries import edits_of
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    edits = {r.doc_id: r.e for r in docs.select("doc_id", edits_of(F.coalesce("text", F.lit("")), F.col("doc_id")).alias("e")).collect()}
    for r in entry.queries()["op5_token_trees"](spark, SF).collect():
        text = texts[r.doc_id]
        assert r.n_before == len(counts.encoding.encode_ordinary(text))
        for e in edits[r.doc_id]:
            start = min(e.start, len(text))
            text = text[:start] + e.text + text[max(start, min(e.end, len(text))) :]
        assert (r.n_tokens, r.n_chars) == (len(counts.encoding.encode_ordinary(text)), len(text))


def test_op9(spark, texts):
    tokenizer = WordEncoder(tokenizer_file()).tokenizer
    at, expected = 0, []
    for i in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = entry.queries()["op9_bit_planes"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == expected


def test_op10(spark, texts):
    for r in entry.queries()["op10_secret_scan"](spark, SF).collect():
        base = secret_scan.base_spans_plainly(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in secret_scan.BASE)
        assert r.base_sha256 == secret_scan.sha256_hex(secret_scan.joined(base))
        assert set(secret_scan.joined(base).split(",")) <= set(r.spans.split(","))


def test_op4(spark, texts):
    rows = entry.queries()["op4_noisy_or_toxicity"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_op8_finds_every_shared_run_of_words(spark, texts):
    items = {r.item_id: r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    expected = set()
    for i, w in items.items():
        grams = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
        for d, text in texts.items():
            v = text.lower().split()
            if any(tuple(v[k : k + 8]) in grams for k in range(len(v) - 7)):
                expected.add((d, i))
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op8_template_match"](spark, SF).collect()}
    assert got >= expected and expected
