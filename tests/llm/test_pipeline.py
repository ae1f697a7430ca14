import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterframe.llm import toxicity
from meterframe.llm.queries import tokenizer_file
from meterframe.llm.word_ids import WordEncoder
from meterframe.session import durable

from test_mixing import brute as mixed_counts
from test_near_dedup import brute as components_of, set_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after each stage, given some odd rows and an extra column."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("rank", F.lit("x"))
    odd = spark.createDataFrame(
        [(10**6, None, "en", "odd", 0, "y"), (10**6 + 1, "", "en", "odd", 0, "y"), (10**6 + 2, "a b", None, None, None, "y"), (10**6 + 2, "a b", None, None, None, "y"),
         (None, "some words of no id at all", "en", "odd", 3, "y"), (10**6 + 3, "lorem " * 40000, "en", "odd", 1, "y")],
        docs.schema,
    )
    docs, out = docs.union(odd), []
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, SF), name)
        out.append(docs.collect())
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_ids"]
    for rows in steps[1:5]:
        assert rows[0].__fields__ == steps[0][0].__fields__
    assert steps[5][0].__fields__ == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_toxicity(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels, F.lit(True))
    weights = toxicity.Weights(model)
    expected = [r for r in steps[0] if toxicity.score_text(r.text, weights)[0] < 0.5]
    assert key(steps[1]) == key(expected) and len(expected) < len(steps[0])


def test_near_dedup(steps):
    rows = steps[1]
    truth = components_of([(r.doc_id, r.text) for r in rows], 80)
    ids = sorted({i for i, n, _, keep in truth if keep and n})
    assert sorted(r.doc_id for r in steps[2] if r.doc_id is not None and set_of(r.text)) == ids
    assert key([r for r in steps[2] if not set_of(r.text)]) == key([r for r in rows if not set_of(r.text)])
    assert set(key(steps[2])) <= set(key(rows))


def test_decontamination(spark, steps):
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + 8]) for w in items for i in range(len(w) - 7)}

    def hit(text):
        w = (text or "").lower().split()
        return any(tuple(w[i : i + 8]) in grams for i in range(len(w) - 7))

    assert key(steps[3]) == key([r for r in steps[2] if not hit(r.text)])


def test_mixing(steps):
    counts = {}
    for (i, _, _), n in mixed_counts([(r.doc_id, r.source) for r in steps[3]], lambda s, n: float(n) ** corpus_pipeline.POWER, corpus_pipeline.SEED).items():
        counts[i] = counts.get(i, 0) + n
    got = {}
    for r in steps[4]:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == counts
    assert set(key(steps[4])) <= set(key(steps[3]))


def test_token_ids(steps):
    encoder = WordEncoder(tokenizer_file())
    ids = [(r.doc_id, np.array([*encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for r in steps[4]]
    expected = sorted(((i, len(b) // 4, zlib.crc32(b)) for i, b in ids), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in steps[5]), key=str) == expected
    rows = sorted(steps[5], key=lambda r: r.start)
    assert [r.start for r in rows] == list(np.cumsum([0, *[r.n_tokens for r in rows]])[:-1])
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_tasks_load_no_pandas():
    """Workers of all stages stay alive; pandas would be held by each of them."""
    import subprocess
    import sys

    names = "bit_planes, mixing, near_dedup, template_match, toxicity"
    code = f"import sys; from meterframe.llm import {names}; sys.exit('pandas' in sys.modules or any('pandas_udf' in open(m.__file__).read() for m in ({names})))"
    root = __file__.rsplit("/tests/", 1)[0]
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
