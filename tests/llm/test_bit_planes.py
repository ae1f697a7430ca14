import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterframe.llm import bit_planes
from meterframe.llm.queries import tokenizer_file
from meterframe.llm.word_ids import WordEncoder
from meterframe.session import fresh_path


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(tokenizer_file())


def whole(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aB'sdtmé́ß1２ΣςİK<|>!#.- \n\t\r\x0b\x0c\x1c\x00　한")), max_size=30))
def test_words_give_the_ids_of_the_whole_text(encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(encoder, text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|startoftext|>b's", "don't", "", " \n", "Über, café; 'SE", "x" * 500])
def test_special_texts(encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(encoder, text)


def test_table_of_words_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr("meterframe.llm.word_ids.CACHED_WORDS", 3)
    small = WordEncoder(tokenizer_file())
    text = "one two three four five six one two three " * 3
    assert np.frombuffer(small.encode(text), "<u4").tolist() == whole(encoder, text)
    assert len(small) <= 3 and len(small.older) <= 3


@pytest.mark.parametrize("kind", ["byte", "bit"])
@given(ids=st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=50))
def test_planes_round_trip(kind, ids):
    data = np.array(ids, "<u4").tobytes()
    assert bit_planes.from_planes(bit_planes.to_planes(data, kind), len(ids), kind) == data


@given(st.lists(st.binary(max_size=20), min_size=1, max_size=5))
def test_crc_of_pieces(parts):
    assert bit_planes.joined_crc([zlib.crc32(p) for p in parts], [len(p) for p in parts]) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("kind,block", [("byte", 7), ("bit", 1000), ("byte", 1 << 16)])
def test_dataset_round_trip(spark, encoder, kind, block):
    texts = [(5, "one two"), (2, None), (9, ""), (3, "word " * 200), (5, "one two"), (None, "null id"), (5, "another"), (7, "é ü " * 9)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, part string").repartition(3)
    path = bit_planes.write(docs, fresh_path(spark, "planes"), tokenizer_file(), block_ids=block, kind=kind)
    rows = sorted(bit_planes.read_back(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 2, 3, 5, 5, 5, 7, 9]
    at, seen = 0, []
    for r in rows:
        assert r.start == at and r.n_tokens == r.n_stated
        at += r.n_tokens
        seen.append((r.doc_id, r.n_tokens, r.ids_crc32))
    ids = [(i, np.array([*whole(encoder, t or ""), 1], "<u4").tobytes()) for i, t in texts]
    expected = [(i, len(b) // 4, zlib.crc32(b)) for i, b in ids]
    assert sorted(seen, key=str) == sorted(expected, key=str)
    index = spark.read.parquet(f"{path}/index").orderBy("part", "chunk").collect()
    assert sum(r.n_ids for r in index) == at and all(r.n_ids <= block for r in index)
    assert [r.first_id for r in index] == list(np.cumsum([0, *[r.n_ids for r in index]])[:-1])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = bit_planes.write(docs, fresh_path(spark, "planes"), tokenizer_file())
    assert bit_planes.read_back(spark, path).collect() == []
