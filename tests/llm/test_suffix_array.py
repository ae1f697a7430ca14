import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterframe.llm.suffix_array import common_prefixes, suffix_array, type_b


def by_hand(data: bytes, depth: int):
    return sorted(range(len(data)), key=lambda i: data[i : i + depth].ljust(depth, b"\0"))


def check(data: bytes, depth: int):
    text = np.frombuffer(data, np.uint8)
    got = suffix_array(text, depth).tolist()
    assert sorted(got) == list(range(len(data)))
    starts = [data[i : i + depth].ljust(depth, b"\0") for i in got]
    assert starts == sorted(starts)
    shared = common_prefixes(text, np.array(got, np.int64), depth).tolist()
    for x, y, n in zip(starts, starts[1:], shared):
        same = next((k for k in range(depth) if x[k] != y[k]), depth)
        assert same == n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 97, 98, 255]), max_size=120), st.integers(1, 40))
def test_order_and_prefixes(values, depth):
    check(bytes(values), depth)


@pytest.mark.parametrize("data", [b"", b"a", b"aaaaaaaaaaaaaaaaaaaa", b"banana" * 30, b"\0\0\0a\0\0", bytes(range(256)) * 3, b"mississippi" * 20 + b"x"])
def test_special(data):
    for depth in (1, 7, 8, 9, 64, 200):
        check(data, depth)


@given(st.binary(max_size=60))
def test_types(data):
    text = np.frombuffer(data, np.uint8)
    if len(data):
        assert type_b(text).tolist() == [data[i:] < data[i + 1 :] for i in range(len(data))]


def test_runs_of_one_byte_are_linear():
    text = np.frombuffer(b"a" * 20_000 + b"b" * 20_000 + b"a" * 20_000, np.uint8)
    got = suffix_array(text, 16)
    assert len(np.unique(got)) == 60_000
