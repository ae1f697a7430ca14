"""Datasets that change by one file."""

import pytest

from meterframe.operators import splits
from meterframe.session import create_once, fresh_path, remove
from meterframe.sources import versions
from meterframe.sources.versions import Dataset, UnfinishedVersion


@pytest.fixture
def data(spark):
    return Dataset(spark, fresh_path(spark, "versions"))


def numbers(data):
    return sorted(r[0] for r in data.read().collect())


def test_append_and_replace(spark, data):
    with pytest.raises(FileNotFoundError):
        data.read()
    assert data.append(spark.range(3), "first")
    assert not data.append(spark.range(3), "first")
    assert data.append(spark.range(3))
    assert numbers(data) == [0, 0, 1, 1, 2, 2]
    data.replace(data.read().distinct())
    assert numbers(data) == [0, 1, 2]
    assert not data.append(spark.range(3), "first")
    assert data.version().number == 3


@pytest.mark.parametrize("change", ["append", "replace"])
def test_a_write_that_ends_between_the_steps(spark, data, monkeypatch, change):
    data.append(spark.range(2))

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "create_once", lost)
        with pytest.raises(OSError):
            getattr(data, change)(spark.range(9))
    assert numbers(data) == [0, 1]
    getattr(data, change)(spark.range(5, 6))
    assert numbers(data) == ([0, 1, 5] if change == "append" else [5])


def test_a_file_that_was_cut_off(spark, data):
    data.append(spark.range(2))
    cut = f"{data.root}/versions/{2:012d}"
    create_once(spark, cut, '{"folders": [')
    assert numbers(data) == [0, 1]
    with pytest.raises(UnfinishedVersion):
        data.append(spark.range(9))
    remove(spark, cut)
    data.append(spark.range(2, 3))
    assert numbers(data) == [0, 1, 2]


def test_two_writers_of_one_number(spark, data, monkeypatch):
    """Another writer commits after this one has looked for the last version."""
    data.append(spark.range(1))
    look, others = Dataset._last, [spark.range(10, 11)]

    def slow(self, whole):
        found = look(self, whole)
        if others and whole and len(calls) == 1:
            Dataset(spark, data.root).append(others.pop(), "other")
        calls.append(1)
        return found

    calls = []
    monkeypatch.setattr(Dataset, "_last", slow)
    assert data.append(spark.range(20, 21), "mine")
    assert numbers(data) == [0, 10, 20]
    assert set(data.version().batches) == {"other", "mine"}


def test_rows_that_a_check_refuses(spark, data):
    data.append(spark.range(2))

    def check(df):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        data.replace(spark.range(5), check=check)
    assert numbers(data) == [0, 1]


def test_folders_by_value_and_new_columns(spark, data):
    first = spark.range(4).selectExpr("id", "id % 2 AS part")
    data.append(first, partition_by=("part",))
    data.append(first, partition_by=("part",))
    assert sorted(map(tuple, data.read().select("id", "part").collect())) == sorted(2 * [(i, i % 2) for i in range(4)])


def test_create_once(spark):
    path = fresh_path(spark, "once")
    assert create_once(spark, path, "a") and not create_once(spark, path, "b")


def test_published_splits(spark, monkeypatch):
    """What readers see when a build ends early, or has an empty split."""
    root = fresh_path(spark, "splits")
    rows = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "id int, split string")
    names = ["train", "test"]
    splits.publish_splits(rows, root, names)

    def ids(name):
        return sorted(r.id for r in splits.read_splits(spark, root, name).collect())

    with pytest.raises(ValueError, match="test"):
        splits.publish_splits(rows.where("split = 'train'"), root, names)
    with monkeypatch.context() as m:
        m.setattr(versions, "create_once", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            splits.publish_splits(rows.where("id > 1"), root, names)
    assert ids("train") == [1, 3] and ids("test") == [2]
    splits.publish_splits(rows.where("id > 1"), root, names)
    assert ids("train") == [3] and ids("test") == [2]
    plan = splits.read_splits(spark, root, "train")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
