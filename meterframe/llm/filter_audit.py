"""How filters of documents act together, in every order they can be applied.

Each filter has a table of the ids of rows that fail it.  Left-semi and
left-anti joins with these tables split the rows, filter by filter, into
classes of rows that fail the same filters, so each row passes one pair of joins
a filter however many orders there are.  A class then stands for its rows: its
table of failed filters is joined with the steps of all orders, and

* a left-anti join with the failures of earlier steps gives what a step removes,
* a left-semi join with them gives what a step would have removed, had an
  earlier one not done so (redundant),

with the labels of the rows lost.  Survivors of a step are the rows of the part
that no step so far has removed.

Rows are counted, not ids: repeated rows count each.  A null text is empty, a
null part (``lang``) the empty string.  A null id has no labels, and neither
fails "identical to a smaller id" nor lets others fail it.  If an id has several
labels the largest counts.  Empty tables have no parts and no result rows.
Columns other than doc_id, text and lang, and doc_id, quality and toxic of the
labels, are ignored.
"""

from __future__ import annotations

import itertools
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterframe.joins import meet
from meterframe.session import durable

LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of words
MOST_CAPITALS = 10  # percent of characters
SIGNS = re.compile(r"[#$%&*|]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
FILTERS = "ABCDE"


def fails_of(text: str) -> list[bool]:
    """Filters A to D: few words, few distinct words, many capitals, signs."""
    data = text.encode()
    words = data.split()  # of bytes: at U+0020 and U+0009 to U+000D
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return [
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * len(text),
        SIGNS.search(text) is not None,
    ]


def judged(docs: DataFrame) -> DataFrame:
    """rid, doc_id, part, whether the row fails A to D, and its text's hash.
    Written, so that a row keeps its ``rid``."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            fails = list(zip(*[fails_of(t) for t in texts])) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    *[pa.array(f, pa.bool_()) for f in fails],
                    pa.array([xxhash.xxh3_128_digest(t.encode()) for t in texts], pa.binary()),
                ],
                ["doc_id", "part", *FILTERS[:4], "text_key"],
            )

    types = ", ".join(f"{f} boolean" for f in FILTERS[:4])
    found = rows.mapInArrow(run, f"doc_id bigint, part string, {types}, text_key binary")
    return durable(found.withColumn("rid", F.monotonically_increasing_id()), "judged")


def copies(rows: DataFrame) -> DataFrame:
    """rid of rows whose text a row of a smaller doc_id has."""
    first = rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"))
    several = durable(first.where("n > 1"), "copies")
    return meet(rows.select("rid", "doc_id", "text_key"), several, ["text_key"]).where("doc_id > least").select("rid")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``, 0 or 1."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).cast("int").alias("good"), F.max(F.col("toxic") == 1).cast("int").alias("toxic")
    )
    named = rows.where("doc_id is not null").join(marks, "doc_id", "left")
    nameless = rows.where("doc_id is null").withColumns({c: F.lit(None).cast("int") for c in ("good", "toxic")})
    return named.unionByName(nameless).fillna(0, ["good", "toxic"])


def classes(rows: DataFrame, failing: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """The number of rows of each set of failed filters, by the columns ``by``.

    ``rows`` has rid; ``failing`` has a table of rid per filter."""
    left = rows.select("rid", *by).withColumn("failed", F.lit("").cast("string"))
    for name, ids in failing.items():
        hit = left.join(ids, "rid", "left_semi").withColumn("failed", F.concat("failed", F.lit(name)))
        left = durable(hit.unionByName(left.join(ids, "rid", "left_anti")), f"split-{name}")
    return left.groupBy(*by, "failed").agg(F.count(F.lit(1)).alias("n"))


def survivors(rows: DataFrame, failing: dict[str, DataFrame], prefix: str) -> DataFrame:
    """Rows (with rid) left after the filters of ``prefix``."""
    for name in prefix:
        rows = rows.join(failing[name], "rid", "left_anti")
    return rows


def removed(rows: DataFrame, failing: dict[str, DataFrame], prefix: str, name: str) -> DataFrame:
    """Rows that ``name`` takes out after the filters of ``prefix``."""
    return survivors(rows, failing, prefix).join(failing[name], "rid", "left_semi")


def redundant(rows: DataFrame, failing: dict[str, DataFrame], prefix: str, name: str) -> DataFrame:
    """Rows that fail ``name`` but are gone after the filters of ``prefix``."""
    return rows.join(failing[name], "rid", "left_semi").join(survivors(rows, failing, prefix).select("rid"), "rid", "left_anti")


def steps_of(parts: DataFrame, filters: str) -> DataFrame:
    """Each row of ``parts`` with every step of every order of the filters."""
    orders = ",".join("".join(p) for p in itertools.permutations(filters))
    named = parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
    steps = named.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    return steps.withColumn("filter", F.expr("substring(filter_order, step, 1)"))


def audit(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, from the classes of rows: part, good,
    toxic, failed (letters of filters) and n.  Written tables of classes are
    small: two to the power of the filters for each part and pair of labels."""
    cells = durable(cells.withColumn("cell", F.monotonically_increasing_id()), "cells")
    steps = steps_of(cells.groupBy("part").agg(F.sum("n").alias("total")), filters)
    failed = cells.where("failed <> ''").select("part", "cell", F.explode(F.split("failed", "(?<=.)(?=.)")).alias("filter"))
    tried = steps.select("part", "filter_order", "step", "filter").join(failed, ["part", "filter"])
    before = tried.select("filter_order", "cell", F.col("step").alias("earlier"))
    same = (tried["filter_order"] == before["filter_order"]) & (tried["cell"] == before["cell"]) & (before["earlier"] < tried["step"])
    of_cell = cells.select("cell", "n", "good", "toxic", (F.length("failed") == 1).alias("alone"))
    outcome = tried.join(before, same, "left_anti").withColumn("taken", F.lit(1)).unionByName(
        tried.join(before, same, "left_semi").withColumn("taken", F.lit(0))
    )

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    gone = F.col("taken") == 1
    keys = ["part", "filter_order", "step", "filter"]
    counted = outcome.join(of_cell, "cell").groupBy(*keys).agg(
        rows_where(gone).alias("removed"),
        rows_where(~gone).alias("redundant"),
        rows_where(F.col("alone")).alias("unique_fails"),
        rows_where(gone & (F.col("good") == 1)).alias("good_lost"),
        rows_where(gone & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    full = durable(steps.join(counted, keys, "left").fillna(0), "steps")
    shares = full.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    so_far = full.select("part", "filter_order", F.col("step").alias("upto"), "removed")
    kept = (
        full.select("part", "filter_order", "step", "total")
        .join(so_far, ["part", "filter_order"])
        .where("upto <= step")
        .groupBy("part", "filter_order", "step")
        .agg((F.first("total") - F.sum("removed")).alias("kept"))
    )
    done = full.join(kept, ["part", "filter_order", "step"]).join(shares, ["part", "filter"])
    numbers = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return done.select("part", "filter_order", F.col("step").cast("int").alias("step"), *[F.col(c).cast("bigint").alias(c) for c in numbers])


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """The table of failing ids of each of the five filters, written."""
    tables = {f: durable(rows.where(F.col(f)).select("rid"), f"fails-{f}") for f in FILTERS[:4]}
    return tables | {"E": durable(copies(rows), "fails-E")}


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = judged(docs)
    marked = labelled(rows.select("rid", "doc_id", "part"), labels)
    return audit(classes(marked, failing_ids(rows), ["part", "good", "toxic"]))
