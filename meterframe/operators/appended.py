"""Key uniqueness of a batch against what is stored, without reading all of it.

Each stored month has a bit filter of fixed size over the hashes of its keys.  A
key whose bits are not all set is new for certain.  The others, *suspects*, are
looked up exactly, in the folders of their months only.  A filter that is too
small makes more suspects, never another result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

WORDS = 1 << 17  # of 64 bits, for each month: one megabyte
HASHES = 3
NO_MONTH = "none"  # rows without time


def month_of(time: str = "timestamp") -> Column:
    """The folder a reading is stored in."""
    return F.coalesce(F.date_format(time, "yyyy-MM"), F.lit(NO_MONTH))


def _bits(rows: DataFrame, keys: Sequence[str], kept: Sequence[str], words: int) -> DataFrame:
    """(kept, word, bit) of each hash of a row's key."""
    hashes = [F.xxhash64(F.lit(i), *[F.col(k) for k in keys]) for i in range(HASHES)]
    return rows.select(*kept, F.explode(F.array(*hashes)).alias("__h")).select(
        *kept,
        F.pmod(F.shiftrightunsigned("__h", 6), F.lit(words)).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("__h", F.lit(64)).cast("int")).alias("bit"),
    )


def key_filter(stored: DataFrame, keys: Sequence[str] = ("timestamp", "object_id"), words: int = WORDS) -> DataFrame:
    """(month, word, bits): the filter of each month of ``stored``, which has a
    column ``month``.  Filters of batches merge by ``merge_filters``."""
    return merge_filters(_bits(stored, keys, ["month"], words).withColumnRenamed("bit", "bits"))


def merge_filters(*filters: DataFrame) -> DataFrame:
    whole = filters[0]
    for f in filters[1:]:
        whole = whole.unionByName(f)
    return whole.groupBy("month", "word").agg(F.bit_or("bits").alias("bits"))


def suspects(batch: DataFrame, filters: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """(month, keys, n): keys of the batch that may be stored, or come twice
    within it, with their rows in the batch."""
    counted = durable(batch.groupBy("month", *keys).agg(F.count(F.lit(1)).alias("n")), "batch_keys")
    # Parts of a key meet again by its values; two nulls are alike in a grouping.
    hit = (
        _bits(counted, keys, ["month", *keys, "n"], words)
        .join(filters, ["month", "word"])
        .where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
        .groupBy("month", *keys, "n")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where(F.col("hits") == HASHES)
        .drop("hits")
    )
    twice = counted.where("n > 1")
    return hit.unionByName(twice).distinct()


def append_key_violations(
    batch: DataFrame,
    stored: DataFrame,
    filters: DataFrame,
    keys: Sequence[str] = ("timestamp", "object_id"),
    words: int = WORDS,
) -> DataFrame:
    """Keys that an append would repeat: (keys, in_batch, in_store).

    ``stored`` lies in folders by ``month``; ``batch`` has that column as well
    (``month_of``).  Keys with nulls are alike if the nulls stand in the same
    place.
    """
    found = durable(suspects(batch, filters, keys, words), "suspects")
    months = [r["month"] for r in found.select("month").distinct().collect()]
    looked = stored.where(F.col("month").isin(months)) if months else stored.limit(0)
    s, k = looked.select("month", *keys).alias("s"), found.alias("k")
    same = F.lit(True)
    for c in ("month", *keys):
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"k.{c}"))
    there = s.join(k, same, "left_semi").groupBy("month", *keys).agg(F.count(F.lit(1)).alias("in_store")).alias("t")
    both = F.lit(True)
    for c in ("month", *keys):
        both = both & F.col(f"k.{c}").eqNullSafe(F.col(f"t.{c}"))
    return (
        k.join(there, both, "left")
        .select(*[F.col(f"k.{c}") for c in keys], F.col("n").alias("in_batch"), F.coalesce("in_store", F.lit(0)).alias("in_store"))
        .where("in_batch + in_store > 1")
    )
