"""Sources mixed to target weights by Poisson replication.

A source of n of the N rows with target weight w gets the mean repetition rate
``w * total / n``.  Each row's count of copies is the Poisson quantile of a
number that its id and a seed give, so counts need no state and no sort, and a
task that runs again gives the same.  A rate above ``MAX_RATE`` is a sum of
independent Poisson numbers of equal smaller rates, each from a hash of its own.
Rows are repeated by their counts and then sorted by a hash over the whole
mixture.

Only built-in expressions are used.  A null source is a source of its own; one
whose weight is null or not above zero gets no copies.  Weights are scaled to sum to one
over the sources that are there.  Rows of equal ``doc_id``, also null ones, get
the same count, each.  All columns are kept; ``copy_no`` (from 0) and
``mix_key`` are added and replace columns of these names.  An empty table gives
an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterframe.llm.boxed import boxed, own, unboxed

MAX_RATE = 8.0  # of one Poisson number
STEPS = 60  # the chance of a larger number at this rate is below 1e-30
BROADCAST_SOURCES = 20_000  # rows of about 600 bytes


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the md5 of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def poisson_sums(rate: Column) -> Column:
    """Partial sums of exp(-rate) * rate^k / k!, for k below STEPS."""
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("sums"))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] * rate / i
        return F.struct(term.alias("term"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + term)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS - 1)), start, step, lambda s: s["sums"])


def copies(row_id: Column, rate: Column, parts: Column, sums: Column, seed: int) -> Column:
    """Copies of a row at a mean rate of any size: of each part, the least k with
    P(X <= k) > u, which is the number of ``sums`` that are not above u."""

    # A lambda's variable is worked out once; an expression in one, for each element.
    numbers = F.transform(F.sequence(F.lit(1), parts), lambda j: uniform(F.lit(seed), F.lit("n"), j, row_id))
    each = F.transform(numbers, lambda u: F.size(F.filter(sums, lambda t: t <= u)))
    return F.when(rate > 0, F.aggregate(each, F.lit(0), lambda a, x: a + x)).otherwise(0)


def rates(docs: DataFrame, weights: Column, total: float | None = None) -> tuple[DataFrame, int]:
    """Per source its rows, target weight and mean repetition rate, and the
    number of sources.  ``weights`` is over the columns source and n (the
    source's rows); ``total`` is the wanted number of rows, N if not given."""
    counted = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "w", F.greatest(F.coalesce(weights.cast("double"), F.lit(0.0)), F.lit(0.0))
    )
    whole = counted.agg(F.sum("w").alias("w"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("sources")).first()
    all_w, size = float(whole["w"] or 0.0), float(total if total is not None else whole["n"] or 0)
    rate = F.when(F.col("w") > 0, F.col("w") / F.lit(all_w) * F.lit(size) / F.col("n")).otherwise(0.0)
    return counted.select("source", "n", "w", rate.cast("double").alias("rate")), whole["sources"]


def tempered(power: float) -> Column:
    """Weights that grow as a power of a source's rows; below one, small sources gain."""
    return F.pow(F.col("n").cast("double"), F.lit(float(power)))


def mix(docs: DataFrame, weights: Column, seed: int = 1, total: float | None = None) -> DataFrame:
    """The mixture, in global order of ``mix_key``."""
    kept = docs.drop("copy_no", "mix_key")  # replaced by the mixture's own
    rate, sources = rates(kept, weights, total)
    parts = F.ceil(F.greatest(F.col("rate") / MAX_RATE, F.lit(1.0))).cast("int")
    # Sums are worked out once for each source; a row only looks its number up.
    rate = rate.select(F.col("source").alias("of"), "rate", parts.alias("parts")).withColumn("sums", poisson_sums(F.col("rate") / F.col("parts")))
    if sources <= BROADCAST_SOURCES:  # counted; same rows either way, but documents need not move
        rate = F.broadcast(rate)
    rows = boxed(kept).join(rate, own("source").eqNullSafe(F.col("of")))
    numbered = rows.withColumn("n", copies(own("doc_id"), F.col("rate"), F.col("parts"), F.col("sums"), seed)).where("n > 0")
    repeated = numbered.select("row", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy_no"))
    keyed = repeated.withColumn("mix_key", uniform(F.lit(seed), F.lit("o"), F.col("copy_no"), own("doc_id")))
    return unboxed(keyed.sort("mix_key", own("doc_id"), "copy_no"), kept.columns, "copy_no", "mix_key")
