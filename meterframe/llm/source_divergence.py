"""How far the sources of a language differ in the terms they use.

A term's row is its counts in the sources of a language that have it, the source
with most documents first.  The share p of a term in a group (a source, or the
whole language) is in billionths, 1 + floor(10^9 (count + 1) / (N + V)), with N
occurrences of the V kept terms in the group; f(p, q) = floor((p - q)^2 / q).

Two sources s, t differ by the sum of f over all kept terms.  If no term
occurred in either this were V f(p0, q0), with p0, q0 the shares of count 0.  What
occurs corrects that sum:

* each (source, count) alone, against count 0 of every other source, times the
  number of terms that have it;
* each pair of counts in one row.  Rows are put into a frequent-pattern tree:
  equal rows count as one with a multiplicity, and a node stands for all rows
  that begin alike.  A node's pairs with its ancestors are worked out once, times
  the rows that pass through the node.

The tree is a table of paths; nodes are groups of equal paths.  A path is as long
as a term has sources, and the result holds all pairs of a language's sources,
so its size is theirs squared; nothing else grows faster than the input.

Null text, lang and source are empty strings; each row counts as a document;
groups without any term and languages without a kept term are reported (pairs
with value 0).  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterframe.joins import small
from meterframe.session import durable

LEAST_DOCS = 3
TOP_TERMS = 200
BILLION = 1_000_000_000
HELD_TERMS = 200_000  # in a task's tables before they are handed on
WIDE = "decimal(38,0)"

# Bytes of a term stay (A-Z lower-cased, all of code points above 127), others part terms.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, its occurrences and its documents."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def table(groups: dict) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [])
        for (lang, source), (occurrences, documents) in groups.items():
            out[0].extend([lang] * len(occurrences))
            out[1].extend([source] * len(occurrences))
            out[2].extend([t.decode() for t in occurrences])
            out[3].extend(occurrences.values())
            out[4].extend([documents[t] for t in occurrences])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, SCHEMA)], schema=SCHEMA)

    def run(batches):
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*[batch.column(c) for c in ("lang", "source", "text")]):
                words = text.as_py().encode().translate(LETTERS).split()
                occurrences, documents = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                held -= len(occurrences)
                occurrences.update(words)
                documents.update(set(words))
                held += len(occurrences)
                if held >= HELD_TERMS:
                    yield table(groups)
                    groups, held = {}, 0
        yield table(groups)

    found = rows.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def sources(docs: DataFrame) -> DataFrame:
    """Every (lang, source) with its place ``sid`` in the order of rows."""
    found = docs.groupBy(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).agg(F.count(F.lit(1)).alias("rows"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("rows"), "source"))
    return durable(found.select("lang", "source", place.alias("sid")), "sources")


def term_rows(counts: DataFrame, places: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, its count in the language and its row, for kept terms."""
    placed = counts.join(small(places), ["lang", "source"])
    rows = placed.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("sid", "n"))).alias("path")
    )
    return durable(rows.where(F.col("docs") >= least_docs).drop("docs"), "terms")


def tree(rows: DataFrame) -> DataFrame:
    """Nodes (lang, path from the root, times): every way in which rows begin,
    and the number of rows that begin so."""
    merged = rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    begun = merged.select("lang", "path", "times", F.explode(F.sequence(F.lit(1), F.size("path"))).alias("k"))
    return begun.select("lang", F.slice("path", F.lit(1), F.col("k")).alias("path"), "times").groupBy("lang", "path").agg(F.sum("times").alias("times"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count; decimals, as 10^9 times a count may not fit 64 bits."""
    wide = (F.lit(BILLION).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")).cast("decimal(30,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", wide, (total + kept).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """f; shares are at most 10^9 + 1, so squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def totals(rows: DataFrame, places: DataFrame) -> DataFrame:
    """lang, source, sid, N, V and p0 of each group, and N of its language."""
    kept = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    mine = rows.select("lang", F.inline("path")).groupBy("lang", "sid").agg(F.sum("n").alias("total"))
    all_groups = places.join(mine, ["lang", "sid"], "left").join(kept, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
    none = F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept")))
    return durable(all_groups.withColumn("none", none), "groups")


def side(groups: DataFrame, name: str) -> DataFrame:
    return groups.select("lang", *[F.col(c).alias(f"{name}_{c}") for c in ("sid", "total", "kept", "none")])


def pair_values(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a_sid, b_sid, value: the sum of f(p of a, q of b) over kept terms."""
    few = small(groups) is not groups

    def hint(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    a, b = side(groups, "a"), side(groups, "b")
    pa_, qb = share(F.col("a_n"), F.col("a_total"), F.col("a_kept")), share(F.col("b_n"), F.col("b_total"), F.col("b_kept"))
    p0, q0 = F.col("a_none"), F.col("b_none")
    # All terms absent from both.
    grid = a.join(hint(b), "lang").where("a_sid <> b_sid")
    base = grid.select("lang", "a_sid", "b_sid", F.coalesce(gap(p0, q0).cast(WIDE) * F.col("a_kept"), F.lit(0)).cast(WIDE).alias("value"))
    # A count of one source against absence from another, both ways round.
    last = nodes.select("lang", F.element_at("path", -1).alias("one"), "times").groupBy("lang", "one").agg(F.sum("times").alias("times"))
    alone = last.select("lang", F.col("one.sid").alias("sid"), F.col("one.n").alias("n"), "times")
    of_a = alone.withColumnsRenamed({"sid": "a_sid", "n": "a_n"}).join(hint(a), ["lang", "a_sid"]).join(hint(b), "lang").where("a_sid <> b_sid")
    of_b = alone.withColumnsRenamed({"sid": "b_sid", "n": "b_n"}).join(hint(b), ["lang", "b_sid"]).join(hint(a), "lang").where("a_sid <> b_sid")
    one_a = (gap(pa_, q0) - gap(p0, q0)).cast(WIDE) * F.col("times")
    one_b = (gap(p0, qb) - gap(p0, q0)).cast(WIDE) * F.col("times")
    # Nodes with their ancestors; pairs that several nodes share are added up first.
    above = nodes.where(F.size("path") > 1).select(
        "lang", F.element_at("path", -1).alias("y"), F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("x"), "times"
    )
    met = above.groupBy("lang", "x", "y").agg(F.sum("times").alias("times"))
    names = [F.col("x.sid").alias("x_sid"), F.col("x.n").alias("x_n"), F.col("y.sid").alias("y_sid"), F.col("y.n").alias("y_n")]
    met = met.select("lang", *names, "times")
    turned = met.select("lang", F.col("x_sid").alias("a_sid"), F.col("x_n").alias("a_n"), F.col("y_sid").alias("b_sid"), F.col("y_n").alias("b_n"), "times").unionByName(
        met.select("lang", F.col("y_sid").alias("a_sid"), F.col("y_n").alias("a_n"), F.col("x_sid").alias("b_sid"), F.col("x_n").alias("b_n"), "times")
    )
    both = turned.join(hint(a), ["lang", "a_sid"]).join(hint(b), ["lang", "b_sid"])
    two = (gap(pa_, qb) - gap(pa_, q0) - gap(p0, qb) + gap(p0, q0)).cast(WIDE) * F.col("times")

    def part(rows: DataFrame, value: Column) -> DataFrame:
        return rows.select("lang", "a_sid", "b_sid", value.cast(WIDE).alias("value"))

    every = base.unionByName(part(of_a, one_a)).unionByName(part(of_b, one_b)).unionByName(part(both, two))
    return every.groupBy("lang", "a_sid", "b_sid").agg(F.sum("value").cast("bigint").alias("value"))


def term_values(rows: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value, rank of the terms a source uses more than its language."""
    each = rows.select("lang", "term", F.col("n").alias("lang_n"), F.inline("path")).join(small(groups), ["lang", "sid"])
    shares = each.select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    more = shares.where("p > q").select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"))
    return ranked(more).where(F.col("rank") <= top)


def ranked(values: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank."""
    places = sources(docs)
    rows = term_rows(term_counts(docs), places, least_docs)
    groups = totals(rows, places)
    values = pair_values(durable(tree(rows), "nodes"), groups)
    named = values.join(
        small(groups.select("lang", F.col("sid").alias("a_sid"), "source")), ["lang", "a_sid"]
    ).join(small(groups.select("lang", F.col("sid").alias("b_sid"), F.col("source").alias("item"))), ["lang", "b_sid"])
    pairs = ranked(named.select("lang", "source", "item", "value"))
    out = pairs.withColumn("part", F.lit("pair")).unionByName(term_values(rows, groups, top).withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")
