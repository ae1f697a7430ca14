"""Boosted trees, one model per meter, grown for all meters together.

A meter's rows are dealt to blocks of bounded size, in which each feature is one
byte: the number of its bin among the meter's own quantiles, or ``MISSING``.  One
job then grows one level of the current tree of every meter: blocks give
histograms (meter, node, feature, bin -> residuals, rows), Spark adds them up, and
the best split of each node follows from running sums over at most 256 bins.
No meter is ever in one task, and nothing per meter comes to the driver.

* Residuals enter as whole millionths, so histograms are exact: they do not
  depend on the order of rows, and the larger child's is its parent's less the
  smaller child's.
* Leaves are split best first.  A node's *rank value* is the least gain on the
  way from the root to it; the nodes that best-first growth splits within its
  number of leaves are those with the largest rank values.  A node that is not
  among them at one level will not be later either, so its children are not
  worked out.
* Leaf values are soft-thresholded by ``l1`` and shrunk by ``l2``; missing
  values go to the side that gains more (without any in training, to the side
  with more rows).

Nodes are numbered 1 for the root, 2 i and 2 i + 1 for the children of i.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rounding import finite, to_units
from ..joins import BROADCAST_ROWS, meet
from ..session import durable, remove
from .series import SeriesOrder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MISSING = 255
DIGITS = 6  # of residuals in histograms
BLOCK_ROWS = 16_384
SLICE_BLOCKS, SLICE_BYTES = 256, 8_000_000  # of blocks that a task turns to rows at once
ACCURACY = 10_000  # of the quantiles: a rank is off by rows / ACCURACY at most


@dataclass(frozen=True)
class TreeSettings:
    """The documented parameters of the per-customer model."""

    trees: int = 400
    step: float = 0.05
    leaves: int = 32
    depth: int = 12
    min_rows: int = 50
    l1: float = 0.5
    l2: float = 0.5
    bins: int = MISSING

    def __post_init__(self):
        if not (2 <= self.bins <= MISSING and self.leaves >= 2 and 1 <= self.depth <= 30 and self.min_rows >= 1):
            raise ValueError(f"settings out of range: {self}")


# -- blocks -------------------------------------------------------------------


def _numbers(df: DataFrame, key: str, features: Sequence[str], others: Sequence[Column]) -> DataFrame:
    x = F.array(*[finite(F.col(c).cast("double")) for c in features]).alias("x")
    return df.where(F.col(key).isNotNull()).select(F.col(key), x, *others, F.xxhash64(*df.columns).alias("__mark"))


def _dealt(rows: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Adds ``block``, so that (key, block) has about BLOCK_ROWS rows; ``counts``
    is a written table (key, n)."""
    return meet(rows, counts, [key]).withColumn("block", F.pmod("__mark", _block_count()).cast("int")).drop("n", "__mark")


def _block_count() -> Column:
    return F.greatest(F.ceil(F.col("n") / F.lit(float(BLOCK_ROWS))), F.lit(1))


def _per_block(facts: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` of a meter's facts, once for each of its blocks, which are
    named ``__key`` and ``__block``."""
    each = facts.withColumn("__block", F.explode(F.sequence(F.lit(0), (_block_count() - 1).cast("int"))))
    return each.select(F.col(key).alias("__key"), "__block", *[F.col(c).alias(f"__{c}") for c in columns])


def _blocks(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """One row per block: bins (rows x features), y, and the level as prediction."""
    kind = dict(rows.dtypes)[key]
    dealt = _dealt(rows, facts.select(key, "n"), key)
    edges = _per_block(facts, key, ["level", "edges"])

    def pack(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        if not n:
            return pa.table({key: right.column("__key").slice(0, 0), **{c: pa.array([], t) for c, t in empty.items()}})
        values = left.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        binned = np.full(values.shape, MISSING, np.uint8)
        for f, edge in enumerate(right.column("__edges")[0].as_py()):
            known = ~np.isnan(values[:, f])
            binned[known, f] = np.searchsorted(np.array(edge, float), values[known, f])
        level = np.full(n, right.column("__level")[0].as_py())
        y = left.column("y").to_numpy()
        return pa.table(
            {
                key: right.column("__key").slice(0, 1),
                "block": right.column("__block").slice(0, 1),
                "bins": pa.array([binned.tobytes()], pa.binary()),
                "y": pa.array([y.tobytes()], pa.binary()),
                "pred": pa.array([level.tobytes()], pa.binary()),
            }
        )

    empty = {"block": pa.int32(), "bins": pa.binary(), "y": pa.binary(), "pred": pa.binary()}
    packed = dealt.groupBy(key, "block").cogroup(edges.groupBy("__key", "__block"))
    return packed.applyInArrow(pack, f"{key} {kind}, block int, bins binary, y binary, pred binary")


def _routed(bins: np.ndarray, splits: list[dict]) -> np.ndarray:
    """The node of each row."""
    node = np.ones(len(bins), np.int64)
    for s in sorted(splits, key=lambda s: s["node"]):
        here = np.flatnonzero(node == s["node"])
        column = bins[here, s["feature"]]
        left = np.where(column == MISSING, s["missing_left"], column <= s["bin"])
        node[here] = 2 * s["node"] + 1 - left
    return node


def _some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of blocks in slices of at most SLICE_BLOCKS blocks, and about SLICE_BYTES bytes."""
    step = max(1, min(SLICE_BLOCKS, SLICE_BYTES * batch.num_rows // max(batch.get_total_buffer_size(), 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _with_tree(blocks: DataFrame, tree: DataFrame, key: str, listed: Sequence[str]) -> DataFrame:
    """Blocks of the meters of ``tree`` (one written row per meter, with arrays).
    With few elements in all, blocks need not move."""
    elements = tree.agg(F.sum(reduce(lambda a, b: a + b, [F.size(c) for c in listed])) + F.count(F.lit(1))).first()[0] or 0
    return blocks.join(F.broadcast(tree) if elements <= BROADCAST_ROWS else tree, key)


def _block_histograms(blocks: DataFrame, width: int, key: str) -> DataFrame:
    """(key, node, feature, bin, g, n) of the wanted nodes, per block."""
    kind = dict(blocks.dtypes)[key]

    def histogram(row: dict) -> list[np.ndarray]:
        bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, width)
        residual = np.rint((np.frombuffer(row["y"]) - np.frombuffer(row["pred"])) * 10.0**DIGITS)
        node, parts = _routed(bins, row["splits"]), []
        for wanted in row["wanted"]:
            here = np.flatnonzero(node == wanted)
            place = (bins[here] + np.arange(width) * 256).ravel()
            n = np.bincount(place, minlength=width * 256)
            g = np.bincount(place, np.repeat(residual[here], width), width * 256)  # whole numbers, exact
            seen = np.flatnonzero(n)
            parts.append(np.stack([np.full(len(seen), wanted), seen // 256, seen % 256, g[seen].astype(np.int64), n[seen]]))
        return parts

    def run(batches):
        for batch in batches:
            # Blocks give rows a few at a time, so that neither a batch of
            # many small blocks nor one of large ones is held as Python objects.
            for some in _some(batch.select([key, "bins", "y", "pred", "splits", "wanted"])):
                keys, parts = [], []
                for i in range(some.num_rows):
                    found = histogram(some.slice(i, 1).drop_columns([key]).to_pylist()[0])
                    keys += [np.full(p.shape[1], i) for p in found]
                    parts += found
                node, feature, bin_, g, n = np.concatenate(parts, axis=1) if parts else np.zeros((5, 0), np.int64)
                which = pa.array(np.concatenate(keys) if keys else [], pa.int64())
                numbers = [pa.array(c.astype(t)) for c, t in zip((node, feature, bin_, g, n), (np.int64, np.int32, np.int32, np.int64, np.int64))]
                yield pa.RecordBatch.from_arrays([some.column(key).take(which), *numbers], [key, "node", "feature", "bin", "g", "n"])

    return blocks.mapInArrow(run, f"{key} {kind}, node bigint, feature int, bin int, g bigint, n bigint")


# -- one level ----------------------------------------------------------------


def leaf_score(g: Column, n: Column, s: TreeSettings) -> Column:
    """What a leaf with residuals g takes off half the squared error, doubled."""
    kept = F.greatest(F.abs(g) - F.lit(s.l1), F.lit(0.0))
    return kept * kept / (n + F.lit(s.l2))


def leaf_value(g: Column, n: Column, s: TreeSettings) -> Column:
    kept = F.greatest(F.abs(g) - F.lit(s.l1), F.lit(0.0))
    return F.signum(g) * kept / (n + F.lit(s.l2)) * F.lit(s.step)


def _plain(units: Column) -> Column:
    return units.cast("double") / F.lit(10.0**DIGITS)


def best_splits(histograms: DataFrame, frontier: DataFrame, key: str, s: TreeSettings) -> DataFrame:
    """(key, node, g, n, bound, feature, bin, missing_left, gl, nl, gain) of the
    nodes of ``frontier`` (key, node, g, n, bound) that are worth a split.  Of equal
    gains the first feature, then the lowest bin, then missing to the left."""
    column = Window.partitionBy(key, "node", "feature")
    known = F.col("bin") < MISSING
    so_far = column.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = histograms.select(
        key, "node", "feature", "bin",
        F.sum("g").over(so_far).alias("gb"), F.sum("n").over(so_far).alias("nb"),
        F.coalesce(F.sum(F.when(~known, F.col("g"))).over(column), F.lit(0)).alias("gm"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))).over(column), F.lit(0)).alias("nm"),
    ).where(known).join(frontier, [key, "node"])
    # Without missing values one side is enough: the one with more rows.
    sides = F.when(F.col("nm") > 0, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.col("nb") * 2 >= F.col("n")))
    both = sums.withColumn("missing_left", F.explode(sides))
    tried = both.withColumns(
        {
            "gl": F.col("gb") + F.when(F.col("missing_left"), F.col("gm")).otherwise(0),
            "nl": F.col("nb") + F.when(F.col("missing_left"), F.col("nm")).otherwise(0),
        }
    ).where((F.col("nl") >= s.min_rows) & (F.col("n") - F.col("nl") >= s.min_rows))
    left = leaf_score(_plain(F.col("gl")), F.col("nl"), s)
    right = leaf_score(_plain(F.col("g") - F.col("gl")), F.col("n") - F.col("nl"), s)
    gained = tried.withColumn("gain", left + right - leaf_score(_plain(F.col("g")), F.col("n"), s)).where("gain > 0")
    order = Window.partitionBy(key, "node").orderBy(F.desc("gain"), "feature", "bin", F.desc("missing_left"))
    first = gained.withColumn("__rank", F.row_number().over(order)).where("__rank = 1")
    return first.select(key, "node", "g", "n", "bound", "feature", "bin", "missing_left", "gl", "nl", "gain")


def picked(nodes: DataFrame, key: str, leaves: int) -> DataFrame:
    """The nodes that best-first growth splits."""
    order = Window.partitionBy(key).orderBy(F.desc("bound"), "node")
    return nodes.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") < leaves).drop("__rank")


def children(splits: DataFrame, key: str) -> DataFrame:
    """(key, node, parent, g, n, bound, smaller) of both children of each split."""
    sides = F.array(
        F.struct((F.col("node") * 2).alias("node"), F.col("gl").alias("g"), F.col("nl").alias("n"), (F.col("nl") * 2 <= F.col("n")).alias("smaller")),
        F.struct(
            (F.col("node") * 2 + 1).alias("node"), (F.col("g") - F.col("gl")).alias("g"), (F.col("n") - F.col("nl")).alias("n"), (F.col("nl") * 2 > F.col("n")).alias("smaller")
        ),
    )
    rows = splits.withColumn("side", F.explode(sides))
    return rows.select(key, "side.node", F.col("node").alias("parent"), "side.g", "side.n", "bound", "side.smaller")


def _listed_splits(splits: DataFrame, key: str) -> DataFrame:
    return splits.groupBy(key).agg(F.collect_list(F.struct("node", "feature", "bin", "missing_left")).alias("splits"))


def _grown(blocks: DataFrame, roots: DataFrame, width: int, key: str, s: TreeSettings) -> DataFrame:
    """Splits of one tree of every meter of ``roots`` (key, node, g, n, bound)."""
    spark = blocks.sparkSession
    frontier, above, parents, nodes = roots, None, None, None
    for depth in range(s.depth):
        if above is None:
            wanted = frontier.groupBy(key).agg(F.collect_list("node").alias("wanted"))
            wanted = wanted.withColumn("splits", F.expr("cast(array() as array<struct<node:bigint,feature:int,bin:int,missing_left:boolean>>)"))
        else:
            wanted = parents.where("smaller").groupBy(key).agg(F.collect_list("node").alias("wanted")).join(_listed_splits(picks, key), key)
        scanned = _with_tree(blocks, durable(wanted, "wanted"), key, ["wanted", "splits"])
        histograms = _block_histograms(scanned, width, key).groupBy(key, "node", "feature", "bin").agg(
            F.sum(F.col("g").cast("decimal(19,0)")).cast("decimal(38,0)").alias("g"), F.sum("n").alias("n")
        )
        if above is not None:
            # The larger child is what the smaller one leaves of their parent.
            own = durable(histograms, "histograms")
            of = parents.where("smaller").select(key, "node", "parent")
            less = own.join(of, [key, "node"]).select(key, F.col("parent").alias("node"), "feature", "bin", F.col("g").alias("less_g"), F.col("n").alias("less_n"))
            sibling = parents.where("not smaller").select(key, F.col("parent").alias("node"), F.col("node").alias("sibling"))
            rest = above.join(sibling, [key, "node"]).join(less, [key, "node", "feature", "bin"], "left")
            rest = rest.select(
                key, F.col("sibling").alias("node"), "feature", "bin",
                (F.col("g") - F.coalesce("less_g", F.lit(0))).cast("decimal(38,0)").alias("g"), (F.col("n") - F.coalesce("less_n", F.lit(0))).alias("n"),
            ).where("n > 0")
            histograms = own.unionByName(rest)
        above = durable(histograms, "histograms")
        found = best_splits(above, frontier, key, s).withColumn("bound", F.least("bound", "gain"))
        nodes = durable(found if nodes is None else nodes.unionByName(found), "nodes")
        picks = durable(picked(nodes, key, s.leaves), "picks")
        # Both children of a split are worked out if one of them may be split further.
        new = children(picks.where(F.col("node") >= 2**depth), key)
        enough = new.where(F.col("n") >= 2 * s.min_rows).select(key, "parent").distinct()
        parents = durable(new.join(enough, [key, "parent"], "left_semi"), "parents")
        frontier = parents.where(F.col("n") >= 2 * s.min_rows).select(key, "node", "g", "n", "bound")
        if parents.isEmpty():
            break
    return picks


def _leaves(splits: DataFrame, key: str, s: TreeSettings) -> DataFrame:
    ends = children(splits, key).join(splits.select(key, "node"), [key, "node"], "left_anti")
    return ends.select(key, "node", "n", leaf_value(_plain(F.col("g")), F.col("n"), s).alias("value"))


def _advanced(blocks: DataFrame, tree: DataFrame, width: int, key: str) -> DataFrame:
    """Blocks with the tree's values added to their predictions, and the sum of
    their next residuals; meters without a tree are done and go."""
    kind = dict(blocks.dtypes)[key]

    def run(batches):
        for batch in (some for whole in batches for some in _some(whole)):
            pred, sums = [], []
            for row in batch.select(["bins", "y", "pred", "splits", "leaves"]).to_pylist():
                bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, width)
                node = _routed(bins, row["splits"])
                ends = sorted((x["node"], x["value"]) for x in row["leaves"])
                numbers, values = np.array([e[0] for e in ends]), np.array([e[1] for e in ends])
                after = np.frombuffer(row["pred"]) + values[np.searchsorted(numbers, node)]
                pred.append(after.tobytes())
                sums.append(int(np.rint((np.frombuffer(row["y"]) - after) * 10.0**DIGITS).sum()))
            columns = [batch.column(c) for c in (key, "block", "bins", "y")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(pred, pa.binary()), pa.array(sums, pa.int64())], [key, "block", "bins", "y", "pred", "g"])

    return _with_tree(blocks, tree, key, ["splits", "leaves"]).mapInArrow(run, f"{key} {kind}, block int, bins binary, y binary, pred binary, g bigint")


# -- the model ----------------------------------------------------------------


def fit_trees(train: DataFrame, features: Sequence[str], target: str, key: str = "object_id", settings: TreeSettings = TreeSettings()) -> DataFrame:
    """One row per meter with a target: (key, rows, level, nodes), the level being
    the target's mean and nodes an array of (tree, node, feature, threshold,
    missing_left, gain, rows, value): splits have a feature and go left up to the
    threshold, leaves have a value.  A meter that cannot be split has no nodes.

    Rows without a target or meter take no part; features that are missing or not
    finite count as missing.  Written to the shared folder after each tree."""
    s = settings
    y = finite(F.col(target).cast("double")).alias("y")
    rows = _numbers(train, key, features, [y]).where("y is not null")
    steps = F.array(*[F.lit((i + 1) / s.bins) for i in range(s.bins)])
    edges = F.array(*[F.coalesce(F.array_distinct(F.percentile_approx(F.col("x")[i], steps, ACCURACY)), F.array().cast("array<double>")) for i in range(len(features))])
    units = to_units(F.col("y"), DIGITS).cast("decimal(19,0)")
    level = F.sum(units).cast("double") / F.count(F.lit(1)) / F.lit(10.0**DIGITS)
    facts = durable(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), level.alias("level"), edges.alias("edges")), "facts")
    blocks = durable(_blocks(rows, facts, key), "blocks")
    residual = F.rint((F.col("y") - F.col("level")) * F.lit(10.0**DIGITS)).cast("decimal(19,0)")
    sums = meet(rows.select(key, "y"), facts.select(key, "n", "level"), [key]).groupBy(key).agg(F.sum(residual).alias("g"))
    done = []
    for tree in range(1, s.trees + 1):
        roots = sums.join(facts.select(key, "n"), key).select(
            key, F.lit(1).cast("bigint").alias("node"), F.col("g").cast("decimal(38,0)").alias("g"), "n", F.lit(float("inf")).alias("bound")
        )
        roots = durable(roots.where(F.col("n") >= 2 * s.min_rows), "roots")
        if roots.isEmpty():
            break
        splits = durable(_grown(blocks, roots, len(features), key, s), "splits")
        leaves = durable(_leaves(splits, key, s), "leaves")
        done.append(_named(splits, leaves, facts, tree, key))
        if tree == s.trees:
            break
        whole = _listed_splits(splits, key).join(leaves.groupBy(key).agg(F.collect_list(F.struct("node", "value")).alias("leaves")), key)
        before, blocks = blocks, durable(_advanced(blocks, durable(whole, "tree"), len(features), key), "blocks")
        for path in before.inputFiles()[:1]:
            remove(blocks.sparkSession, path.rsplit("/", 1)[0])
        sums = blocks.groupBy(key).agg(F.sum(F.col("g").cast("decimal(19,0)")).alias("g"))
    plain = facts.select(key, F.col("n").alias("rows"), "level")
    if not done:
        return plain.withColumn("nodes", F.array().cast(NODES))
    listed = reduce(DataFrame.unionByName, done).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*NODE_FIELDS))).alias("nodes"))
    return durable(plain.join(listed, key, "left").withColumn("nodes", F.coalesce("nodes", F.array().cast(NODES))), "models")


NODE_FIELDS = ("tree", "node", "feature", "threshold", "missing_left", "gain", "rows", "value")
NODES = "array<struct<tree:int,node:bigint,feature:int,threshold:double,missing_left:boolean,gain:double,rows:bigint,value:double>>"


def _named(splits: DataFrame, leaves: DataFrame, facts: DataFrame, tree: int, key: str) -> DataFrame:
    """A tree's nodes, with thresholds in place of bins."""
    at = splits.join(facts.select(key, "edges"), key).select(
        key, F.lit(tree).alias("tree"), "node", "feature", F.col("edges")[F.col("feature")][F.col("bin")].alias("threshold"),
        "missing_left", "gain", F.col("n").alias("rows"), F.lit(None).cast("double").alias("value"),
    )
    none = {"feature": "int", "threshold": "double", "missing_left": "boolean", "gain": "double"}
    ends = leaves.select(key, F.lit(tree).alias("tree"), "node", *[F.lit(None).cast(t).alias(c) for c, t in none.items()], F.col("n").alias("rows"), "value")
    return at.unionByName(ends)


def predict_trees(models: DataFrame, df: DataFrame, features: Sequence[str], target: str, order: SeriesOrder = SeriesOrder()) -> DataFrame:
    """(key, time, y_true, y_pred) of every row of a fitted meter."""
    key, kinds = order.key, dict(df.dtypes)
    rows = _numbers(df, key, features, [F.col(order.time).alias("t"), F.col(target).cast("double").alias("y")])
    counts = durable(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(models.select(key), key), "counts")
    dealt = _dealt(rows, counts, key)
    each = _per_block(models.join(counts.select(key, "n"), key), key, ["level", "nodes"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        if not n or not right.num_rows:
            return pa.table({key: left.column(key).slice(0, 0), "t": left.column("t").slice(0, 0), "y": pa.array([], pa.float64()), "y_pred": pa.array([], pa.float64())})
        x = left.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        pred = np.full(n, right.column("__level")[0].as_py())
        at = np.zeros(n, np.int64)
        tree = 0
        for s in right.column("__nodes")[0].as_py():  # by tree and node: parents first
            if s["tree"] != tree:
                tree, at = s["tree"], np.ones(n, np.int64)
            here = np.flatnonzero(at == s["node"])
            if s["feature"] is None:
                pred[here] += s["value"]
                continue
            column = x[here, s["feature"]]
            left_side = np.where(np.isnan(column), s["missing_left"], column <= s["threshold"])
            at[here] = 2 * s["node"] + 1 - left_side
        return pa.table({key: left.column(key), "t": left.column("t"), "y": left.column("y"), "y_pred": pred})

    found = dealt.groupBy(key, "block").cogroup(each.groupBy("__key", "__block")).applyInArrow(run, f"{key} {kinds[key]}, t {kinds[order.time]}, y double, y_pred double")
    return found.select(key, F.col("t").alias(order.time), F.col("y").alias("y_true"), "y_pred")


def tree_nodes(models: DataFrame, key: str = "object_id") -> DataFrame:
    """One row per node, with the names of ``NODE_FIELDS``."""
    return models.select(key, F.inline("nodes"))


def forecast_trees(
    train: DataFrame, evaluation: DataFrame, features: Sequence[str], target: str,
    order: SeriesOrder = SeriesOrder(), settings: TreeSettings = TreeSettings(),
) -> DataFrame:
    """(key, time, y_true, y_pred, model) for all evaluation rows of meters that
    have training rows with a target."""
    models = fit_trees(train, features, target, order.key, settings)
    return predict_trees(models, evaluation, features, target, order).withColumn("model", F.lit("trees"))
