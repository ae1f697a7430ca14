"""Near duplicates by chosen-path similarity join.

A document's set is its distinct five-word shingles; two are linked if the
Jaccard similarity of their sets reaches the threshold.  Equal sets are one
*class*, so copies cost nothing further.  Then

1. each of ``TREES`` independent trees branches the classes by minwise tokens:
   the first level by one minwise shingle of the set, nodes that are still
   large by the next, up to ``DEPTH`` levels;
2. in every node, of any size, each class is compared with the node's first
   one, and components are formed from the links found;
3. small nodes are compared exhaustively, but for pairs already in one
   component.  Large nodes at the last level are cut into blocks, and each
   pair of blocks is compared likewise in a group of its own, which gives only
   links between what it has not yet connected: no more than it has classes.
   Pairs that meet in several trees are compared there in the first.

Links are confirmed on the full sets; signatures only put aside pairs whose
estimate is more than ``SPREAD`` standard deviations below the threshold.  A
pair at similarity s meets in a tree with probability s to the power of the
levels its node has, so a pair at 0.85 is missed with probability 0.15^16 in
small nodes and 1e-5 at four levels.

Documents without words, or null, have empty sets and are linked with nothing.
Documents of one component share its smallest ``doc_id`` (nulls last); a null
``doc_id`` alone has a null component.  Repeated rows are answered each.
Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterframe.joins import meet
from meterframe.llm.boxed import boxed, own, unboxed
from meterframe.llm.components import components
from meterframe.llm.shingles import WordHashes, mixed, set_key, shingles
from meterframe.session import durable

TREES, DEPTH = 16, 4
LEAF = 32  # classes that are compared exhaustively in one node
BLOCK, BLOCK_SHINGLES = 512, 2_000_000  # of a large node's block, on average
SPREAD = 4.5
PERCENT = 85
SLICE = 1024  # shingles hashed at once
BROADCAST_ROWS = 200_000  # of about 100 bytes; more are joined by shuffles

COORDINATES = TREES * DEPTH
SEEDS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minwise value of each coordinate, 31 bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), SLICE):
        h = hashes[at : at + SLICE, None] * SEEDS
        h ^= h >> np.uint64(32)
        h *= SEEDS[::-1]
        np.minimum(least, h.min(axis=0), out=least)
    return (least >> np.uint64(33)).astype(np.int32)


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class key and signature (null for empty sets)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        words = WordHashes()
        for batch in batches:
            sets = [shingles(words.of(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int32())),
                ],
                ["doc_id", "n_shingles", "cls", "sig"],
            )

    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, cls binary, sig array<int>")


def path(level: int) -> Column:
    """A node's name: its tree and the minwise tokens chosen so far."""
    return F.xxhash64("tree", *[F.get(F.col("sig"), F.col("tree") * DEPTH + k) for k in range(level)])


def nodes(classes: DataFrame) -> DataFrame:
    """(node, tree, size, volume, cls) of the last node of each class in each
    tree; nodes of one class are left out.  Only classes of large nodes go to
    the next level.  The volume of a node is its sets' shingles."""
    levels = range(1, DEPTH + 1)
    rows = classes.select("cls", "sig", "n_shingles", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select("cls", "n_shingles", "tree", *[path(k).alias(f"node{k}") for k in levels])
    out = None
    for level in levels:
        named = rows.withColumn("node", F.col(f"node{level}")).drop(f"node{level}")
        sizes = named.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("volume")).where("size > 1")
        there = durable(named.join(sizes, "node"), "nodes")
        done = (there if level == DEPTH else there.where(F.col("size") <= LEAF)).select("node", "tree", "size", "volume", "cls")
        out = done if out is None else out.union(done)
        rows = there.where(F.col("size") > LEAF).drop("node", "size", "volume")
    return out


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose sizes allow the threshold and whose signatures do
    not speak against it."""
    goal = percent / 100
    least = goal - SPREAD * (goal * (1 - goal) / COORDINATES) ** 0.5
    side = classes.select("cls", "n_shingles", "sig")
    a, b = (side.select(*[F.col(c).alias(f"{x}_{c}") for c in side.columns]) for x in "ab")
    both = pairs.distinct().join(a, F.col("a") == F.col("a_cls")).where(F.col("a_n_shingles") > 0)
    both = both.join(b, F.col("b") == F.col("b_cls"))
    fits = 100 * F.least("a_n_shingles", "b_n_shingles") >= percent * F.greatest("a_n_shingles", "b_n_shingles")
    same = F.aggregate(F.zip_with("a_sig", "b_sig", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return both.where(fits).where(same >= least * COORDINATES).select("a", "b")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, hashes) of the wanted (cls, doc_id), from the texts again."""
    named = durable(wanted.select(F.col("doc_id").alias("_id"), "cls"), "wanted")
    if named.count() <= BROADCAST_ROWS:  # counted; same rows either way, but texts need not move
        named = F.broadcast(named)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(named, F.col("doc_id").eqNullSafe(F.col("_id"))).select("cls", "text")

    def run(batches):
        words = WordHashes()
        for batch in batches:
            keys, sets = [], []
            for cls, text in zip(batch.column("cls").to_pylist(), batch.column("text")):
                hashes = shingles(words.of(text.as_py() or ""))
                if set_key(hashes) == cls:  # rows of one doc_id may hold other texts
                    keys.append(cls)
                    sets.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["cls", "hashes"])

    return rows.mapInArrow(run, "cls binary, hashes binary").dropDuplicates(["cls"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union."""
    a, b = (sets.select(F.col("cls").alias(x), F.col("hashes").alias(f"{x}_set")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "a_set", "b_set")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def open_members(members: DataFrame) -> DataFrame:
    """Members (node, ..., cls, label) of nodes that hold several components.  The
    classes of a crowded node stay where they are."""
    of_node = members.groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
    several = durable(of_node.where("lo <> hi").select("node", "n"), "several")
    return meet(members, several, ["node"]).drop("n")


def across(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components in small nodes."""
    small = members.where(F.col("size") <= LEAF)
    left = small.select("node", F.col("cls").alias("a"), F.col("label").alias("a_label"))
    right = small.select("node", F.col("cls").alias("b"), F.col("label").alias("b_label"))
    return left.join(right, "node").where("a < b and a_label <> b_label").select("a", "b")


def links_in_large(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components within large nodes."""
    blocks = F.greatest(F.ceil(F.col("size") / F.lit(float(BLOCK))), F.ceil(F.col("volume") / F.lit(float(BLOCK_SHINGLES)))).cast("int")
    dealt = (
        members.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", "tree", "block", "cls", "label", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    )
    full = dealt.join(durable(sets.join(classes.select("cls", "sig"), "cls"), "sets"), "cls")
    goal = percent / 100
    least = (goal - SPREAD * (goal * (1 - goal) / COORDINATES) ** 0.5) * COORDINATES

    def run(group: pa.Table) -> pa.Table:
        keys, tree = group.column("cls").to_pylist(), group.column("tree")[0].as_py()
        block, lo, hi = np.array(group.column("block")), group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        sig = np.array(group.column("sig").to_pylist(), np.int32)
        hashes = [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()]
        sizes = np.array([len(h) for h in hashes])
        _, root = np.unique(np.array(group.column("label").to_pylist(), object), return_inverse=True)  # components, by number
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        found = []
        for x in left.tolist():
            others = right if lo != hi else right[right > x]
            others = others[(root[others] != root[x]) & (100 * np.minimum(sizes[others], sizes[x]) >= percent * np.maximum(sizes[others], sizes[x]))]
            equal = sig[others] == sig[x]
            alike = equal.sum(axis=1)
            before = equal.reshape(-1, TREES, DEPTH).all(axis=2)[:, :tree].any(axis=1)
            for k in np.argsort(-alike, kind="stable").tolist():
                y = int(others[k])
                if alike[k] < least:
                    break
                if before[k] or root[x] == root[y]:
                    continue
                common = len(np.intersect1d(hashes[x], hashes[y], assume_unique=True))
                if 100 * common >= percent * (sizes[x] + sizes[y] - common):
                    found.append((keys[x], keys[y]))
                    root[root == root[y]] = root[x]
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return full.groupBy("node", "lo", "hi").applyInArrow(run, "a binary, b binary")


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, its class, the class's component and
    that component's smallest doc_id.  Written to the shared folder."""
    profile = durable(profiles(docs), "profiles")
    classes = durable(
        profile.where("cls is not null").groupBy("cls").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")
        ),
        "classes",
    )
    placed = durable(nodes(classes), "placed")
    first = durable(placed.groupBy("node").agg(F.min("cls").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1"), "first")
    stars = meet(placed, first, ["node"]).where("a <> cls").select("a", F.col("cls").alias("b"))
    starred = durable(likely(stars, classes, percent), "stars")
    links = durable(confirmed(starred, _sets(docs, classes, starred), percent), "links")
    labels = components(links)
    members = placed.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    members = durable(open_members(durable(members, "labelled")), "members")
    rest = durable(likely(across(members), classes, percent).join(starred, ["a", "b"], "left_anti"), "rest")
    large = members.where(F.col("size") > LEAF)
    more = durable(confirmed(rest, _sets(docs, classes, rest), percent), "links")
    if not large.isEmpty():
        wanted = large.select("cls").distinct().join(classes.select("cls", "doc_id"), "cls")
        more = more.union(durable(links_in_large(large, classes, durable(sets_of(docs, wanted), "sets"), percent), "links"))
    labels = components(links.union(more))
    named = classes.select("cls", "doc_id").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.select("cls", "doc_id", F.coalesce("label", "cls").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    by_class = named.join(least, "component").select("cls", "component", "least")
    return durable(profile.select("doc_id", "n_shingles", "cls").join(by_class, "cls", "left"), "groups")


def link(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id and kept."""
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return groups(docs, percent).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Written sets of all classes in the pairs."""
    keys = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    return durable(sets_of(docs, classes.select("cls", "doc_id").join(keys, "cls")), "sets")


def without_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs, one of each component; rows without words all stay.

    That one has the component's smallest doc_id; if several rows have that id,
    or only null ids are there, one row of the first class by its key."""
    found = groups(docs, percent)
    worded = found.where("cls is not null")
    chosen = worded.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "cls")).alias("one")
    ).select("one.doc_id", "one.cls")
    twice = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("gone"))
    twice = durable(twice, "ids")
    gone = worded.where("not (doc_id <=> least)").where("doc_id is not null").select(F.col("doc_id").alias("gone"))
    rows, doc_id = boxed(docs), own("doc_id")
    if twice.isEmpty():
        return unboxed(rows.join(_small(durable(gone, "gone")), doc_id == F.col("gone"), "left_anti"), docs.columns)
    single = rows.join(_small(durable(gone.join(twice, "gone", "left_anti"), "gone")), doc_id == F.col("gone"), "left_anti")
    single = single.join(_small(twice), doc_id.eqNullSafe(F.col("gone")), "left_anti")
    several = rows.join(_small(twice), doc_id.eqNullSafe(F.col("gone")), "left_semi").withColumn("cls", class_of(own("text")))
    chosen = chosen.select(F.col("doc_id").alias("id"), F.col("cls").alias("of"))
    one = several.join(chosen, doc_id.eqNullSafe(F.col("id")) & (F.col("cls") == F.col("of")), "left_semi")
    one = one.withColumn("id", doc_id).dropDuplicates(["id", "cls"])
    return unboxed(single.unionByName(one.select("row")).unionByName(several.where("cls is null").select("row")), docs.columns)


def class_of(text: Column) -> Column:
    @F.arrow_udf("binary")
    def key(texts: pa.Array) -> pa.Array:
        words = WordHashes()
        sets = (shingles(words.of(t.as_py() or "")) for t in texts)
        return pa.array([set_key(s) if len(s) else None for s in sets], pa.binary())

    return key(text)


def _small(rows: DataFrame) -> DataFrame:
    """A hint to broadcast a written table whose rows were counted."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
