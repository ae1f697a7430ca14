"""Nearest neighbours by cosine with vantage-point trees, one per shard.

Vectors are dealt to shards by a hash of their id, so that shards have equal
sizes.  In a shard, equal vectors are one point with a list of ids, and a tree
halves the points by their distance (angle) to a vantage point, down to leaves
of ``LEAF`` points.  Queries come in blocks; each block visits each shard's
tree once, all queries at a time.  First every query goes down to the leaf it
falls into, which gives a first k-th distance t; then the tree is walked and a
side is left out for queries whose distance d to the vantage point lies more
than ``factor * t`` beyond the border.  With ``factor`` 1 the triangle
inequality makes that exact; smaller factors visit less.

Scores are cosines of the original vectors in double precision.  Ties go to the
smaller id.  Vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows with a null id; vectors of another length
than the query's are not compared with it.  Of rows with the same id, which
should not be, each is a candidate, but an id is listed once, with its best
score, and a query never finds its own id; as queries, the greatest such vector
counts.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterframe.session import durable

LEAF = 48
SHARD_NUMBERS = 1 << 20  # components of a shard's vectors, on average (8 MB)
BLOCK_NUMBERS = 1 << 19  # of a block of queries
FACTOR = 1.0  # exact; 0.6 still found 99.9 % of the neighbours on the given tables
SLACK = 1e-7  # of an angle
ROUNDING = 1e-10  # of a cosine
FOUND_POINTS = 1 << 20  # found at a time for a part of a block's queries
BROADCAST_SIZES = 20_000  # lengths of vectors

FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, in doubles."""
    v = F.col("vector")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither vanish nor overflow."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in the same order of adding wherever a row stands."""
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


class Tree:
    """Points in the order of the tree; node i is (vantage point, border, from,
    middle, to) over that order, or a leaf with vantage point -1."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.unit = points / np.sqrt((points * points).sum(axis=1))[:, None]
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, float, int, int, int]] = []
        self.children: list[tuple[int, int]] = []
        self._build(0, len(points))

    def _build(self, lo: int, hi: int) -> int:
        number = len(self.nodes)
        self.nodes.append((-1, 0.0, lo, lo, hi))
        self.children.append((-1, -1))
        if hi - lo <= LEAF:
            return number
        mine = self.order[lo:hi]
        # The point farthest from the first one sees the others at differing angles.
        far = int(np.argmin(self.unit[mine] @ self.unit[mine[0]]))
        vantage = int(mine[far])
        d = angle(self.unit[mine] @ self.unit[vantage])
        half = (hi - lo) // 2
        self.order[lo:hi] = mine[np.argpartition(d, half)]
        d.partition(half)
        border = float(d[half])
        self.nodes[number] = (vantage, border, lo, lo + half, hi)
        inner, outer = self._build(lo, lo + half), self._build(lo + half, hi)
        self.children[number] = (inner, outer)
        return number


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


class Search:
    """The k nearest points of a tree for each of a block of queries."""

    def __init__(self, tree: Tree, queries: np.ndarray, k: int, factor: float):
        self.tree, self.k, self.factor = tree, k, factor
        self.unit = queries / np.sqrt((queries * queries).sum(axis=1))[:, None]
        self.best = np.full((len(queries), k), -2.0)  # cosines, largest first
        self.point = np.full((len(queries), k), -1)
        self.seen: set[int] = set()

    def run(self) -> None:
        if len(self.unit) and len(self.tree.points):
            home = np.zeros(len(self.unit), np.int64)
            self._home(0, np.arange(len(self.unit)), home)
            self._walk(0, np.arange(len(self.unit)), home)

    def _home(self, number: int, who: np.ndarray, home: np.ndarray) -> None:
        vantage, border, *_ = self.tree.nodes[number]
        if not len(who):
            return
        if vantage < 0:
            home[who] = number
            self._leaf(number, who)
            return
        inside = angle(self.unit[who] @ self.tree.unit[vantage]) < border
        for child, part in zip(self.tree.children[number], (who[inside], who[~inside])):
            self._home(child, part, home)

    def _walk(self, number: int, who: np.ndarray, home: np.ndarray) -> None:
        vantage, border, *_ = self.tree.nodes[number]
        if vantage < 0:
            self._leaf(number, who[home[who] != number])
            return
        d = angle(self.unit[who] @ self.tree.unit[vantage])
        for side, child in enumerate(self.tree.children[number]):
            # t shrinks while the first side is walked
            reach = self.factor * angle(self.best[who, -1]) + SLACK
            reach = np.where(self.best[who, -1] <= -1.5, np.inf, reach)
            near = d - reach <= border if side == 0 else d + reach >= border
            if near.any():
                self._walk(child, who[near], home)

    def _leaf(self, number: int, who: np.ndarray) -> None:
        if not len(who):
            return
        _, _, lo, _, hi = self.tree.nodes[number]
        points = self.tree.order[lo:hi]
        cosine = self.unit[who] @ self.tree.unit[points].T
        all_cosine = np.concatenate([self.best[who], cosine], axis=1)
        all_point = np.concatenate([self.point[who], np.broadcast_to(points, cosine.shape)], axis=1)
        top = np.argpartition(-all_cosine, self.k - 1, axis=1)[:, : self.k]
        cosine, point = np.take_along_axis(all_cosine, top, 1), np.take_along_axis(all_point, top, 1)
        rank = np.argsort(-cosine, axis=1, kind="stable")
        self.best[who], self.point[who] = np.take_along_axis(cosine, rank, 1), np.take_along_axis(point, rank, 1)


def within(tree: Tree, queries: np.ndarray, floors: np.ndarray, factor: float):
    """(queries, points) of each leaf whose cosine is not below the query's floor,
    but for rounding; the tree is walked with the same pruning."""
    unit = queries / np.sqrt((queries * queries).sum(axis=1))[:, None]
    reach = factor * angle(floors) + SLACK
    open_ = [(0, np.arange(len(unit)))]
    while open_:
        number, who = open_.pop()
        vantage, border, lo, _, hi = tree.nodes[number]
        if vantage < 0:
            points = tree.order[lo:hi]
            near = unit[who] @ tree.unit[points].T >= floors[who, None] - ROUNDING
            at, point = np.nonzero(near)
            if len(at):
                yield who[at], points[point]
            continue
        d = angle(unit[who] @ tree.unit[vantage])
        for child, near in zip(tree.children[number], (d - reach[who] <= border, d + reach[who] >= border)):
            if near.any():
                open_.append((child, who[near]))


def best_of(query: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of each query the k ids with the largest scores, the smaller of equal ones;
    an id counts once."""
    order = np.lexsort((-score, found, query))
    query, found, score = query[order], found[order], score[order]
    first = np.append(True, (query[1:] != query[:-1]) | (found[1:] != found[:-1])) if len(query) else np.zeros(0, bool)
    query, found, score = query[first], found[first], score[first]
    order = np.lexsort((found, -score, query))
    query, found, score = query[order], found[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], found[rank < k], score[rank < k]


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the k nearest ids of a shard, by place of the query."""
    vectors, queries = scaled(vectors), scaled(queries)
    points, point_of = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, point_of.ravel()))
    ids, point_of = ids[order], point_of.ravel()[order]
    new = np.append(True, (ids[1:] != ids[:-1]) | (point_of[1:] != point_of[:-1])) if len(ids) else np.zeros(0, bool)
    ids, point_of = ids[new], point_of[new]  # a point's ids are distinct
    starts = np.searchsorted(point_of, np.arange(len(points) + 1))
    tree = Tree(points)
    out = ([], [], [])
    # More than k: the query's own vector may be among them, and points may share
    # ids; queries with fewer than k ids so far ask for more points.  This gives
    # the k-th score; which ids tie with it follows.
    asked, width = np.arange(len(queries)), min(k + 4, len(points))
    while len(asked):
        missing = []
        step = max(FOUND_POINTS // max(width, 1), 1)
        for part in [asked[i : i + step] for i in range(0, len(asked), step)]:
            found = Search(tree, queries[part], width, factor)
            found.run()
            who, column = np.nonzero(found.point >= 0)
            at = found.point[who, column]
            score = cosines(queries[part[who]], points[at])
            best: list[dict[int, float]] = [{} for _ in part]
            for q, p, s in zip(who.tolist(), at.tolist(), score.tolist()):
                mine = ids[starts[p] : starts[p + 1]][: k + 1]  # the smallest ids of equal vectors
                for i in mine[mine != query_ids[part[q]]][:k].tolist():
                    best[q][i] = max(s, best[q].get(i, -2.0))
            for q, listed in zip(part.tolist(), best):
                if len(listed) < k and width < len(points):
                    missing.append(q)
                    continue
                out[0].extend([q] * len(listed))
                out[1].extend(listed)
                out[2].extend(listed.values())
        asked, width = np.array(missing, np.int64), min(2 * width, len(points))
    best = best_of(np.array(out[0], np.int64), np.array(out[1], np.int64), np.array(out[2], float), k)
    full, last = np.unique(best[0][::-1], return_index=True)  # place of each query's last score
    last = len(best[0]) - 1 - last
    full, floors = full[last - np.searchsorted(best[0], full) == k - 1], best[2][last[last - np.searchsorted(best[0], full) == k - 1]]
    # Every point as near as the last, however many there are: ties go by id.
    step = max(FOUND_POINTS // (LEAF * max(vectors.shape[1], 1)), 1)
    done = [tuple(c[~np.isin(best[0], full)] for c in best)]
    for i in range(0, len(full), step):
        part, floor = full[i : i + step], floors[i : i + step]
        held, size = [], 0
        for who, at in within(tree, queries[part], floor, factor):
            score = cosines(queries[part[who]], points[at])
            many = np.minimum(starts[at + 1] - starts[at], k + 1)  # the smallest ids of equal vectors
            place = np.repeat(starts[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            query, score = np.repeat(part[who], many), np.repeat(score, many)
            other = ids[place] != query_ids[query]
            held.append((query[other], ids[place][other], score[other]))
            size += len(held[-1][0])
            if size > 4 * k * step:
                held = [best_of(*[np.concatenate(c) for c in zip(*held)], k)]
                size = len(held[0][0])
        if held:
            done.append(best_of(*[np.concatenate(c) for c in zip(*held)], k))
    return tuple(np.concatenate(c) for c in zip(*done))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, factor: float = FACTOR) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k nearest found.
    ``vectors`` and ``is_query`` are over vec_id and vector (see ``usable``)."""
    sized = vectors.withColumn("size", F.size("vector"))
    sizes = sized.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"))
    shards = F.greatest(F.ceil(F.col("n") * F.col("size") / F.lit(float(SHARD_NUMBERS))), F.lit(1)).cast("int")
    blocks = F.greatest(F.ceil(F.col("q") * F.col("size") / F.lit(float(BLOCK_NUMBERS))), F.lit(1)).cast("int")
    plan = durable(sizes.select(F.col("size").alias("_size"), shards.alias("shards"), blocks.alias("blocks")), "plan")
    if plan.count() <= BROADCAST_SIZES:  # counted, and usually one row; vectors need not move for it
        plan = F.broadcast(plan)
    if not 0 < factor <= 1:
        raise ValueError("the factor lies above 0 and up to 1")
    planned = sized.join(plan, F.col("size") == F.col("_size")).drop("_size")
    asked = planned.where(is_query).groupBy("vec_id", "size", "shards", "blocks").agg(F.max("vector").alias("vector"))
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])
    place = ["size", "shard", "block"]
    rows = planned.withColumns({"shard": F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    queries = asked.withColumns({"block": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).cast("int"), "shard": F.explode(F.sequence(F.lit(0), F.col("shards") - 1))})

    def numbers(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = table.column("vec_id").to_numpy()
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return ids, flat.reshape(len(ids), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return FOUND.empty_table()
        ids, mine = numbers(left)
        query_ids, asked_for = numbers(right)
        who, found, score = search_shard(ids, mine, query_ids, asked_for, k, factor)
        return pa.table({"query_id": query_ids[who], "vec_id": found, "score": score}, schema=FOUND)

    columns = [*place, "vec_id", "vector"]
    asked_in = queries.select(*[F.col(c).alias(f"q_{c}" if c in place else c) for c in columns])
    found = rows.select(columns).groupBy(place).cogroup(asked_in.groupBy(*[f"q_{c}" for c in place]))
    found = found.applyInArrow(run, "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

