"""Language-model scores from a weighted backoff automaton.

Tokens are a text's words (runs of characters other than space and U+0009 to
U+000D, A-Z lower-cased) and one end.  N-grams of the training texts are
smoothed towards the next shorter ones (a Dirichlet prior):

    p(w | h) = (c(hw) + STRENGTH * p(w | h')) / (c(h) + STRENGTH)

with h' the history without its first word, and p(w) = (c + 0.1) / (N + 0.1 *
(V + 1)) at the bottom, where V + 1 counts one class for all unknown words.
As an automaton: a state is a history that training texts hold, with an arc of
weight log p(w | h) for each word seen behind it and a failure arc to h' of
weight log(STRENGTH / (c(h) + STRENGTH)); the root has an arc for every word.
A text is read once from left to right: the state is carried along, failure
arcs are taken until a state has an arc for the word, and the weights are
added up.

The automaton of the corpus is never in one place.  Texts are laid into blocks
of bounded size; each block sends the counts of its distinct n-grams, packed by
hash range, to where they are added up over all blocks, and gets back the
totals of its own n-grams, in the same order.  From these it builds the part of
the automaton that its texts can reach.  N-grams go by 64-bit hashes.

Null texts are empty: their only token is the end.  A null ``doc_id`` counts as
an empty id for ``train``.  Repeated rows are learned from and answered each.
If there is no training text, every word is unknown.  Texts longer than a block
are cut between words; each part starts with the words before it.  Columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterframe.llm.shingles import WordHashes, mixed
from meterframe.session import durable

ORDER = 2
STRENGTH = 200.0
ADDED = 0.1
BLOCK_TOKENS = 600_000
BUCKET_GRAMS = 600_000  # n-grams a task adds up at once, on average
END = np.uint64(0x2545F4914F6CDD1D)  # stands for the end; words hash to other values but by chance
FACTORS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03], np.uint64)

BLOCK = "block bigint, words binary, tokens binary, n_tokens bigint, doc_ids array<bigint>, sizes array<int>, lead array<int>, train array<boolean>, wholes array<bigint>, train_tokens bigint"
BLOCK_ARROW = pa.schema(
    [("block", pa.int64()), ("words", pa.binary()), ("tokens", pa.binary()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
     ("lead", pa.list_(pa.int32())), ("train", pa.list_(pa.bool_())), ("wholes", pa.list_(pa.int64())), ("train_tokens", pa.int64())]
)
COUNTS = "bucket int, block bigint, level int, n int, hashes binary, counts binary"
COUNTS_ARROW = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("level", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]
)
TOTALS = "block bigint, bucket int, level int, totals binary, known bigint"
TOTALS_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("level", pa.int32()), ("totals", pa.binary()), ("known", pa.int64())])
SCORES = "doc_id bigint, whole bigint, train boolean, n_tokens bigint, n_known bigint, base_score double, score double"
SCORES_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("whole", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


# ---------------------------------------------------------------- blocks


def blocks(docs: DataFrame, train: Column, order: int = ORDER) -> DataFrame:
    """Token numbers of texts in blocks.  ``words`` are the block's distinct
    word hashes, ``tokens`` numbers into them; text i has ``sizes[i]`` tokens, of
    which the first ``lead[i]`` only repeat what came before in its last part."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), train.alias("train"))

    def run(batches):
        from pyspark import TaskContext

        table, part = WordHashes(), TaskContext.get().partitionId() << 32
        held, size, made, rows_seen = [], 0, 0, 0
        for batch in batches:
            for doc_id, text, is_train in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("train").to_pylist()):
                hashes = np.append(table.of(text.as_py()), END)
                whole = part + rows_seen
                rows_seen += 1
                for at in range(0, len(hashes), BLOCK_TOKENS):
                    lead = min(at, order - 1)
                    piece = hashes[at - lead : at + BLOCK_TOKENS]
                    if held and size + len(piece) > BLOCK_TOKENS:
                        yield _block(part + made, held)
                        held, size, made = [], 0, made + 1
                    held.append((doc_id, piece, lead, bool(is_train), whole))
                    size += len(piece)
        if held:
            yield _block(part + made, held)

    return rows.mapInArrow(run, BLOCK)


def _block(number: int, held: list) -> pa.RecordBatch:
    words, tokens = np.unique(np.concatenate([h for _, h, _, _, _ in held]), return_inverse=True)
    row = {
        "block": number, "words": planes(words), "tokens": packed(tokens.astype("<u4")), "n_tokens": len(tokens), "doc_ids": [d for d, *_ in held],
        "sizes": [len(h) for _, h, *_ in held], "lead": [h[2] for h in held], "train": [h[3] for h in held], "wholes": [w for *_, w in held],
        "train_tokens": sum(len(h) - lead for _, h, lead, train, _ in held if train),
    }
    return pa.RecordBatch.from_pylist([row], schema=BLOCK_ARROW)


class Grams:
    """The distinct n-grams of a block, level by level.

    ``of[k]`` numbers, for each token, the (k + 1)-gram that ends there (-1 where
    the text is shorter), in the order of ``hashes[k]``."""

    def __init__(self, row: dict, order: int):
        words = from_planes(row["words"])
        tokens = unpacked(row["tokens"], "<u4").astype(np.int64)
        sizes = np.array(row["sizes"], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.tokens, self.sizes, self.lead = tokens, sizes, np.array(row["lead"], np.int64)
        place = np.arange(len(tokens)) - np.repeat(self.starts, sizes)  # within the text
        self.counted = place >= np.repeat(self.lead, sizes)
        self.train = np.repeat(np.array(row["train"], bool), sizes) & self.counted
        self.hashes, self.of = [words], [tokens]
        at = words[tokens]
        for level in range(1, order):
            longer = np.zeros_like(at)
            longer[1:] = mixed(at[:-1] * FACTORS[0] + words[tokens[1:]] * FACTORS[1] + np.uint64(level))
            at = longer
            there = place >= level
            distinct, number = np.unique(at[there], return_inverse=True)
            of = np.full(len(tokens), -1, np.int64)
            of[there] = number
            self.hashes.append(distinct)
            self.of.append(of)

    def counts(self, level: int) -> np.ndarray:
        """Of each n-gram of the level, how often training texts of the block hold it."""
        ends = self.of[level][self.train & (self.of[level] >= 0)]
        return np.bincount(ends, minlength=len(self.hashes[level]))


def bucket_cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted hashes pass from one of ``buckets`` equal ranges to the next."""
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


# ---------------------------------------------------------------- counts


def block_counts(stored: DataFrame, order: int, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams = Grams(row, order)
                for level in range(order):
                    hashes, counts = grams.hashes[level], grams.counts(level).astype("<u4")
                    cuts = bucket_cuts(hashes, buckets)
                    full = np.flatnonzero(np.diff(cuts))
                    parts = [(hashes[cuts[k] : cuts[k + 1]], counts[cuts[k] : cuts[k + 1]]) for k in full]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(full, pa.int32()), pa.array([row["block"]] * len(full), pa.int64()), pa.array([level] * len(full), pa.int32()),
                            pa.array([len(h) for h, _ in parts], pa.int32()), pa.array([planes(h) for h, _ in parts], pa.binary()), pa.array([packed(c) for _, c in parts], pa.binary()),
                        ],
                        schema=COUNTS_ARROW,
                    )

    return stored.mapInArrow(run, COUNTS)


def planes(hashes: np.ndarray) -> bytes:
    """Sorted hashes as steps, byte plane by byte plane: the high ones are zeros."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return packed(np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T))


def from_planes(data: bytes) -> np.ndarray:
    rows = np.ascontiguousarray(unpacked(data, np.uint8).reshape(8, -1).T)
    return np.cumsum(rows.view("<u8").ravel(), dtype=np.uint64)


def totals(counts: DataFrame) -> DataFrame:
    """For each block, bucket and level the corpus counts of the block's n-grams;
    ``known`` (in one row of each bucket and level) is how many distinct n-grams
    training texts hold."""

    def run(group: pa.Table) -> pa.Table:
        by_level: dict[int, list[tuple]] = {}
        for r in group.to_pylist():
            by_level.setdefault(r["level"], []).append((r["block"], r["bucket"], from_planes(r["hashes"]), unpacked(r["counts"], "<u4")))
        out = []
        for level, rows in by_level.items():
            rows.sort(key=lambda r: r[0])
            distinct, number = np.unique(np.concatenate([h for _, _, h, _ in rows]), return_inverse=True)
            total = np.bincount(number, np.concatenate([c for *_, c in rows]), len(distinct))
            ends = np.cumsum([len(h) for _, _, h, _ in rows])
            back = [packed(total[number[e - len(h) : e]].astype("<u8")) for e, (_, _, h, _) in zip(ends, rows)]
            known = [int(np.count_nonzero(total)), *[0] * (len(rows) - 1)]
            out += [{"block": r[0], "bucket": r[1], "level": level, "totals": b, "known": k} for r, b, k in zip(rows, back, known)]
        return pa.Table.from_pylist(out, schema=TOTALS_ARROW)

    return counts.groupBy("bucket").applyInArrow(run, TOTALS)


# ---------------------------------------------------------------- automaton


class Automaton:
    """States, arcs and failure arcs that a block's texts can reach.

    State 0 is the root; the others are histories of 1 to order - 1 words.  An
    arc's key is ``state * width + word``; ``weight`` and ``target`` are by arc."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], n: int, v: int, strength: float):
        order, self.width = len(counts), len(grams.hashes[0])
        base = (counts[0] + ADDED) / (n + ADDED * (v + 1))
        self.base = np.log10(base)
        # By n-gram: its last word, and the shorter grams without its first or last word.
        last, suffix, prefix = [np.arange(self.width)], [np.zeros(self.width, np.int64)], [np.zeros(self.width, np.int64)]
        for level in range(1, order):
            ends = np.flatnonzero(grams.of[level] >= 0)
            _, one = np.unique(grams.of[level][ends], return_index=True)
            at = ends[one]
            last.append(grams.tokens[at])
            suffix.append(grams.of[level - 1][at])
            prefix.append(grams.of[level - 1][at - 1])
        p = [base]
        for level in range(1, order):
            p.append((counts[level] + strength * p[level - 1][suffix[level]]) / (counts[level - 1][prefix[level]] + strength))
        # Histories that training texts hold become states, numbered level by level.
        state, fail, back, made = [], [0], [0.0], 1
        for level in range(order - 1):
            there = counts[level] > 0
            number = np.where(there, made + np.cumsum(there) - 1, -1)
            lower = state[level - 1][suffix[level]] if level else np.zeros(self.width, np.int64)
            fail += lower[there].tolist()
            back += np.log10(strength / (counts[level][there] + strength)).tolist()
            made += int(there.sum())
            state.append(number)
        # Arcs of the root for every word, then one for each longer n-gram seen in training.
        keys, weights, targets = [np.arange(self.width)], [self.base], []
        targets.append(np.maximum(state[0], 0) if order > 1 else np.zeros(self.width, np.int64))
        for level in range(1, order):
            seen = np.flatnonzero(counts[level] > 0)
            keys.append(state[level - 1][prefix[level][seen]] * self.width + last[level][seen])
            weights.append(np.log10(p[level][seen]))
            reach = state[level] if level < order - 1 else None
            targets.append(reach[seen] if reach is not None else np.maximum(state[level - 1][suffix[level][seen]], 0))
        self.arcs = dict(zip(np.concatenate(keys).tolist(), range(sum(map(len, keys)))))
        self.weight, self.target = array("d", np.concatenate(weights).tobytes()), array("q", np.concatenate(targets).astype(np.int64).tobytes())
        self.fail, self.back = fail, back

    def read(self, words: list[int], lead: int = 0) -> float:
        """Log10 probability of the words behind the first ``lead``."""
        arcs, weight, target, fail, back, width = self.arcs.get, self.weight, self.target, self.fail, self.back, self.width
        state, taken = 0, []
        for word in words:
            arc = arcs(state * width + word)
            while arc is None:
                taken.append(back[state])
                state = fail[state]
                arc = arcs(state * width + word)
            taken.append(weight[arc])
            state = target[arc]
            if lead:  # so far only what stands before
                lead -= 1
                taken.clear()
        return math.fsum(taken)


def block_scores(stored: DataFrame, found: DataFrame, order: int, n: int, v: int, strength: float) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got: dict[int, list] = {}
        for r in right.to_pylist():
            got.setdefault(r["level"], []).append((r["bucket"], r["totals"]))
        counts = [np.concatenate([unpacked(t, "<u8") for _, t in sorted(got[level])]).astype(float) if level in got else np.zeros(0) for level in range(order)]
        got.clear()
        out = []
        for row in left.to_pylist():  # one
            grams = Grams(row, order)
            machine = Automaton(grams, counts, n, v, strength)
            for i, (start, size, lead) in enumerate(zip(grams.starts.tolist(), grams.sizes.tolist(), grams.lead.tolist())):
                mine = grams.tokens[start : start + size]
                out.append(
                    {
                        "doc_id": row["doc_ids"][i], "whole": row["wholes"][i], "train": row["train"][i], "n_tokens": size - lead,
                        "n_known": int(np.count_nonzero(counts[0][mine[lead:]])), "base_score": math.fsum(machine.base[mine[lead:]].tolist()),
                        "score": machine.read(mine.tolist(), lead),
                    }
                )
        return pa.Table.from_pylist(out, schema=SCORES_ARROW)

    return stored.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, SCORES)


def score(docs: DataFrame, train: Column, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score.  The model learns from the rows where ``train`` holds."""
    stored = durable(blocks(docs, train, order), "blocks")
    size = stored.agg(
        F.sum("n_tokens").alias("tokens"),
        F.sum("train_tokens").alias("train"),
    ).first()
    n = int(size["train"] or 0)
    buckets = max(1, math.ceil((size["tokens"] or 0) * order / 2 / BUCKET_GRAMS))
    found = durable(totals(block_counts(stored, order, buckets)), "totals")
    v = int(found.where("level = 0").agg(F.sum("known")).first()[0] or 0)
    parts = block_scores(stored, found, order, n, v, strength)
    # One row a text but for texts that were cut.
    return (
        parts.groupBy("whole")
        .agg(
            F.first("doc_id").alias("doc_id"), F.first("train").alias("train"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
            F.sum("base_score").alias("base_score"), F.sum("score").alias("score"),
        )
        .select(
            "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score"
        )
    )
