"""Token counts that follow edits.

The tokenizer's pattern cuts a text into pre-tokens, and each is encoded alone,
so a text's tokens are the sum over its pre-tokens.  A tree is kept for each
document: its leaves are runs of about ``LEAF`` pre-tokens with their
characters, pre-tokens and tokens, and each node above holds the sums of two.
An edit goes down the tree to the leaves it touches, takes at least ``CONTEXT``
pre-tokens before them as context, cuts and encodes from there until a cut falls
on the end of an old leaf behind the edit, and adds the differences along the
paths to the root.  The rest of the text is neither cut nor encoded.

(Whether a pre-token ends at a place depends on the text up to the first
character of the second pre-token behind, and on nothing before, so three
pre-tokens of context are enough and the cuts agree from the first common one.)

Edits are (start, end, text) in code points of the text as the edits before
left it; places beyond the text mean its end, and an end before the start means
the start.  Null texts are empty and null replacements delete.  Rows are
answered one by one.  Other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 32
CONTEXT = 4
CACHED_PIECES = 300_000  # in each of two tables per task
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"


class PieceCounts(dict):
    """Tokens of a pre-token.  A full table becomes the older one."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("kept", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(pattern)
        self.older: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        found = self.older.get(piece)
        if found is None:
            found = len(self.encoding.encode_ordinary(piece))
        if len(piece) < 64:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class Tree:
    """Sums of characters, pre-tokens and tokens: level 0 holds the leaves, level
    k + 1 the sums of two nodes of level k."""

    def __init__(self, leaves: np.ndarray):
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            if len(below) % 2:
                below = np.concatenate([below, np.zeros((1, 3), np.int64)])
            self.levels.append(below.reshape(-1, 2, 3).sum(axis=1))

    @property
    def total(self) -> np.ndarray:
        return self.levels[-1][0] if len(self.levels[0]) else np.zeros(3, np.int64)

    def find(self, place: int, column: int = 0) -> tuple[int, np.ndarray]:
        """The leaf that holds the place (the last one if none does) and the sums before it."""
        at, before = 0, np.zeros(3, np.int64)
        for level in reversed(self.levels[:-1]):
            at *= 2
            if at + 1 < len(level) and place >= before[column] + level[at, column]:
                before = before + level[at]
                at += 1
        return at, before

    def put(self, leaf: int, sums: np.ndarray) -> None:
        change = sums - self.levels[0][leaf]
        for level in self.levels:
            level[leaf] += change
            leaf //= 2

    def to_bytes(self) -> bytes:
        return np.concatenate(self.levels).astype("<i8").tobytes() if len(self.levels[0]) else b""

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        flat = np.frombuffer(data, "<i8").reshape(-1, 3).astype(np.int64)
        tree = cls.__new__(cls)
        tree.levels = []
        if not len(flat):
            tree.levels = [flat]
            return tree
        # With n leaves the levels have n, ceil(n / 2), ... 1 nodes: 2 n - 1 and up to one more a level.
        n = next(n for n in range(max(1, len(flat) // 2 - 32), len(flat) + 1) if nodes_of(n) == len(flat))
        at = 0
        while True:
            tree.levels.append(flat[at : at + n].copy())
            at += n
            if n == 1:
                return tree
            n = -(-n // 2)


def nodes_of(leaves: int) -> int:
    total = leaves
    while leaves > 1:
        leaves = -(-leaves // 2)
        total += leaves
    return total


def grouped(pieces: list[str], counts: PieceCounts) -> np.ndarray:
    """Leaves over pre-tokens."""
    sums = np.array([(len(p), 1, counts[p]) for p in pieces], np.int64).reshape(-1, 3)
    return np.add.reduceat(sums, np.arange(0, len(sums), LEAF)) if len(sums) else sums


def build(text: str, counts: PieceCounts) -> Tree:
    return Tree(grouped(counts.cut.findall(text), counts))


def edit(text: str, tree: Tree, start: int, end: int, new: str, counts: PieceCounts) -> tuple[str, Tree, int]:
    """The new text and tree, and how many characters were cut and encoded."""
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    edited = text[:start] + new + text[end:]
    leaves = tree.levels[0]
    if not len(leaves):
        return edited, build(edited, counts), len(edited)
    first, before = tree.find(start)
    place, pieces = int(before[0]), 0
    while first > 0 and pieces < CONTEXT:
        first -= 1
        place -= int(leaves[first, 0])
        pieces += int(leaves[first, 1])
    last, old_end = tree.find(end)
    last_place = int(old_end[0]) + int(leaves[last, 0])
    shift = len(new) - (end - start)
    found, at = [], place
    for m in counts.cut.finditer(edited, place):
        if at >= start + len(new):
            while last_place + shift < at and last + 1 < len(leaves):
                last += 1
                last_place += int(leaves[last, 0])
            if last_place + shift == at and last_place >= end:
                break
        found.append(m[0])
        at = m.end()
    else:
        last = len(leaves) - 1
    slots = last - first + 1
    sums = np.array([(len(p), 1, counts[p]) for p in found], np.int64).reshape(-1, 3)
    if len(sums) > 4 * LEAF * slots or slots > 4 * LEAF + len(sums):  # leaves far off their size: laid out anew
        rest = np.add.reduceat(sums, np.arange(0, len(sums), LEAF)) if len(sums) else sums
        return edited, Tree(np.concatenate([leaves[:first], rest, leaves[last + 1 :]])), at - place
    for k in range(slots):
        part = sums[len(sums) * k // slots : len(sums) * (k + 1) // slots]
        tree.put(first + k, part.sum(axis=0) if len(part) else np.zeros(3, np.int64))
    return edited, tree, at - place


def keep(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text, n_tokens and tree of each row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        counts = PieceCounts(path, pattern)
        for batch in batches:
            trees = [build(t.as_py(), counts) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array([int(t.total[2]) for t in trees], pa.int64()), pa.array([t.to_bytes() for t in trees], pa.binary())],
                ["doc_id", "text", "n_tokens", "tree"],
            )

    return rows.mapInArrow(run, "doc_id bigint, text string, n_tokens bigint, tree binary")


def listed(edits: DataFrame) -> DataFrame:
    """(doc_id, seq, start, end, text) rows as one list a document, in order of seq."""
    step = F.struct("seq", F.struct(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "text").alias("e"))
    return edits.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(step)), lambda s: s["e"]).alias("edits"))


def follow(kept: DataFrame, edits: Column | str, path: str, pattern: str) -> DataFrame:
    """The kept rows after their ``edits`` (a column of type ``EDITS``, null for
    none): doc_id, text, n_tokens, tree, the tokens before, and how many
    characters were cut and encoded."""
    rows = kept.select("doc_id", "text", "tree", (F.col(edits) if isinstance(edits, str) else edits).cast(EDITS).alias("edits"))

    def run(batches):
        counts = PieceCounts(path, pattern)
        for batch in batches:
            out = []
            for doc_id, text, data, steps in zip(*(batch.column(c) for c in ("doc_id", "text", "tree", "edits"))):
                text, tree, work = text.as_py(), Tree.from_bytes(data.as_py()), 0
                before = int(tree.total[2])
                for e in steps.as_py() or []:
                    start = 0 if e["start"] is None else e["start"]
                    text, tree, more = edit(text, tree, start, start if e["end"] is None else e["end"], e["text"] or "", counts)
                    work += more
                out.append({"doc_id": doc_id.as_py(), "text": text, "n_tokens": int(tree.total[2]), "tree": tree.to_bytes(), "n_before": before, "encoded_chars": work})
            yield pa.RecordBatch.from_pylist(out, schema=FOLLOWED)

    return rows.mapInArrow(run, "doc_id bigint, text string, n_tokens bigint, tree binary, n_before bigint, encoded_chars bigint")


FOLLOWED = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64()), ("tree", pa.binary()), ("n_before", pa.int64()), ("encoded_chars", pa.int64())]
)
