"""Token ids in blocks of byte or bit planes, with a chunk index.

A dataset is a folder of two Parquet tables:

``chunks``  one row per block of up to ``block_ids`` consecutive ids: its place
            (``part``, ``chunk``), ``n_ids``, the zstandard-compressed planes,
            the documents that begin in it and the number of the first of them.
``index``   one row per chunk: ``part``, ``chunk``, ``first_id`` (its place in
            the whole stream), ``n_ids`` and the bytes of each plane.

Documents follow each other in ascending ``doc_id`` (null first; rows of the
same id in any order of equal texts, else by text); a chunk may hold many
documents and a document many chunks.  Spark writes the tables, so a task that
runs again leaves one copy.

Nulls: a null text counts as empty and gives the end id alone.  An empty table
gives an empty dataset.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterframe.llm.word_ids import WordEncoder

BLOCK_IDS = 1 << 16
LEVEL = 3  # of zstandard

CHUNK = (
    "part int, chunk int, n_ids int, first_doc int, kind string, planes array<binary>, "
    "doc_ids array<bigint>, doc_starts array<int>, doc_tokens array<bigint>"
)
PIECE = "part int, doc int, chunk int, doc_id bigint, begins bigint, n_tokens bigint, n_ids bigint, crc bigint"


def to_planes(ids: bytes, kind: str) -> list[bytes]:
    """Plane k holds byte (or bit) k of each id, lowest first."""
    rows = np.frombuffer(ids, np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [rows[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(bits[:, k]).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> bytes:
    if kind == "byte":
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).tobytes()
    bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes]
    return np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little").tobytes()


def in_order(docs: DataFrame) -> DataFrame:
    """Rows dealt and sorted by doc_id.  The text's hash and the row's number
    let Spark cut between rows of one id."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    return rows.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row").select("doc_id", "text")


class _Blocks:
    """Collects documents into blocks of fixed size."""

    def __init__(self, part: int, block_ids: int, kind: str):
        import zstandard

        self.part, self.size, self.kind = part, 4 * block_ids, kind
        self.press = zstandard.ZstdCompressor(level=LEVEL).compress
        self.held = bytearray()
        self.chunk = self.docs = self.first = 0
        self.begun: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes):
        self.begun.append((doc_id, len(self.held) // 4, len(ids) // 4))
        self.docs += 1
        view, at = memoryview(ids), 0
        while at < len(view):
            step = min(len(view) - at, self.size - len(self.held))
            self.held += view[at : at + step]
            at += step
            if len(self.held) == self.size:
                yield self.row()

    def row(self) -> dict:
        ids, begun = bytes(self.held), self.begun
        out = {
            "part": self.part, "chunk": self.chunk, "n_ids": len(ids) // 4, "first_doc": self.first, "kind": self.kind,
            "planes": [self.press(p) for p in to_planes(ids, self.kind)],
            "doc_ids": [d for d, _, _ in begun], "doc_starts": [s for _, s, _ in begun], "doc_tokens": [n for _, _, n in begun],
        }
        self.held, self.begun, self.first, self.chunk = bytearray(), [], self.docs, self.chunk + 1
        return out

    def rest(self):
        if self.held:
            yield self.row()


CHUNK_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int32()), ("first_doc", pa.int32()), ("kind", pa.string()),
        ("planes", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int32())), ("doc_tokens", pa.list_(pa.int64())),
    ]
)
PIECE_ARROW = pa.schema(
    [("part", pa.int32()), ("doc", pa.int32()), ("chunk", pa.int32())]
    + [(name, pa.int64()) for name in ("doc_id", "begins", "n_tokens", "n_ids", "crc")]
)


def encode(docs: DataFrame, tokenizer: str, end_id: int = 1, block_ids: int = BLOCK_IDS, kind: str = "byte") -> DataFrame:
    """The rows of ``chunks``."""
    if kind not in ("byte", "bit"):
        raise ValueError(f"planes are of bytes or bits, not {kind!r}")
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder, blocks = WordEncoder(tokenizer), _Blocks(TaskContext.get().partitionId(), block_ids, kind)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                for row in blocks.add(doc_id, encoder.encode(text.as_py()) + end):
                    yield pa.RecordBatch.from_pylist([row], schema=CHUNK_ARROW)
        for row in blocks.rest():
            yield pa.RecordBatch.from_pylist([row], schema=CHUNK_ARROW)

    return in_order(docs).mapInArrow(run, CHUNK)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_ids: int = BLOCK_IDS, kind: str = "byte") -> str:
    """Write a dataset; returns its path."""
    chunks = encode(docs, tokenizer, end_id, block_ids, kind)
    chunks.write.option("compression", "none").parquet(f"{path}/chunks")
    stored = docs.sparkSession.read.parquet(f"{path}/chunks")
    sizes = stored.select("part", "chunk", "n_ids", F.transform("planes", F.octet_length).alias("plane_bytes"))
    first = F.col("part_first") + F.coalesce(
        F.sum("n_ids").over(Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    index = sizes.join(part_starts(stored), "part").select("part", "chunk", first.alias("first_id"), "n_ids", "plane_bytes")
    index.write.parquet(f"{path}/index")
    return path


def part_starts(chunks: DataFrame) -> DataFrame:
    """Ids before each part: one row per written part, so a single window."""
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("part_first"))


def pieces(chunks: DataFrame) -> DataFrame:
    """What each chunk holds of each document: ids, crc32 and, where the
    document begins, its id, place in the part and length."""

    def run(batches):
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                ids = memoryview(from_planes([unpress(p) for p in row["planes"]], row["n_ids"], row["kind"]))
                cuts = [*row["doc_starts"], row["n_ids"]]
                out = []
                if cuts[0] > 0:  # the end of a document begun before
                    out.append((row["first_doc"] - 1, None, None, None, 0, cuts[0]))
                for k, (doc_id, n) in enumerate(zip(row["doc_ids"], row["doc_tokens"])):
                    out.append((row["first_doc"] + k, doc_id, cuts[k], n, cuts[k], cuts[k + 1]))
                yield pa.RecordBatch.from_pylist(
                    [
                        {"part": row["part"], "doc": doc, "chunk": row["chunk"], "doc_id": i, "begins": b, "n_tokens": n, "n_ids": hi - lo, "crc": zlib.crc32(ids[4 * lo : 4 * hi])}
                        for doc, i, b, n, lo, hi in out
                    ],
                    schema=PIECE_ARROW,
                )

    return chunks.mapInArrow(run, PIECE)


def joined_crc(crcs: list[int], lengths: list[int]) -> int:
    """crc32 of pieces put together, from the crc32 and bytes of each.  As crc32
    is affine, adding b after a gives crc(a + zeros) ^ crc(zeros) ^ crc(b)."""
    total = 0
    for crc, length in zip(crcs, lengths):
        zeros = bytes(length)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it in the whole
    stream), n_tokens (ids found) and ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers)."""
    chunks = spark.read.parquet(f"{path}/chunks")
    index = spark.read.parquet(f"{path}/index").select("part", "chunk", "first_id")
    found = pieces(chunks).join(index, ["part", "chunk"])
    # A document of one chunk, the usual case, leaves the map tasks as one row.
    whole = F.struct("chunk", "doc_id", "n_tokens", "n_ids", "crc", (F.col("first_id") + F.col("begins")).alias("start"))
    docs = found.groupBy("part", "doc").agg(F.sort_array(F.collect_list(whole)).alias("p"))

    @F.arrow_udf("bigint")
    def crc(parts: pa.Array, lengths: pa.Array) -> pa.Array:
        return pa.array([joined_crc(c.as_py(), [4 * n for n in of.as_py()]) for c, of in zip(parts, lengths)], pa.int64())

    def total(column: str):
        return F.aggregate(F.col(column), F.lit(0).cast("bigint"), lambda a, x: a + x)

    return docs.select(
        F.col("p")[0]["doc_id"].alias("doc_id"),
        F.col("p")[0]["start"].alias("start"),
        total("p.n_ids").alias("n_tokens"),
        F.when(F.size("p") == 1, F.col("p")[0]["crc"]).otherwise(crc("p.crc", "p.n_ids")).alias("ids_crc32"),
        F.col("p")[0]["n_tokens"].alias("n_stated"),
    )
