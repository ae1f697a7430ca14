"""Passages that occur more than once, by suffix arrays.

Every string of ``length`` bytes that also starts anywhere else, in the same
text or another, is a repeat; the bytes that repeats cover are removed.  Texts
are UTF-8 bytes and matches never cross texts.

One suffix array over all texts would be one task's work, so places are first
dealt to shards in which all equal strings meet:

1. *Anchors.*  Of the short grams in a string, the one with the least hash
   (leftmost of equal ones) is its anchor.  Equal strings have the same anchor at
   the same offset.  Strings that start one after the other often share an
   anchor; they and the bytes they span are its *context*.  Every start belongs
   to one context.
2. Anchors whose gram occurs once are done: nothing repeats there.
3. Equal contexts of one gram become one with a multiplicity.
4. Contexts with the same gram go to one shard of bounded size, where a suffix
   array is built by two-stage sorting (``suffix_array``).  Neighbours that share
   ``length`` bytes are equal strings; a run of them that stands for more than
   one place is repeated.
5. Grams with too many different contexts for a shard are parted by the place of
   the anchor in the string: strings whose anchor lies in the same half of the
   offsets also share the bytes between, so these name a smaller group.  After
   as many halvings as offsets have bits a group holds equal strings only, which
   are one context.
6. Repeated strings of contexts go back to their places; spans are merged.

Null texts are empty; empty and short texts keep all bytes.  Each row is a text
of its own, so repeated rows repeat each other; a null doc_id is a row like any
other.  Empty tables give no rows.  Columns other than doc_id and text are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterframe.joins import BROADCAST_ROWS, meet, small
from meterframe.llm.shingles import mixed
from meterframe.llm.suffix_array import common_prefixes, suffix_array
from meterframe.session import durable

LENGTH = 200
STEP = 1 << 18  # starts that are hashed at once
SHARD_BYTES = 1_000_000  # of contexts, on average
GROUP_BYTES = SHARD_BYTES // 4  # of one gram's contexts in a shard

BASE = 0x9E3779B97F4A7C15
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def offsets_of(length: int) -> int:
    """Number of places an anchor can have in a string: a power of two that
    leaves about a third of the length to the gram."""
    if length < 8:
        raise ValueError("strings of 8 bytes or more")
    return 1 << int(length * 0.64).bit_length() - 1


class Hashes:
    """Hashes of any stretch of a buffer, which do not depend on its place."""

    def __init__(self, size: int):
        step, back = np.full(size + 1, BASE, np.uint64), np.full(size + 1, pow(BASE, -1, 1 << 64), np.uint64)
        step[0] = back[0] = 1
        self.up, self.down = np.multiply.accumulate(step), np.multiply.accumulate(back)

    def sums(self, text: np.ndarray) -> np.ndarray:
        out = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(BYTES[text] * self.up[: len(text)], out=out[1:])
        return out


def anchors(text: np.ndarray, valid: np.ndarray, length: int, hashes: Hashes) -> tuple[np.ndarray, ...]:
    """(start, count, offset, gram, context) of each anchor: ``count`` strings
    start from ``start`` on, the anchor lies ``offset`` bytes after the first."""
    width = offsets_of(length)
    gram = length - width + 1
    sums = hashes.sums(text)
    grams = mixed((sums[gram:] - sums[:-gram]) * hashes.down[: len(text) - gram + 1])
    # Hash and, in the low bits, distance from the start of the window.
    least = grams & ~np.uint64(width - 1)
    reach = 1
    while reach < width:
        least = np.minimum(least[: len(least) - reach], least[reach:] + np.uint64(reach))
        reach *= 2
    starts = np.flatnonzero(valid[: len(least)])
    places = starts + (least[starts] & np.uint64(width - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, places[1:] != places[:-1])) if len(places) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(places)))
    start, place = starts[first], places[first]
    end = start + count - 1 + length
    shape = (count * width + (place - start)).astype(np.uint64)
    context = mixed((sums[end] - sums[start]) * hashes.down[start] + shape * np.uint64(0xA0761D6478BD642F))
    return start, count, place - start, grams[place], context


def pieces(ends: np.ndarray, length: int, step: int):
    """Stretches of a buffer of texts to hash at once, as (from, to, starts
    up to): whole texts together, long ones in steps counted from their start."""
    begin = 0
    at = 0
    for end in ends.tolist():
        if end - at > step:
            if at > begin:
                yield begin, at, at
            for low in range(at, end, step):
                yield low, min(low + step + length - 1, end), low + step
            begin = end
        elif end - begin > step:
            yield begin, at, at
            begin = at
        at = end
    if at > begin:
        yield begin, at, at


def profile(docs: DataFrame, length: int, step: int = STEP) -> DataFrame:
    """Per row: rid, doc_id, two hashes of the text, its bytes, sha256, and the
    anchors as arrays (gram, context, place).  Written, so rid stays."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    width = offsets_of(length)

    def run(batches):
        hashes = Hashes(step + length)
        for batch in batches:
            column = batch.column("text")
            wide = np.dtype(np.int64 if pa.types.is_large_string(column.type) else np.int32)
            borders = np.frombuffer(column.buffers()[1], wide, len(column) + 1, column.offset * wide.itemsize).astype(np.int64)
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[borders[0] : borders[-1]]
            borders = borders - borders[0]
            found = []
            for low, high, upto in pieces(borders[1:], length, step):
                if high - low < length:
                    continue
                valid = np.zeros(high - low, bool)
                inside = slice(np.searchsorted(borders, low, "right") - 1, np.searchsorted(borders, high, "left") + 1)
                for a, b in zip(borders[inside][:-1].tolist(), borders[inside][1:].tolist()):
                    valid[max(a - low, 0) : max(min(b - length + 1, upto) - low, 0)] = True
                start, *rest = anchors(data[low:high], valid, length, hashes)
                found.append((start + low, *rest))
            start, count, offset, gram, context = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 5
            owner = np.searchsorted(borders, start, "right") - 1
            lists = np.searchsorted(start, borders)  # of the texts, in order
            lists = pa.array(lists.astype(np.int32))
            place = ((start - borders[owner]) * width + (count - 1)) * width + offset
            texts = [memoryview(data[a:b]) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
                    pa.array(np.diff(borders), pa.int64()),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    pa.ListArray.from_arrays(lists, pa.array(gram.astype(np.uint64).view(np.int64))),
                    pa.ListArray.from_arrays(lists, pa.array(context.astype(np.uint64).view(np.int64))),
                    pa.ListArray.from_arrays(lists, pa.array(place.astype(np.int64))),
                ],
                ["doc_id", "text_hash", "text_key", "n_bytes", "sha", "gram", "context", "place"],
            )

    types = "doc_id bigint, text_hash bigint, text_key binary, n_bytes bigint, sha binary, gram array<bigint>, context array<bigint>, place array<bigint>"
    return durable(rows.mapInArrow(run, types).withColumn("rid", F.monotonically_increasing_id()), "profile")


def with_texts(docs: DataFrame, wanted: DataFrame, listed: str) -> DataFrame:
    """Columns of ``wanted`` (doc_id, text_hash, ..., a written table) with the
    text.  Rows of one doc_id and one text are wanted once.  ``listed`` is its
    array column; with few elements in all the texts need not move."""
    elements = wanted.agg(F.sum(F.size(listed))).first()[0] or 0
    wanted = wanted.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    if elements <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    same = texts["doc_id"].eqNullSafe(wanted["_doc"]) & (F.xxhash64(texts["text"]) == wanted["_hash"])
    return texts.join(wanted, same).drop("doc_id", "_doc", "_hash")


def context_bytes(docs: DataFrame, rows: DataFrame, contexts: DataFrame, length: int) -> DataFrame:
    """Contexts (g, c, n, rid, place) with their bytes: g, c, n, off, ctx."""
    per_row = contexts.groupBy("rid").agg(F.collect_list(F.struct("g", "c", "n", "place")).alias("wants"))
    named = per_row.join(rows.select("rid", "doc_id", "text_hash", "text_key"), "rid")
    # Equal rows may each stand for some contexts of their text.
    named = named.groupBy("doc_id", "text_hash").agg(F.first("text_key").alias("text_key"), F.flatten(F.collect_list("wants")).alias("wants"))
    width = offsets_of(length)

    def run(batches):
        for batch in batches:
            out = ([], [], [], [], [])
            for text, key, wants in zip(batch.column("text"), batch.column("text_key").to_pylist(), batch.column("wants")):
                data = text.as_py().encode()
                if xxhash.xxh3_128_digest(data) != key:
                    continue
                fields = wants.values
                place = fields.field("place").to_numpy()
                start, count, off = place // (width * width), place // width % width, place % width
                for k, name in enumerate(("g", "c", "n")):
                    out[k].append(fields.field(name).to_numpy())
                out[3].append(off)
                out[4].extend([data[a : a + n + length] for a, n in zip(start.tolist(), count.tolist())])
            numbers = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out[:4]]
            yield pa.RecordBatch.from_arrays([*numbers, pa.array(out[4], pa.binary())], ["g", "c", "n", "off", "ctx"])

    found = with_texts(docs, durable(named, "wanted"), "wants").select("text", "text_key", "wants").mapInArrow(
        run, "g bigint, c bigint, n bigint, off bigint, ctx binary"
    )
    repeated = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():  # each of the equal rows has given them
        found = found.dropDuplicates(["g", "c"])
    return durable(found.withColumns({"lo": F.lit(0), "hi": F.lit(width - 1)}), "contexts")


def repeated_in(contexts: list[bytes], times: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first, last) of the stretches of starts in contexts whose
    strings stand for more than one place.  Contexts are laid end to end; a start
    is one of whose string ends within its context."""
    sizes = np.array([len(c) for c in contexts])
    text = np.frombuffer(b"".join(contexts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(text)) - begins[owner]
    whole = inner + length <= sizes[owner]
    order = suffix_array(text, length)
    order = order[whole[order]]
    apart = common_prefixes(text, order, length) < length
    run = np.cumsum(np.append(True, apart)) - 1
    weight = np.bincount(run, np.minimum(times, 2)[owner[order]])
    at = np.sort(order[weight[run] >= 2])
    new = np.append(True, (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])) if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return owner[at[first]], inner[at[first]], inner[at[last]]


def in_shards(contexts: DataFrame, length: int) -> DataFrame:
    """(g, c, runs) of contexts with repeated strings; a group g is in one shard."""
    total = contexts.agg(F.sum(F.length("ctx"))).first()[0] or 0
    shards = max(-(-total // SHARD_BYTES), 1)
    dealt = contexts.select("g", "c", "n", "ctx", F.pmod(F.xxhash64("g", F.lit(12)), F.lit(shards)).alias("shard"))

    def run(shard: pa.Table) -> pa.Table:
        g, c = shard.column("g").to_numpy(), shard.column("c").to_numpy()
        who, first, last = repeated_in(shard.column("ctx").to_pylist(), shard.column("n").to_numpy(), length)
        return pa.table({"g": g[who], "c": c[who], "i0": first.astype(np.int32), "i1": last.astype(np.int32)})

    found = dealt.groupBy("shard").applyInArrow(run, "g bigint, c bigint, i0 int, i1 int")
    return found.groupBy("g", "c").agg(F.collect_list(F.struct("i0", "i1")).alias("runs"))


def halved(contexts: DataFrame, length: int) -> DataFrame:
    """Contexts of large groups, cut to the strings whose anchor lies in the
    lower and in the upper half of the offsets lo to hi.  Groups are named by the
    bytes that all strings of a half share."""
    middle = ((F.col("lo") + F.col("hi") + 1) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("lo").alias("lo"), (middle - 1).alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi"))
    )
    rows = contexts.withColumn("half", F.explode(halves)).select("g", "c", "n", "off", "ctx", "half.lo", "half.hi")
    # Start i of a context has its anchor at off - i.
    low = F.greatest(F.col("off") - F.col("hi"), F.lit(0))
    high = F.least(F.col("off") - F.col("lo"), F.length("ctx") - F.lit(length))
    rows = rows.withColumns({"at": low.cast("int"), "upto": high.cast("int")}).where("at <= upto")
    shared = F.expr(f"substring(ctx, cast(off - lo + 1 as int), {length} - (hi - lo))")
    rows = rows.withColumns({"g2": F.xxhash64("g", "lo", "hi", shared), "ctx2": F.expr(f"substring(ctx, at + 1, upto - at + {length})")})
    rows = rows.withColumns({"off2": F.col("off") - F.col("at")})
    return rows.select("g", "c", "at", "n", "g2", F.xxhash64("ctx2", "off2", F.lit(2)).alias("c2"), "off2", "ctx2", "lo", "hi")


def repeated_starts(contexts: DataFrame, length: int, group_bytes: int) -> DataFrame:
    """(g, c, runs): per context the stretches of its starts that are repeated."""
    levels, found = [], []
    while True:
        sizes = contexts.groupBy("g").agg(F.sum(F.length("ctx")).alias("bytes"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
        large = small(durable(sizes.where((F.col("bytes") > group_bytes) & (F.col("lo") < F.col("hi"))).select("g"), "large"))
        any_large = not large.isEmpty()
        rest = contexts.join(large, "g", "left_anti") if any_large else contexts
        found.append(durable(in_shards(rest, length), "found"))
        if not any_large:
            break
        cut = durable(halved(contexts.join(large, "g", "left_semi"), length), "halved")
        levels.append(cut.select("g", "c", "at", "g2", "c2"))
        contexts = durable(
            cut.groupBy("g2", "c2", "lo", "hi")
            .agg(F.sum("n").alias("n"), F.first("off2").alias("off"), F.first("ctx2").alias("ctx"))
            .select(F.col("g2").alias("g"), F.col("c2").alias("c"), "n", "off", "ctx", "lo", "hi"),
            "contexts",
        )
    runs = found.pop()
    for cut in reversed(levels):  # back to the contexts that were cut
        held = cut.groupBy("g2", "c2").agg(F.count(F.lit(1)).alias("held"))
        facts = durable(runs.select(F.col("g").alias("g2"), F.col("c").alias("c2"), "runs").join(held, ["g2", "c2"]), "facts")
        moved = meet(cut, facts, ["g2", "c2"], "held").select(
            "g", "c", F.transform("runs", lambda r: F.struct((r["i0"] + F.col("at")).alias("i0"), (r["i1"] + F.col("at")).alias("i1"))).alias("runs")
        )
        merged = moved.groupBy("g", "c").agg(F.flatten(F.collect_list("runs")).alias("runs"))
        runs = durable(merged.unionByName(found.pop()), "runs")
    return runs


def removed_spans(places: DataFrame, facts: DataFrame, length: int) -> DataFrame:
    """rid, n_removed, n_spans and the spans (start, end) that repeats cover."""
    width = offsets_of(length)
    start = F.expr(f"place div {width * width}")
    hits = meet(places, facts, ["g", "c"]).select("rid", start.alias("start"), F.inline("runs"))
    covered = hits.select("rid", F.struct((F.col("start") + F.col("i0")).alias("a"), (F.col("start") + F.col("i1") + length).alias("b")).alias("span"))
    per_row = covered.groupBy("rid").agg(F.collect_list("span").alias("spans"))

    def run(batches):
        for batch in batches:
            lists, removed = [], []
            for spans in batch.column("spans"):
                a, b = spans.values.field("a").to_numpy(), spans.values.field("b").to_numpy()
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.append(True, a[1:] > b[:-1])
                a, b = a[new], b[np.append(np.flatnonzero(new)[1:], len(b)) - 1]
                removed.append(int((b - a).sum()))
                lists.append([{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid"),
                    pa.array(removed, pa.int64()),
                    pa.array([len(x) for x in lists], pa.int64()),
                    pa.array(lists, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                ],
                ["rid", "n_removed", "n_spans", "spans"],
            )

    return durable(per_row.mapInArrow(run, "rid bigint, n_removed bigint, n_spans bigint, spans array<struct<a:bigint,b:bigint>>"), "spans")


def repeats(docs: DataFrame, length: int = LENGTH, group_bytes: int = GROUP_BYTES, step: int = STEP) -> tuple[DataFrame, DataFrame]:
    """The profile of the rows of docs and, by its rid, what to remove from rows
    that hold a repeat (see ``removed_spans``); both written."""
    rows = profile(docs, length, step)
    each = rows.select("rid", F.inline(F.arrays_zip("gram", "context", "place"))).withColumnsRenamed({"gram": "g", "context": "c"})
    grams = durable(each.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "grams")
    places = durable(meet(each, grams, ["g"]).drop("n"), "places")
    contexts = durable(places.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), F.first("rid").alias("rid"), F.first("place").alias("place")), "distinct")
    runs = repeated_starts(context_bytes(docs, rows, contexts, length), length, group_bytes)
    facts = durable(contexts.select("g", "c", "n").join(runs, ["g", "c"]), "facts")
    return rows, removed_spans(places, facts, length)


def kept_parts(docs: DataFrame, rows: DataFrame, spans: DataFrame) -> DataFrame:
    """rid and the remaining bytes of rows that lose some but not all of them.
    (If two rows have one text, they lose all of it or have no repeat.)"""
    partly = spans.join(rows.select("rid", "doc_id", "text_hash", "text_key", "n_bytes"), "rid").where("n_removed < n_bytes")
    partly = partly.select("rid", "doc_id", "text_hash", "text_key", "spans")

    def run(batches):
        for batch in batches:
            rids, kept = [], []
            for rid, text, key, spans in zip(*[batch.column(c) for c in ("rid", "text", "text_key", "spans")]):
                data = text.as_py().encode()
                if xxhash.xxh3_128_digest(data) != key.as_py():
                    continue
                cuts = [(s["a"], s["b"]) for s in spans.as_py()]
                starts, ends = [0, *[b for _, b in cuts]], [*[a for a, _ in cuts], len(data)]
                rids.append(rid.as_py())
                kept.append(b"".join(data[a:b] for a, b in zip(starts, ends)))
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(kept, pa.binary())], ["rid", "kept"])

    found = with_texts(docs, durable(partly, "partly"), "spans")
    return found.select("rid", "text", "text_key", "spans").mapInArrow(run, "rid bigint, kept binary")


def digest(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, spans = repeats(docs, length, **sizes)
    kept = durable(kept_parts(docs, rows, spans).select("rid", F.sha2("kept", 256).alias("part")), "kept")
    done = rows.select("rid", "doc_id", "n_bytes", F.lower(F.hex("sha")).alias("whole")).join(spans.drop("spans"), "rid", "left").join(kept, "rid", "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    sha = F.when(F.col("n_removed").isNull(), F.col("whole")).when(F.col("n_removed") == F.col("n_bytes"), none).otherwise(F.col("part"))
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_removed", "n_spans")]
    return done.select("doc_id", "n_bytes", *zero, sha.alias("kept_sha256"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id and the remaining text of each row of docs.  Characters of which
    only a part remains are left out."""
    rows, spans = repeats(docs, length)
    kept = durable(kept_parts(docs, rows, spans), "kept")
    untouched = rows.join(spans.select("rid"), "rid", "left_anti").groupBy("doc_id", "text_hash").agg(
        F.collect_list("rid").alias("rids"), F.first("text_key").alias("text_key")
    )
    whole = with_texts(docs, durable(untouched.select("doc_id", "text_hash", "rids"), "whole"), "rids")
    whole = whole.select(F.explode("rids").alias("rid"), "text").dropDuplicates(["rid"])

    @F.pandas_udf("string")
    def decoded(data):
        return data.map(lambda b: b.decode(errors="ignore"))

    texts = whole.unionByName(kept.select("rid", decoded("kept").alias("text")))
    return rows.select("rid", "doc_id").join(texts, "rid", "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
