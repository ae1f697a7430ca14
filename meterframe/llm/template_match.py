"""Benchmark questions in documents, also with other numbers, names and units.

Texts become templates: numbers, names (capitalised words within a sentence)
and units behind a number give way to typed placeholders, other words lose
their marks at either end and their case.  Windows of ``WINDOW`` template words
(all words of a shorter item, if it has ``LEAST_WORDS``) are hashed and joined;
a window must hold at least as many plain words as placeholders.

Windows of a document that hit one item at one offset belong together.  Over
them, each value in the item must stand for one value in the document and the
other way round; then the item is found: ``exact`` if all values are the same,
else ``reparameterised``.  If slots do not fit, the windows that agree with one
such assignment count; the item is found if they cover more than ``SHARE`` percent of it.

A word counts by what stands before it, so the first window of an item may look
different in a document.  An item without a window behind the first that says
enough also has windows of its plain words, with no placeholders; it is
``exact`` where all of them stand together.  Items below ``LEAST_WORDS`` words have
only that one window, and count where it stands between sentence or line marks.

A bit table of fixed size (``2 ** TABLE_BITS`` bits), filled from all windows of
the benchmark, is sent to the tasks; windows it does not know cannot join and
stay where they are.  All others are joined exactly.

Null and empty texts hold nothing; items below ``least_words`` words (1 for whole
benchmarks) or of marks alone are not searched; items with a null id are answered under it.  Rows of equal
``doc_id`` and text are answered once.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterframe.llm.boxed import boxed, own, unboxed
from meterframe.llm.shingles import mixed
from meterframe.session import durable

WINDOW = 8
LEAST_WORDS = 5
SHARE = 80  # percent of an item's words, if slots do not fit
REMOVE_SHARE, PASSAGE = 50, 50  # percent; words
TABLE_BITS = 24
CACHED_WORDS = 400_000  # per task
BROADCAST_ROWS = 200_000
PLAIN, NUMBER, UNIT, NAME = range(4)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
NUMERIC = re.compile(r"[+-]?[$€£]?\d[\d.,/:]*(%|[a-z]{1,3})?", re.I)
MARKS = "\"'`.,;:!?()[]{}<>*_#|~…«»„“”‘’"
# Words that are units where they follow a number.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles g kg gram grams mg ton tons pound pounds ounce ounces l ml liter liters litre litres "
    "gallon gallons s sec second seconds minute minutes hour hours day days week weeks month months year years percent dollar dollars cent cents "
    "euro euros degree degrees mph kmh kb mb gb tb hz khz mhz w kw kwh v volt volts joule joules".split()
)

NOTHING = np.uint64(xxhash.xxh3_64_intdigest(""))  # a word of marks alone
PLAIN_KEY = np.uint64(0x5851F42D4C957F2D)  # sets the hashes of plain windows apart
WINDOWS = "key bigint, at int, hash bigint, slots array<struct<place:int,kind:int,value:bigint>>"
SLOT = pa.struct([("place", pa.int32()), ("kind", pa.int32()), ("value", pa.int64())])


class Words:
    """What is known of each distinct word: its hash, what it is alone, and
    whether a sentence ends behind it."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.hash = np.zeros(CACHED_WORDS, np.uint64)
        self.kind = np.zeros(CACHED_WORDS, np.int8)
        self.unit = np.zeros(CACHED_WORDS, bool)
        self.ends = np.zeros(CACHED_WORDS, bool)

    def numbers(self, words: list[str]) -> np.ndarray:
        known = self.number
        new = set(words).difference(known)
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = set(words)
        if len(new) > len(self.hash):  # one text with more distinct words than the table
            for name in ("hash", "kind", "unit", "ends"):
                setattr(self, name, np.resize(getattr(self, name), len(new)))
        if new:
            self.add(list(new))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def add(self, new: list[str]) -> None:
        first, digest = len(self.number), xxhash.xxh3_64_intdigest
        bares = [w.strip(MARKS) for w in new]
        lows = [b.lower() for b in bares]
        place = slice(first, first + len(new))
        self.hash[place] = np.fromiter(map(digest, lows), np.uint64, len(new))
        # Letters alone are no number, and what ends a sentence is among the marks.
        self.kind[place] = [
            NUMBER if not b.isalpha() and NUMERIC.fullmatch(b) else NAME if b[:1].isupper() and b[1:].islower() else PLAIN for b in bares
        ]
        self.unit[place] = [low in UNITS for low in lows]
        self.ends[place] = [len(b) != len(w) and w.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":") for w, b in zip(new, bares)]
        self.number.update(zip(new, range(first, first + len(new))))

    def template(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word: template hash, kind and value."""
        words = text.split()
        at = self.numbers(words)
        kind, value = self.kind[at].copy(), self.hash[at]
        if len(at):
            first = np.append(True, self.ends[at][:-1])
            kind[(kind == NAME) & first] = PLAIN  # any word is capitalised there
            after = np.append(False, kind[:-1] == NUMBER)
            kind[(kind != NUMBER) & self.unit[at] & after] = UNIT
        return np.where(kind == PLAIN, value, kind.astype(np.uint64)), kind, value


def window_hashes(template: np.ndarray, kind: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window that begins at each word, and whether it says enough."""
    n = len(template) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total, each = np.full(n, width, np.uint64), mixed(template)  # each word is mixed once, not once for each window
    for k in range(width):
        total ^= each[k : k + n]
        total *= FACTOR
    plain = np.concatenate([[0], np.cumsum(kind == PLAIN)])
    return mixed(total), 2 * (plain[width:] - plain[:n]) >= width


def between_marks(text: str, ends: np.ndarray, width: int) -> np.ndarray:
    """Whether the window that begins at each word has a sentence or line mark,
    or an end of the text, on either side.  ``ends``: a sentence ends behind the word."""
    cut = np.append(True, ends)
    cut[np.cumsum([len(line.split()) for line in text.splitlines()])] = True
    cut[-1] = True
    return cut[:-width] & cut[width:]


def plain_hashes(value: np.ndarray, width: int) -> np.ndarray:
    return window_hashes(value, np.zeros(len(value), np.int8), width)[0] ^ PLAIN_KEY


def _rows(key: int, at: np.ndarray, hashes: np.ndarray, width: int, kind: np.ndarray, value: np.ndarray) -> list[dict]:
    out = []
    for p, h in zip(at.tolist(), hashes[at].astype(np.int64).tolist()):
        slots = np.flatnonzero(kind[p : p + width])
        out.append(
            {"key": key, "at": p, "hash": h, "slots": [{"place": int(k), "kind": int(kind[p + k]), "value": int(value[p + k].astype(np.int64))} for k in slots]}
        )
    return out


WINDOW_ARROW = pa.schema([("key", pa.int64()), ("at", pa.int32()), ("hash", pa.int64()), ("slots", pa.list_(SLOT))])


def item_windows(benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """item_id, at, hash, slots and width of all windows of the items, and the
    items' numbers of words."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = WINDOW_ARROW.append(pa.field("width", pa.int32())).append(pa.field("words", pa.int32())).append(pa.field("plain", pa.bool_()))

    def run(batches):
        words = Words()
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text")):
                template, kind, value = words.template(text.as_py())
                width = min(WINDOW, len(template))
                if width >= max(least_words, 1) and (value != NOTHING).any():
                    hashes, good = window_hashes(template, kind, width)
                    good &= width >= LEAST_WORDS
                    found = [{**r, "width": width, "words": len(template), "plain": False} for r in _rows(item, np.flatnonzero(good), hashes, width, kind, value)]
                    if not good[1:].any():
                        hashes = plain_hashes(value, width)
                        of = _rows(item, np.arange(len(hashes)), hashes, width, np.zeros_like(kind), value)
                        found += [{**r, "width": width, "words": len(template), "plain": True} for r in of]
                    yield pa.RecordBatch.from_pylist(found, schema=schema)

    return rows.mapInArrow(run, WINDOWS + ", width int, words int, plain boolean").withColumnRenamed("key", "item_id")


def bit_table(windows: DataFrame) -> np.ndarray:
    """The fixed-size table: at most 2 ** TABLE_BITS / 64 rows reach the driver."""
    placed = windows.select(F.shiftrightunsigned("hash", 64 - TABLE_BITS).alias("place"))
    bits = placed.groupBy(F.shiftright("place", 6).cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits"))
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    found = bits.toArrow()
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint64)
    return table


def doc_windows(docs: DataFrame, table: np.ndarray, widths: list[tuple[int, bool]]) -> DataFrame:
    """Windows, by width and whether of plain words, that the bit table knows: doc_id, text_hash, at, hash, slots."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    schema = WINDOW_ARROW.append(pa.field("doc_id", pa.int64()))

    def run(batches):
        words, bits = Words(), shared.value
        for batch in batches:
            for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), batch.column("text")):
                text = text.as_py()
                template, kind, value = words.template(text)
                for width, plain in widths:
                    if len(value) < width:
                        continue
                    if plain:
                        hashes, good, slots = plain_hashes(value, width), True, np.zeros_like(kind)
                        if width < LEAST_WORDS:
                            good = between_marks(text, words.ends[words.numbers(text.split())], width)
                    else:
                        (hashes, good), slots = window_hashes(template, kind, width), kind
                    place = hashes >> np.uint64(64 - TABLE_BITS)
                    hit = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
                    at = np.flatnonzero(good & (hit > 0))
                    if len(at):
                        found = [{**r, "doc_id": doc_id} for r in _rows(key, at, hashes, width, slots, value)]
                        yield pa.RecordBatch.from_pylist(found, schema=schema)

    return rows.mapInArrow(run, WINDOWS + ", doc_id bigint").withColumnRenamed("key", "text_hash")


AGREEING = "n_windows bigint, n_slots bigint, same boolean, places array<int>"


def agreeing(windows, width):
    """Of windows (at, slots) whose slots do not fit together: those that agree
    with one assignment of values, and where they begin.  Tried are equal
    values and, if each value of the item stands for one in the document, pairs
    taken by the number of windows that hold them."""
    held = [(w["at"], {(p["kind"], p["item"], p["doc"]) for p in w["slots"]}) for w in windows]
    counts = Counter(p for _, pairs in held for p in pairs)
    equal = {p for p in counts if p[1] == p[2]}
    taken, items, values = set(), set(), set()
    for kind, item, doc in sorted(counts, key=lambda p: (-counts[p], p[1] != p[2], p)):
        if (kind, item) not in items and (kind, doc) not in values:
            taken.add((kind, item, doc))
            items.add((kind, item))
            values.add((kind, doc))
    best = None
    of_item = len({p[:2] for p in counts})
    for chosen in (equal, taken) if of_item == len(counts) else (equal,):
        mine = [(at, pairs) for at, pairs in held if pairs <= chosen]
        pairs = set().union(*[p for _, p in mine])
        covered = len({at + i for at, _ in mine for i in range(width)})
        if best is None or covered > best[0]:
            best = covered, (len(mine), len(pairs), all(p[1] == p[2] for p in pairs), [at for at, _ in mine])
    return best[1]


def find(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, n_slots, kind, covered, words) of items found."""
    items = durable(item_windows(benchmark, least_words), "items")
    widths = sorted((r["width"], r["plain"]) for r in items.select("width", "plain").distinct().collect())  # at most 2 * WINDOW
    windows = durable(doc_windows(docs, bit_table(items), widths), "windows").dropDuplicates(["doc_id", "text_hash", "at", "hash"])
    there = items.select("item_id", "hash", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "width", "words", "plain")
    hits = windows.join(there, "hash").select(
        "doc_id", "text_hash", "item_id", "width", "words", "plain", (F.col("at") - F.col("item_at")).alias("offset"), F.col("item_at").alias("at"),
        F.zip_with("item_slots", "slots", lambda i, d: F.struct(i["kind"].alias("kind"), i["value"].alias("item"), d["value"].alias("doc"))).alias("slots"),
    )
    together = hits.groupBy("doc_id", "text_hash", "item_id", "offset", "width", "words", "plain").agg(F.collect_set(F.struct("at", "slots")).alias("windows"))
    together = together.withColumns({"n_windows": F.size("windows").cast("bigint"), "pairs": F.array_distinct(F.flatten("windows.slots"))})

    together = together.where(~F.col("plain") | (F.col("n_windows") == F.col("words") - F.col("width") + 1))

    def distinct(*names: str):
        return F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"].alias("k"), *[p[n].alias(n) for n in names]))))

    fits = (distinct("item") == F.size("pairs")) & (distinct("doc") == F.size("pairs"))
    judged = durable(together.withColumn("fits", fits), "judged")

    def places(begins: Column) -> Column:  # words of the item below windows that begin there
        return F.array_distinct(F.flatten(F.transform(begins, lambda a: F.sequence(a, a + F.col("width") - 1)))).alias("places")

    facts = ("doc_id", "text_hash", "item_id", "words")
    whole = judged.where("fits").select(
        *facts, "n_windows", F.size("pairs").cast("bigint").alias("n_slots"), F.forall("pairs", lambda p: p["item"] == p["doc"]).alias("same"), places(F.col("windows.at"))
    )
    # Few windows do not fit; only they are sent to Python.  Marked so, the function is not
    # worked out once more for the condition below, in a second Python worker of each task.
    agree = F.udf(agreeing, AGREEING).asNondeterministic()
    parts = judged.where("not fits").withColumn("part", agree("windows", "width"))
    parts = parts.select(*facts, "part.n_windows", "part.n_slots", "part.same", places(F.col("part.places")))
    return (
        whole.unionByName(parts.where(100 * F.size("places") > SHARE * F.col("words")))
        .groupBy(*facts)
        .agg(
            F.max("n_windows").alias("n_windows"),
            F.max("n_slots").alias("n_slots"),
            F.when(F.max("same"), "exact").otherwise("reparameterised").alias("kind"),
            F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("covered"),
        )
        .select("doc_id", "text_hash", "item_id", "n_windows", "n_slots", "kind", "covered", "words")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS, share: int = REMOVE_SHARE, passage: int = PASSAGE) -> DataFrame:
    """The rows of docs that hold no item: of each, less than ``share`` percent of
    its words and less than ``passage`` words."""
    there = (100 * F.col("covered") >= share * F.col("words")) | (F.col("covered") >= passage)
    found = durable(find(docs, benchmark, least_words).where(there).select(F.col("doc_id").alias("id"), "text_hash").distinct(), "found")
    if found.count() <= BROADCAST_ROWS:  # counted; same rows either way, but texts need not move
        found = F.broadcast(found)
    hit = own("doc_id").cast("bigint").eqNullSafe(F.col("id")) & (F.xxhash64(own("text")) == F.col("text_hash"))
    return unboxed(boxed(docs).join(found, hit, "left_anti"), docs.columns)
