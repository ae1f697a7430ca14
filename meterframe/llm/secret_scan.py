"""Secrets in texts.

An Aho-Corasick automaton finds keywords in one pass over the lower-case text;
anchored patterns run only where a keyword starts.  Kinds that carry a checksum
or other proof of their form inside are reported only if it holds.

Kinds, in the order used for equal starts:

``assign``   a value of at least 6 characters given to a password, token ...
``access``   an access key id, ``AKIA`` and at least 16 more
``hex``      a run of at least 24 lower-case hex digits (no keyword; found by its own pattern)
``github``   ``gh?_`` tokens whose last 6 characters are the base-62 crc32 of the 30 before
``npm``      the same form behind ``npm_``
``jwt``      three base64url parts, of which the first decodes to a JSON object with ``alg``
``key``      a PEM private key block whose body decodes as base64

Spans are (kind, start, end) in code points, end exclusive.  Null or empty
texts have none; each row is answered by one row, also rows with equal or null
``doc_id``.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "key")
# The patterns of the base kinds and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
JWT_RUN = re.compile(r"[A-Za-z0-9_-]*")
KEY = re.compile(r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END \1PRIVATE KEY-----")
KEYWORDS = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign"),
    "akia": "access",
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "github"),
    "npm_": "npm",
    "eyj": "jwt",
    "-----begin ": "key",
}
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(number: int, width: int) -> str:
    out = ""
    for _ in range(width):
        number, digit = divmod(number, 62)
        out = DIGITS[digit] + out
    return out


def carries_crc(m: re.Match) -> bool:
    return base62(zlib.crc32(m[1].encode()), 6) == m[2]


def names_algorithm(m: re.Match) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(head, dict) and "alg" in head


def holds_base64(m: re.Match) -> bool:
    body = "".join(m[2].split())
    try:
        return len(base64.b64decode(body, validate=True)) > 0
    except (ValueError, binascii.Error):
        return False


# Of each kind with keywords: its pattern and what a match must pass.
RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= LEAST_VALUE),
    "access": (ACCESS, lambda m: len(m[0]) >= LEAST_ACCESS),
    "github": (GITHUB, carries_crc),
    "npm": (NPM, carries_crc),
    "jwt": (JWT, names_algorithm),
    "key": (KEY, holds_base64),
}


def lower_ascii(text: str) -> str:
    """A-Z in lower case; other letters, and so all places, stay."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


class Scanner:
    def __init__(self):
        import ahocorasick

        self.keywords = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            self.keywords.add_word(word, (kind, len(word)))
        self.keywords.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        near: dict[str, list[int]] = {}
        for end, (kind, length) in self.keywords.iter(lower_ascii(text)):
            near.setdefault(kind, []).append(end - length + 1)
        found = [("hex", *m.span()) for m in HEX.finditer(text)]
        for kind, starts in near.items():
            pattern, passes = RULES[kind]
            free = 0  # matches of a kind do not overlap; one that fails its test still takes its place
            for start in sorted(starts):
                m = pattern.match(text, start) if start >= free else None
                if m:
                    free = m.end()
                    if passes(m):
                        found.append((kind, start, free))
                elif kind == "jwt" and start >= free and text.startswith("eyJ", start):
                    free = JWT_RUN.match(text, start).end()  # what follows the run decides for all starts in it
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans) -> str:
    return ",".join([f"{kind}:{start}:{end}" for kind, start, end in spans])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``, the spans of the row's text in order."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "found"])

    return rows.mapInArrow(run, "doc_id bigint, found array<struct<kind:string,start:bigint,end:bigint>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the sha256 of the base spans, and all spans."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds: str):
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def base_spans_plainly(text: str) -> list[tuple[str, int, int]]:
    """The base kinds by running each pattern over the whole text (for tests)."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
