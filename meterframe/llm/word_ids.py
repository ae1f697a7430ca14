"""Token ids of whole texts, encoding each distinct word once per task.

The tokenizer drops white space and no piece of it reaches across white space,
so a text's ids are the ids of its words in order (tests compare the two on
random texts).  Words are looked up in a table of bounded size.
"""

from __future__ import annotations

import os
import re

CACHED_WORDS = 500_000  # in each of two tables per task
LONG = 64  # bytes; longer words are not kept
# Texts of ASCII and Latin-1 letters only have one code point a letter and nothing
# to compose, so they can be cut on lower-case bytes.
PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
# How the tokenizer's file splits lower-case text.
PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\xff]+|[0-9]|[^a-z0-9\x80-\xff\t-\r ]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder(dict):
    """Maps a word, or a lower-case ASCII piece of one, to its ids as
    little-endian unsigned 32-bit integers.

    When the table is full it becomes the older one; words still in use come
    back from there, the others are forgotten with it."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.letters = byte_letters()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self._new(word)
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        if len(word) < LONG:
            self[word] = found
        return found

    def _new(self, word: bytes) -> bytes:
        """Ids of a piece in lower case, or of a whole word."""
        if word.isalpha() and word.islower():  # of bytes: ASCII letters only
            return self._model(word.decode())
        if b"<|" in word or b"|>" in word:  # may be a special token, which is case-sensitive
            return self._whole(word)
        if word.isascii() or PLAIN.fullmatch(word.decode()):
            pieces = PIECES.findall(word.decode().lower().encode())
            if pieces == [word]:
                return self._model("".join([self.letters[b] for b in word]))
            return b"".join([self[p] for p in pieces])
        return self._whole(word)

    def _model(self, letters: str) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(letters)])

    def _whole(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return b"".join([self.packed[i] for i in ids])

    def encode(self, text: str) -> bytes:
        if "<|" not in text and PLAIN.fullmatch(text):
            words = PIECES.findall(text.lower().encode())
        else:
            words = text.encode().split()
        return b"".join([self[w] for w in words])
