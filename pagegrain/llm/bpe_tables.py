"""Encoding with the ``tokenizers`` library by a table of distinct chunks.

Text is cut at single spaces between two other characters. No token of the two public vocabularies crosses such a space, so a
chunk's ids do not depend on its neighbours: each distinct chunk of a batch is looked up once in a table of chunks, encoded where it is new,
and its ids are joined back by position. A chunk that is one run of
Latin letters (perhaps with signs after it) goes straight to the library's merge model; any other goes through its whole encoder.
Texts with unusual white space are encoded whole.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
import pyarrow as pa

from pagegrain.llm.common import ChunkTable, encoded, process_tables, ship

ship(__name__)

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD_LETTERS = frozenset(chr(i) for i in range(256) if re.match(f"[{LETTERS}]", chr(i)))
#: Signs that are cut off as one run after a word; others may be part of contractions or of special tokens.
SIGNS = r'!"#$%&()*+,\-./:;=?@\[\]^_`{}~\\'
#: A word, perhaps with signs after it, perhaps followed by a line feed and another such word.
PLAIN = re.compile(rf"([{LETTERS}]+)([{SIGNS}]*)(?:(\n)([{LETTERS}]+)([{SIGNS}]*))?")
#: White space other than space, tab, line feed and carriage return, and characters that libraries class differently.
UNUSUAL = re.compile("[\u000b\u000c\u001c-\u001f\u0085  ᠎ -‏    ⁠　﻿]")
#: Texts whose spaces do not all stand alone between other characters, or that have unusual ones.
APART = UNUSUAL.pattern + "|^ | $|  |\n | \n|\t|\r"
ENTRIES = 1_200_000


def byte_signs() -> dict[int, str]:
    """Byte-level vocabularies write byte b as a printable sign: itself where it is one, else the next unused sign from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkEncoder:
    """``encode(text)`` gives little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str, entries: int = ENTRIES):
        from tokenizers import Tokenizer

        self.library, self.entries = Tokenizer.from_file(path), entries
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        #: Word vocabularies lower the text and drop its white space; byte vocabularies keep a space before its word.
        self.words = spec["normalizer"] is not None
        self.signs = byte_signs()
        self.space, self.joined, self.tokenize = self.signs[32], b"".join, self.library.model.tokenize
        #: by id
        self.ids = [struct.pack("<I", i) for i in range(self.library.get_vocab_size())]
        #: by chunk that stands after a space
        self.table = ChunkTable(self.chunk, entries)
        #: by sign or word that stands after no space
        self.runs = ChunkTable(self.run, entries)

    def whole(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def run(self, letters: str) -> bytes:
        """A run of letters (perhaps after a space), of signs, or a line feed."""
        signs = letters.encode().decode("latin-1").translate(self.signs)
        return self.joined([self.ids[t.id] for t in self.tokenize(signs)])

    def chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            # printable ASCII stands for itself
            if chunk.isalpha():
                return self.joined([self.ids[t.id] for t in self.tokenize(chunk.lower() if self.words else self.space + chunk)])
            if (word := chunk.rstrip(".,!?$%&*#;:)")).isalpha():
                return self.table[word] + self.runs[chunk[len(word):]]
        elif WORD_LETTERS.issuperset(chunk):
            return self.run(chunk.lower() if self.words else " " + chunk)
        if m := PLAIN.fullmatch(chunk):
            word, sign, feed, *after = m.groups()
            if not sign and not feed:
                return self.run(word.lower() if self.words else " " + word)
            if self.words:
                return b"".join([self.table[word], self.runs[sign] if sign else b"", *(self.table[x] for x in after if x)])
            return self.table[word] + b"".join(self.runs[x] for x in (sign, feed, *after) if x)
        return self.whole(chunk if self.words else " " + chunk)

    def first(self, chunk: str) -> bytes:
        """A chunk that stands at the start of its text."""
        if self.words:
            return self.table[chunk]
        if m := PLAIN.fullmatch(chunk):
            return b"".join(self.runs[x] for x in m.groups() if x)
        return self.whole(chunk)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        return encoded(texts, APART, self.table.many, self.encode, None if self.words else self.first)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if UNUSUAL.search(text):
            return self.whole(text)
        if text[0] == " " or text[-1] == " " or "  " in text or "\n " in text or " \n" in text or "\t" in text or "\r" in text:
            # cut only at the spaces that stand alone between other characters
            first, *rest = re.split(r"(?<=[^ \t\n\r]) (?=[^ \t\n\r])", text)
        else:
            first, *rest = text.split(" ")
        return self.first(first) + b"".join(map(self.table.__getitem__, rest))


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(path: str, entries: int = ENTRIES) -> ChunkEncoder:
    """The worker's encoder for this vocabulary file. One encoder is held per file: another bound on its tables drops the one before."""
    tables = process_tables()
    if path not in tables or tables[path].entries != entries:
        tables.pop(path, None)
        tables[path] = ChunkEncoder(path, entries)
    return tables[path]
