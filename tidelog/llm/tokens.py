"""Token ids of whole texts by the tokenizers library, remembered by word.

A byte-pair tokenizer cuts a text into pieces before it merges, and no piece
reaches over a change from text to white space. So a text is cut at white space
here, each distinct word is encoded once a worker, and its ids are looked up
after that. Words of plain letters and marks go straight to the tokenizer's
model; everything else goes through its whole chain. The ids are those of
``Tokenizer.encode(text, add_special_tokens=False)``; a tokenizer of another
make is called on whole texts.
"""

from __future__ import annotations

import array
import json
import re

from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

from tidelog.llm.common import worker_store

#: Words remembered by a worker, some 100 MB; then it starts afresh.
WORDS_KEPT = 600_000

_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

# Letters that no normal form changes, then ASCII marks other than the apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
_PIECE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# White space to Python but not to the tokenizers' patterns, and the mark of a word without a blank.
_ODD = re.compile("[\x00\x1c-\x1f]")
_NOT_SINGLE = re.compile(r"[^\S \n]|\s\s")
_NOT_SINGLE_ASCII = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")


def byte_letters() -> dict[int, int]:
    """Byte to letter as byte-level tokenizers show it: printable bytes stay, others follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


class Words(dict):
    """Word to the bytes of its ids (unsigned, 32 bits, little-endian)."""

    def __init__(self, source: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(source)
        made = json.loads(source)
        before = made["pre_tokenizer"]
        normal = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
        # Byte-level pieces keep one blank in front of a word; the other make drops white space.
        self.spaced = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not normal
        self.dropped = before["type"] == "Sequence" and before["pretokenizers"][0].get("invert") and normal == ["NFC", "Replace", "Lowercase"]
        # A token of its own ends the text before it, which no cut at white space shows.
        self.own = [t["content"] for t in made["added_tokens"]]
        self.letters = byte_letters()
        self.blank = chr(self.letters[32])
        self.pieces: dict[str, bytes] = {}
        self.tokenize = self.tokenizer.model.tokenize

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
            self.pieces.clear()
        ids = self[word] = self.word(word)
        return ids

    def word(self, word: str) -> bytes:
        lead = ""
        if self.spaced:
            # A word stands for itself with a blank before it; NUL marks one without.
            if word[:1] == "\x00":
                word = word[1:]
            elif word != "\n":
                lead = " "
        stem = word.rstrip(_MARKS)
        if stem.isascii() and stem.isalpha():
            # Printable ASCII is shown as it is.
            marks = word[len(stem) :]
            stem = stem.lower() if self.dropped else stem
            ids = self.model(self.blank + stem if lead else stem)
            return ids + self.piece(marks) if marks else ids
        plain = _PLAIN.fullmatch(word)
        if not plain or not word:
            return self.whole(lead + word)
        letters, marks = plain.groups()
        if self.dropped:
            letters = letters.lower()
        if not letters:
            return self.piece(lead + marks)
        return self.piece(lead + letters) + (self.piece(marks) if marks else b"")

    def piece(self, piece: str) -> bytes:
        if piece not in self.pieces:
            self.pieces[piece] = self.model(piece.encode().decode("latin-1").translate(self.letters))
        return self.pieces[piece]

    def model(self, shown: str) -> bytes:
        return array.array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not (self.spaced or self.dropped) or _ODD.search(text) or any(t in text for t in self.own):
            return self.whole(text)
        if self.dropped:
            words = text.split()
        elif any(t in text for t in _NOT_SINGLE_ASCII) if text.isascii() else _NOT_SINGLE.search(text):
            words = [p[1:] if p[0] == " " and p[1:2].strip() else "\x00" + p for p in _PIECE.findall(text)]
        else:
            words = ("\x00" + text.replace("\n", " \n \x00")).split(" ")
        return b"".join(map(self.__getitem__, words))


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """A tokenizer's file, read once and sent to the executors (a few MB)."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def words_of(source: Broadcast) -> Words:
    """The worker's memory of words for this tokenizer."""
    kept = worker_store("tokenizers")
    if source.value not in kept:
        kept[source.value] = Words(source.value)
    return kept[source.value]
