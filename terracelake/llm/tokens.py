"""Token ids of whole texts by the ``tokenizers`` library, with chunks encoded once.

The library spends most of its time on words it has just seen. Here a text is cut where
no token can reach across, and the ids of each piece are remembered. Every rule below
that skips the library is one that gives the library's ids; whatever the rules don't
cover goes to the library, as a chunk or as a whole text.
"""

from __future__ import annotations

import re
import string
import struct
from functools import lru_cache

from tokenizers import Tokenizer

# Entries remembered by one worker; both tables are emptied when they are full.
CHUNKS = 600_000
WORDS = 400_000
LONGEST = 64  # characters of a piece worth remembering

# Letters up to here are unchanged by NFC and have one lower-case form, whatever the
# version of Unicode.
PLAIN_LETTERS = "\u024f"

# Spaces other than blank, tab and line ends: texts that hold them go to the library whole.
RARE_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
RARE_ASCII = "\x0b\x0c\x1c\x1d\x1e\x1f"


def has_rare_space(text: str) -> bool:
    if text.isascii():
        return any(space in text for space in RARE_ASCII)
    return RARE_SPACE.search(text) is not None


def _byte_letters() -> dict[int, str]:
    """The library's stand-in letter for each byte: printable ones for themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Chunks(dict):
    """Chunk of text -> its packed ids. ``before`` stands before each chunk in the text."""

    def __init__(self, tokenizer: Tokenizer, lower: bool, before: str, chunks: int, words: int):
        super().__init__()
        self.tokenizer, self.lower, self.before = tokenizer, lower, before
        self.most, self.most_words = chunks, words
        self.model = tokenizer.model
        self.words: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        """Ids of letters only, which the library's splitting leaves in one piece."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= self.most_words:
                self.words.clear()
            letters = word.replace(" ", BYTE_LETTERS[32]) if word.isascii() else (
                word.encode().decode("latin-1").translate(BYTE_LETTERS))
            found = packed([t.id for t in self.model.tokenize(letters)])
            if len(word) <= LONGEST:
                self.words[word] = found
        return found

    def tail(self, tail: str) -> bytes:
        found = self.tails.get(tail)
        if found is None:
            if len(self.tails) >= self.most_words:
                self.tails = {"": b""}
            found = self.whole(tail)
            if len(tail) <= LONGEST:
                self.tails[tail] = found
        return found

    def encode(self, before: str, chunk: str) -> bytes:
        core = chunk.rstrip(string.punctuation)
        if not core.isalpha() or not (core.isascii() or max(core) <= PLAIN_LETTERS and core.lower().isalpha()):
            return self.whole(before + chunk)
        ids = self.word(core.lower() if self.lower else before + core)
        return ids if len(core) == len(chunk) else ids + self.tail(chunk[len(core):])

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        found = self.parts(self.before, chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = found
        return found

    def parts(self, before: str, chunk: str) -> bytes:
        if "\n" not in chunk:
            return self.encode(before, chunk)
        lines = chunk.split("\n")
        if any(not line or line[0].isspace() or line[-1].isspace() for line in lines):
            return self.whole(before + chunk)
        # A single line end between two visible characters is a piece of its own.
        return self.tail("\n").join([self.encode(before, lines[0]), *(self.encode("", x) for x in lines[1:])])


class WordIds:
    """For vocabularies that drop white space and case (``word_bpe_49k.json``)."""

    def __init__(self, path: str):
        # Without case and blanks there are fewer different chunks.
        self.chunks = Chunks(Tokenizer.from_file(path), True, "", CHUNKS // 2, WORDS // 2)

    def __call__(self, text: str) -> bytes:
        if has_rare_space(text):
            return self.chunks.whole(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


class ByteIds:
    """For byte-level vocabularies that keep all text (``byte_bpe_50k.json``).

    A text may be cut before a blank unless white space stands on both of its sides.
    """

    def __init__(self, path: str):
        self.chunks = Chunks(Tokenizer.from_file(path), False, " ", CHUNKS, WORDS)

    def __call__(self, text: str) -> bytes:
        first, *others = text.split(" ")
        if has_rare_space(text) or "" in others or " \n" in text or " \t" in text or " \r" in text:
            return self.chunks.whole(text)
        return self.chunks.parts("", first) + b"".join(map(self.chunks.__getitem__, others)) if text else b""


@lru_cache(maxsize=2)
def encoder(kind: type, path: str):
    """One encoder per worker process, kept between tasks."""
    return kind(path)
