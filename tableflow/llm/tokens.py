"""Token ids by the tokenizers library, with the ids of recurring words kept in each worker.

A single space between two visible characters always begins a new pre-token of a byte-level
tokenizer, so texts are cut there and the parts' ids are joined. A part is encoded by the
library's own pre-tokenizer and model when it is first met.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterable

from tokenizers import Tokenizer

#: Bytes of results that a worker keeps in each of two generations, so that its memory is bounded;
#: and what a result costs beside its key's characters and its ids.
KEPT_BYTES = 72 << 20
ENTRY_COST = 150
#: Longer texts recur too seldom to take others' room.
LONGEST_KEPT = 16
#: Marks that end words, and what a part without a space before it begins with.
MARKS = ".,"
BARE = "\1"
ENDS = {*MARKS, ".\n"}


def byte_characters() -> list[str]:
    """A visible character for each byte: itself where it is one, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found, more = [], 0x100
    for byte in range(256):
        if byte in shown:
            found.append(chr(byte))
        else:
            found.append(chr(more))
            more += 1
    return found


_SHOWN = dict(enumerate(byte_characters()))
SPACE = _SHOWN[32]


def visible(text: str) -> str:
    """The text's bytes as the characters that stand for them in byte-level vocabularies."""
    return text.encode().decode("latin-1").translate(_SHOWN)


class Kept(dict):
    """Results by text. A full generation becomes the old one; what is used again is kept."""

    def __init__(self, compute):
        self.compute, self.old, self.room = compute, {}, KEPT_BYTES

    def __missing__(self, text: str) -> bytes:
        found = self.old.get(text)
        if found is None:
            found = self.compute(text)
            if len(text) > LONGEST_KEPT:
                return found
        self.room -= ENTRY_COST + len(text) + len(found)
        if self.room < 0:
            self.old = dict(self)
            self.clear()
            self.room = KEPT_BYTES
        self[text] = found
        return found


class _Irregular(Exception):
    """A part that can't be told apart from its neighbours."""


class ByParts:
    """Ids of whole texts, joined from the ids of their parts.

    A part is kept under its text without the space before it. With ``letters``, which encodes a
    run of letters, commas and periods at the ends of words are made parts of their own, so that a
    word is kept once: ``BARE`` before a part tells that no space goes before it.
    """

    def __init__(self, encode, letters=None):
        self.encode, self.letters = encode, letters
        self.parts = Kept(self.part_ids)

    def ids(self, text: str) -> bytes:
        for cut in (self.marked(text), text):
            if cut is not None:
                first, *rest = cut.split(" ")
                if not first[-1:].isspace() and (first or not rest):
                    try:
                        return self.encode(first) + b"".join(map(self.parts.__getitem__, rest))
                    except _Irregular:
                        pass
        return b"".join(map(self.run_ids, regular_runs(text)))

    def marked(self, text: str) -> str | None:
        """The text with a space before each comma or period that ends a word.

        None if not all of them follow a letter or digit, after which they are pre-tokens.
        """
        if self.letters is None or BARE in text:
            return None
        found = text + " "  # a mark may end the text
        for mark in MARKS:
            found = found.replace(mark + " ", f" {BARE}{mark} ")
        found = found.replace(".\n", f" {BARE}.\n {BARE}")[:-1]
        before = found.split(" " + BARE)[:-1]
        return found if all([one[-1:].isalnum() or one == ".\n" for one in before]) else None

    def part_ids(self, part: str) -> bytes:
        if self.letters is not None:
            if part.isalpha():  # one pre-token, with the space
                return self.letters(" " + part)
            if part[:1] == BARE:
                word = part[1:]
                if word in ENDS or word[:1].isalnum() and not word[-1].isspace():
                    return self.letters(word) if word.isalpha() else self.encode(word)
                raise _Irregular
        if not part or part[0].isspace() or part[-1].isspace():
            raise _Irregular
        return self.encode(" " + part)

    def run_ids(self, run: str) -> bytes:
        part = run[1:]
        if run[0] == " " and part and not part[0].isspace() and not part[-1].isspace():
            return self.parts[part]
        return self.encode(run)


class Encoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` would.

    With ``added`` the strings of added tokens in a text get those tokens' ids, as they do in an
    unchanged tokenizer; texts that hold one are left to the library. Without it they are
    ordinary text (the library's ``encode_special_tokens``).
    """

    def __init__(self, path: str, added: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.tokenize = self.tokenizer.model.tokenize
        self.vocabulary = self.tokenizer.get_vocab_size()
        split = repr(self.tokenizer.pre_tokenizer)
        by_words = self.tokenizer.normalizer is None and split.startswith("ByteLevel(") \
            and "add_prefix_space=False" in split and "use_regex=True" in split
        self.ids = self.joined_ids = self.whole_ids
        if by_words:
            self.ids = self.joined_ids = ByParts(self.split_ids, self.word_ids).ids
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        if added and by_words:
            self.ids = self.ids_with_added

    def ids_with_added(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self.whole_ids(text)
        return self.joined_ids(text)

    def whole_ids(self, text: str) -> bytes:
        return packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def piece_ids(self, piece: str) -> bytes:
        return packed_ids([token.id for token in self.tokenize(piece)])

    def word_ids(self, word: str) -> bytes:
        if word.isascii():  # letters, after a space perhaps
            return self.piece_ids(word.replace(" ", SPACE))
        return self.piece_ids(visible(word))

    def split_ids(self, text: str) -> bytes:
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return b"".join([self.piece_ids(piece) for piece, _ in split])


def packed_ids(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def regular_runs(text: str) -> list[str]:
    """The text cut before each space that stands between two visible characters."""
    runs, start, at = [], 0, text.find(" ", 1)
    while at >= 0:
        if at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
            runs.append(text[start:at])
            start = at
        at = text.find(" ", at + 1)
    if start < len(text):
        runs.append(text[start:])
    return runs


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker for a tokenizer file, added tokens included."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, added=True)
    return _encoders[path]
