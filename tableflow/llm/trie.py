"""BPE encoding of words by depth-first traversal of a trie that shares their prefixes.

The distinct words of a batch are put in a trie, with the last symbol of a word (which bears the
end-of-word mark) on an edge of its own. A prefix's encoding is known from its *last token* and
the encoding of what is before that token. The last token is the one token that ends there and
stands next to the last token of what is before it: two neighbours may stand next to each other if
BPE leaves just these two when it merges their symbols. So every node of the trie is given its
state once, from its ancestors' states, and words get their ids by going back from token to token.

The trie is held as the sorted words and how many symbols each shares with the one before it:
going through them in order is the depth-first traversal, and the states of the current path are
a stack. Words that were encoded before are remembered up to a bound of bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tableflow.llm.arrow import appended, slices, texts
from tableflow.llm.tokens import byte_characters, visible
from tableflow.scratch import ship_package

#: Text whose words are put in a trie together (a document at least).
SLICE_BYTES = 4 << 20
#: Bytes of remembered words and pairs of a worker, about.
KEPT_BYTES = 224 << 20
#: What a remembered word costs beside its characters: objects, pointers, the table's places.
WORD_COST, PAIR_COST = 400, 160

#: The normalisation and splitting that plain words are given here without the library (fixed).
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The words of ASCII text; what begins with a letter, digit, apostrophe or other sign is apart.
_WORDS = r"[A-Za-z]+|[0-9]|'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])|[^A-Za-z0-9 \t\n\r\f\v]+"
_ASCII_UNITS = re.compile(_WORDS).findall
#: What stands between white space, if it has characters beyond ASCII, or else its words.
_UNITS = re.compile(
    r"[^ \t\n\r\f\v]*[^\x00-\x7f][^ \t\n\r\f\v]*|" + _WORDS).findall


def units(text: str) -> list[str]:
    return _ASCII_UNITS(text) if text.isascii() else _UNITS(text)


class Merges:
    """The tokens and merges of a BPE model with an end-of-word mark."""

    def __init__(self, model: dict):
        vocabulary, mark = model["vocab"], model["end_of_word_suffix"] or ""
        if model.get("continuing_subword_prefix") or model.get("ignore_merges") or not mark:
            raise ValueError("the traversal needs a plain BPE model with an end-of-word mark")
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.names = {number: name for name, number in vocabulary.items()}
        made = set()
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merged[vocabulary[left], vocabulary[right]] = rank, vocabulary[left + right]
            made.add(left + right)
        ranks = {found: rank for rank, found in self.merged.values()}
        if len(ranks) != len(self.merged) or any(
                ranks.get(part, -1) >= rank for pair, (rank, _) in self.merged.items()
                for part in pair):
            raise ValueError("each merge has to make a token of its own from earlier ones")
        #: Tokens within words and at their ends by their characters, and single symbols.
        self.inner, self.final = {}, {}
        for name, number in vocabulary.items():
            symbols = name.removesuffix(mark)
            if name in made or len(symbols) == 1:
                (self.final if name.endswith(mark) and symbols else self.inner)[symbols] = number
        #: Beginnings of tokens: the token where one ends there (not at a word's end), else -1.
        self.begun = dict.fromkeys((name[:end] for name in [*self.inner, *self.final]
                                    for end in range(1, len(name))), -1) | self.inner
        if any(symbol not in self.inner or symbol not in self.final
               for symbol in byte_characters()):
            raise ValueError("the vocabulary lacks single bytes")
        self.parts = {found: pair for pair, (_, found) in self.merged.items()}
        self.neighbours: dict[tuple[int, int], bool] = {}
        self.reached: dict[int, bool] = {}

    def symbols(self, token: int) -> list[int]:
        """The single symbols that the token was made of."""
        pair = self.parts.get(token)
        return [token] if pair is None else self.symbols(pair[0]) + self.symbols(pair[1])

    def merge(self, ids: list[int]) -> list[int]:
        """What BPE leaves of the symbols: the earliest merge first, from left to right."""
        while True:
            found = [(self.merged[pair], at) for at, pair in enumerate(zip(ids, ids[1:]))
                     if pair in self.merged]
            if not found:
                return ids
            (_, made), at = min(found)
            ids = ids[:at] + [made] + ids[at + 2:]

    def stands(self, token: int) -> bool:
        """Whether the token's symbols alone are merged into it."""
        found = self.reached.get(token)
        if found is None:
            found = self.reached[token] = self.merge(self.symbols(token)) == [token]
        return found

    def beside(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart and whole when their symbols are merged."""
        found = self.stands(right) and \
            self.merge(self.symbols(left) + self.symbols(right)) == [left, right]
        if len(self.neighbours) * PAIR_COST >= KEPT_BYTES // 4:
            self.neighbours.clear()
        self.neighbours[left, right] = found
        return found

    def encoded(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each word (of visible characters, not empty) with its ids, in sorted order."""
        # of the first 0, 1, 2, ... symbols: the last token, its length, and where a token that
        # isn't over may begin
        path: list[tuple[int, int, list[int]]] = [(-1, 0, [])]
        before = ""
        for word in sorted(words):
            inner = len(word) - 1  # the last symbol has an edge of its own
            shared, most = 0, min(inner, len(path) - 1)
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del path[shared + 1:]
            for end in range(shared + 1, inner + 1):
                path.append(self.visit(word, end, path))
            token, length = self.ending(word, path)
            found, at = [token], inner + 1 - length
            while at:
                token, length, _ = path[at]
                found.append(token)
                at -= length
            yield word, found[::-1]
            before = word

    def visit(self, word: str, end: int, path: list) -> tuple[int, int, list[int]]:
        """The state of the node of the first ``end`` symbols, from its ancestors' states."""
        begun, neighbours = self.begun.get, self.neighbours.get
        open_at, last, length = [], -1, 0
        for start in (*path[-1][2], end - 1):  # the longest token first
            token = begun(word[start:end])
            if token is None:
                continue
            open_at.append(start)
            if token >= 0 and not length:
                beside = neighbours((path[start][0], token)) if start else self.stands(token)
                if beside is None:
                    beside = self.beside(path[start][0], token)
                if beside:
                    last, length = token, end - start
        return last, length, open_at

    def ending(self, word: str, path: list) -> tuple[int, int]:
        """The last token of the whole word and its length."""
        end = len(word)
        for start in (*path[-1][2], end - 1):
            token = self.final.get(word[start:])
            if token is not None and (self.beside_known(path[start][0], token) if start
                                      else self.stands(token)):
                return token, end - start
        raise AssertionError("a single symbol always stands")  # pragma: no cover

    def beside_known(self, left: int, right: int) -> bool:
        found = self.neighbours.get((left, right))
        return self.beside(left, right) if found is None else found


class Words:
    """Encodes whole texts as ``Tokenizer.encode(text, add_special_tokens=False)`` would.

    Normalisation and splitting never join what white space separates. What stands between it is
    split into its words here if it is ASCII, which makes the text's *units*; any other is a unit
    that the library's own normaliser and pre-tokeniser split. The words are encoded by the trie.
    Strings of added tokens in a text are those tokens.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.library = Tokenizer.from_file(path)
        split = described["pre_tokenizer"]
        self.plain = described["normalizer"] == NORMALIZER \
            and split["pretokenizers"][0]["pattern"] == {"Regex": SPLIT}
        added = described["added_tokens"]
        if not self.plain or any(one["normalized"] or one["lstrip"] or one["rstrip"]
                                 or one["single_word"] for one in added) \
                or described["decoder"] is not None or described["post_processor"] is not None:
            raise ValueError(f"{path}: another kind of tokenizer")
        self.merges = Merges(described["model"])
        self.names = {**self.merges.names, **{one["id"]: one["content"] for one in added}}
        self.added = {one["content"]: one["id"] for one in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split \
            if added else lambda text: [text]
        self.known: dict[str, tuple[int, str, str]] = {}  # by unit
        self.held = 0

    def split(self, unit: str) -> list[str]:
        """The words of a unit of a text, as visible characters."""
        if unit.isascii():
            low = unit.lower()
            return [low if low.isprintable() else visible(low)]
        normal = self.library.normalizer.normalize_str(unit)
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def learn(self, units: set[str]) -> None:
        """Remember the ids of all these units."""
        if self.held >= KEPT_BYTES:  # what is not met again is forgotten
            self.known = {unit: self.known[unit] for unit in units if unit in self.known}
            self.held = sum(WORD_COST + 8 * len(unit) for unit in self.known)
        split = {unit: self.split(unit) for unit in units.difference(self.known)}
        ids = dict(self.merges.encoded({word for found in split.values() for word in found}))
        for unit, found in split.items():
            own = ids[found[0]] if len(found) == 1 else [n for word in found for n in ids[word]]
            self.known[unit] = (len(own), " ".join(map(str, own)),
                                " ".join(map(self.names.__getitem__, own)))
            self.held += WORD_COST + 8 * len(unit)

    def results(self, whole: list[str]) -> Iterator[list[tuple[int, str, str]]]:
        """For each text its units' number of ids, the ids in decimal, and the tokens' names."""
        cut = [[units(piece) if at % 2 == 0 else piece for at, piece in enumerate(self.cut(text))]
               for text in whole]
        self.learn(set().union(*[held for pieces in cut for held in pieces[::2]]))
        for pieces in cut:
            found = list(map(self.known.__getitem__, pieces[0]))
            for at in range(1, len(pieces), 2):
                found.append((1, str(self.added[pieces[at]]), pieces[at]))
                found += map(self.known.__getitem__, pieces[at + 1])
            yield found if all([one[0] for one in found]) else [one for one in found if one[0]]


_words: dict[str, Words] = {}


def words(path: str) -> Words:
    """The encoder of this worker for a tokenizer file."""
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``row`` (all columns of the documents) and ``ids`` (array of int).

    A null text has no ids, like an empty one; rows that repeat each have their own.
    """
    def ids(batch: pa.RecordBatch) -> list[pa.Array]:
        found = []
        for piece in _pieces(batch):
            found += [[int(number) for part in one for number in part[1].split()]
                      for one in words(path).results(piece)]
        return [pa.array(found, pa.list_(pa.int32()))]

    return _with(docs, text, "ids array<int>", ids)


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``row`` (all columns of the documents), the number and digest of the ids, and the digest of
    the text that they decode to: the tokens' names with one space between.

    A null text is empty: it has no ids and decodes to nothing. Every row stands for itself, and
    columns of the documents may have the results' names.
    """
    def found(batch: pa.RecordBatch) -> list[pa.Array]:
        counts, ids_sha, text_sha = [], [], []
        for piece in _pieces(batch):
            for parts in words(path).results(piece):
                numbers, decimals, names = zip(*parts) if parts else ((), (), ())
                counts.append(sum(numbers))
                ids_sha.append(_sha256(decimals))
                text_sha.append(_sha256(names))
        return [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                pa.array(text_sha, pa.string())]

    return _with(docs, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", found)


def _sha256(parts: Iterable[str]) -> str:
    return hashlib.sha256(" ".join(parts).encode()).hexdigest()


def _pieces(batch: pa.RecordBatch) -> Iterator[list[str]]:
    for piece in slices(batch, "text", SLICE_BYTES) if batch.num_rows else ():
        yield texts(piece.column("text"))


def _with(docs: DataFrame, text: str, fields: str, compute) -> DataFrame:
    ship_package(docs.sparkSession)
    row = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")
    return appended(docs.select(row, docs[f"`{text}`"].cast("string").alias("text")), fields,
                    compute, drop=("text",))
