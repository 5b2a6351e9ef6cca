"""Byte-level BPE with a pair occurrence index.

Texts are cut into pre-tokens, which are numbered; merges happen once for each
distinct pre-token of a partition (until the numbering is full and starts
anew). All new pre-tokens of a block of texts are laid out as one linked
sequence of symbols, and every adjacent pair that has a rank is entered in an
index: rank -> all its positions. The active ranks are applied in ascending
order: the positions that still hold the pair are merged together, and the
pairs that this makes on both sides are appended to the lists of their
ranks. A pre-token's merges happen in the order of their ranks, left to
right within a rank, as in the definition of BPE, since pre-tokens do not
touch each other.

Everything is row-local: no shuffle, and a task holds a block of texts, its
tokens and a bounded numbering. The closure carries the tokenizer's
definition, whose size does not depend on the data.

Special tokens' strings inside a text are special tokens, none are added.

Defined cases: a null text is the empty text (no ids); null and repeated ids
of documents are passed through; an empty table gives an empty result;
other columns are not read. ``decode`` takes a null array as empty, refuses
ids outside the vocabulary (``ValueError``), and gives U+FFFD for bytes that
are no UTF-8.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from copse.llm import text as X
from copse.llm.tokens import PLAIN, byte_symbols

#: Pre-tokens that a task remembers before it starts anew.
CACHE_ENTRIES = 400_000
BLOCK_BYTES = 4 << 20

#: Fixed value: the pre-token rule of byte-level BPE, and the same for texts
#: of ``PLAIN`` characters, where Python's classes agree.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


class Vocabulary:
    """Symbols, merges and special tokens of a tokenizer definition."""

    def __init__(self, definition: str):
        d = json.loads(definition)
        cut, model = d["pre_tokenizer"], d["model"]
        if model["type"] != "BPE" or d["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] \
                or not cut.get("use_regex", True):
            raise ValueError("not a byte-level BPE without normalizer and prefix space")
        ids, symbols = model["vocab"], byte_symbols()
        added = {t["content"]: t["id"] for t in d["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in d["added_tokens"]):
            raise ValueError("special tokens that take their surroundings in are not supported")
        self.size = max([*ids.values(), *added.values()]) + 1
        self.special = added
        self.byte_id = np.zeros(256, np.int64)
        for c, b in symbols.items():
            self.byte_id[b] = ids[c]
        self.pieces: list[bytes | None] = [None] * self.size
        for token, i in ids.items():
            self.pieces[i] = bytes(symbols[c] for c in token)
        for token, i in added.items():
            self.pieces[i] = token.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        key = self.left * (self.size + 1) + self.right
        self.by_key = np.argsort(key, kind="stable")
        self.keys = key[self.by_key]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 without one."""
        key = a * (self.size + 1) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], -1)


def merge(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, concatenated, and the number of each word's."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    n = int(length.sum())
    symbol = np.empty(n + 1, np.int64)
    symbol[:n] = v.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    symbol[n] = v.size  # stands after each word's end; no pair has it
    after = np.arange(1, n + 2, dtype=np.int64)
    before = np.arange(-1, n, dtype=np.int64)
    last = np.cumsum(length)
    after[last[length > 0] - 1] = n
    before[(last - length)[length > 0]] = -1
    index: dict[int, list[np.ndarray]] = {}

    def enter(at: np.ndarray) -> list[int]:
        """Adds positions to the lists of their pairs' ranks; ranks that had none."""
        rank = v.ranks(symbol[at], symbol[after[at]])
        has = rank >= 0
        at, rank = at[has], rank[has]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        new = []
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
            if lo < hi:
                r = int(rank[lo])
                if r not in index:
                    index[r] = []
                    new.append(r)
                index[r].append(at[lo:hi])
        return new

    active = enter(np.flatnonzero(after[:n] < n))
    heapify(active)
    while active:
        r = heappop(active)
        lists = index.pop(r)
        a, b, made = v.left[r], v.right[r], v.made[r]
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
        if a == b and len(at) > 1:
            at = _alternate(at, after)
        if not len(at):
            continue
        gone = after[at]
        beyond = after[gone]
        symbol[at], symbol[gone] = made, -1
        after[at] = beyond
        inner = beyond < n
        before[beyond[inner]] = at[inner]
        ahead = before[at]
        for x in enter(np.unique(np.concatenate((ahead[ahead >= 0], at[inner])))):
            heappush(active, x)
    left = symbol[:n] >= 0
    word = np.repeat(np.arange(len(words)), length)
    return symbol[:n][left], np.bincount(word[left], minlength=len(words))


def _alternate(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions that follow each other directly, every second one."""
    starts = np.concatenate(([True], after[at[:-1]] != at[1:]))
    place = np.arange(len(at))
    return at[(place - np.maximum.accumulate(np.where(starts, place, 0))) % 2 == 0]


class Numbers(dict):
    """Numbers for pre-tokens, from 0 on; ``new`` are those not merged yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Encoder:
    def __init__(self, definition: str):
        self.vocabulary = Vocabulary(definition)
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.library = Tokenizer.from_str(definition).pre_tokenizer
        self.cut, self.plain_cut = regex.compile(CUT), re.compile(PLAIN_CUT)
        self._clear()

    def _clear(self) -> None:
        """Starts the numbering anew, special tokens first."""
        self.numbers = Numbers()
        for token in self.vocabulary.special:
            self.numbers["special", token] = len(self.numbers)
        self.ids = np.array(list(self.vocabulary.special.values()), np.int32)
        self.count = np.ones(len(self.ids), np.int64)
        self.start = np.arange(len(self.ids))

    def pre_tokens(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return self.plain_cut.findall(text)
        new = [c for c in set(text) if unicodedata.category(c) == "Cn"]
        if not new:
            return self.cut.findall(text)
        known = text.translate({ord(c): self._like(c) for c in new})
        return [text[m.start():m.end()] for m in self.cut.finditer(known)]

    @functools.cache
    def _like(self, c: str) -> str:
        """A character of the same class as ``c``, which is too new for Python's
        tables (Unicode versions differ): the library says which class."""
        for like in "a1":
            if len(self.library.pre_tokenize_str(like + c)) == 1:
                return like
        return "\x00"

    def _number(self, text: str) -> np.ndarray:
        number = self.numbers.__getitem__
        if self.special is None or not self.special.search(text):
            words = self.pre_tokens(text)
            return np.fromiter(map(number, words), np.int32, len(words))
        out, done = [], 0
        for m in self.special.finditer(text):
            out += [*map(number, self.pre_tokens(text[done:m.start()])), number(("special", m.group()))]
            done = m.end()
        return np.array([*out, *map(number, self.pre_tokens(text[done:]))], np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, concatenated, and the number of each text's."""
        if len(self.numbers) > CACHE_ENTRIES:
            self._clear()
        coded = [self._number(t) for t in texts]
        if self.numbers.new:
            ids, count = merge([w.encode() for w in self.numbers.new], self.vocabulary)
            self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(count) - count))
            self.ids, self.count = np.concatenate((self.ids, ids.astype(np.int32))), np.concatenate((self.count, count))
            self.numbers.new.clear()
        words = np.concatenate([np.empty(0, np.int32), *coded])
        count = self.count[words]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        ids = self.ids[np.repeat(self.start[words], count) + place]
        text = np.repeat(np.arange(len(texts)), [len(c) for c in coded])
        return ids, np.bincount(text, count, len(texts)).astype(np.int64)


def _definition(tokenizer_path: str) -> str:
    with open(tokenizer_path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, ids. ``tokenizer_path`` is read on the driver only."""
    thin = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(_definition(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for b in batches:
            raw = X.batch_bytes(b.column(1))
            for lo, hi in X.blocks(raw, BLOCK_BYTES):
                ids, count = encoder.encode([t.decode() for t in raw[lo:hi]])
                offsets = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists], ["doc_id", "ids"])

    return thin.mapInArrow(run, T.StructType([thin.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the text of its ids (special tokens
    included) in the new column ``text``."""
    if text in encoded.columns:
        raise ValueError(f"column {text} exists")
    at = encoded.columns.index(ids)
    shared = encoded.sparkSession.sparkContext.broadcast(_definition(tokenizer_path))
    schema = T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Vocabulary(shared.value).pieces
        for b in batches:
            texts = []
            for i in range(b.num_rows):
                own = (b.column(at)[i].values or pa.array([], pa.int32())).to_numpy(zero_copy_only=False).tolist()
                if own and not (0 <= min(own) and max(own) < len(pieces)):
                    raise ValueError("an id is outside the vocabulary")
                texts.append(b"".join(map(pieces.__getitem__, own)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], schema.names)

    return encoded.mapInArrow(run, schema)
