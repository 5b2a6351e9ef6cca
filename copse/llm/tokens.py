"""Token counts by the whole-token shortcut.

Before the scan, every vocabulary string that can stand alone is encoded by
the tokenizer library itself; those that come back as one token are proven
whole tokens. A text is cut into pre-tokens; a proven one counts as one
without merging, and only the others are merged, by the library, with a
bounded cache. A text with a character for which the cut below is not known
to be the library's own, or with a special token's string, goes to the
library whole.

Everything is row-local: no shuffle, and a task holds one Arrow batch. The
closure carries the tokenizer's definition, whose size does not depend on
the data.

Defined cases: a null text is the empty text (0 bytes, 0 tokens); null and
repeated ids are passed through; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

#: Merged pre-tokens that a task remembers before it starts anew.
CACHE_ENTRIES = 200_000

#: Fixed value: the pre-token rule of word_bpe_49k.json in Python's syntax.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+"
#: Printable ASCII, blanks, and Latin letters to U+017F but the dotted
#: capital I: composed already, lower case of one character, and the same
#: classes in Python and in the library.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-įı-ſ]*")
WORD_END = "</w>"


def byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others, in order, for the characters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def proven_whole_tokens(library: Tokenizer) -> dict[str, int]:
    """Strings that the library encodes, alone, as exactly one token."""
    symbols = byte_symbols()
    alone = []
    for entry in library.get_vocab(with_added_tokens=False):
        if entry.endswith(WORD_END):
            raw = bytes(symbols[c] for c in entry.removesuffix(WORD_END))
            alone.append(raw.decode("utf-8", "ignore"))
    alone = sorted({w for w in alone if w and PLAIN.fullmatch(w) and w == w.lower()})
    cut = re.compile(CUT).fullmatch
    encoded = library.encode_batch(alone, add_special_tokens=False)
    return {w: 1 for w, e in zip(alone, encoded) if len(e.ids) == 1 and cut(w)}


class PreTokens(dict):
    """Token count by pre-token; unknown ones are merged by the library."""

    def __init__(self, library: Tokenizer, whole: dict[str, int]):
        super().__init__(whole)
        self.library, self.whole = library, whole

    def __missing__(self, word: str) -> int:
        if len(self) > len(self.whole) + CACHE_ENTRIES:
            self.clear()
            self.update(self.whole)
        n = self[word] = len(self.library.encode(word, add_special_tokens=False).ids)
        return n


class Counter:
    def __init__(self, definition: str, whole: dict[str, int]):
        self.library = load(definition)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known = PreTokens(self.library, whole)
        self.cut = re.compile(CUT).findall

    def count(self, text: str) -> int:
        if not PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        return sum(map(self.known.__getitem__, self.cut(text.lower())))


def load(definition: str) -> Tokenizer:
    library = Tokenizer.from_str(definition)
    library.no_truncation()
    library.no_padding()
    return library


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer_path`` is read on the driver only.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    whole = proven_whole_tokens(load(definition))
    thin = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((definition, whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for b in batches:
            size, n = [], []
            for x in b.column(1):
                t = x.as_py() or ""
                size.append(len(t.encode()))
                n.append(counter.count(t))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([k > limit for k in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = thin.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
