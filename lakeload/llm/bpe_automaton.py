"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton reads token sequences and accepts exactly those that applying
the merges in order produces. It starts as one state whose arcs, one for every
single symbol, lead back to it. Each merge (a, b) adds a gadget: the arcs a,
which all lead to one state, now lead to a copy of it that lacks the arc b, and
every state with the arc a gets an arc ab to where a b led. So every token has
one state its arcs lead to. That state is stored as what sets it apart: the arcs
it lost and the merges that took them, and before the token was made those that
the state of its right part had lost by then. An arc made later than such a
loss is there only if the arc of its left part is. The whole automaton is thus
one table of lost arcs.

Words are read symbol by symbol. At every position one token ends the only
accepted path there. What the rest of a word depends on is, for each earlier
position at which a label may still be growing, how far it has grown and the
state of the path to that position. These sets are the rows of a transition
table, which is filled in as words need them: (row, symbol) gives the token
that ends here and the next row. Encoding is one table step per symbol, then
the path is read back from the end. Table and whole words are kept per Python
worker, in bounded numbers of bytes. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from lakeload.llm.common import column, give_back, no_cycle_search

_WORD_BYTES = 16 << 20  # of the words met since the last change of generations, and of those before
_LONGEST_KEPT = 64
_TABLE_BYTES = 48 << 20
_ROWS_AT_ONCE = 256

# What an entry takes of memory, places in dictionaries and numbers included.
_WORD_COST = 55  # beside its two texts
_ROW_COST = 110  # beside its labels
_STEP_COST = 120


START = -1
_SYMBOL_BITS = 21
_LOW = (1 << 32) - 1


class Automaton:
    """The token automaton of a vocabulary and its merges in order."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], word_end: str = "") -> None:
        size = max(vocab.values()) + 1
        self._made = [-1] * size  # the merge that made a token
        self._left, self._right = [-1] * size, [-1] * size
        self._lost: dict[int, int] = {}  # state and arc: the merge that took the arc
        idle: set[int] = set()
        for number, (a, b) in enumerate(merges):
            first, second, both = vocab[a], vocab[b], vocab[a + b]
            self._made[both], self._left[both], self._right[both] = number, first, second
            if first not in idle and second not in idle and self.has_arc(first, second):
                self._lost[first << 32 | second] = number
            else:
                idle.add(both)  # the merge finds nothing to merge: no state gets an arc
        # labels as a tree over symbols: child by node and symbol, the token inside a word and the token at its end
        self._child: dict[int, int] = {}
        self._inner, self._final = array("i", [-1]), array("i", [-1])
        for label, token in vocab.items():
            if token in idle:
                continue
            closes = bool(word_end) and label.endswith(word_end)
            node = 0
            for symbol in label[: len(label) - len(word_end)] if closes else label:
                arc = node << _SYMBOL_BITS | ord(symbol)
                below = self._child.get(arc)
                if below is None:
                    below = self._child[arc] = len(self._inner)
                    self._inner.append(-1)
                    self._final.append(-1)
                node = below
            if closes or not word_end:
                self._final[node] = token
            if not closes:
                self._inner[node] = token
        self._grows = bytearray(len(self._inner))  # whether a node has children
        for arc in self._child:
            self._grows[arc >> _SYMBOL_BITS] = 1
        self._made, self._left, self._right = (array("i", x) for x in (self._made, self._left, self._right))
        self._lengths = array("i", [0]) * size
        for label, token in vocab.items():
            self._lengths[token] = len(label) - (len(word_end) if word_end and label.endswith(word_end) else 0)
        self._forget()

    def _forget(self) -> None:
        """Start the transition table anew."""
        start = array("q", [START + 1]).tobytes()
        # Of a row, all (how far a label has grown, state of the path to where it began), packed.
        self._growing = [start]
        self._rows = {start: 0}
        self._steps: dict[int, int] = {}  # by row and symbol, the next row and the token that ends there
        self._ends: dict[int, int] = {}  # by row and symbol, the token that ends a word
        self.held = 0  # bytes, about

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state that a token's arcs lead to (START: where words begin) has an arc for a token."""
        made, left, right, lost = self._made, self._left, self._right, self._lost
        before = 1 << 62  # only losses before this merge count
        while state >= 0:
            arc, until = token, before
            while arc >= 0:
                taken = lost.get(state << 32 | arc)
                if taken is not None and taken < until:
                    return False
                # a loss up to the merge that made this arc concerns its left part
                until, arc = min(before, made[arc] + 1), left[arc]
            before, state = min(before, made[state]), right[state]
        return True

    def _ending(self, row: int, symbol: int, tokens: array) -> tuple[int, array]:
        """The token that ends the path with this symbol, and the labels that grow by the symbol."""
        grown, found = array("q"), -1
        for label in memoryview(self._growing[row]).cast("q"):
            below = self._child.get(label >> 32 << _SYMBOL_BITS | symbol)
            if below is None:
                continue
            state = label & _LOW
            if self._grows[below]:
                grown.append(below << 32 | state)
            token = tokens[below]
            if found < 0 and token >= 0 and self.has_arc(state - 1, token):
                found = token
        if found < 0:
            raise ValueError(f"no token ends with {chr(symbol)!r}")
        return found, grown

    def _step(self, row: int, symbol: int) -> int:
        token, grown = self._ending(row, symbol, self._inner)
        grown.append(token + 1)
        after = grown.tobytes()
        below = self._rows.get(after)
        if below is None:
            below = self._rows[after] = len(self._growing)
            self._growing.append(after)
            self.held += _ROW_COST + len(after)
        self.held += _STEP_COST
        found = self._steps[row << _SYMBOL_BITS | symbol] = below << 32 | token
        return found

    def encode(self, word: str) -> list[int]:
        """The tokens of one pre-split word."""
        if not word:
            return []
        known, row, path = self._steps.get, 0, []
        symbols = list(map(ord, word))
        final = symbols.pop()
        for symbol in symbols:
            found = known(row << _SYMBOL_BITS | symbol)
            if found is None:
                if self.held > _TABLE_BYTES:  # the row on hand goes on in the new table
                    row = self._renew(row)
                    known = self._steps.get
                found = self._step(row, symbol)
            path.append(found)
            row = found >> 32
        last = self._ends.get(row << _SYMBOL_BITS | final)
        if last is None:
            last = self._ends[row << _SYMBOL_BITS | final] = self._ending(row, final, self._final)[0]
            self.held += _STEP_COST
        lengths = self._lengths
        tokens, at = [last], len(word) - lengths[last]
        while at:
            token = path[at - 1] & _LOW
            tokens.append(token)
            at -= lengths[token]
        tokens.reverse()
        return tokens

    def _renew(self, row: int) -> int:
        """Start the table anew with the start and this row; the row's new number."""
        growing = self._growing[row]
        self._forget()
        if growing not in self._rows:
            self._rows[growing] = len(self._growing)
            self._growing.append(growing)
        return self._rows[growing]


# The steps of the tokenizer files that the quick word split stands for.
_QUICK_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_QUICK_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Scripts in which letters, digits and lower case are beyond doubt; others go through the library.
_UNUSUAL = regex.compile(r"[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")


# The same split for lower-case text of the first 256 code points.
_LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+").findall


def _byte_symbols() -> dict[int, str]:
    """The printable symbol a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Text to ids and back for a tokenizer file: its normalizer and word split, and the automaton."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        if model.get("type") != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-pair encodings are compiled")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str if library.normalizer else str
        self._split = library.pre_tokenizer.pre_tokenize_str
        steps = (described["pre_tokenizer"] or {}).get("pretokenizers") or [{}, {}]
        self._quick = (
            regex.compile(_QUICK_SPLIT).findall
            if described["normalizer"] == _QUICK_NORMALIZER
            and steps[0].get("pattern") == {"Regex": _QUICK_SPLIT}
            and steps[0].get("invert")
            and steps[1].get("type") == "ByteLevel"
            and not steps[1].get("add_prefix_space")
            else None
        )
        self._symbols = _byte_symbols()
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in described["added_tokens"]):
            raise ValueError("added tokens are only found literally")
        self._marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.labels = {i: label for label, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.numbers = {i: str(i) for i in self.labels}
        self._label_of = {self.numbers[i]: label for i, label in self.labels.items()}  # by the id as text
        self._words = _Words(self)

    def _parts(self, text: str) -> Iterator[str]:
        """The ids of a text's words, as text."""
        for part in self._marks.split(text) if self._marks else [text]:
            if part in self.special:
                yield self.numbers[self.special[part]]
            elif part:
                yield from map(self._words.__getitem__, self._pre_split(part))

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.written(text)[1].split()]

    def written(self, text: str) -> tuple[int, str, str]:
        """The number of a text's tokens, their ids as text and the decoded text."""
        numbers = " ".join(self._parts(text))
        ids = numbers.split()
        return len(ids), numbers, " ".join(map(self._label_of.__getitem__, ids))

    def _pre_split(self, text: str) -> list[str]:
        """The words of a normalized text, as they are; the library's byte symbols are left for later."""
        if self._quick is None:
            return self._split_by_library(text)
        if text.isascii():
            return _LATIN(text.lower())
        text = unicodedata.normalize("NFC", text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._split_by_library(text) if _UNUSUAL.search(text) else self._quick(text.lower())
        return _LATIN(text.lower())

    def _split_by_library(self, text: str) -> list[str]:
        back = {ord(s): b for b, s in self._symbols.items()}
        return [word.translate(back).encode("latin-1").decode() for word, _ in self._split(self._normalize(text))]

    def decode(self, ids: list[int]) -> str:
        """The arcs' labels one after another, as the library joins them where no decoder is set."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])


class _Words(dict):
    """The ids of words as text, filled in as they come up.

    Words not met since the change of generations before the last are forgotten.
    """

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self._codec = codec
        self._before: dict[str, str] = {}
        self.held = 0  # bytes of this generation, about

    def __missing__(self, word: str) -> str:
        found = self._before.get(word)
        if found is None:
            codec = self._codec
            symbols = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(codec._symbols)
            found = " ".join(map(codec.numbers.__getitem__, codec.automaton.encode(symbols)))
        if len(word) <= _LONGEST_KEPT:
            if self.held > _WORD_BYTES:
                self._before = self.copy()
                self.clear()
                self.held = 0
            self[word] = found
            self.held += _WORD_COST + getsizeof(word) + getsizeof(found)
        return found


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per tokenizer file and Python worker."""
    return Codec(path)


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row: its id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, unless ``with_ids`` is off, ``ids`` and ``decoded``.

    ``tokenizer`` is the path of a tokenizer file that every machine has. A null
    text is empty, and an empty text has no tokens. Rows are independent, so
    repeated ids stay repeated.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                    part = batch.slice(start, _ROWS_AT_ONCE)
                    with no_cycle_search():
                        found = [coder.written(text or "") for text in part["text"].to_pylist()]
                        out = {
                            "n_tokens": [count for count, _, _ in found],
                            "ids_sha256": [hashlib.sha256(numbers.encode()).hexdigest() for _, numbers, _ in found],
                            "decoded_sha256": [hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest() for _, _, decoded in found],
                        }
                        if with_ids:
                            out["ids"] = [np.array(numbers.split(), np.int32) for _, numbers, _ in found]
                            out["decoded"] = [decoded for _, _, decoded in found]
                    yield pa.RecordBatch.from_arrays([part["id"], *(pa.array(v, _TYPES[k]) for k, v in out.items())], names=["id", *out])
        finally:
            give_back()

    plain = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text"))
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    return plain.mapInArrow(rows, schema).withColumnRenamed("id", id_col)


_TYPES = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "ids": pa.list_(pa.int32()), "decoded": pa.string()}
