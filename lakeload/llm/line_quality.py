"""Line-first cleaning: rules judge single lines, and a text that loses too much of itself goes.

A line with words fails if it
- is navigation: separators, bars or other markup symbols make up a large share
  of its words, or it is many very short entries;
- shouts: nearly all of its letters are capitals, over several words;
- is boilerplate: it holds a phrase of site furniture and is short;
- lacks punctuation: it is long for a heading and doesn't end like a sentence;
- repeats an earlier line of the text.

Failed lines are taken out. A text is rejected if its failed lines hold more
than a set share of its characters. Word counts and repeats of word triples
are judged beforehand on the whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeload.llm.common import give_back, column, no_cycle_search

_SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
_FURNITURE = re.compile(
    r"(?i)\b(?:cookie|privacy policy|terms of (?:use|service)|all rights reserved|sign (?:in|up)|log ?in|subscribe"
    r"|newsletter|click here|read more|share (?:this|on)|skip to|javascript|back to top|lorem ipsum|follow us)\b"
)
# fixed values: what ends a sentence, in Indic, Arabic, Ethiopic, Armenian, Burmese, Khmer and Tibetan scripts too
_CLOSING = tuple(".!?:;\"'”’»…)]}。！？।॥؟۔؛።፧፨։။។༎")


def _count(text: str, symbols: str) -> int:
    return sum(map(text.count, symbols))


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules."""

    min_words: int = 50
    max_repeated_percent: int = 50
    max_symbols_per_word: float = 0.2
    max_capital_share: float = 0.8
    shouted_words: int = 5
    max_furniture_words: int = 25
    heading_words: int = 12
    max_lost_share: float = 0.5

    def line_fails(self, line: str, words: list[bytes]) -> str | None:
        """The rule a line with words fails, if any."""
        symbols = _count(line, _SYMBOLS)
        if symbols > self.max_symbols_per_word * len(words) and symbols > 2:
            return "navigation"
        if len(words) >= self.shouted_words:
            letters = sum(map(str.isalpha, line))
            if sum(map(str.isupper, line)) > self.max_capital_share * letters:
                return "capitals"
        if len(words) <= self.max_furniture_words and _FURNITURE.search(line):
            return "boilerplate"
        if len(words) > self.heading_words and not line.rstrip().endswith(_CLOSING):
            return "punctuation"
        return None


def _repeated_words(words: list[bytes]) -> int:
    """Words inside triples that are found twice or more."""
    triples = list(zip(words, words[1:], words[2:]))
    if len(set(triples)) == len(triples):
        return 0
    counts = Counter(triples)
    again = np.array([counts[t] > 1 for t in triples])
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def judge(text: str | None, rules: LineRules) -> dict:
    """Counts, verdicts and the text without its failed lines."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines, seen, kept = text.split("\n"), set(), []
    duplicates, lost, total = 0, 0, 0
    for line in lines:
        own = line.encode("utf-8", "surrogatepass").split()
        if not own:
            kept.append(line)
            continue
        total += len(line)
        if line in seen:
            duplicates += 1
            lost += len(line)
            continue
        seen.add(line)
        if rules.line_fails(line, own):
            lost += len(line)
        else:
            kept.append(line)
    repeated = _repeated_words(words)
    failed = len(words) < rules.min_words or 100 * repeated > rules.max_repeated_percent * len(words)
    return {
        "n_words": len(words),
        "word_chars": len(text) - _count(text, _SPACE),
        "n_symbols": _count(text, _SYMBOLS),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated,
        "base_failed": failed,
        "kept": not failed and lost <= rules.max_lost_share * total,
        "lost_share": lost / total if total else 0.0,
        "cleaned": "\n".join(kept),
    }


_FIELDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean", "lost_share": "double", "cleaned": "string"}
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules = LineRules(), with_text: bool = True) -> DataFrame:
    """Per row: its id, the base counts, ``base_failed``, ``kept``, ``lost_share`` and the ``cleaned`` text.

    Null and empty texts have no words and fail. Rows are independent.
    """
    fields = {k: v for k, v in _FIELDS.items() if with_text or k != "cleaned"}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with no_cycle_search():
                found = [judge(t, rules) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *(pa.array([f[k] for f in found], _ARROW[v]) for k, v in fields.items())], names=["id", *fields]
            )
        give_back()


    plain = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text"))
    return plain.mapInArrow(rows, "id long, " + ", ".join(f"{k} {v}" for k, v in fields.items())).withColumnRenamed("id", id_col)
