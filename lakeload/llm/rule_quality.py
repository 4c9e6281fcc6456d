"""Quality scores from a sparse ensemble of rules on text statistics.

Shallow regression trees are boosted on a bounded sample of labelled texts.
Every path of a tree that ends in a node is a rule: a conjunction of limits on
statistics. A logistic model with an L1 penalty weighs rules and statistics and
drops most; the rest compile into one Spark column expression, which scores
all texts inside the JVM from their statistics. The statistics are counted over
whole texts in Arrow batches.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeload.llm.common import give_back, column, no_cycle_search, text_crc

STATISTICS = (
    "log_words", "chars_per_word", "repeated_triples", "repeated_next", "top_word_share", "symbol_share", "bar_share",
    "exclaim_share", "capital_share", "digit_share", "stop_share", "comma_share", "words_per_line", "distinct_lines",
)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[np.frombuffer(b"#*$%&<>@^~_=+{}[]\\/", np.uint8)] = True


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one text; all zero where there are no words."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, number = len(text), len(words)
    distinct = len(set(words))
    again = sum(map(operator.eq, words, words[1:]))
    most = counts_of_most(words, distinct)
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    return [
        float(np.log(number)),
        size / number,
        1 - len(set(zip(words, words[1:], words[2:]))) / max(number - 2, 1) if number > 2 else 0.0,
        again / number,
        most / number,
        float(counts[_SYMBOLS].sum()) / number,
        float(counts[ord("|")]) / number,
        float(counts[ord("!")]) / number,
        upper / (upper + lower + 1),
        float(counts[48:58].sum()) / size,
        float(counts[ord(".")]) / number,
        float(counts[ord(",")]) / number,
        number / max(len(lines), 1),
        len(set(lines)) / max(len(lines), 1),
    ]


def counts_of_most(words: list[bytes], distinct: int) -> int:
    """How often the most frequent word occurs."""
    if distinct == len(words):
        return 1
    found: dict[bytes, int] = {}
    for word in words:
        found[word] = found.get(word, 0) + 1
    return max(found.values())


_ROWS_AT_ONCE = 512


def with_statistics(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """(``id``, one double per statistic) and, if asked for, all columns of ``docs`` in a struct ``_row``.

    The text passes through the tasks once, whether it is carried or not.
    """
    fields = ["id long", *(f"{s} double" for s in STATISTICS)]
    names = ["id", *STATISTICS]
    plain = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("_text"))
    if carry:
        rest = F.struct(F.lit(0).alias("__none"), *[column(c) for c in docs.columns if c != text_col])
        plain = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("_text"), rest.alias("_rest"))
        fields += ["_text string", f"_rest {plain.schema['_rest'].dataType.simpleString()}"]
        names += ["_text", "_rest"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(start, _ROWS_AT_ONCE)
                with no_cycle_search():
                    found = np.array([statistics(t) for t in part["_text"].cast(pa.binary()).to_pylist()], np.float64).reshape(-1, len(STATISTICS))
                arrays = [part["id"], *(pa.array(found[:, i]) for i in range(len(STATISTICS)))]
                yield pa.RecordBatch.from_arrays(arrays + ([part["_text"], part["_rest"]] if carry else []), names=names)
        give_back()

    found = plain.mapInArrow(rows, ", ".join(fields))
    if not carry:
        return found
    whole = [F.col("_text").cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col("_rest").getField(c).alias(c) for c in docs.columns]
    return found.withColumn("_row", F.struct(*whole)).drop("_text", "_rest")


@dataclass(frozen=True)
class Rule:
    """Limits (statistic, is greater, value) that all hold, and the rule's weight."""

    limits: tuple[tuple[int, bool, float], ...]
    weight: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for i, greater, value in self.limits:
            out &= (x[:, i] > value) == greater
        return out


@dataclass(frozen=True)
class RuleModel:
    """A constant and weighted rules; their sum is the log odds of label 1."""

    constant: float
    rules: tuple[Rule, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.constant + sum((r.weight * r.holds(x) for r in self.rules), np.zeros(len(x)))
        return 1 / (1 + np.exp(-z))

    def expression(self) -> Column:
        """The score as a column over the statistics."""
        z = F.lit(self.constant)
        for rule in self.rules:
            held = None
            for i, greater, value in rule.limits:
                limit = F.col(STATISTICS[i]) > value if greater else F.col(STATISTICS[i]) <= value
                held = limit if held is None else held & limit
            z = z + F.when(held, F.lit(rule.weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-z))


def _tree_rules(x: np.ndarray, target: np.ndarray, depth: int, least: int) -> tuple[list[tuple], np.ndarray]:
    """The paths of a least-squares tree, one to every node but the root, and the tree's values at x."""
    rules, values = [], np.full(len(x), target.mean())

    def grow(rows: np.ndarray, path: tuple) -> None:
        values[rows] = target[rows].mean()
        if len(path) == depth or len(rows) < 2 * least or np.ptp(target[rows]) == 0:
            return
        best = (1e-12, None, None)
        y = target[rows] - target[rows].mean()
        for i in range(x.shape[1]):
            v = x[rows, i]
            order = np.argsort(v, kind="stable")
            ranked, sums = v[order], np.cumsum(y[order])
            n = np.arange(1, len(v))
            gain = sums[:-1] ** 2 * (1 / n + 1 / (len(v) - n))
            gain[(ranked[1:] == ranked[:-1]) | (n < least) | (len(v) - n < least)] = 0
            k = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (gain[k], i, (ranked[k] + ranked[k + 1]) / 2)
        _, i, value = best
        if i is None:
            return
        greater = x[rows, i] > value
        for side in (True, False):
            below = (*path, (i, side, float(value)))
            rules.append(below)
            grow(rows[greater == side], below)

    grow(np.arange(len(x)), ())
    return rules, values


def _lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Weights that minimise the mean logistic loss plus ``penalty`` times their absolute sum (accelerated proximal steps)."""
    n = len(y)
    base = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    constant, w = float(np.log(base / (1 - base))), np.zeros(a.shape[1])
    rate = 4 * n / (np.linalg.norm(np.column_stack([np.ones(n), a]), 2) ** 2 + 1e-9)
    old, old_c, t = w.copy(), constant, 1.0
    for _ in range(steps):
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_c = w + (t - 1) / t_next * (w - old), constant + (t - 1) / t_next * (constant - old_c)
        gap = 1 / (1 + np.exp(-np.clip(ahead_c + a @ ahead, -500, 500))) - y
        old, old_c, t = w, constant, t_next
        constant = ahead_c - rate * gap.mean()
        w = ahead - rate * (a.T @ gap) / n
        w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
    return constant, w


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, penalty: float = 3e-4) -> RuleModel:
    """Learn rules and their weights from statistics and labels (0 or 1).

    With labels of one kind only, or none, there are no rules: the score is the
    share of label 1, one half without labels.
    """
    if len(y) == 0:
        return RuleModel(0.0, ())
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    constant = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return RuleModel(constant, ())
    z, found = np.full(len(y), constant), {}
    least = max(5, len(y) // 500)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        paths, values = _tree_rules(x, (y - p) / max(float((p * (1 - p)).mean()), 0.02), depth, least)
        z = z + rate * np.clip(values, -4, 4)
        found.update(dict.fromkeys(paths))
    paths = list(found)
    # rules that hold for the same rows are one rule
    columns = {}
    for path in paths:
        held = Rule(path, 0.0).holds(x)
        columns.setdefault(held.tobytes(), (path, held))
    kept = list(columns.values())
    if not kept:
        return RuleModel(constant, ())
    constant, w = _lasso_logistic(np.column_stack([held for _, held in kept]).astype(np.float64), y.astype(np.float64), penalty)
    return RuleModel(float(constant), tuple(Rule(path, float(v)) for (path, _), v in zip(kept, w) if v))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held_out: int = 0, sample: int = 8000) -> RuleModel:
    """Fit on labelled rows outside the held-out fold, at most ``sample`` of them.

    The fold of a row is the CRC-32 of its id's text modulo ``folds``. If there
    are more labelled rows, those least by a hash of the id are taken, and of
    texts that share an id the one least by its hash, so the choice doesn't
    depend on their order.
    """
    known = labels.select(column(id_col).cast("long").alias("l_id"), column(label_col).cast("int").alias("l_label"))
    known = known.where("l_label IN (0, 1) AND l_id IS NOT NULL").where(F.crc32(F.col("l_id").cast("string").cast("binary")) % folds != held_out)
    known = known.orderBy(F.xxhash64("l_id"), "l_id", "l_label").limit(sample)
    # at most ``sample`` pairs of numbers
    chosen = docs.join(F.broadcast(known), column(id_col).cast("long") == F.col("l_id"))
    key = F.struct("l_id", "l_label", F.xxhash64(column(text_col)).alias("hash")).alias("key")
    rows = with_statistics(chosen.select(key, column(text_col).alias("text"), F.col("l_id")), "l_id", "text", carry=True)
    least = F.min(F.struct(F.col("_row.key.hash"), *STATISTICS)).alias("least")
    rows = rows.groupBy("id", F.col("_row.key.l_label").alias("label")).agg(least).select("least.*", "id", "label").toPandas()
    rows = rows.sort_values(["id", "label", *STATISTICS])
    return fit_rules(rows[list(STATISTICS)].to_numpy(np.float64), rows["label"].to_numpy(np.float64))


def score_documents(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, carry: bool = False) -> DataFrame:
    """Per row: id, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on); with ``carry`` also ``_row``.

    Null, empty and wordless texts have statistics of zero and are scored from
    those. Repeated rows stay.
    """
    found = with_statistics(docs, id_col, text_col, carry).withColumn("score", model.expression())
    columns = [F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted")]
    return found.select(*columns, *(["_row"] if carry else []))


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    return F.coalesce(text_crc(id_col) % folds == fold, F.lit(False))
