"""Language identification by a string kernel.

Two texts are compared by the character strings of one to four code points that
occur in both (blended spectrum, presence only), divided by the geometric mean
of their own numbers of such strings. A bounded sample of the learnable texts
serves as landmarks; Nyström features map the kernel with them to vectors, and
one ridge regression per language separates it from the rest. Everything after
the presence of strings is linear, so the landmarks, the Nyström map and the
regression weights fold into one matrix, and a batch of texts is scored by the
product of its sparse presence matrix with it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from lakeload.llm.common import give_back, column, text_crc

UNDETERMINED = "und"
_LONGEST = 4
_BLOCK = 64
_LETTER = regex.compile(r"\p{L}")


def strings_of(text: str) -> np.ndarray:
    """The distinct strings of one to four code points of a lower-case text, as sorted hashes."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    multiplier, parts, h = np.uint64(0x9E3779B97F4A7C15), [], None
    for size in range(1, _LONGEST + 1):
        if len(points) < size:
            break
        h = points.copy() if h is None else h[:-1] * multiplier + points[size - 1 :]
        parts.append(_distinct(h * np.uint64(0xD6E8FEB86659FD93) + np.uint64(size)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def _places(known: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Where the strings of a text that are known stand among all known ones."""
    if not len(known):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return at[known[at] == own]


@dataclass(frozen=True)
class KernelModel:
    """Folded weights: one row per known string, one column per language."""

    languages: tuple[str, ...]
    strings: np.ndarray
    weights: np.ndarray
    constant: np.ndarray

    def values(self, texts: list[str]) -> np.ndarray:
        """The regressions' values, a row per text."""
        out = np.zeros((len(texts), len(self.languages)), np.float64)
        for i, text in enumerate(texts):
            own = strings_of(text)
            # a row of the sparse product: the weights of the strings present
            at = _places(self.strings, own)
            out[i] = self.weights[at].sum(axis=0, dtype=np.float64) / np.sqrt(max(len(own), 1))
        return out + self.constant

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score; ``und`` and 0 for null texts, texts without a letter, or if nothing was learned."""
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if known:
            values = self.values([texts[i] for i in known])
            best = values.argmax(axis=1)  # the first of equal languages in their order
            for i, row, b in zip(known, values, best):
                names[i], scores[i] = self.languages[b], float(np.clip(row[b], 0, 1))
        return names, scores


def fit(strings: list[np.ndarray], languages: list[str], landmarks: int = 240, ridge: float = 1e-3) -> KernelModel:
    """Learn from the strings of texts; landmarks are the first texts of each language in turn, two of each at least."""
    names = tuple(sorted(set(languages)))
    if not names:
        return KernelModel((), np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), np.zeros(0))
    by_name = {n: [i for i, x in enumerate(languages) if x == n and len(strings[i])] for n in names}
    turns = [i for group in zip(*(by_name[n] + [None] * (max(map(len, by_name.values())) - len(by_name[n])) for n in names)) for i in group if i is not None]
    marks = turns[: max(landmarks, 2 * len(names))]
    if not marks:
        return KernelModel((), np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), np.zeros(0))
    known = _distinct(np.concatenate([strings[i] for i in marks]))
    held = np.zeros((len(known), len(marks)), np.float32)
    for j, i in enumerate(marks):
        held[np.searchsorted(known, strings[i]), j] = 1 / np.sqrt(len(strings[i]))
    kernel = np.empty((len(strings), len(marks)))
    for start in range(0, len(strings), _BLOCK):
        block = strings[start : start + _BLOCK]
        presence = np.zeros((len(block), len(known)), np.float32)
        for i, own in enumerate(block):
            presence[i, _places(known, own)] = 1 / np.sqrt(max(len(own), 1))
        kernel[start : start + len(block)] = presence @ held
    among = kernel[marks]
    value, vector = np.linalg.eigh((among + among.T) / 2)
    use = value > 1e-6 * value.max()
    nystroem = vector[:, use] / np.sqrt(value[use])
    features = kernel @ nystroem
    wanted = np.array([[float(x == n) for n in names] for x in languages])
    middle, share = features.mean(axis=0), wanted.mean(axis=0)
    centred = features - middle
    w = np.linalg.solve(centred.T @ centred + ridge * len(strings) * np.eye(centred.shape[1]), centred.T @ (wanted - share))
    return KernelModel(names, known, (held @ (nystroem @ w)).astype(np.float32), share - middle @ w)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_out: int = 1, sample: int = 1600, longest: int = 200_000) -> KernelModel:
    """Fit on a bounded sample of whole texts with a language outside the held-out fold, of every language alike.

    Up to ``sample`` divided by the number of languages, four at least, are taken
    of each language, those least by a hash of the id. Texts above ``longest``
    bytes are chosen only for languages that have too few others, and then whole.
    Tasks send the strings of the chosen texts, not the texts. The documents are
    read twice, however many languages there are, and a third time only where ids
    repeat so much that too few rows lie below a bound of the hash.
    """
    fold = text_crc(id_col) % folds
    able = docs.where(column(lang_col).isNotNull() & column(text_col).isNotNull() & column(id_col).isNotNull() & (fold != held_out))
    able = able.select(column(id_col).cast("long").alias("id"), column(lang_col).cast("string").alias("lang"), column(text_col).cast("string").alias("text"))
    able = able.withColumn("long", F.octet_length("text") > longest)
    counts = able.groupBy("lang").agg(F.sum(F.when(F.col("long"), 0).otherwise(1)).alias("n")).collect()
    each = max(4, sample // max(len(counts), 1))
    spark = docs.sparkSession
    # few rows pass the bound, so that what is shuffled does not grow with the number of tasks
    bounds = [(name, int(2**64 * 4 * each / n) - 2**63 if n > 4 * each else 2**63 - 1) for name, n in counts]

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [strings_of(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["nth"], batch["long"], pa.array(held, pa.binary())], names=["lang", "nth", "long", "strings"])
        give_back()

    def chosen(bounds: list[tuple[str, int]]) -> list:
        near = able.join(spark.createDataFrame(bounds, "lang string, bound long"), "lang").where(F.xxhash64("id") <= F.col("bound"))
        order = Window.partitionBy("lang").orderBy("long", F.xxhash64("id"), "id", "text")
        some = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each)
        return some.select("lang", "nth", "long", "text").mapInArrow(presence, "lang string, nth int, long boolean, strings binary").collect()

    rows = chosen(bounds)
    found = Counter(r["lang"] for r in rows if not r["long"])
    few = {name for name, n in counts if found[name] < min(each, n)}
    if few:
        rows = [r for r in rows if r["lang"] not in few] + chosen([(name, 2**63 - 1) for name in sorted(few)])
    rows.sort(key=lambda r: (r["lang"], r["nth"]))
    return fit([np.frombuffer(r["strings"], np.uint64) for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: KernelModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred`` and ``score`` of the whole text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the landmarks' strings

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            names, scores = learned.predict(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])
        give_back()


    plain = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text"))
    return plain.mapInArrow(rows, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)
