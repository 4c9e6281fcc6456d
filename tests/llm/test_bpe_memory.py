"""The encoder's tables: bounded in bytes, and right however often they start anew."""

from __future__ import annotations

import random
import tracemalloc

import public_tokenizers
from tokenizers import Tokenizer

from lakeload.llm import bpe_automaton
from lakeload.llm.bpe_automaton import Codec

PATH = public_tokenizers.path("word_bpe_49k.json")


def words(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choices("etaoinshrdlucmfwyp", k=rng.randint(6, 14))) for _ in range(count)]


def test_tables_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe_automaton, "_WORD_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(bpe_automaton, "_TABLE_BYTES", 6 << 20, raising=False)
    coder = Codec(PATH)
    text = " ".join(words(1, 12_000))
    tracemalloc.start()
    try:
        coder.written(text)
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert held < 10 << 20  # two generations of words and the table, and a quarter for what the estimates miss


def test_small_tables_give_the_same_ids(monkeypatch):
    library = Tokenizer.from_file(PATH)
    text = " ".join(words(7, 1500)) + " 't café 日本語 <|endoftext|> " + " ".join(words(7, 400)) + " " + "abcdefgh" * 300
    expected = library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe_automaton, "_WORD_BYTES", 5_000)
    for table in (0, 2_000, 50_000):  # anew at every step, within words, and now and then
        monkeypatch.setattr(bpe_automaton, "_TABLE_BYTES", table)
        coder = Codec(PATH)
        for _ in range(2):
            count, numbers, decoded = coder.written(text)
            assert [int(i) for i in numbers.split()] == expected and count == len(expected)
            assert decoded == library.decode(expected, skip_special_tokens=False)
        assert coder._words.held <= 5_000 + 1_000 and coder.automaton.held <= table + 2_000
