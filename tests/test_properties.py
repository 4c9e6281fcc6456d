"""Random inputs against plain Python statements of the rules."""

from __future__ import annotations

import math
import random
from collections import Counter
from decimal import Decimal, InvalidOperation

from pyspark.sql import types as T

from lakeload.contracts import TableContract, column
from lakeload.operators import quality, versioned
from lakeload.operators.conform import conform

PIECES = ["", "-", "+", "0", "7", "42", "999", ".", ".5", "e2", "E-1", " ", "x", "NaN", "inf", "18446744073709551615"]


def random_texts(n, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 3))) for _ in range(n)]
    return sorted(set(texts)) + [None]


def number(text):
    """The finite number a text states, None if it states none."""
    try:
        value = Decimal(text.strip())
    except (InvalidOperation, AttributeError):
        return None
    return value if value.is_finite() else None


def frame(spark, texts):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.StringType())])
    return spark.createDataFrame([(t, t) for t in texts], schema)


def contract(declared):
    fields = [column("id", "String"), column("x", declared)]
    return TableContract("t", T.StructType(fields), "id", None, None, None, None)


def test_integer_and_float_coercion(spark):
    texts = random_texts(400, 1)
    df = frame(spark, texts)
    whole = {r["id"]: r["x"] for r in conform(df, contract("Int64")).collect()}
    real = {r["id"]: r["x"] for r in conform(df, contract("Float64")).collect()}
    assert len(whole) == len(texts) - 1  # NULL and '' both become ''
    for t in texts[:-1]:
        value = number(t)
        cut = 0 if value is None else math.trunc(value)
        assert whole[t] == (cut if -(2**63) <= cut < 2**63 else 0), t
        expected = 0.0 if value is None or math.isinf(float(value)) else float(value)
        assert math.isclose(real[t], round(expected, 6), rel_tol=1e-12, abs_tol=1e-6), t


def test_accepted_and_rejected_are_the_input(spark):
    texts = random_texts(400, 2)
    df = frame(spark, texts)
    key = TableContract("t", T.StructType([column("x", "UInt64"), column("id", "String")]), "x", None, None, None, None)
    accepted, rejected = quality.split_rejects(df, key)
    taken, refused = [r["x"] for r in accepted.collect()], [r["x"] for r in rejected.collect()]
    assert Counter(taken + refused) == Counter(texts)
    for t in taken:
        assert 0 <= int(t) < 2**63
    for t in refused:
        try:
            assert t is None or not 0 <= int(t) < 2**63
        except ValueError:
            pass


def test_upsert_and_latest_against_dictionaries(spark):
    rng = random.Random(3)
    for _ in range(3):
        old = {k: (k, rng.choice([None, *range(5)]), f"old{k}") for k in range(0, 40)}
        batch = [(rng.randrange(60), rng.choice([None, *range(8)]), f"new{i}") for i in range(120)]
        schema = "k long, ts long, x string"
        old_df, new_df = spark.createDataFrame(list(old.values()), schema), spark.createDataFrame(batch, schema)
        order = lambda ts: -1 if ts is None else ts

        best = {}
        for k, ts, _x in batch:
            best[k] = max(best.get(k, -1), order(ts))
        got = {r["k"]: (r["ts"], r["x"]) for r in versioned.upsert(old_df, new_df, ["k"], "ts").collect()}
        assert set(got) == set(old) | set(best)
        for k, (ts, x) in got.items():
            if k in old and best.get(k, -2) <= order(old[k][1]):
                assert (ts, x) == old[k][1:]
            else:
                assert order(ts) == best[k] and (k, ts, x) in batch
        latest = versioned.latest_version(new_df, ["k"], ["ts"]).collect()
        assert {r["k"]: order(r["ts"]) for r in latest} == best
