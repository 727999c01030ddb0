import math
import random

import pytest
from pyspark.sql import functions as F

from strandline import runtime
from strandline.operators.key_quantiles import key_quantiles

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def expected(rows, probs):
    out = {}
    for k in {k for k, _ in rows}:
        vs = sorted(v for x, v in rows if x == k and v is not None and not (isinstance(v, float) and math.isnan(v)))
        for p in probs:
            out[k, p] = (sum(x == k for x, _ in rows), len(vs), vs[max(1, math.ceil(p * len(vs))) - 1] if vs else None)
    return out


def check(spark, rows, kind, bits=12):
    df = spark.createDataFrame(rows, f"contig string, v {kind}").withColumn("k", F.lit(1)).withColumn("lo", F.lit("x")).withColumn("prob", F.lit(7))
    got = {(r[0], r["prob"]): (r["n_rows"], r["n_values"], r["quantile"]) for r in key_quantiles(df, "contig", "v", PROBS, bits).collect()}
    assert got == expected(rows, PROBS)


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_integers_with_a_hot_key(spark, bits):
    rng = random.Random(bits)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), rng.choice([None, rng.randint(-3000, 3000), 7])) for _ in range(2000)]
    check(spark, [*rows, ("none", None), ("one", -5)], "int", bits)


def test_extremes_doubles_and_nan(spark):
    check(spark, [("a", x) for x in (-(2**63), 2**63 - 1, 0, -1, 1, -1)], "bigint")
    check(spark, [("a", x) for x in (-1.5, 2.5, 0.0, 1e300, -1e-300, math.inf, math.nan, None)], "double")


def test_empty(spark):
    assert key_quantiles(spark.createDataFrame([], "k string, v int"), "k", "v", [0.5]).count() == 0


def test_beyond_the_broadcast_limit(spark, monkeypatch):
    """The same result when the state is split into hot keys, broadcast, and cold ones, shuffled."""
    rows = [("hot", i % 50) for i in range(500)] + [(f"k{i}", i) for i in range(100)] + [(None, 3), (None, 9)]
    join = runtime.join_state
    monkeypatch.setattr("strandline.operators.key_quantiles.join_state", lambda *a: join(*a, limit=0))
    monkeypatch.setattr(runtime, "HOT_PART", 10)
    check(spark, rows, "int", 3)
