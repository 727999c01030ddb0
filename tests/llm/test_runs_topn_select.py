import math
import random

import pytest
from pyspark.sql import functions as F

from strandline.llm.multi_select import group_percentiles, merge_digests, multi_select, regroup, value_digest
from strandline.llm.runs import collapse_runs
from strandline.llm.top_n import top_n_per_group


def brute_runs(s, max_gap=2):
    out, cur, gap = [], None, 0
    for i, x in enumerate(s or []):
        if x in (4, 5, 6):
            gap += 1
            continue
        wall = x is None or x == 7
        if cur and (wall or x != cur[2] or gap > max_gap):
            out.append(tuple(cur))
            cur = None
        if not wall:
            cur = [cur[0], i, x, cur[3] + 1] if cur else [i, i, x, 1]
        gap = 0
    return out + ([tuple(cur)] if cur else [])


def test_runs_against_a_scan(spark):
    rng = random.Random(3)
    seqs = [(i, [rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, 6, 7, None]) for _ in range(rng.randint(1, 60))]) for i in range(300)]
    seqs += [(900, None), (901, []), (902, [6, 6]), (903, [2] * 50_000), (None, [1, 1, 1]), seqs[0], seqs[1]]
    df = spark.createDataFrame(seqs, "seq_id bigint, ref array<int>").withColumn("id", F.lit(1)).withColumn("base", F.lit(9)).withColumn("s", F.lit(0))
    for least in (1, 5):
        got = sorted((tuple(r) for r in collapse_runs(df.drop("base"), "seq_id", "ref", min_bases=least).collect()), key=str)
        want = sorted({(i, *r, r[1] - r[0] + 1) for i, s in seqs for r in brute_runs(s) if r[3] >= least}, key=str)
        assert got == want
    assert collapse_runs(df.limit(0), "seq_id", "ref").count() == 0


def test_near_identical_events_merge_most_similar_first(spark):
    df = spark.createDataFrame([(1, [10, 10, 11, 20, 21, 21])], "id bigint, s array<int>")
    got = [tuple(r)[1:5] for r in collapse_runs(df, "id", "s", neutral=(), wall=(), min_similarity=0.8, scale=10).orderBy("first_col").collect()]
    assert got == [(0, 2, 10, 3), (3, 5, 21, 3)]


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_top_n(spark, bits):
    rng = random.Random(bits)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), rng.choice([None, -5, 0, 0, 3, rng.randint(-10**12, 10**12)]), i) for i in range(600)]
    rows += rows[:100] + [("a", 5, None), ("few", None, 1), ("few", -(2**63), -4)]
    df = spark.createDataFrame(rows, "g string, score bigint, id bigint").withColumn("s", F.lit("x")).withColumn("need", F.lit(1))
    got = {}
    for r in top_n_per_group(df, "g", "score", "id", 10, bits).collect():
        got.setdefault(r["g"], set()).add(r["id"])
    low = -(2**63)
    for g in ("hot", "a", "b", "few"):
        uniq = {(s if s is not None else low, i) for k, s, i in rows if k == g and i is not None}
        assert got[g] == {i for _, i in sorted(uniq, key=lambda x: (-x[0], x[1]))[:10]}
    assert set(got) == {"hot", "a", "b", "few"}
    assert top_n_per_group(df.limit(0), "g", "score", "id", 3).count() == 0


def test_top_n_of_doubles(spark):
    df = spark.createDataFrame([("a", x, i) for i, x in enumerate((1.5, -2.0, math.inf, math.nan, None, 1e-300, 0.0))], "g string, v double, id bigint")
    assert {r["id"] for r in top_n_per_group(df, "g", "v", "id", 3).collect()} == {2, 0, 5}


def pct(vs, p):
    vs = sorted(vs)
    return vs[max(1, math.ceil(p * len(vs))) - 1]


def test_percentiles_and_merge(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, rng.randint(-50, 50), rng.randint(-(10**12), 10**12), 3]), rng.randint(0, 1)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "k string, v bigint, day int").withColumn("code", F.lit(1)).withColumn("n", F.lit(2))
    got = {(r["k"], r["prob"]): r["v"] for r in group_percentiles(df, ["k"], "v", [0.01, 0.5, 0.99]).collect()}
    for k in ("hot", "a", None):
        vs = [v for x, v, _ in rows if x == k and v is not None]
        assert [got[k, p] for p in (0.01, 0.5, 0.99)] == [pct(vs, p) for p in (0.01, 0.5, 0.99)]
    parts = merge_digests(*[value_digest(df.filter(F.col("day") == i), ["k"], "v") for i in (0, 1)])
    again = {r["k"]: r["code"] for r in multi_select(parts, ["k"], {"m": lambda n: F.ceil(n / 2)}).collect()}
    assert again == {k: got[k, 0.5] for k in ("hot", "a", None)}
    assert group_percentiles(df.limit(0), ["k"], "v", [0.5]).count() == 0
    assert group_percentiles(df.withColumn("v", F.lit(None).cast("bigint")), ["k"], "v", [0.5]).count() == 0


def test_percentile_error_is_bounded(spark):
    rng = random.Random(6)
    vs = [int(rng.lognormvariate(8, 2)) for _ in range(3000)]
    df = spark.createDataFrame([("a", v) for v in vs], "k string, v bigint")
    assert value_digest(df, ["k"], "v", 0.05).count() < value_digest(df, ["k"], "v").count() / 5
    for r in group_percentiles(df, ["k"], "v", [0.1, 0.5, 0.9], 0.05).collect():
        assert abs(r["v"] - pct(vs, r["prob"])) <= 0.05 * pct(vs, r["prob"]) + 1


def test_relative_error_holds_for_fractions_and_signs(spark):
    rng = random.Random(9)
    vs = [i / 10 for i in range(1, 10)] + [rng.lognormvariate(0, 8) * rng.choice([-1, 1]) for _ in range(800)] + [0.0, -0.0, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([("a", v) for v in vs] + [("t", i / 10) for i in range(1, 10)], "k string, v double")
    for e in (0.01, 0.2):
        probs = [0.001, 0.07, 0.3, 0.5, 0.55, 0.999]
        for k, mine in (("a", [v for v in vs if v is not None and not math.isnan(v)]), ("t", [i / 10 for i in range(1, 10)])):
            for r in group_percentiles(df.filter(F.col("k") == k), ["k"], "v", probs, e).collect():
                want = pct(mine, r["prob"])
                assert r["v"] == want if math.isinf(want) else abs(r["v"] - want) <= e * abs(want)
    ints = spark.createDataFrame([("a", v) for v in [-7, 0, 3, 99, 100, 101, -5000, 10**15]], "k string, v bigint")
    exact = {r["prob"]: r["v"] for r in group_percentiles(ints, ["k"], "v", [0.25, 0.375, 0.5], 0.01).collect()}
    assert exact == {0.25: -7, 0.375: 0, 0.5: 3}


def test_ranks_are_those_of_the_written_decimals(spark):
    df = spark.range(1, 101).select(F.lit("k").alias("k"), F.col("id").alias("v"))
    got = {r["prob"]: r["v"] for r in group_percentiles(df, ["k"], "v", [0.07, 0.28, 0.55, 0.57]).collect()}
    assert got == {0.07: 7, 0.28: 28, 0.55: 55, 0.57: 57}


def test_digests_of_archives_make_one_of_their_day(spark):
    rng = random.Random(10)
    rows = [(rng.randint(1, 9), rng.randint(-20, 20)) for _ in range(600)]
    df = spark.createDataFrame(rows, "archive int, v int")
    by_day = value_digest(df, ["archive"], "v").withColumn("day", F.col("archive") % 2)
    got = {r["day"]: r["code"] for r in multi_select(regroup(by_day, ["day"]), ["day"], {"m": lambda n: F.ceil(n / 2)}).collect()}
    assert got == {d: pct([v for a, v in rows if a % 2 == d], 0.5) for d in (0, 1)}


def test_runs_of_large_codes(spark):
    df = spark.createDataFrame([(1, [70_000, 70_000, 2**31 - 1])], "id bigint, s array<int>")
    assert [tuple(r)[3:5] for r in collapse_runs(df, "id", "s").orderBy("first_col").collect()] == [(70_000, 2), (2**31 - 1, 1)]
