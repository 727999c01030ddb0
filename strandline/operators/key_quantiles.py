"""Exact quantiles of every key where a few keys hold most of the rows.

Each round counts values by key in a histogram of 2**bits bins. Counts merge, so every task sends at most one row
for a key and bin, however many rows the key has. The bin that holds the wanted rank is split further in the next
round until it holds a single value. No round gathers or sorts the values of a key.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.runtime import exact_part, from_code, join_state, materialize, order_code, release


def _bit_length(x: Column) -> Column:
    return F.when(x == 0, 0).otherwise(F.length(F.bin(x)))


def key_quantiles(df: DataFrame, key: str, value: str, probs: list[float], bits: int = 12) -> DataFrame:
    """(key, n_rows, n_values, share, prob, quantile): exact discrete quantiles of value for each key.

    quantile is the ceil(prob * n_values)-th smallest value, at least the first; prob counts as the decimal it is written as. For the rest see key_ranks.
    """
    ranks = {repr(float(p)): (lambda n, p=p: F.ceil(exact_part(n, p))) for p in probs}
    k = key_ranks(df, key, value, ranks, bits)
    return k.select(df.schema[key].name, "n_rows", "n_values", "share", F.col("target").cast("double").alias("prob"), F.col("value").alias("quantile"))


def key_ranks(df: DataFrame, key: str, value: str, targets: dict[str, Callable[[Column], Column]], bits: int = 12) -> DataFrame:
    """(key, n_rows, n_values, share, target, value): for each target the value of its rank among the values of each key, exactly.

    targets gives for each name the rank as a function of the key's number of values; ranks beyond 1 to n_values are moved to these. n_rows counts all rows of the key and
    share is its part of all rows of df, null keys and null values counted in. Null keys form one key. Null and NaN
    values are no values; a key without values has null values. An empty df gives no rows. Repeated rows count as
    often as they stand. Other columns of df, whatever their names, are ignored.
    """
    name, kind = df.schema[key].name, df.schema[value].dataType
    base = df.select(F.col(key).alias("k"), order_code(df, value).alias("code"))
    totals = materialize(
        base.groupBy("k").agg(F.count("*").alias("n_rows"), F.count("code").alias("n_values"), F.min("code").alias("lo"), F.max("code").alias("hi")),
        "key_totals",
    )
    total = totals.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    rank = F.map_from_arrays(F.array(*map(F.lit, targets)), F.array(*(f(F.col("n_values")).cast("bigint") for f in targets.values())))
    ranks = totals.select("*", F.explode(rank).alias("target", "want"))
    state = materialize(
        ranks.filter("n_values > 0").select(
            "k", "n_rows", "target", "lo", "hi",
            F.greatest(F.least("want", "n_values"), F.lit(1)).cast("bigint").alias("rank"),
            _bit_length(F.col("lo").bitwiseXOR(F.col("hi"))).alias("shift"),
        ).withColumn("prefix", F.expr("if(shift = 64, 0L, shiftright(lo, shift))")),
        "key_ranks",
    )
    found = []
    while True:
        found.append(state.filter("lo = hi"))
        open_ = state.filter("lo <> hi")
        if open_.isEmpty():
            break
        ranges = materialize(
            open_.select("k", "n_rows", "shift", "prefix").distinct().withColumn("finer", F.greatest(F.col("shift") - bits, F.lit(0))), "key_ranges"
        )
        inside = join_state(base.filter("code is not null"), ranges, ["k"], "inner", "n_rows", total)
        inside = inside.filter(F.expr("shift = 64 or shiftright(code, shift) = prefix"))
        bins = inside.groupBy("k", "shift", "prefix", "finer", F.expr("shiftright(code, finer)").alias("bin")).agg(
            F.count("*").alias("n"), F.min("code").alias("lo"), F.max("code").alias("hi")
        )
        upto = Window.partitionBy("k", "shift", "prefix").orderBy("bin")
        bins = bins.withColumn("before", F.sum("n").over(upto) - F.col("n")).withColumnRenamed("k", "bk")
        o = open_.select("k", "n_rows", "target", "rank", F.col("shift").alias("s0"), F.col("prefix").alias("p0"))
        hit = o.join(bins, o.k.eqNullSafe(bins.bk) & (o.s0 == bins.shift) & (o.p0 == bins.prefix) & (o.rank > bins.before) & (o.rank <= bins.before + bins.n))
        state = materialize(
            hit.select("k", "n_rows", "target", "lo", "hi", (F.col("rank") - F.col("before")).alias("rank"), F.col("finer").alias("shift"), F.col("bin").alias("prefix")), "key_ranks"
        )
        release(ranges)
    done = found[0]
    for part in found[1:]:
        done = done.unionByName(part)
    done = done.select(F.col("k").alias("dk"), F.col("target").alias("dt"), F.col("lo").alias("code"))
    out = ranks.join(done, ranks.k.eqNullSafe(done.dk) & (ranks.target == done.dt), "left")
    return out.select(
        F.col("k").alias(name), "n_rows", "n_values", (F.col("n_rows") / F.lit(max(total, 1))).alias("share"), "target", from_code(F.col("code"), kind).alias("value")
    )


def hot_keys(df: DataFrame, key: str, share: float, label: str, code_bits: int = 24) -> DataFrame:
    """(tbl, contig): the keys that hold at least ``share`` of all rows of df, null keys counted among the rows; tbl is label.

    Rows are ordered by a hash of their key, so a key's rows stand together, and the values at every share-th part of the order are selected
    exactly: a key with that many rows can't lie between two of them. Only the keys so found are then counted, as other keys may
    have the same hash. Null keys are never reported; an empty df gives none.
    """
    steps = math.ceil(1 / share)
    code = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 64 - code_bits)
    coded = df.select(F.col(key).alias("contig"), F.when(F.col(key).isNotNull(), code).alias("code"))
    # one group of all rows: what is above the code's bits is 0
    coded = coded.withColumn("all", F.coalesce(F.shiftrightunsigned("code", code_bits), F.lit(0)))
    ranks = {str(i): (lambda n, i=i: F.ceil(exact_part(n, share) * i)) for i in range(1, steps + 1)}
    picked = materialize(key_ranks(coded, "all", "code", ranks).select("n_rows", F.col("value").alias("c")).filter("c is not null").distinct(), "hot_codes")
    # at most steps rows
    counts = coded.join(F.broadcast(picked), F.col("code") == F.col("c")).groupBy("contig", "n_rows").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= exact_part(F.col("n_rows"), share)).select(F.lit(label).alias("tbl"), "contig")
