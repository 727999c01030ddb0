"""Percentiles of every group by distributed multi-select over mergeable value counts.

A digest holds (group, value, weight) rows. Digests of separate partitions, archives or days merge by union. All groups
and ranks are searched at once: every partition proposes the weighted median of its values still in range, and its other quarters beside it; the weighted medians of the
proposals become the pivots, weights are counted below, at and above each pivot, and the ranges that can't hold the rank are discarded, until each
rank is found. One pass a round does both: with its counts a partition proposes the quarters of each part between the pivots, as
one of these is the next range. When less than half of the rows are still in a range, only those are kept for the next rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.runtime import exact_part, from_code, join_state, materialize, order_code, release


def value_digest(df: DataFrame, groups: list[str], value: str, rel_error: float = 0.0) -> DataFrame:
    """(groups..., code, weight): how often each value of a group stands; null and NaN values are left out.

    With rel_error > 0 each value stands for those of its step on a grid of factor 1 + rel_error, as the step's geometric middle, which bounds a group's rows; a
    percentile is then off by at most that part of itself, whatever its sign and size. Whole numbers up to 1 / rel_error, zeros and infinities stay exact. 0 is exact.
    """
    if rel_error:
        x, kind = F.col(value).cast("double"), df.schema[value].dataType
        size, base = F.abs(x), F.log(F.lit(1 + rel_error))
        middle = F.signum(x) * F.exp((F.floor(F.log(size) / base) + 0.5) * base)
        whole = not isinstance(kind, (T.FloatType, T.DoubleType))
        keep = (size * rel_error <= 1) if whole else (size == 0) | (size == F.lit(float("inf"))) | F.isnan(x)
        df = df.select(*groups, F.when(keep, F.col(value)).otherwise((F.round(middle) if whole else middle).cast(kind)).alias(value))
    return df.select(*groups, order_code(df, value).alias("code")).filter("code is not null").groupBy(*groups, "code").agg(F.count("*").alias("weight"))


def regroup(digest: DataFrame, groups: list[str]) -> DataFrame:
    """The digest by other groups, which are columns of it: those of archives become one of their day or sample, with no value counted again."""
    return digest.groupBy(*groups, "code").agg(F.sum("weight").alias("weight"))


def merge_digests(*digests: DataFrame) -> DataFrame:
    """One digest of all rows of the given ones, which may come from separate days or archives."""
    merged = digests[0]
    for d in digests[1:]:
        merged = merged.unionByName(d)
    keys = [c for c in merged.columns if c != "weight"]
    return merged.groupBy(*keys).agg(F.sum("weight").alias("weight"))


#: A round's pivots for each rank.
PIVOTS = 3
PROPOSED = [("weight", "bigint"), ("rows", "bigint"), *((f"q{j}", "bigint") for j in range(1, PIVOTS + 1))]


def _marks(x: pd.DataFrame, by: list[str], value: str, parts: int, js: range) -> tuple[pd.DataFrame, list[np.ndarray]]:
    """(groups, values): for each group of rows the values at which its weight reaches j of parts; groups come in order of by."""
    x = x.sort_values([*by, value], kind="stable", ignore_index=True)
    g = x.groupby(by, dropna=False, sort=False)
    upto, all_ = g["weight"].cumsum(), g["weight"].transform("sum")
    at = [(upto * parts >= j * all_) & ((upto - x["weight"]) * parts < j * all_) for j in js]
    return x[at[0]].assign(weight=all_, rows=g["rows"].transform("sum")), [x.loc[m, value].to_numpy() for m in at]


def _propose(mine: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For each rank (mine) and part of its range the weight and rows that a partition has there, and where the part's weight reaches each quarter."""
    by, names = [*mine, "part"], [n for n, _ in PROPOSED]

    def gathered(parts: list[pd.DataFrame]) -> pd.DataFrame:
        x = pd.concat(parts, ignore_index=True)
        for j in range(1, PIVOTS + 1):
            groups, (middle,) = _marks(x, by, f"q{j}", 2, range(1, 2))
            out = groups[[*by, "weight", "rows"]].reset_index(drop=True) if j == 1 else out
            out[f"q{j}"] = middle
        return out[[*by, *names]]

    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for x in batches:
            groups, quarters = _marks(x.assign(rows=1), by, "code", PIVOTS + 1, range(1, PIVOTS + 1))
            parts.append(groups[[*by, "weight", "rows"]].reset_index(drop=True).assign(**dict(zip(names[2:], quarters))))
            held += len(parts[-1])
            if held > 500_000:
                parts = [gathered(parts)]
                held = len(parts[0]) // 2
        if parts:
            yield gathered(parts)

    return propose


def multi_select(digest: DataFrame, groups: list[str], targets: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(groups..., n, target, rank, code): the rank-th smallest value of each group, exactly, as order code.

    targets gives for each name the rank, from 1 to n, as a function of the group's number of values n; ranks out of that
    range are moved to its ends. Null groups form one group; an empty digest gives no rows.
    """
    keys = [f"g{i}" for i in range(len(groups))]
    mine = [*keys, "target"]
    # ranges of (group, value) keep a group's values together, so that few partitions propose for it, and split a hot group among several
    rows = digest.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], "code", "weight")
    rows = materialize(rows.repartitionByRange(F.xxhash64(*keys), "code"), "digest")
    rank = F.map_from_arrays(F.array(*map(F.lit, targets)), F.array(*(f(F.col("n")).cast("bigint") for f in targets.values())))
    sizes = rows.groupBy(*keys).agg(F.sum("weight").alias("n"), F.count("*").alias("size"))
    state = sizes.select(*keys, "n", "size", F.explode(rank).alias("target", "rank"))
    state = state.withColumn("rank", F.greatest(F.lit(1), F.least("rank", "n")).cast("bigint"))
    none = F.lit(None).cast("bigint")
    state = materialize(state.select("*", F.col("rank").alias("left"), none.alias("lo"), none.alias("hi"), F.array().cast("array<bigint>").alias("pivots"), none.alias("found"), F.col("size").alias("inside")), "select_state")
    total, done, n_open = rows.count(), [], state.count()
    names = {k: f"p_{k}" for k in mine}
    # parts of a range count from 0: even ones lie between pivots, odd ones are the pivots
    part = reduce(lambda a, b: a + b, (F.expr(f"coalesce(int(code > get(pivots, {j})) + int(code >= get(pivots, {j})), 0)") for j in range(PIVOTS)))
    while n_open > 0:
        play = join_state(rows, state.select(*mine, "size", "lo", "hi", "pivots"), keys, "inner", "size", total, size=n_open)
        play = play.filter("(lo is null or code > lo) and (hi is null or code < hi)").select(*mine, part.alias("part"), "code", "weight")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in play.select(*mine, "part").schema)
        told = play.mapInPandas(_propose(mine), f"{kinds}, " + ", ".join(f"{n} {t}" for n, t in PROPOSED))
        # the weighted median of the proposals, kept among them as far as its digits go
        median = lambda q: F.expr(f"greatest(min({q}), least(max({q}), cast(floor(percentile({q}, 0.5, weight)) as bigint)))")
        parts = told.groupBy(*mine, "part").agg(F.sum("weight").alias("w"), F.sum("rows").alias("inside"), F.array_sort(F.array_distinct(F.array(*(median(q) for q, _ in PROPOSED[2:])))).alias("next"))
        upto = Window.partitionBy(*mine).orderBy("part")
        parts = parts.withColumn("upto", F.sum("w").over(upto)).withColumnsRenamed(names)
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(p)) for k, p in names.items()))
        hit = state.drop("inside").join(parts, same & (F.col("left") <= F.col("upto")) & (F.col("left") > F.col("upto") - F.col("w")))
        state = materialize(hit.select(
            *keys, "n", "size", "target", "rank", (F.col("left") - F.col("upto") + F.col("w")).alias("left"),
            F.expr("if(part % 2 = 0, coalesce(get(pivots, int(part div 2) - 1), lo), lo)").alias("lo"),
            F.expr("if(part % 2 = 0, coalesce(get(pivots, int(part div 2)), hi), hi)").alias("hi"),
            F.col("next").alias("pivots"), F.expr("if(part % 2 = 1, get(pivots, int(part div 2)), null)").alias("found"), "inside",
        ), "select_state")
        done.append(state.filter("found is not null"))
        state = state.filter("found is null")
        n_open, kept = state.agg(F.count("*"), F.coalesce(F.sum("inside"), F.lit(0))).first()
        if 0 < kept * 2 < total:
            # one row a group with the ranges of its ranks, so that a row which lies in several stays one
            ranges = state.groupBy(*keys).agg(F.max("size").alias("size"), F.collect_list(F.struct("lo", "hi")).alias("ranges"))
            within = F.expr("exists(ranges, x -> (x.lo is null or code > x.lo) and (x.hi is null or code < x.hi))")
            less = materialize(join_state(rows, ranges, keys, "inner", "size", total, size=n_open).filter(within).select(*keys, "code", "weight"), "digest")
            release(rows)
            rows, total = less, less.count()
    release(rows)
    out = done[0] if done else state
    for found in done[1:]:
        out = out.unionByName(found)
    return out.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], "n", "target", "rank", F.col("found").alias("code"))


def group_percentiles(df: DataFrame, groups: list[str], value: str, probs: list[float], rel_error: float = 0.0) -> DataFrame:
    """(groups..., n, prob, value): discrete percentiles, the ceil(prob * n)-th smallest value of each group; prob counts as the decimal it is written as."""
    targets = {repr(float(p)): (lambda n, p=p: F.ceil(exact_part(n, p))) for p in probs}
    found = multi_select(value_digest(df, groups, value, rel_error), groups, targets)
    return found.select(*groups, "n", F.col("target").cast("double").alias("prob"), from_code(F.col("code"), df.schema[value].dataType).alias(value))
