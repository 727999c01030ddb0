"""The N best rows of every group by simultaneous bisection of all groups' cutoffs.

A row's place in its group is an order-preserving code of two words: its score, then the complement of its identifier,
so that higher is better and the smaller identifier wins a tie. Every round counts, for all undecided groups at once, the
rows above the midpoints that halve the group's remaining code range ``bits`` times, keeps the one part that holds the
cutoff, and goes on inside it. No group is sorted or gathered; a group with a third of all rows costs what its
counts cost. When less than half of the rows lie in a range, only those are read in the next rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.runtime import join_state, materialize, order_code, release

LOWEST = -(2**63)


def _start(lo: Column, hi: Column) -> Column:
    """Bits in which codes between lo and hi can differ."""
    x = lo.bitwiseXOR(hi)
    return F.when(x == 0, 0).otherwise(F.length(F.bin(x)))


def top_n_per_group(df: DataFrame, group: str, score: str, ident: str, n: int, bits: int = 6) -> DataFrame:
    """(group, ident, score code): the n rows of each group with the highest score, the smaller ident first among equals.

    All rows of groups with at most n. Rows equal in group, score and ident count once, so that copies neither appear
    twice nor take a place. Rows with a null group or ident are no candidates; a null or NaN score is lower
    than any other. An empty df gives no rows. Other columns of df, whatever their names, are ignored.
    """
    names = df.schema[group].name, df.schema[ident].name
    rows = materialize(
        df.select(F.col(group).alias("g"), F.coalesce(order_code(df, score), F.lit(LOWEST)).alias("s"), F.bitwise_not(F.col(ident).cast("bigint")).alias("j"))
        .filter("g is not null and j is not null")
        .distinct(),
        "top_n_rows",
    )
    total = rows.count()
    sizes = rows.groupBy("g").agg(F.count("*").alias("size"), F.min("s").alias("lo"), F.max("s").alias("hi")).filter(F.col("size") > n)
    # word: 0 while the score is searched, 1 while the identifier is among rows of the cutoff score s_cut
    state = materialize(sizes.select("g", "size", F.lit(0).alias("word"), "lo", "hi", F.lit(n).cast("bigint").alias("need"), F.lit(LOWEST).alias("s_cut")), "top_n_state")
    play, held, decided, n_open = rows, total, [], state.count()
    while n_open:
        ranged = state.withColumn("shift", F.greatest(_start(F.col("lo"), F.col("hi")) - bits, F.lit(0)))
        inside = join_state(play, materialize(ranged, "top_n_ranges"), ["g"], "inner", "size", total, size=n_open)
        inside = inside.withColumn("code", F.when(F.col("word") == 0, F.col("s")).otherwise(F.col("j")))
        inside = inside.filter("(word = 0 or s = s_cut) and code between lo and hi").withColumn("part", F.expr("shiftright(code, shift)"))
        counts = inside.groupBy("g", "size", "word", "need", "s_cut", "part").agg(F.count("*").alias("c"), F.min("code").alias("lo"), F.max("code").alias("hi"))
        above = Window.partitionBy("g").orderBy(F.desc("part"))
        at = counts.withColumn("above", F.sum("c").over(above) - F.col("c")).filter("above < need and above + c >= need")
        at = materialize(at.withColumn("need", F.col("need") - F.col("above")), "top_n_cut")
        # exactly n rows lie at or above the part's lowest code, or they all share one code
        exact = (F.col("need") == F.col("c")) | ((F.col("word") == 1) & (F.col("lo") == F.col("hi")))
        decided.append(at.filter(exact).select("g", "size", F.when(F.col("word") == 0, F.col("lo")).otherwise(F.col("s_cut")).alias("s_cut"), F.when(F.col("word") == 0, F.lit(LOWEST)).otherwise(F.col("lo")).alias("j_cut")))
        tied = (F.col("word") == 0) & (F.col("lo") == F.col("hi"))
        open_ = at.filter(~exact)
        n_open, left = open_.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
        if not n_open:
            break
        state = materialize(
            open_.select(
                "g", "size",
                F.when(tied, 1).otherwise(F.col("word")).alias("word"),
                F.when(tied, F.lit(LOWEST)).otherwise(F.col("lo")).alias("lo"),
                F.when(tied, F.lit(2**63 - 1)).otherwise(F.col("hi")).alias("hi"),
                "need", F.when(tied, F.col("lo")).otherwise(F.col("s_cut")).alias("s_cut"),
            ),
            "top_n_state",
        )
        if left * 2 < held:
            # only the rows between the bounds of their group can still be at its cutoff
            within = F.expr("if(word = 0, s between lo and hi, s = s_cut and j between lo and hi)")
            less = materialize(join_state(play, state, ["g"], "inner", "size", total, size=n_open).filter(within).select("g", "s", "j"), "top_n_rows")
            if play is not rows:
                release(play)
            play, held = less, left
    if play is not rows:
        release(play)
    if decided:
        cuts = decided[0]
        for part in decided[1:]:
            cuts = cuts.unionByName(part)
        rows = join_state(rows, materialize(cuts, "top_n_cuts"), ["g"], "left", "size", total)
        rows = rows.filter("s_cut is null or s > s_cut or (s = s_cut and j >= j_cut)")
    return rows.select(F.col("g").alias(names[0]), F.bitwise_not("j").alias(names[1]), F.col("s").alias("score_code"))
