"""Interval joins, islands and containment over half-open intervals of contigs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap_join(left: DataFrame, right: DataFrame, bin_size: int = 512, contig: str = "contig", start: str = "start0", end: str = "end0", r_contig: str = "chrom", r_start: str = "win_s", r_end: str = "win_e", how: str = "inner") -> DataFrame:
    """Pairs of rows whose intervals share a base, each once; null contigs and empty intervals match nothing.

    Both sides are laid into bins of the contig and joined by (contig, bin), so the join is an equi-join whose keys are as
    many as the contig has bins: a contig with a third of all rows still spreads over all tasks. A pair that shares several bins counts in the
    bin of the later start only.
    """
    a = left.filter(F.col(contig).isNotNull() & (F.col(end) > F.col(start)))
    b = right.filter(F.col(r_contig).isNotNull() & (F.col(r_end) > F.col(r_start)))
    a = a.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / bin_size), F.floor((F.col(end) - 1) / bin_size))))
    b = b.withColumn("__rbin", F.explode(F.sequence(F.floor(F.col(r_start) / bin_size), F.floor((F.col(r_end) - 1) / bin_size))))
    hit = (a[contig] == b[r_contig]) & (F.col("__bin") == F.col("__rbin")) & (F.col(start) < F.col(r_end)) & (F.col(end) > F.col(r_start))
    hit &= F.col("__bin") == F.floor(F.greatest(F.col(start).cast("bigint"), F.col(r_start).cast("bigint")) / bin_size)
    return a.join(b, hit, how).drop("__bin", "__rbin")


def overlap_len(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))


def coverage(df: DataFrame, contig: str = "contig", start: str = "start0", end: str = "end0") -> DataFrame:
    """(contig, start, end, depth): maximal stretches of equal depth above 0, by +1 and -1 events and their running sum.

    Events are summed by position first, so the sort holds one row for each position at which the depth may change. The running sum of a
    contig is taken by stretches of it: sums of stretches first, then within each.
    """
    chunk = 1 << 20
    e = df.filter(F.col(contig).isNotNull() & (F.col(end) > F.col(start)))
    ev = e.select(F.col(contig).alias("contig"), F.explode(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("d")), F.struct(F.col(end).alias("pos"), F.lit(-1).alias("d")))).alias("x"))
    ev = ev.groupBy("contig", "x.pos").agg(F.sum("x.d").alias("d")).filter("d <> 0").withColumn("chunk", F.floor(F.col("pos") / chunk))
    sums = ev.groupBy("contig", "chunk").agg(F.sum("d").alias("s"), F.min("pos").alias("first"))
    by = Window.partitionBy("contig").orderBy("chunk")
    sums = sums.withColumn("past", F.coalesce(F.sum("s").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("next_first", F.lead("first").over(by))
    inner = Window.partitionBy("contig", "chunk").orderBy("pos")
    run = ev.join(sums.drop("s", "first"), ["contig", "chunk"]).withColumn("depth", F.col("past") + F.sum("d").over(inner))
    run = run.withColumn("end", F.coalesce(F.lead("pos").over(inner), F.col("next_first")))
    return run.filter("depth > 0 and end is not null").select("contig", F.col("pos").alias("start"), "end", "depth")


def stretches(df: DataFrame, contig: str, start: str, end: str, gap: int = 0, chunk: int = 1 << 20) -> DataFrame:
    """df with head: the first start of the stretch of rows a row lies in. A stretch ends where the next start is more than gap behind every end so far.

    Two levels: the furthest end and the last head of each chunk of a contig are carried over its chunks, of which it has few; rows are sorted within a
    chunk only, so that no task holds a whole contig. Null contigs form one contig; start and end must not be null. df is read three times.
    """
    a = df.withColumn("__chunk", F.floor(F.col(start) / chunk))
    inner = Window.partitionBy(contig, "__chunk").orderBy(start, end)

    def carried(rows: DataFrame, value: Column, name: str) -> DataFrame:
        per = rows.groupBy(F.col(contig).alias("__c"), F.col("__chunk").alias("__k")).agg(F.max(value).alias("__m"))
        w = Window.partitionBy("__c").orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
        per = per.select("__c", "__k", F.max("__m").over(w).alias(name))
        return rows.join(per, rows[contig].eqNullSafe(F.col("__c")) & (rows["__chunk"] == F.col("__k"))).drop("__c", "__k")

    a = carried(a, F.col(end), "__reach")
    reach = F.greatest("__reach", F.max(end).over(inner.rowsBetween(Window.unboundedPreceding, -1)))
    a = a.withColumn("__first", F.when(F.coalesce(F.col(start) > reach + gap, F.lit(True)), F.col(start))).drop("__reach")
    # heads grow along a contig, so the last one is the greatest
    a = carried(a, F.col("__first"), "__head")
    return a.withColumn("head", F.greatest("__head", F.max("__first").over(inner.rowsBetween(Window.unboundedPreceding, 0)))).drop("__head", "__first", "__chunk")


def islands(df: DataFrame, contig: str, pos: str, merge_dist: int = 20) -> DataFrame:
    """(contig, pos, island): distinct positions, numbered by the first position of the stretch in which no gap exceeds merge_dist."""
    d = df.filter(F.col(contig).isNotNull() & F.col(pos).isNotNull()).select(F.col(contig).alias("contig"), F.col(pos).cast("bigint").alias("pos")).distinct()
    return stretches(d, "contig", "pos", "pos", merge_dist).select("contig", "pos", F.col("head").alias("island"))
