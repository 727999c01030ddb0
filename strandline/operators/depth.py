"""Coverage of contigs: depth histogram, its mean and median, and normalised depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.alignment_filter import flag_clear
from strandline.operators.intervals import coverage

CLIP = 1000


def depth_runs(aln: DataFrame, contigs: DataFrame) -> DataFrame:
    """Runs of equal depth of mapped primary records, deletions and skips counted, reads cut at the end of their contig."""
    r = aln.filter(flag_clear(0x904)).select("aln_id", "contig", "start0", "end0").distinct()
    r = r.join(contigs.select("contig", "len"), "contig").withColumn("end0", F.least("end0", "len"))
    return coverage(r)


def depth_histogram(runs: DataFrame, contigs: DataFrame) -> DataFrame:
    """(depth, n): bases of the contigs with reads by depth, depths above 1,000 as 1,000, uncovered bases as 0."""
    covered = runs.groupBy("contig").agg(F.sum(F.col("end") - F.col("start")).alias("covered"))
    empty = covered.join(contigs.select("contig", "len"), "contig").select(F.lit(0).cast("bigint").alias("depth"), (F.col("len") - F.col("covered")).alias("n"))
    some = runs.select(F.least("depth", F.lit(CLIP)).alias("depth"), (F.col("end") - F.col("start")).alias("n"))
    return some.unionByName(empty).groupBy("depth").agg(F.sum("n").alias("n"))


def depth_stats(hist: DataFrame) -> DataFrame:
    """(mean, median) of the histogram; the median is the smallest depth that half of the bases don't exceed, at least 1.

    The histogram has at most 1,001 rows, so its running sum may run in one task.
    """
    upto = Window.orderBy("depth")
    h = hist.withColumn("cum", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy()))
    return h.agg((F.sum(F.col("depth") * F.col("n")) / F.sum("n")).alias("mean"), F.greatest(F.lit(1), F.min(F.when(F.col("cum") >= F.col("total") / 2, F.col("depth")))).alias("median"))


def normalised(runs: DataFrame, median: float, low: float = -1.0, high: float = 3.0) -> DataFrame:
    return runs.select("contig", "start", "end", F.greatest(F.lit(low), F.least(F.lit(high), F.col("depth") / F.lit(float(median)) - 1)).alias("norm"))
