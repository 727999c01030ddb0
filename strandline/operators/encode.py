"""Choose the reads of each window and lay windows out in columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline import codes
from strandline.functions import sequence as S
from strandline.operators.alignment_filter import records, usable_reads
from strandline.operators.intervals import overlap_join, overlap_len


def window_reads(reads: DataFrame, windows: DataFrame, min_mq: int = 1, span: tuple[str, str] = ("core_s", "core_e"), reach: bool = True) -> DataFrame:
    """Usable reads, each once, joined to the windows whose span they overlap, a half-open interval of two columns of windows; with reach they must also overlap the window.

    The span is the window's core, whatever targets encoding finds there, so that every window has its reads. Another one, such as that of the targets found, may be given.
    """
    w = windows.select("batch_id", F.col("chrom").alias("w_chrom"), "win_s", "win_e", F.col(span[0]).alias("span_s"), F.col(span[1]).alias("span_e"))
    pairs = overlap_join(records(usable_reads(reads, min_mq)), w, r_contig="w_chrom", r_start="span_s", r_end="span_e").drop("span_s", "span_e")
    pairs = pairs.withColumn("win_overlap", overlap_len(F.col("start0"), F.col("end0"), F.col("win_s").cast("bigint"), F.col("win_e").cast("bigint")))
    return pairs.filter("win_overlap > 0") if reach else pairs


def select_reads(pairs: DataFrame, depth: int = 30) -> DataFrame:
    """At most depth reads for each window and platform, with their row number in order of start.

    A read that is no backbone and lies inside a trusted backbone interval is dropped: in order of start, the furthest trusted end among the intervals that
    begin no later tells it, so a window may have any number of reads. The score takes the mean aligned length before that. Ties go by the smaller aln_id.
    """
    group = Window.partitionBy("batch_id", "platform")
    trusted = F.col("backbone") & (F.col("end0") - F.col("start0") > 2 * F.col("trust"))
    begun = group.orderBy(F.col("start0").cast("bigint"))
    # an interval begins trust behind its read, so each value of trust has its own frame
    reach = [F.max(F.when(trusted & (F.col("trust") == t), F.col("end0") - t)).over(begun.rangeBetween(Window.unboundedPreceding, -t)) for t in sorted({v[-1] for v in codes.READ_LIMITS.values()})]
    p = pairs.withColumn("mean_len", F.avg("aln_len").over(group)).withColumn("reach", F.greatest(*reach))
    p = p.filter(F.col("backbone") | F.coalesce(F.col("reach") < F.col("end0"), F.lit(True)))
    p = p.withColumn("score", F.col("win_overlap") - F.col("clip_ratio") * 100 + F.col("aln_len") / F.col("mean_len") + F.col("mapq"))
    p = p.withColumn("rank", F.row_number().over(group.orderBy(F.desc(F.round("score", 6)), "aln_id"))).filter(F.col("rank") <= depth)
    return p.withColumn("row", F.row_number().over(group.orderBy("start0", "aln_id")) - 1).drop("reach")


def stack_platforms(selected: DataFrame) -> DataFrame:
    """selected with stacked: the place of a read from 0 when the rows of a window's platforms stand one below the other, short reads first, the others by name."""
    w = Window.partitionBy("batch_id").orderBy(F.col("platform") != "ILLUMINA", "platform", "row")
    return selected.withColumn("stacked", F.row_number().over(w) - 1)


def insertions(selected: DataFrame, max_insert: int = 15) -> DataFrame:
    """(batch_id, pos, ins): the longest insertion of at most max_insert bases after each position of a window, over all platforms."""
    ops = S.walk_ops(selected, ["batch_id", "win_s", "win_e"]).filter((F.col("op") == "I") & (F.col("len") <= max_insert))
    ops = ops.withColumn("pos", F.col("ref_pos") - 1).filter("pos >= win_s and pos < win_e")
    return ops.groupBy("batch_id", "pos").agg(F.max("len").alias("ins"))


def columns(windows: DataFrame, ins: DataFrame) -> DataFrame:
    """(batch_id, chrom, pos, ins, col): the column at which each position of a window begins; insertions widen what follows."""
    w = windows.filter("win_e > win_s").select("batch_id", "chrom", F.explode(F.expr("sequence(cast(win_s as bigint), win_e - 1L)")).alias("pos"))
    w = w.join(ins, ["batch_id", "pos"], "left").withColumn("ins", F.coalesce("ins", F.lit(0)))
    before = Window.partitionBy("batch_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return w.withColumn("col", F.coalesce(F.sum(F.col("ins") + 1).over(before), F.lit(0))).select("batch_id", "chrom", "pos", "ins", "col")


def cells(selected: DataFrame, cols: DataFrame) -> DataFrame:
    """(batch_id, platform, row, aln_id, col, k, base, bq, op): what each selected read has in each column; k counts within an insertion.

    base is 5 in a deletion and bq -2. An insertion longer than its position's columns is left out, but its bases are passed over.
    """
    ops = S.walk_ops(selected, ["batch_id", "platform", "row", "aln_id", "seq", "qual", "win_s", "win_e"]).filter(F.col("op").isin("M", "=", "X", "I", "D") & (F.length("seq") > 0))
    ops = ops.filter(F.when(F.col("op") == "I", F.expr("ref_pos - 1 >= win_s and ref_pos - 1 < win_e")).otherwise(F.expr("ref_pos < win_e and ref_pos + len > win_s")))
    k = F.explode(F.expr("if(op = 'I', sequence(0, len - 1), sequence(int(greatest(0L, win_s - ref_pos)), int(least(len, win_e - ref_pos)) - 1))"))
    c = ops.withColumn("k", k)
    c = c.withColumn("pos", F.expr("if(op = 'I', ref_pos - 1, ref_pos + k)")).withColumn("q", F.expr("int(query_pos + if(op = 'D', 0, k))"))
    c = c.filter("op = 'D' or q < length(seq)")
    c = c.withColumn("base", F.when(F.col("op") == "D", 5).otherwise(S.base_code(F.expr("substring(seq, q + 1, 1)"))))
    c = c.withColumn("bq", F.when(F.col("op") == "D", -2).otherwise(F.coalesce(F.expr("try_element_at(qual, q + 1)").cast("int"), F.lit(0))))
    c = c.select("batch_id", "platform", "row", "aln_id", "op", "len", "k", "pos", "base", "bq").join(cols.select("batch_id", "pos", "ins", "col"), ["batch_id", "pos"])
    c = c.filter("op <> 'I' or len <= ins")
    return c.select("batch_id", "platform", "row", "aln_id", F.expr("col + if(op = 'I', 1 + k, 0)").alias("col"), "pos", "op", F.expr("if(op = 'I', k + 1, 0)").alias("k"), "base", "bq")
