"""Which alignment records of a read are kept, and what their missing sequence is restored from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline import codes
from strandline.functions import sequence as S
from strandline.runtime import materialize

MATE = "case when flag & 1 = 0 then 0 when flag & 64 <> 0 then 1 when flag & 128 <> 0 then 2 end"


def flag_clear(mask: int) -> Column:
    return F.col("flag").bitwiseAND(mask) == 0


def records(df: DataFrame) -> DataFrame:
    """Each record once, whatever copies were delivered."""
    return df.dropDuplicates(["aln_id"])


def decisive(df: DataFrame) -> DataFrame:
    """(aln_id, qname, flag, mate, score, mismatches, nm, seq_len, sourced): what decides about a record, each record once.

    Everything up to the choice of records runs on these narrow rows; sequences and qualities are only moved for records that are kept.
    seq_len is 0 for a missing sequence; sourced says that the sequence can restore another record's.
    """
    length = F.coalesce(F.length("seq"), F.lit(0))
    return df.select(
        "aln_id", "qname", "flag", F.expr(MATE).alias("mate"), F.coalesce("as_score", F.lit(0)).alias("score"),
        F.coalesce(S.condensed_mismatches("md").cast("bigint"), "nm", F.lit(0)).alias("mismatches"), F.coalesce("nm", F.lit(0)).alias("nm"), length.alias("seq_len"), ((length > 0) & (F.col("seq") != "*")).alias("sourced"),
    ).dropDuplicates(["aln_id"])


def primary_sources(rows: DataFrame) -> DataFrame:
    """(s_qname, s_mate, p_id, p_as, p_len): the primary record with a sequence of each mate of a read; of two, the one with the larger aln_id. rows as decisive gives them.

    Grouping is by read name over the whole input, so mapped order doesn't matter; the maximum combines before the shuffle, so a
    read name with very many records sends one row a task.
    """
    p = rows.filter(flag_clear(codes.NOT_PRIMARY) & F.col("sourced") & F.col("qname").isNotNull() & F.col("mate").isNotNull())
    p = p.groupBy(F.col("qname").alias("s_qname"), F.col("mate").alias("s_mate")).agg(F.max(F.struct("aln_id", "score", "seq_len")).alias("p"))
    return p.select("s_qname", "s_mate", F.col("p.aln_id").alias("p_id"), F.col("p.score").alias("p_as"), F.col("p.seq_len").cast("bigint").alias("p_len"))


def secondary_candidates(rows: DataFrame, min_ratio: float | None = 0.8, max_mismatch: int | None = 6, condensed: bool = True) -> DataFrame:
    """Mapped non-primary records that pass the score and mismatch gates, with p_id, p_as and p_len of their mate's primary; rows as decisive gives them.

    The ratio gate only holds for records without a sequence, and only where the primary is known. The mismatch count is the condensed one
    of md where there is one, else nm, missing 0. The primaries are joined by a hash join; a hot read name has at most
    three of them, so its many narrow records stay where the scan left them if the side is small, and are split by AQE otherwise.
    """
    r = rows.filter((F.col("flag").bitwiseAND(codes.NOT_PRIMARY) != 0) & flag_clear(codes.UNMAPPED) & F.col("qname").isNotNull())
    src = primary_sources(rows)
    r = r.join(src, (r.qname == src.s_qname) & (r.mate == src.s_mate), "left").drop("s_qname", "s_mate")
    if min_ratio is not None:
        r = r.filter((F.col("seq_len") > 0) | F.col("p_as").isNull() | (F.col("score") >= F.col("p_as") * min_ratio))
    if max_mismatch is not None:
        r = r.filter(F.col("mismatches" if condensed else "nm") <= max_mismatch)
    return r


def keep_best(cand: DataFrame, n: int = 100) -> DataFrame:
    """The n candidates of each read with the highest score, the smaller aln_id first among equals.

    row_number with a filter on it becomes a group limit before the shuffle: a task sends at most n rows of a read.
    """
    w = Window.partitionBy("qname").orderBy(F.desc("score"), "aln_id")
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def filter_alignments(df: DataFrame, min_ratio: float = 0.8, max_mismatch: int | None = 6, condensed: bool = True, max_records: int = 100) -> DataFrame:
    """The whole filter stage: mapped primaries as they are, and the kept others with tags dropped and their sequence restored.

    A record without a sequence takes it from its mate's primary, turned to its own strand and trimmed by its hard clips; where
    there is none it is dropped, after it has taken its place among the best.
    """
    rows = materialize(decisive(df), "filter_rows")
    kept = keep_best(secondary_candidates(rows, min_ratio, max_mismatch, condensed), max_records)
    kept = kept.filter("seq_len > 0 or p_id is not null").select(F.col("aln_id").alias("k_id"), F.when(F.col("seq_len") == 0, F.col("p_id")).alias("k_source"))
    kept = materialize(kept, "filter_kept")
    primary = records(df.filter(flag_clear(codes.NOT_PRIMARY | codes.UNMAPPED)))
    own = records(df.filter(F.col("flag").bitwiseAND(codes.NOT_PRIMARY) != 0).join(kept, F.col("aln_id") == F.col("k_id"), "left_semi")).join(kept, F.col("aln_id") == F.col("k_id"))
    asked = kept.select("k_source").distinct()
    source = records(df.filter(flag_clear(codes.NOT_PRIMARY)).join(asked, F.col("aln_id") == F.col("k_source"), "left_semi"))
    source = source.select(F.col("aln_id").alias("p_id"), S.plus_seq("seq", "flag").alias("p_seq"), S.plus_qual("qual", "flag").alias("p_qual"))
    kept = own.join(source, F.col("k_source") == F.col("p_id"), "left")
    seqless = F.col("k_source").isNotNull()
    turned = F.when(S.is_reverse("flag"), S.revcomp("p_seq")).otherwise(F.col("p_seq"))
    turned_qual = F.when(S.is_reverse("flag"), F.reverse("p_qual")).otherwise(F.col("p_qual"))
    kept = kept.withColumn("qual", F.when(seqless, S.hard_trim_qual(turned_qual, "cigar")).otherwise(F.col("qual")))
    kept = kept.withColumn("seq", F.when(seqless, S.hard_trim(turned, "cigar")).otherwise(F.col("seq")))
    kept = kept.withColumn("md", F.lit(None).cast("string")).withColumn("nm", F.lit(None).cast("bigint"))
    return primary.unionByName(kept.select(*primary.columns))


def read_limits(spark) -> DataFrame:  # noqa: ANN001
    rows = [(p, *v) for p, v in codes.READ_LIMITS.items()]
    return spark.createDataFrame(rows, "lim_platform string, loose_ratio double, loose_len int, strict_ratio double, strict_len int, trust int")


def usable_reads(df: DataFrame, min_mq: int = 1) -> DataFrame:
    """Reads that may be encoded: mapped, no duplicates; other than short reads also primary and with mapq >= min_mq; within the loose limits.

    Adds aln_len, clip_len, clip_ratio, backbone (the strict limits) and trust. PACBIO is read with the HIFI limits. The limits are three rows, broadcast.
    """
    r = df.filter(flag_clear(codes.UNMAPPED | codes.DUPLICATE) & F.col("contig").isNotNull() & (F.size("cigar") > 0))
    r = r.filter((F.col("platform") == "ILLUMINA") | (flag_clear(codes.NOT_PRIMARY) & (F.col("mapq") >= min_mq)))
    lim = F.broadcast(read_limits(df.sparkSession))
    r = r.join(lim, F.when(F.col("platform") == "PACBIO", "HIFI").otherwise(F.col("platform")) == F.col("lim_platform"))
    r = r.withColumn("aln_len", S.aligned_len("cigar")).withColumn("clip_len", S.clip_len("cigar")).withColumn("clip_ratio", S.clip_ratio("cigar"))
    r = r.filter("aln_len >= loose_len and clip_ratio <= loose_ratio")
    return r.withColumn("backbone", F.expr("clip_ratio <= strict_ratio and clip_len < strict_len")).drop("lim_platform", "loose_ratio", "loose_len", "strict_ratio", "strict_len")


def filtered_table(df: DataFrame) -> DataFrame:
    return materialize(filter_alignments(df), "filtered")
