"""One query for each scalar function, over whole tables, with its SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline import codes
from strandline.functions import probability as P
from strandline.functions import sequence as S
from strandline.operators.pileup import reference_chunks
from strandline.runtime import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def on_alignments(name: str, sql: str, **cols) -> None:  # noqa: ANN003
    """Columns as functions of nothing: none may be made before there is a session."""
    QUERIES[name] = lambda spark, d: table(spark, d, "alignments").select("aln_id", *[c().alias(k) for k, c in cols.items()])
    ORACLE[name] = f"select aln_id, {sql} from alignments"


def sql_sum(ops: str, cigar: str = "cigar") -> str:
    return f"case when {cigar} is not null then coalesce(list_sum(list_transform(list_filter({cigar}, lambda c: contains('{ops}', c.op)), lambda c: c.len)), 0)::bigint end"


_REVCOMP = "reverse(translate({0}, 'ACGTUacgtu', 'TGCAAtgcaa'))"
_H = "coalesce(list_sum(list_transform(list_filter(list_zip({0}, range(len({0}))), lambda z: z[2] < coalesce(list_position(list_transform({0}, lambda c: c.op <> 'H'), true), len({0}) + 1) - 1), lambda z: z[1].len)), 0)::bigint"
_LEAD, _TRAIL = _H.format("cigar"), _H.format("list_reverse(cigar)")
_CLIP = """case when {0}[{1}].op = 'H' then {0}[{1}].len + case when {0}[{2}].op = 'S' then {0}[{2}].len else 0 end when {0}[{1}].op = 'S' then {0}[{1}].len else 0 end"""
SQL_CLIP = f"(({_CLIP.format('cigar', 1, 2)}) + ({_CLIP.format('list_reverse(cigar)', 1, 2)}))::bigint"
SQL_MD = "len(regexp_extract_all(replace(regexp_replace(md, '[0-9]*[1-9][0-9]*', '|', 'g'), '0', ''), '[^|]+'))::int"

on_alignments("fn_revcomp", f"{_REVCOMP.format('seq')} as rc", rc=lambda: S.revcomp("seq"))
on_alignments(
    "fn_orient", f"case when (flag & 16) <> 0 then {_REVCOMP.format('seq')} else seq end as plus_seq, case when (flag & 16) <> 0 then list_reverse(qual) else qual end as plus_qual",
    plus_seq=lambda: S.plus_seq("seq", "flag"), plus_qual=lambda: S.plus_qual("qual", "flag"),
)
on_alignments(
    "fn_hardclip_trim", f"case when {_LEAD} >= length(seq) - {_TRAIL} then '' else substr(seq, {_LEAD} + 1, length(seq) - {_LEAD} - {_TRAIL}) end as trimmed",
    trimmed=lambda: S.hard_trim("seq", "cigar"),
)
on_alignments("fn_md_condensed", f"{SQL_MD} as runs", runs=lambda: S.condensed_mismatches("md"))
on_alignments(
    "fn_cigar_parse", "array_to_string(list_transform(cigar, lambda c: c.len::varchar || c.op), '') as cigar_text, len(cigar)::int as n_ops, list_sum(list_transform(cigar, lambda c: c.len))::bigint as total_len",
    cigar_text=lambda: S.cigar_text("cigar"), n_ops=lambda: F.size(S.parse_cigar(S.cigar_text("cigar"))), total_len=lambda: S.cigar_sum(S.parse_cigar(S.cigar_text("cigar")), "MIDNSHP=X"),
)
on_alignments("fn_ref_end", f"start0 + {sql_sum('MDN=X')} as ref_end", ref_end=lambda: S.ref_end("start0", "cigar"))
on_alignments("fn_aln_len", f"{sql_sum('MI=X')} as aln_len", aln_len=lambda: S.aligned_len("cigar"))
on_alignments("fn_read_len", f"{sql_sum('MISH=X')} as read_len", read_len=lambda: S.read_len("cigar"))
on_alignments("fn_clip_len", f"{SQL_CLIP} as clip_len", clip_len=lambda: S.clip_len("cigar"))
on_alignments("fn_clip_ratio", f"{SQL_CLIP}::double / nullif({sql_sum('MISH=X')}, 0) as clip_ratio", clip_ratio=lambda: S.clip_ratio("cigar"))
on_alignments("fn_int_tag", "coalesce(try_cast(md as bigint), 0) as tag", tag=lambda: S.int_tag("md"))
on_alignments("fn_mapq_code", "case when mapq = 255 then 0 else mapq end as code", code=lambda: S.mapq_code("mapq"))
on_alignments("fn_quality_norm", "case when mapq >= 0 then (case when mapq = 255 then 0 else mapq end) / 60.0::double else mapq end as mq_norm", mq_norm=lambda: F.when(F.col("mapq") >= 0, S.mapq_code("mapq") / F.lit(60.0)).otherwise(F.col("mapq")))
on_alignments("prj_drop_tags", "case when (flag & 2304) = 0 then md end as md, case when (flag & 2304) = 0 then nm end as nm, as_score", md=lambda: F.when(F.col("flag").bitwiseAND(codes.NOT_PRIMARY) == 0, F.col("md")), nm=lambda: F.when(F.col("flag").bitwiseAND(codes.NOT_PRIMARY) == 0, F.col("nm")), as_score=lambda: F.col("as_score"))


@query("fn_hash_id")
def fn_hash_id(spark: SparkSession, d: str) -> DataFrame:
    """The standard 64-bit xxHash with seed 0 of read names, signed, for exchange with files that carry it."""
    @F.pandas_udf(T.LongType())
    def xxh(s: pd.Series) -> pd.Series:
        import xxhash

        return pd.Series(np.array([xxhash.xxh64_intdigest(x or "") for x in s], np.uint64).view(np.int64))

    return table(spark, d, "alignments").select("aln_id", F.when(F.col("qname").isNotNull(), xxh("qname")).alias("rid"))


@query("fn_upper", "select contig, upper(seq) as seq from contigs")
def fn_upper(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contigs").select("contig", F.upper("seq").alias("seq"))


@query("fn_base_code", """select contig, case upper(b) when 'A' then 0 when 'C' then 1 when 'G' then 2 when 'T' then 3 else 4 end as code, count(*) as n
    from (select contig, unnest(string_split(seq, '')) as b from contigs) group by all""")  # fmt: skip
def fn_base_code(spark: SparkSession, d: str) -> DataFrame:
    b = reference_chunks(table(spark, d, "contigs"), 4096).select("contig", F.explode(F.split("chunk", "")).alias("b"))
    return b.groupBy("contig", S.base_code("b").alias("code")).agg(F.count("*").alias("n"))


@query("fn_cigar_walk", """with o as (select aln_id, start0, u.i as i, u.c.op as op, u.c.len as len from (select distinct aln_id, start0, cigar, unnest(list_transform(cigar, lambda c, i: {'i': i - 1, 'c': c})) as u from alignments))
    select aln_id, i::int as i, op, len, start0 + coalesce(sum(case when contains('MDN=X', op) then len else 0 end) over w, 0)::bigint as ref_pos,
    coalesce(sum(case when contains('MIS=X', op) then len else 0 end) over w, 0)::bigint as query_pos from o window w as (partition by aln_id order by i rows between unbounded preceding and 1 preceding)""")  # fmt: skip
def fn_cigar_walk(spark: SparkSession, d: str) -> DataFrame:
    return S.walk_ops(table(spark, d, "alignments").dropDuplicates(["aln_id"]), ["aln_id"])


_OPS = """o as (select aln_id, qual, flag, hl, rl, i, op, len, coalesce(sum(case when contains('MIS=X', op) then len else 0 end) over (partition by aln_id order by i rows between unbounded preceding and 1 preceding), 0)::bigint as q
    from (select aln_id, qual, flag, hl, rl, u.i as i, u.c.op as op, u.c.len as len from (select distinct aln_id, qual, flag, case when cigar[1].op = 'H' then cigar[1].len else 0 end as hl, """ + sql_sum("MISH=X") + """ as rl,
    cigar, unnest(list_transform(cigar, lambda c, i: {'i': i - 1, 'c': c})) as u from alignments)))"""  # fmt: skip


def _ops(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    a = table(spark, d, "alignments").dropDuplicates(["aln_id"])
    a = a.withColumn("hl", F.when(F.col("cigar")[0]["op"] == "H", F.col("cigar")[0]["len"]).otherwise(0)).withColumn("rl", S.read_len("cigar"))
    return S.walk_ops(a, ["aln_id", *keep])


@query("fn_avg_ins_bq", f"with {_OPS} select aln_id, i::int as i, round(coalesce(list_avg(qual[q + 1 : q + len]), 0), 4) as avg_bq from o where op = 'I' and len(qual) > 0")
def fn_avg_ins_bq(spark: SparkSession, d: str) -> DataFrame:
    o = _ops(spark, d, "qual").filter("op = 'I' and size(qual) > 0").withColumn("b", F.expr("slice(qual, int(query_pos) + 1, len)"))
    mean = F.aggregate("b", F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("b"), F.lit(0))
    return o.select("aln_id", "i", F.round(F.coalesce(mean, F.lit(0.0)), 4).alias("avg_bq"))


@query("fn_flank_bq", f"with {_OPS} select aln_id, i::int as i, round(coalesce(list_avg(qual[greatest(q, 1) : q + 1]), 0), 4) as avg_bq from o where op = 'D' and len(qual) > 0")
def fn_flank_bq(spark: SparkSession, d: str) -> DataFrame:
    """Mean quality of the bases on either side of a deletion; at an end of the read of the one there is."""
    o = _ops(spark, d, "qual").filter("op = 'D' and size(qual) > 0").withColumn("b", F.expr("slice(qual, int(greatest(query_pos, 1L)), if(query_pos > 0, 2, 1))"))
    mean = F.aggregate("b", F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("b"), F.lit(0))
    return o.select("aln_id", "i", F.round(F.coalesce(mean, F.lit(0.0)), 4).alias("avg_bq"))


@query("fn_rel_pos", f"with {_OPS} select aln_id, i::int as i, round((case when (flag & 16) <> 0 then -1 else 1 end) * ((q + hl)::double / rl * 2 - 1), 6) as rel_pos from o where contains('MID=X', op) and rl > 0")
def fn_rel_pos(spark: SparkSession, d: str) -> DataFrame:
    """Where an operation begins in the read as sequenced, from -1 to 1, turned for the reverse strand."""
    o = _ops(spark, d, "flag", "hl", "rl").filter(F.col("op").isin("M", "I", "D", "=", "X") & (F.col("rl") > 0))
    rel = (F.col("query_pos") + F.col("hl")) / F.col("rl") * 2 - 1
    return o.select("aln_id", "i", F.round(F.when(S.is_reverse("flag"), -1).otherwise(1) * rel, 6).alias("rel_pos"))


@query("fn_norm_depth", """select distinct archive_id, contig, pos, raw_depth, round(greatest(-1, least(3, raw_depth / greatest(global_median, 1) - 1)), 4) as norm
    from depth_norm join depth_meta using (archive_id) where raw_depth >= 0""")  # fmt: skip
def fn_norm_depth(spark: SparkSession, d: str) -> DataFrame:
    meta = table(spark, d, "depth_meta").select("archive_id", "global_median")
    raw = table(spark, d, "depth_norm").filter("raw_depth >= 0").select("archive_id", "contig", "pos", "raw_depth").distinct().join(meta, "archive_id")
    norm = F.greatest(F.lit(-1.0), F.least(F.lit(3.0), F.col("raw_depth") / F.greatest("global_median", F.lit(1.0)) - 1))
    return raw.select("archive_id", "contig", "pos", "raw_depth", F.round(norm, 4).alias("norm"))


@query("fn_downsample_ratio", "select archive_id, round(least(30.0::double / nullif(global_median, 0), 1), 6) as ratio from depth_meta")
def fn_downsample_ratio(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "depth_meta").select("archive_id", F.round(F.least(F.lit(30.0) / F.nullif("global_median", F.lit(0.0)), F.lit(1.0)), 6).alias("ratio"))


@query("fn_softmax", """select vec_id, list_transform(e, lambda v: round(v / list_sum(e), 4)) as probs from (
    select vec_id, list_transform(x, lambda v: exp(v - list_max(x))) as e from (select vec_id, list_transform(embedding[1:6], lambda v: v::double * 8) as x from embeddings))""")  # fmt: skip
def fn_softmax(spark: SparkSession, d: str) -> DataFrame:
    x = F.transform(F.slice("embedding", 1, 6), lambda v: v.cast("double") * 8)
    return table(spark, d, "embeddings").select("vec_id", F.transform(P.softmax(x), lambda v: F.round(v, 4)).alias("probs"))


@query("fn_sigmoid", "select vec_id, round(1 / (1 + exp(-20 * embedding[7]::double)), 4) as p from embeddings")
def fn_sigmoid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(P.sigmoid(F.col("embedding")[6].cast("double") * 20), 4).alias("p"))


@query("fn_gap_to_del", "select distinct batch_id, list_transform(ref_seq, lambda v: case when v = 6 then 5 else v end)::int[] as ref_seq from encoded_batches")
def fn_gap_to_del(spark: SparkSession, d: str) -> DataFrame:
    turned = F.transform("ref_seq", lambda v: F.when(v == codes.INSERTION_COLUMN, codes.DELETION).otherwise(v.cast("int")))
    return table(spark, d, "encoded_batches").dropDuplicates(["batch_id"]).select("batch_id", turned.alias("ref_seq"))


@query("fn_prefix_trunc", "select distinct batch_id, case when len(target_cols) > 0 then ref_seq[1 : list_max(target_cols) + 1] else [] end::int[] as ref_seq from encoded_batches where ref_seq is not null")
def fn_prefix_trunc(spark: SparkSession, d: str) -> DataFrame:
    """The sequence up to its last target column; nothing where there is no target."""
    e = table(spark, d, "encoded_batches").filter("ref_seq is not null").dropDuplicates(["batch_id"])
    return e.select("batch_id", F.slice("ref_seq", F.lit(1), F.coalesce(F.array_max("target_cols") + 1, F.lit(0))).cast("array<int>").alias("ref_seq"))


@query("fn_round_up", """select platform, greatest(ceil(max(case when mapq <> 255 then mapq end) / 10.0) * 10, 60)::bigint as mq_max, greatest(ceil(max(list_max(qual)) / 5.0) * 5, 40)::bigint as bq_max from alignments group by 1""")
def fn_round_up(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "alignments").groupBy("platform").agg(F.max(F.when(F.col("mapq") != 255, F.col("mapq"))).alias("mq"), F.max(F.array_max("qual")).alias("bq"))
    return a.select("platform", S.round_up(F.col("mq"), 10, 60).alias("mq_max"), S.round_up(F.col("bq"), 5, 40).alias("bq_max"))
