"""Queries over depth and pileups."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import depth as D
from strandline.operators import pileup as P
from strandline.plans.alignment_queries import _WALK
from strandline.runtime import materialize, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


_RUNS = """r as (select distinct aln_id, a.contig, start0, least(end0, len) as end0 from alignments a join contigs c on a.contig = c.contig where (flag & 2308) = 0),
    ev as (select contig, pos, sum(d) as d from (select contig, start0 as pos, 1 as d from r where end0 > start0 union all select contig, end0, -1 from r where end0 > start0) group by 1, 2 having sum(d) <> 0),
    runs as (select * from (select contig, pos as start, lead(pos) over w as "end", sum(d) over w as depth from ev window w as (partition by contig order by pos)) where depth > 0 and "end" is not null)"""
_HIST = f"""{_RUNS}, hist as (select depth, sum(n)::bigint as n from (select least(depth, 1000)::bigint as depth, "end" - start as n from runs
    union all select 0, c.len - x.n from (select contig, sum("end" - start) as n from runs group by 1) x join contigs c using (contig)) group by 1)"""
_STATS = f"""{_HIST}, st as (select sum(depth * n)::double / sum(n) as mean, greatest(1, min(case when cum >= total / 2::double then depth end)) as median
    from (select *, sum(n) over (order by depth) as cum, sum(n) over () as total from hist))"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return D.depth_runs(table(spark, d, "alignments"), table(spark, d, "contigs"))


@query("agg_depth", f'with {_RUNS} select contig, start, "end", depth::bigint as depth from runs')
def agg_depth(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d)


@query("win_cumsum", f'with {_RUNS} select contig, start, "end", sum(depth * ("end" - start)) over (partition by contig order by start)::bigint as bases from runs')
def win_cumsum(spark: SparkSession, d: str) -> DataFrame:
    """Aligned bases up to the end of each run of a contig, summed run block by run block."""
    from strandline.runtime import sum_before

    r = _runs(spark, d).withColumn("here", F.col("depth") * (F.col("end") - F.col("start")))
    return sum_before(r, ["contig"], "start", "here", "past", 1 << 20).select("contig", "start", "end", (F.col("past") + F.col("here")).cast("bigint").alias("bases"))


def _hist(spark: SparkSession, d: str) -> DataFrame:
    return D.depth_histogram(materialize(_runs(spark, d), "runs"), table(spark, d, "contigs"))


@query("agg_hist", f"with {_HIST} select depth, n from hist")
def agg_hist(spark: SparkSession, d: str) -> DataFrame:
    return _hist(spark, d)


@query("agg_global_merge", "select raw_depth as depth, count(*) as n from (select distinct archive_id, contig, pos, least(raw_depth, 1000) as raw_depth from depth_norm where raw_depth >= 0) group by 1")
def agg_global_merge(spark: SparkSession, d: str) -> DataFrame:
    """One histogram from those of the archives."""
    m = table(spark, d, "depth_norm").filter("raw_depth >= 0").select("archive_id", "contig", "pos", F.least("raw_depth", F.lit(1000)).alias("depth")).distinct()
    return m.groupBy("archive_id", "depth").agg(F.count("*").alias("n")).groupBy("depth").agg(F.sum("n").alias("n"))


@query("agg_mean", f"with {_STATS} select round(mean, 6) as mean from st")
def agg_mean(spark: SparkSession, d: str) -> DataFrame:
    return D.depth_stats(_hist(spark, d)).select(F.round("mean", 6).alias("mean"))


@query("agg_median_disc", f"with {_STATS} select median::bigint as median from st")
def agg_median_disc(spark: SparkSession, d: str) -> DataFrame:
    return D.depth_stats(_hist(spark, d)).select(F.col("median").cast("bigint").alias("median"))


@query("stage_depth", f"""with {_STATS} select contig, start, "end", round(greatest(-1, least(3, depth::double / (select median from st) - 1)), 4) as norm from runs""")
def stage_depth(spark: SparkSession, d: str) -> DataFrame:
    """The depth stage as a whole: normalised depth by runs."""
    runs = materialize(_runs(spark, d), "runs")
    median = D.depth_stats(D.depth_histogram(runs, table(spark, d, "contigs"))).first()["median"]
    return D.normalised(runs, median or 1).withColumn("norm", F.round("norm", 4))


_PILE = f"""pr as (select distinct on (aln_id) aln_id, a.contig, start0, flag, mapq, cigar, upper(a.seq) as seq, qual, platform, upper(c.seq) as cseq from alignments a join contigs c on a.contig = c.contig
    where (flag & 3332) = 0 and mapq >= 1 and length(a.seq) > 0 and len(qual) > 0 and length(c.seq) > 0), {_WALK.format(keep='aln_id', src='pr', key='aln_id')},
    o3 as (select pr.contig, platform, (flag & 16) <> 0 as rev, mapq, seq, qual, cseq, op, len, case when op = 'I' then ref_pos - 1 else ref_pos end as p0, q, unnest(range(0, case when op = 'I' then 1 else len end)) as k from ops join pr using (aln_id) where contains('M=XID', op)),
    cl as (select contig, platform, rev, mapq, p0 + k as pos, op in ('I', 'D') as indel, op not in ('I', 'D') and substr(cseq, p0 + k + 1, 1) <> substr(seq, q + k + 1, 1) as mis, qual[q + k + 1] as bq,
    case op when 'I' then coalesce(list_avg(qual[q + 1 : q + len]), 0) when 'D' then coalesce(list_avg(qual[greatest(q, 1) : q + 1]), 0) end as mean_bq from o3 where p0 >= 0 and p0 + k < length(cseq)),
    pile as (select contig, pos, platform, count(*) filter (not indel and not mis and not rev) as match_f, count(*) filter (not indel and not mis and rev) as match_r, count(*) filter (mis and not rev) as mis_f, count(*) filter (mis and rev) as mis_r,
    count(*) filter (indel and not rev) as indel_f, count(*) filter (indel and rev) as indel_r, coalesce(sum(bq) filter (mis), 0)::double as mis_bq, coalesce(sum(mapq) filter (mis), 0)::double as mis_mq,
    coalesce(sum(mean_bq) filter (indel), 0)::double as indel_bq, coalesce(sum(mapq) filter (indel), 0)::double as indel_mq, count(*) filter (mis) as n_mis, count(*) filter (indel) as n_indel from cl group by 1, 2, 3)"""


def _pile(spark: SparkSession, d: str) -> DataFrame:
    return P.pileup(table(spark, d, "alignments"), table(spark, d, "contigs"))


@query("agg_pileup12", f"with {_PILE} select * replace (round(mis_bq, 3) as mis_bq, round(indel_bq, 3) as indel_bq) from pile")
def agg_pileup12(spark: SparkSession, d: str) -> DataFrame:
    return _pile(spark, d).withColumn("mis_bq", F.round("mis_bq", 3)).withColumn("indel_bq", F.round("indel_bq", 3))


@query("jn_pos_ref", f"with {_PILE} select contig, pos, count(*) as n, count(*) filter (mis) as n_mis from cl where not indel group by 1, 2")
def jn_pos_ref(spark: SparkSession, d: str) -> DataFrame:
    """Read bases against the reference base at their position."""
    p = _pile(spark, d).groupBy("contig", "pos").agg(F.sum(F.col("match_f") + F.col("match_r") + F.col("mis_f") + F.col("mis_r")).alias("n"), F.sum("n_mis").alias("n_mis"))
    return p.filter("n > 0")


_DUAL = _PILE + ", du as (select contig, pos, " + ", ".join(f"sum(case when platform {op} 'ILLUMINA' then {c} else 0 end) as {k}_{c}" for k, op in (("i", "="), ("o", "<>")) for c in P.SUMS) + " from pile group by 1, 2)"
_FEAT = _DUAL + """, lo as (select *, i_n_mis + i_n_indel as i_alt, o_n_mis + o_n_indel as o_alt, (sum(i_n_mis + i_n_indel) over w - i_n_mis - i_n_indel) / 20.0::double as i_local, (sum(o_n_mis + o_n_indel) over w - o_n_mis - o_n_indel) / 20.0::double as o_local
    from du window w as (partition by contig order by pos range between 10 preceding and 10 following))"""


@query("jn_dual_platform", f"with {_DUAL} select contig, pos, i_match_f::bigint as i_match_f, i_n_mis::bigint as i_n_mis, o_match_f::bigint as o_match_f, o_n_mis::bigint as o_n_mis, o_n_indel::bigint as o_n_indel from du")
def jn_dual_platform(spark: SparkSession, d: str) -> DataFrame:
    return P.dual(_pile(spark, d)).select("contig", "pos", "i_match_f", "i_n_mis", "o_match_f", "o_n_mis", "o_n_indel")


@query("win_local_alt", f"with {_FEAT} select contig, pos, round(i_local, 4) as i_local, round(o_local, 4) as o_local from lo")
def win_local_alt(spark: SparkSession, d: str) -> DataFrame:
    return P.local_alt(P.dual(_pile(spark, d))).select("contig", "pos", F.round("i_local", 4).alias("i_local"), F.round("o_local", 4).alias("o_local"))


@query("flt_candidate_mask", f"with {_FEAT} select contig, pos, i_alt::bigint as i_alt, o_alt::bigint as o_alt from lo where i_alt >= 2 or o_alt >= 2")
def flt_candidate_mask(spark: SparkSession, d: str) -> DataFrame:
    return P.local_alt(P.dual(_pile(spark, d))).filter("i_alt >= 2 or o_alt >= 2").select("contig", "pos", "i_alt", "o_alt")


_REF = "rb as (select contig, u.i - 1 as pos, u.b as b from (select contig, unnest(list_transform(string_split(upper(seq), ''), lambda b, i: {'i': i, 'b': b})) as u from contigs where length(seq) > 0))"
_GC = _REF + ", gc as (select contig, pos, avg(case when b in ('G', 'C') then 1.0::double else 0 end) over (partition by contig order by pos rows between 10 preceding and 10 following) as gc from rb)"
_REP = _REF + "".join(
    f""", r{k} as (select contig, s, e from (select contig, min(pos) as s, max(pos) + {k} as e from (select contig, pos, pos - row_number() over (partition by contig order by pos) as g from
    (select contig, pos, b = lead(b, {k}) over (partition by contig order by pos) as same from rb) where same) group by contig, g))"""
    for k in (1, 2, 3)
) + """, rp as (select contig, pos, max(n)::int as repeat_len from (select contig, pos, 1 as n from rb union all select contig, unnest(range(s, e + 1)), e - s + 1 from (select * from r1 union all select * from r2 union all select * from r3)) group by 1, 2)"""


@query("win_gc", f"with {_GC} select contig, pos, round(gc, 4) as gc from gc")
def win_gc(spark: SparkSession, d: str) -> DataFrame:
    return P.gc_content(table(spark, d, "contigs")).withColumn("gc", F.round("gc", 4))


@query("win_repeat", f"with {_REP} select contig, pos, repeat_len from rp")
def win_repeat(spark: SparkSession, d: str) -> DataFrame:
    return P.repeats(table(spark, d, "contigs"))


def _features_sql(rounded: bool = True) -> str:
    sql = _rounded_features_sql()
    return sql if rounded else re.sub(r"round\((.*?), [34]\) as", r"\1 as", sql)


def _rounded_features_sql() -> str:
    cols = []
    for k in ("i", "o"):
        depth = "(" + " + ".join(f"{k}_{c}" for c in P.SUMS[:6]) + ")"
        cols.append(f"{depth}::double as depth_{k}")
        for kind, f, r, bq, mq, n in (("snp", "mis_f", "mis_r", "mis_bq", "mis_mq", "n_mis"), ("ind", "indel_f", "indel_r", "indel_bq", "indel_mq", "n_indel")):
            cols += [
                f"round({k}_{n} / ({depth} + 1e-6), 4) as {kind}_vaf_{k}", f"round(least({k}_{f}, {k}_{r}) / ({k}_{f} + {k}_{r} + 1e-6), 4) as {kind}_sb_{k}",
                f"round({k}_{bq} / ({k}_{n} + 1e-6), 3) as {kind}_bq_{k}", f"round({k}_{mq} / ({k}_{n} + 1e-6), 3) as {kind}_mq_{k}",
            ]
    gc, rep = _GC.removeprefix(_REF + ", "), _REP.removeprefix(_REF)
    return f"""with {_FEAT}, {_REF}, {gc}{rep} select lo.contig, lo.pos, {', '.join(cols)}, round(i_local, 4) as local_i, round(o_local, 4) as local_o, round(gc, 4) as gc, repeat_len::double as repeat_len
        from lo join gc on gc.contig = lo.contig and gc.pos = lo.pos join rp on rp.contig = lo.contig and rp.pos = lo.pos where i_alt >= 2 or o_alt >= 2"""


@query("prj_features", _features_sql())
def prj_features(spark: SparkSession, d: str) -> DataFrame:
    f = P.features(_pile(spark, d), table(spark, d, "contigs"))
    digits = lambda c: 3 if "_bq_" in c or "_mq_" in c else 4
    return f.select("contig", "pos", *[F.col(c) if c.startswith("depth") or c == "repeat_len" else F.round(c, digits(c)).alias(c) for c in f.columns[2:]])


_SIX = " + ".join(P.SUMS[:6])


def _each(spark: SparkSession, d: str, *cols) -> DataFrame:  # noqa: ANN002
    return _pile(spark, d).select("contig", "pos", "platform", *cols)


@query("fn_pos_depth6", f"with {_PILE} select contig, pos, platform, ({_SIX})::bigint as depth from pile")
def fn_pos_depth6(spark: SparkSession, d: str) -> DataFrame:
    return _each(spark, d, P.depth6(F.col).alias("depth"))


@query("fn_vaf", f"with {_PILE} select contig, pos, platform, round(n_mis / ({_SIX} + 1e-6), 4) as snp_vaf, round(n_indel / ({_SIX} + 1e-6), 4) as ind_vaf from pile")
def fn_vaf(spark: SparkSession, d: str) -> DataFrame:
    return _each(spark, d, *[F.round(P.vaf(F.col(n), P.depth6(F.col)), 4).alias(f"{k}_vaf") for k, (*_, n) in P.KINDS.items()])


@query("fn_strand_bias", f"with {_PILE} select contig, pos, platform, round(least(mis_f, mis_r) / (mis_f + mis_r + 1e-6), 4) as snp_sb, round(least(indel_f, indel_r) / (indel_f + indel_r + 1e-6), 4) as ind_sb from pile")
def fn_strand_bias(spark: SparkSession, d: str) -> DataFrame:
    return _each(spark, d, *[F.round(P.strand_bias(F.col(f), F.col(r)), 4).alias(f"{k}_sb") for k, (f, r, *_) in P.KINDS.items()])


@query("fn_mean_q", f"with {_PILE} select contig, pos, platform, round(mis_bq / (n_mis + 1e-6), 3) as snp_bq, round(mis_mq / (n_mis + 1e-6), 3) as snp_mq, round(indel_bq / (n_indel + 1e-6), 3) as ind_bq, round(indel_mq / (n_indel + 1e-6), 3) as ind_mq from pile")
def fn_mean_q(spark: SparkSession, d: str) -> DataFrame:
    return _each(spark, d, *[F.round(P.mean_quality(F.col(q), F.col(n)), 3).alias(f"{k}_{name}") for k, (_, _, bq, mq, n) in P.KINDS.items() for name, q in (("bq", bq), ("mq", mq))])
