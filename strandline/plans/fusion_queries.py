"""Queries over prediction windows: sites, votes, read identity, fusion and variants."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import probability as P
from strandline.operators import fusion as U
from strandline.runtime import materialize, scratch_dir, table
from strandline.sources import text as X

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def _windows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prediction_windows")


def _sites(spark: SparkSession, d: str) -> DataFrame:
    return U.sites(_windows(spark, d))


_SITE = """wd as (select distinct on (window_id) * from prediction_windows where ref_seq is not null and len(sites) > 0),
    st as (select window_id, chrom, u.i - 1 as ord, u.s.pos as pos, u.s."offset" as off, u.s.p_base as p_base, u.s.p_het as p_het, u.s.reads as reads, ref_seq[u.s."offset" + 1] as ref
    from (select window_id, chrom, ref_seq, unnest(list_transform(sites, lambda s, i: {'i': i, 's': s})) as u from wd) where u.s."offset" >= 0 and u.s."offset" < len(ref_seq) and len(u.s.p_base) > 1),
    s2 as (select *, list_position(p_base, list_max(p_base)) - 1 as am, list_transform(list_reverse(list_sort(list_transform(p_base, lambda v, i: {'v': v, 'i': i - 1}))), lambda z: z.i) as ranked from st)"""
_VOTE = """vt as (select window_id, ord, r.rid as rid, case when r.base = 6 then 5 else r.base end as base from (select window_id, ord, unnest(reads) as r from st) where r.rid <> 0 and r.base between 0 and 6)"""
_IDENT = f"""{_SITE}, {_VOTE}, ids as (select * from (select *, p_base[ref + 1] as p_ref, p_base[alt + 1] as p_alt from (select *, case when ranked[1] = ref then ranked[2] else ranked[1] end as alt from s2
    where p_het >= 0.7::float and ref < 4 and (ranked[1] = ref or ranked[2] = ref)) where alt < 4) where p_ref >= 0.3::float and p_alt >= 0.3::float),
    idn as (select rid, sum(p_het::double * case when base = ref then p_ref else -p_ref end::double) as delta_sum, sum(p_het::double) as w_sum from ids join vt using (window_id, ord) where base in (ref, alt) group by 1),
    sco as (select *, case when w_sum > 0.1 then delta_sum / (w_sum + 1) end as score from idn)"""


@query("argmax_base", f"with {_SITE} select window_id, ord::int as ord, am::int as base from s2")
def argmax_base(spark: SparkSession, d: str) -> DataFrame:
    return _sites(spark, d).select("window_id", "ord", P.argmax(F.col("p_base")).alias("base"))


@query("top2_base", f"with {_SITE} select window_id, ord::int as ord, ranked[1]::int as first, ranked[2]::int as second from s2")
def top2_base(spark: SparkSession, d: str) -> DataFrame:
    t = P.top2(F.col("p_base"))
    return _sites(spark, d).select("window_id", "ord", t[0].alias("first"), t[1].alias("second"))


@query("fn_margin", f"with {_SITE} select window_id, ord::int as ord, round(list_sort(p_base, 'DESC')[1]::double - list_sort(p_base, 'DESC')[2]::double, 5) as margin from st")
def fn_margin(spark: SparkSession, d: str) -> DataFrame:
    return _sites(spark, d).select("window_id", "ord", F.round(P.margin(F.col("p_base")), 5).alias("margin"))


@query("fn_phred", f"with {_SITE} select window_id, ord::int as ord, least(99, trunc(-10 * log10(greatest(1 - list_max(p_base)::double, 1e-10))))::int as qual from st")
def fn_phred(spark: SparkSession, d: str) -> DataFrame:
    return _sites(spark, d).select("window_id", "ord", P.phred(F.array_max("p_base")).alias("qual"))


@query("fn_genotype", f"with {_SITE} select window_id, ord::int as ord, case when p_het >= 0.5 then '0/1' else '1/1' end as gt from st")
def fn_genotype(spark: SparkSession, d: str) -> DataFrame:
    return _sites(spark, d).select("window_id", "ord", P.genotype(F.col("p_het")).alias("gt"))


_UNSURE = "us as (select * from s2 where not coalesce(am = ref and list_max(p_base) >= 0.8::float and p_het < 0.4::float, false))"


@query("flt_confident_ref", f"with {_SITE}, {_UNSURE} select window_id, ord::int as ord from us")
def flt_confident_ref(spark: SparkSession, d: str) -> DataFrame:
    return U.unsure(_sites(spark, d), F.lit(0.8).cast("float"), F.lit(0.4).cast("float")).select("window_id", "ord")


@query("flt_vote", f"with {_SITE}, {_VOTE} select window_id, ord::int as ord, rid, base from vt")
def flt_vote(spark: SparkSession, d: str) -> DataFrame:
    return U.votes(_sites(spark, d)).select("window_id", "ord", "rid", "base")


@query("flt_identity_site", f"with {_IDENT} select window_id, ord::int as ord, ref, alt::int as alt from ids")
def flt_identity_site(spark: SparkSession, d: str) -> DataFrame:
    return U.identity_sites(_sites(spark, d), F.lit(0.7).cast("float"), F.lit(0.3).cast("float")).select("window_id", "ord", "ref", F.col("alt").cast("int").alias("alt"))


def _identity(spark: SparkSession, d: str) -> DataFrame:
    return U.read_identity(_sites(spark, d), F.lit(0.7).cast("float"), F.lit(0.3).cast("float"))


@query("agg_identity", f"with {_IDENT} select rid, round(delta_sum, 4) as delta_sum, round(w_sum, 4) as w_sum from idn")
def agg_identity(spark: SparkSession, d: str) -> DataFrame:
    return _identity(spark, d).select("rid", F.round("delta_sum", 4).alias("delta_sum"), F.round("w_sum", 4).alias("w_sum"))


@query("agg_score", f"with {_IDENT} select rid, round(score, 4) as score, round(w_sum, 4) as coverage from sco")
def agg_score(spark: SparkSession, d: str) -> DataFrame:
    return _identity(spark, d).select("rid", F.round("score", 4).alias("score"), F.round("w_sum", 4).alias("coverage"))


#: Haplotype clusters for the test tables: every voting read by a residue of its id, as there is no haplotype file among them.
_CLU = "clu as (select rid, min(((rid % 97) + 97) % 97) as cluster from vt group by 1)"
_MED = f"{_IDENT}, {_CLU}, med as (select cluster, median(score) as median, count(*) as n from clu join sco using (rid) where score is not null group by 1)"


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    return U.votes(_sites(spark, d)).select("rid", F.pmod("rid", F.lit(97)).alias("cluster")).distinct()


@query("agg_cluster_median", f"with {_MED} select cluster, round(median, 4) as median, n from med")
def agg_cluster_median(spark: SparkSession, d: str) -> DataFrame:
    x = _identity(spark, d).filter("score is not null").join(_clusters(spark, d), "rid")
    return U.cluster_medians(materialize(x, "clustered")).select("cluster", F.round("median", 4).alias("median"), "n")


@query("jn_cluster_scores", f"""with {_MED} select rid, round(case when median >= 0 then abs(coalesce(score, median)) when median < 0 then -abs(score) else score end, 4) as score,
    round(coalesce(w_sum, case when median is not null then 1 end), 4) as coverage from clu left join sco using (rid) left join med using (cluster) where score is not null or w_sum is not null or median is not null""")  # fmt: skip
def jn_cluster_scores(spark: SparkSession, d: str) -> DataFrame:
    r = U.resign(_identity(spark, d), _clusters(spark, d))
    return r.select("rid", F.round("score", 4).alias("score"), F.round("coverage", 4).alias("coverage"))


_W = "case when score is null then 0.1::double else exp(greatest(-20, least(20, score * 3))) * ln(1 + w_sum) end"
_FUSED = f"""{_IDENT}, {_UNSURE}, pri as (select window_id, ord, {', '.join(f'sum(case when base = {b} then {_W} else 0 end) as w{b}' for b in range(6))} from vt left join sco using (rid) group by 1, 2),
    fu as (select *, case when plain then list_transform(p_base, lambda x: x::double) else list_transform(pw, lambda x: x / (list_sum(pw) + 1e-9)) end as fused from (
    select us.*, p_het < 0.7::float and list_sort(p_base, 'DESC')[1]::double - list_sort(p_base, 'DESC')[2]::double > 0.3 as plain, [{', '.join(f'p_base[{b + 1}]::double * (1 + coalesce(w{b}, 0))' for b in range(6))}] as pw from us left join pri using (window_id, ord))),
    fi as (select *, list_position(fused, list_max(fused)) - 1 as base, list_max(fused) as prob from fu)"""


@query("fn_vote_weight", f"with {_IDENT} select window_id, ord::int as ord, rid, base, round({_W}, 4) as w from vt left join sco using (rid)")
def fn_vote_weight(spark: SparkSession, d: str) -> DataFrame:
    """Every vote with the weight of its read."""
    v = U.votes(_sites(spark, d)).join(_identity(spark, d), "rid", "left")
    return v.select("window_id", "ord", "rid", "base", F.round(P.vote_weight(F.col("score"), F.col("w_sum")), 4).alias("w"))


def _fused(spark: SparkSession, d: str) -> DataFrame:
    scores = _identity(spark, d).select("rid", "score", F.col("w_sum").alias("coverage"))
    s = U.unsure(_sites(spark, d), F.lit(0.8).cast("float"), F.lit(0.4).cast("float"))
    return U.fused(s, scores, het=F.lit(0.7).cast("float"))


@query("jn_site_votes", f"with {_FUSED} select window_id, ord::int as ord, {', '.join(f'round(coalesce(w{b}, 0), 4) as w{b}' for b in range(6))} from us join pri using (window_id, ord)")
def jn_site_votes(spark: SparkSession, d: str) -> DataFrame:
    s = U.unsure(_sites(spark, d), F.lit(0.8).cast("float"), F.lit(0.4).cast("float"))
    v = U.votes(s).join(_identity(spark, d), "rid", "left").withColumn("w", P.vote_weight(F.col("score"), F.col("w_sum")))
    return v.groupBy("window_id", "ord").agg(*[F.round(F.sum(F.when(F.col("base") == b, F.col("w")).otherwise(0.0)), 4).alias(f"w{b}") for b in range(6)])


@query("fn_fuse", f"with {_FUSED} select window_id, ord::int as ord, list_transform(fused, lambda x: round(x, 4)) as fused, base::int as base from fi")
def fn_fuse(spark: SparkSession, d: str) -> DataFrame:
    return _fused(spark, d).select("window_id", "ord", F.transform("fused", lambda x: F.round(x, 4)).alias("fused"), "base")


_EVENT = f"""{_FUSED}, ev as (select window_id, chrom, off, pos, ref, base, prob, prob - p_base[ref + 1]::double as delta, p_het from (select *, row_number() over (partition by window_id, off order by ord desc) as r
    from fi where base <> ref and ref between 0 and 5) where r = 1),
    bl as (select *, sum(case when new then 1 else 0 end) over (partition by window_id order by off) as block from (select *, coalesce(pos <> lag(pos) over w and off <> lag(off) over w + 1, true) as new from ev window w as (partition by window_id order by off)))"""


@query("last_per_col", f"with {_EVENT} select window_id, off as \"offset\", pos::bigint as pos, ref, base::int as base, round(prob, 4) as prob, round(delta, 4) as delta from ev")
def last_per_col(spark: SparkSession, d: str) -> DataFrame:
    return U.events(_fused(spark, d)).select("window_id", "offset", "pos", "ref", "base", F.round("prob", 4).alias("prob"), F.round("delta", 4).alias("delta"))


@query("win_event_blocks", f"with {_EVENT} select window_id, off as \"offset\", block::bigint as block from bl")
def win_event_blocks(spark: SparkSession, d: str) -> DataFrame:
    return U.blocks(U.events(_fused(spark, d))).select("window_id", "offset", "block")


@query("agg_block_min", f"with {_EVENT} select window_id, block::bigint as block, round(least(1, min(prob)), 4) as prob, round(least(1, min(delta)), 4) as delta, round(avg(p_het), 4) as p_het from bl group by 1, 2")
def agg_block_min(spark: SparkSession, d: str) -> DataFrame:
    a = _alleles(spark, d)
    return a.select("window_id", "block", F.round("prob", 4).alias("prob"), F.round("delta", 4).alias("delta"), F.round("p_het", 4).alias("p_het"))


def _alleles(spark: SparkSession, d: str) -> DataFrame:
    return U.alleles(U.blocks(U.events(_fused(spark, d))), _windows(spark, d))


_LET = "substr('ACGTN- #', {0} + 1, 1)"
_ALLELE = f"""{_EVENT}, bk as (select window_id, block, min(off) as off, arg_min(pos, off) as first_pos, max(pos) as last_pos, arg_min(ref, off) as first_ref, coalesce(string_agg({_LET.format('ref')}, '' order by off) filter (ref <> 5), '') as rs,
    coalesce(string_agg({_LET.format('base')}, '' order by off) filter (base <> 5), '') as als, min(prob) as prob, min(delta) as delta, avg(p_het) as p_het from bl group by 1, 2),
    an as (select bk.*, chrom, coalesce({_LET.format('list_filter(ref_seq[1 : off], lambda c: c < 5)[-1]')}, 'N') as anchor from bk join wd using (window_id)),
    al as (select *, anchor || rs as r, anchor || als as a, first_pos + case when first_ref = 5 then 1 else 0 end as p0 from an),
    t1 as (select *, list_max(list_filter(range(0, least(length(r), length(a))), lambda k: right(r, k) = right(a, k))) as cs from al),
    t2 as (select *, left(r, length(r) - cs) as r1, left(a, length(a) - cs) as a1 from t1),
    t3 as (select *, list_max(list_filter(range(0, least(length(r1), length(a1))), lambda k: left(r1, k) = left(a1, k))) as cp from t2),
    va as (select window_id, chrom, block, first_pos, last_pos, r, a, p0 + cp as vpos, substr(r1, cp + 1) as ref, substr(a1, cp + 1) as alt, least(1, prob) as prob, least(1, delta) as delta, p_het from t3)"""


@query("win_anchor", f"with {_ALLELE} select window_id, block::bigint as block, anchor from an")
def win_anchor(spark: SparkSession, d: str) -> DataFrame:
    return _alleles(spark, d).select("window_id", "block", F.left("raw_ref", F.lit(1)).alias("anchor"))


@query("fn_allele_build", f"with {_ALLELE} select window_id, block::bigint as block, r as ref, a as alt from va")
def fn_allele_build(spark: SparkSession, d: str) -> DataFrame:
    return _alleles(spark, d).select("window_id", "block", F.col("raw_ref").alias("ref"), F.col("raw_alt").alias("alt"))


@query("fn_allele_trim", f"with {_ALLELE} select window_id, block::bigint as block, vpos::bigint as vpos, ref, alt from va")
def fn_allele_trim(spark: SparkSession, d: str) -> DataFrame:
    return _alleles(spark, d).select("window_id", "block", "vpos", "ref", "alt")


@query("best_per_pos", f"with {_ALLELE} select window_id, block::bigint as block, vpos::bigint as vpos, ref, alt from (select *, row_number() over (partition by window_id, vpos order by prob desc, block) as k from va where ref <> alt) where k = 1")
def best_per_pos(spark: SparkSession, d: str) -> DataFrame:
    return U.best_per_position(_alleles(spark, d)).select("window_id", "block", "vpos", "ref", "alt")


#: Blocks of a contig in order of window and block; each step of the recursion takes the next one and keeps it if no kept block of another window covers its first position.
_SEEN = f"""{_ALLELE.replace("wd as", "recursive wd as", 1)}, ch as materialized (select *, row_number() over (partition by chrom order by window_id, block) as k from va where ref <> alt and chrom is not null),
    sw as (select chrom, 0::bigint as k, []::struct(w bigint, b bigint, f bigint, l bigint)[] as kept from ch group by chrom union all
    select ch.chrom, ch.k, case when len(list_filter(kept, lambda x: x.w <> ch.window_id and ch.first_pos between x.f and x.l)) = 0
    then list_append(kept, {{'w': ch.window_id, 'b': ch.block::bigint, 'f': ch.first_pos::bigint, 'l': ch.last_pos::bigint}}) else kept end from sw join ch on ch.chrom = sw.chrom and ch.k = sw.k + 1),
    se as (select ch.* from ch join (select u.w as window_id, u.b as block from (select unnest(kept) as u from (select * from sw qualify row_number() over (partition by chrom order by k desc) = 1))) using (window_id, block))"""


@query("set_seen", f"with {_SEEN} select window_id, chrom, block::bigint as block, vpos::bigint as vpos, ref, alt from se")
def set_seen(spark: SparkSession, d: str) -> DataFrame:
    return U.unseen(_alleles(spark, d)).select("window_id", "chrom", "block", "vpos", "ref", "alt")


def _variants(spark: SparkSession, d: str) -> DataFrame:
    return U.variants(_windows(spark, d))


_VARIANT = f"""{_SEEN}, vr as (select chrom, vpos::bigint as pos, ref, alt, least(99, trunc(-10 * log10(greatest(1 - prob::float::double, 1e-10))))::int as qual, prob::float::double as prob, delta, p_het,
    case when p_het >= 0.5 then '0/1' else '1/1' end as gt from (select *, row_number() over (partition by window_id, vpos order by prob::float desc, block) as nth from se) where nth = 1)"""


@query("sort_variants", f"with {_VARIANT} select chrom, pos, ref, alt, qual, round(prob, 4) as prob, round(delta, 4) as delta, round(p_het, 4) as p_het, gt from vr order by chrom, pos, ref, alt")
def sort_variants(spark: SparkSession, d: str) -> DataFrame:
    v = _variants(spark, d).select("chrom", "pos", "ref", "alt", "qual", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("prob", "delta", "p_het")], "gt")
    return v.orderBy("chrom", "pos", "ref", "alt")


@query("snk_vcf", f"""with {_VARIANT} select unnest([{', '.join("'" + line.replace("\t", "' || chr(9) || '") + "'" for line in X.VCF_HEADER)}]) as value union all
    select concat_ws(chr(9), chrom, pos, '.', ref, alt, qual, 'PASS', printf('PROB=%.3f;DELTA=%.3f;PHET=%.3f', prob, delta, p_het), 'GT', gt) from vr""")  # fmt: skip
def snk_vcf(spark: SparkSession, d: str) -> DataFrame:
    """The file with its header, as it is read again, line by line."""
    X.write_vcf(U.vcf_rows(_variants(spark, d)), path := f"{scratch_dir(spark)}/vcf-{uuid.uuid4().hex}")
    return spark.read.text(path)


@query("jn_variant_ref", f"""with {_VARIANT} select chrom, pos, ref, alt, pos > 0 and length(seq) > 0 and pos - 1 + length(ref) <= length(seq) and substr(upper(seq), pos, length(ref)) = upper(ref) as agrees
    from vr join (select contig, seq from contigs where seq is not null) on chrom = contig""")  # fmt: skip
def jn_variant_ref(spark: SparkSession, d: str) -> DataFrame:
    """Variants of contigs whose sequence is known, and whether it has the reference allele at their place."""
    known = table(spark, d, "contigs").filter("seq is not null").select(F.col("contig").alias("chrom"))
    v = _variants(spark, d).join(known, "chrom", "left_semi")
    return U.reference_agrees(v, table(spark, d, "contigs")).select("chrom", "pos", "ref", "alt", "agrees")


@query("win_nonoverlap")
def win_nonoverlap(spark: SparkSession, d: str) -> DataFrame:
    """Contigs with the variants written in, from their pieces: what was applied and what was skipped, the new length, and a digest of the digests of the pieces."""
    p = U.corrected_pieces(materialize(_variants(spark, d), "variants"), table(spark, d, "contigs")).select("contig", "bin", F.length("seq").alias("n"), F.md5("seq").alias("md5"), "applied", "skipped")
    digests = F.array_sort(F.collect_list(F.struct("bin", "md5")))
    return p.groupBy("contig").agg(F.sum("n").alias("new_len"), F.md5(F.array_join(F.transform(digests, lambda x: x["md5"]), "")).alias("digest"), F.sum("applied").alias("applied"), F.sum("skipped").alias("skipped"))


#: Each step of the recursion takes the next change of a contig that fits its sequence, and applies it if it begins behind those applied before.
_CHANGED = f"""{_VARIANT}, known as (select contig, upper(seq) as seq from contigs where seq is not null),
    c0 as (select chrom, pos as p0, ref as r0, alt as a0, case when (length(ref) > 1 or length(alt) > 1) and left(ref, 1) = left(alt, 1) then 1 else 0 end as sk from vr),
    c1 as (select chrom, p0, r0, a0, p0 + sk - 1 as s, substr(r0, sk + 1) as cr, substr(a0, sk + 1) as ca from c0 where length(r0) > sk or length(a0) > sk),
    c2 as (select c1.*, s + length(cr) as e, s >= 0 and s + length(cr) <= length(seq) and substr(seq, s + 1, length(cr)) = cr as fits from c1 join known on chrom = contig where seq <> ''),
    c3 as materialized (select *, row_number() over (partition by chrom order by p0, r0, a0) as k from c2 where fits),
    ap as (select chrom, 0::bigint as k, -1::bigint as reach, false as ok from c3 group by 1 union all
    select c3.chrom, c3.k, case when c3.s >= reach then greatest(reach, c3.e) else reach end, c3.s >= reach from ap join c3 on c3.chrom = ap.chrom and c3.k = ap.k + 1),
    c4 as (select chrom, s, e, ca, row_number() over w as i, coalesce(lag(e) over w, 0) as b, p0, r0, a0 from c3 join ap using (chrom, k) where ok window w as (partition by chrom order by s, p0, r0, a0)),
    nw as (select chrom, string_agg(substr(seq, b + 1, s - b) || ca, '' order by i) as head, max(e) as e, count(*) as applied from c4 join known on chrom = contig group by 1)"""


@query("win_nonoverlap_whole", f"""with {_CHANGED}, fin as (select contig, coalesce(head, '') || substr(seq, coalesce(e, 0) + 1) as seq, coalesce(applied, 0) as applied from known left join nw on chrom = contig)
    select contig, length(seq) as new_len, md5(seq) as digest, applied::int as applied, (coalesce(m, 0) - applied)::int as skipped from fin left join (select chrom, count(*) as m from c2 group by 1) on chrom = contig""")  # fmt: skip
def win_nonoverlap_whole(spark: SparkSession, d: str) -> DataFrame:
    """The corrected sequences as contigs has them, one value each."""
    a = U.apply_variants(materialize(_variants(spark, d), "variants"), table(spark, d, "contigs"))
    return a.select("contig", F.length("seq").alias("new_len"), F.md5("seq").alias("digest"), "applied", "skipped")


@query("agg_counts", f"with {_SITE} select chrom, count(distinct window_id) as windows, count(*) as sites, max(off) as max_offset from st group by 1")
def agg_counts(spark: SparkSession, d: str) -> DataFrame:
    return _sites(spark, d).groupBy("chrom").agg(F.countDistinct("window_id").alias("windows"), F.count("*").alias("sites"), F.max("offset").alias("max_offset"))
