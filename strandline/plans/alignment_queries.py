"""Queries over alignments and windows: filters, joins, top-k, clustering and window layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline import codes
from strandline.functions import sequence as S
from strandline.operators import alignment_filter as A
from strandline.operators import encode as E
from strandline.operators.clusters import cluster_windows, number_gaps
from strandline.operators.intervals import islands, overlap_join
from strandline.operators.window_cells import cell_sums
from strandline.plans.function_queries import SQL_CLIP, SQL_MD, sql_sum
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


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return materialize(A.decisive(table(spark, d, "alignments")), "filter_rows")


def windows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "encoded_batches").dropDuplicates(["batch_id"])


def flagged(name: str, cond: str, sql: str) -> None:
    QUERIES[name] = lambda spark, d: table(spark, d, "alignments").filter(cond).select("aln_id", "contig", "start0").distinct()
    ORACLE[name] = f"select distinct aln_id, contig, start0 from alignments where {sql}"


flagged("flt_depth_reads", "flag & 2308 = 0", "(flag & 2308) = 0")
flagged("flt_cand_reads", "flag & 3332 = 0 and mapq >= 1 and length(seq) > 0 and size(qual) > 0", "(flag & 3332) = 0 and mapq >= 1 and length(seq) > 0 and len(qual) > 0")
flagged("flt_enc_reads", "flag & 1028 = 0 and (platform = 'ILLUMINA' or (flag & 2304 = 0 and mapq >= 1))", "(flag & 1028) = 0 and (platform = 'ILLUMINA' or ((flag & 2304) = 0 and mapq >= 1))")
flagged("src_bam_region", "contig = 'ctg000003l' and start0 < 600000 and end0 > 100000", "contig = 'ctg000003l' and start0 < 600000 and end0 > 100000")


@query("src_bam_header", "select contig, contig_idx, len from contigs where len >= 2000 and contig in (select contig from alignments)")
def src_bam_header(spark: SparkSession, d: str) -> DataFrame:
    """Contigs long enough that are asked for; what is asked for and absent is skipped."""
    asked = table(spark, d, "alignments").select("contig").distinct()
    return table(spark, d, "contigs").filter("len >= 2000").join(asked, "contig", "left_semi").select("contig", "contig_idx", "len")


_MATE = "case when (flag & 1) = 0 then 0 when (flag & 64) <> 0 then 1 when (flag & 128) <> 0 then 2 end"
_ALN = "a as (select distinct on (aln_id) * from alignments)"
_PRIMARY = f"""p as (select qname, mate, p_as, p_len from (select qname, {_MATE} as mate, coalesce(as_score, 0) as p_as, length(seq) as p_len, aln_id,
    row_number() over (partition by qname, {_MATE} order by aln_id desc) as r from a where (flag & 2304) = 0 and length(seq) > 0 and seq <> '*' and qname is not null) where r = 1 and mate is not null)"""
_CAND = f"""c as (select a.*, {_MATE} as mate, coalesce(as_score, 0) as score from a where (flag & 2304) <> 0 and (flag & 4) = 0 and qname is not null),
    g as (select c.*, p.p_as, p.p_len from c left join p on c.qname = p.qname and c.mate = p.mate where length(coalesce(seq, '')) > 0 or p_as is null or score >= p_as * 0.8::double)"""
_BEST = f"""b as (select * from (select *, row_number() over (partition by qname order by score desc, aln_id) as rank from g where coalesce({SQL_MD}, nm, 0) <= 6) where rank <= 100)"""


@query("jn_primary_source", f"with {_ALN}, {_PRIMARY}, {_CAND} select c.aln_id, p.p_as, p.p_len from c left join p on c.qname = p.qname and c.mate = p.mate")
def jn_primary_source(spark: SparkSession, d: str) -> DataFrame:
    """Every non-primary record with its own mate's primary."""
    return A.secondary_candidates(_rows(spark, d), min_ratio=None, max_mismatch=None).select("aln_id", "p_as", "p_len")


@query("flt_as_ratio", f"with {_ALN}, {_PRIMARY}, {_CAND} select aln_id, score, p_as from g")
def flt_as_ratio(spark: SparkSession, d: str) -> DataFrame:
    return A.secondary_candidates(_rows(spark, d), max_mismatch=None).select("aln_id", "score", "p_as")


@query("flt_max_mismatch", f"select aln_id, coalesce({SQL_MD}, nm, 0)::bigint as mismatches from (select distinct aln_id, flag, md, nm from alignments) where (flag & 2304) <> 0 and (flag & 4) = 0 and coalesce({SQL_MD}, nm, 0) <= 6")
def flt_max_mismatch(spark: SparkSession, d: str) -> DataFrame:
    n = F.coalesce(S.condensed_mismatches("md"), "nm", F.lit(0)).cast("bigint")
    a = table(spark, d, "alignments").filter((F.col("flag").bitwiseAND(codes.NOT_PRIMARY) != 0) & A.flag_clear(codes.UNMAPPED)).select("aln_id", "md", "nm").distinct()
    return a.select("aln_id", n.alias("mismatches")).filter("mismatches <= 6")


@query("topk_as", f"with {_ALN}, {_PRIMARY}, {_CAND}, {_BEST} select qname, aln_id, score, rank::int as rank from b")
def topk_as(spark: SparkSession, d: str) -> DataFrame:
    return A.keep_best(A.secondary_candidates(_rows(spark, d))).select("qname", "aln_id", "score", "rank")


@query("stage_filter", f"""with {_ALN}, {_PRIMARY}, {_CAND}, {_BEST} select aln_id, length(seq)::bigint as seq_len, nm from a where (flag & 2308) = 0
    union all select aln_id, case when length(coalesce(seq, '')) > 0 then length(seq) else greatest(0, p_len - coalesce(case when cigar[1].op = 'H' then cigar[1].len end, 0) - coalesce(case when len(cigar) > 1 and cigar[-1].op = 'H' then cigar[-1].len end, 0)) end, null
    from b where length(coalesce(seq, '')) > 0 or p_len is not null""")  # fmt: skip
def stage_filter(spark: SparkSession, d: str) -> DataFrame:
    """The filter stage as a whole: what is written of every record that is kept."""
    return A.filter_alignments(table(spark, d, "alignments")).select("aln_id", F.length("seq").cast("bigint").alias("seq_len"), "nm")


@query("win_qname_groups", "select qname, count(*) as n, count(*) filter ((flag & 2304) = 0) as n_primary from (select distinct aln_id, qname, flag from alignments) group by 1")
def win_qname_groups(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "alignments").select("aln_id", "qname", "flag").distinct()
    return a.groupBy("qname").agg(F.count("*").alias("n"), F.count_if(A.flag_clear(codes.NOT_PRIMARY)).alias("n_primary"))


_USE = f"""u as (select * from (select *, {sql_sum('MI=X')} as aln_len, {SQL_CLIP} as clip_len, {SQL_CLIP}::double / nullif({sql_sum('MISH=X')}, 0) as clip_ratio,
    case platform when 'NANOPORE' then 0.5 when 'ILLUMINA' then 0.2 else 0.4 end::double as lr, case platform when 'NANOPORE' then 2000 when 'ILLUMINA' then 50 else 1000 end as ll,
    case platform when 'NANOPORE' then 0.1 else 0.05 end::double as sr, case platform when 'NANOPORE' then 400 when 'ILLUMINA' then 10 else 200 end as sl, case platform when 'ILLUMINA' then 5 else 50 end as trust
    from a where (flag & 1028) = 0 and contig is not null and len(cigar) > 0 and (platform = 'ILLUMINA' or ((flag & 2304) = 0 and mapq >= 1)) and platform in ('NANOPORE', 'HIFI', 'PACBIO', 'ILLUMINA'))
    where aln_len >= ll and clip_ratio <= lr)"""


@query("flt_platform_thresholds", f"with {_ALN}, {_USE} select aln_id, aln_len, clip_len, round(clip_ratio, 6) as clip_ratio from u")
def flt_platform_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return A.records(A.usable_reads(table(spark, d, "alignments"))).select("aln_id", "aln_len", "clip_len", F.round("clip_ratio", 6).alias("clip_ratio"))


@query("flt_backbone", f"with {_ALN}, {_USE} select aln_id, start0 + trust as t_start, end0 - trust as t_end from u where clip_ratio <= sr and clip_len < sl and end0 - start0 > 2 * trust")
def flt_backbone(spark: SparkSession, d: str) -> DataFrame:
    b = A.records(A.usable_reads(table(spark, d, "alignments")).filter("backbone and end0 - start0 > 2 * trust"))
    return b.select("aln_id", (F.col("start0") + F.col("trust")).alias("t_start"), (F.col("end0") - F.col("trust")).alias("t_end"))


_WIN = "w as (select distinct batch_id, chrom, win_s, win_e, list_min(targets_ref_pos) as t_min, list_max(targets_ref_pos) as t_max from encoded_batches)"


@query("jn_read_window", f"with {_ALN}, {_WIN} select batch_id, aln_id from w join a on contig = chrom and start0 < win_e and end0 > win_s where end0 > start0 and win_e > win_s")
def jn_read_window(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "alignments").select("aln_id", "contig", "start0", "end0").distinct()
    w = table(spark, d, "encoded_batches").select("batch_id", "chrom", "win_s", "win_e").distinct()
    return overlap_join(r, w).select("batch_id", "aln_id")


_PAIR = f"""{_ALN}, {_USE}, {_WIN}, pr as (select u.*, batch_id, win_s, win_e, least(end0, win_e) - greatest(start0, win_s) as ov, avg(aln_len) over (partition by batch_id, platform) as mean_len
    from w join u on u.contig = w.chrom and start0 < t_max and end0 > t_min where t_min < t_max)"""
_SEL = f"""{_PAIR}, k as (select * from pr where (clip_ratio <= sr and clip_len < sl) or not exists (select 1 from pr b where b.batch_id = pr.batch_id and b.platform = pr.platform and b.clip_ratio <= b.sr and b.clip_len < b.sl
    and b.end0 - b.start0 > 2 * b.trust and b.start0 + b.trust <= pr.start0 and b.end0 - b.trust >= pr.end0)),
    s as (select *, row_number() over (partition by batch_id, platform order by start0, aln_id) - 1 as rowno from (select *, row_number() over (partition by batch_id, platform
    order by round(greatest(ov, 0) - clip_ratio * 100 + aln_len / mean_len + mapq, 6) desc, aln_id) as rank from k) where rank <= 30)"""


def on_windows(name: str, sql: str, cells: str | None = None):  # noqa: ANN201
    """Registers a query of a window's reads twice: under its name by the interval of the listed targets, which is the interval of its SQL, and as name_core by the
    window's core, as the stage itself chooses reads; f takes the reads of all windows, or, where cells names them, the sums of window_cells.cell_sums.
    """

    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = lambda spark, d: f(spark, d, _sums_by_targets(spark, d, cells) if cells else _by_targets(spark, d))
        ORACLE[name] = sql
        by_window = lambda spark, d: E.window_reads(table(spark, d, "alignments"), windows(spark, d))
        QUERIES[f"{name}_core"] = lambda spark, d: f(spark, d, cell_sums(table(spark, d, "alignments"), windows(spark, d), cells, table(spark, d, "contigs")) if cells else by_window(spark, d))
        by_core = sql.replace("list_min(targets_ref_pos) as t_min, list_max(targets_ref_pos) as t_max", "core_s as t_min, core_e as t_max")
        ORACLE[f"{name}_core"] = by_core.replace("where t_min < t_max)", "where t_min < t_max and start0 < win_e and end0 > win_s)")
        return f

    return add


def _target_spans(spark: SparkSession, d: str) -> DataFrame:
    return windows(spark, d).withColumn("t_min", F.array_min("targets_ref_pos")).withColumn("t_max", F.array_max("targets_ref_pos"))


def _by_targets(spark: SparkSession, d: str) -> DataFrame:
    return E.window_reads(table(spark, d, "alignments"), _target_spans(spark, d), span=("t_min", "t_max"), reach=False)


def _sums_by_targets(spark: SparkSession, d: str, cells: str) -> DataFrame:
    return cell_sums(table(spark, d, "alignments"), _target_spans(spark, d), cells, table(spark, d, "contigs"), span=("t_min", "t_max"), reach=False)


@on_windows("flt_target_overlap", f"with {_PAIR} select batch_id, aln_id, greatest(ov, 0)::bigint as win_overlap from pr")
def flt_target_overlap(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    return pairs.select("batch_id", "aln_id", "win_overlap")


@on_windows("jn_contained", f"with {_SEL} select batch_id, platform, count(*) as kept from k group by 1, 2")
def jn_contained(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    """How many reads of a window are in no trusted interval of another, or are backbones."""
    return E.select_reads(pairs, depth=2**31 - 1).groupBy("batch_id", "platform").agg(F.count("*").alias("kept"))


@on_windows("topk_reads", f"with {_SEL} select batch_id, platform, aln_id, rank::int as rank, rowno::int as rowno from s")
def topk_reads(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    return E.select_reads(pairs).select("batch_id", "platform", "aln_id", "rank", F.col("row").alias("rowno"))


_WALK = """ops as (select {keep}, op, len, start0 + coalesce(sum(case when contains('MDN=X', op) then len else 0 end) over w, 0)::bigint as ref_pos,
    coalesce(sum(case when contains('MIS=X', op) then len else 0 end) over w, 0)::bigint as q from (select {keep}, start0, x.i as i, x.c.op as op, x.c.len as len from
    (select *, unnest(list_transform(cigar, lambda c, i: {{'i': i, 'c': c}})) as x from {src})) window w as (partition by {key} order by i rows between unbounded preceding and 1 preceding))"""
_INS = f"""{_SEL}, {_WALK.format(keep='batch_id, aln_id, platform, win_s, win_e', src='s', key='batch_id, aln_id')}, ins as (select batch_id, ref_pos - 1 as pos, max(len) as ins from ops where op = 'I' and len <= 15 and ref_pos - 1 >= win_s and ref_pos - 1 < win_e group by 1, 2)"""


@on_windows("agg_max_insert", f"with {_INS} select batch_id, pos, ins from ins")
def agg_max_insert(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    return E.insertions(E.select_reads(pairs))


_COLS = f"""{_INS}, cm as materialized (select batch_id, pos, coalesce(ins, 0) as ins, coalesce(sum(1 + coalesce(ins, 0)) over (partition by batch_id order by pos rows between unbounded preceding and 1 preceding), 0)::bigint as col
    from (select batch_id, unnest(range(win_s::bigint, win_e::bigint)) as pos from w) left join ins using (batch_id, pos))"""


@on_windows("win_col_map", f"with {_COLS} select batch_id, pos, ins, col from cm")
def win_col_map(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    return E.columns(windows(spark, d), E.insertions(E.select_reads(pairs))).select("batch_id", "pos", "ins", "col")


@on_windows("win_depth_expand", f"""with {_COLS}, dp as (select contig, pos, round(avg(norm), 3) as dp from (select distinct archive_id, contig, pos, norm from depth_norm where contig is not null and norm is not null) group by 1, 2)
    select batch_id, (col + k)::bigint as col, coalesce(dp, -2) as dp from (select batch_id, pos, col, unnest(range(0, ins + 1)) as k from cm) x join (select batch_id, chrom from w) y using (batch_id) left join dp on dp.contig = chrom and dp.pos = x.pos""")  # fmt: skip
def win_depth_expand(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    """Normalised depth (the mean of the archives) of every column; insertion columns have that of their anchor, positions without one -2."""
    cols = E.columns(windows(spark, d), E.insertions(E.select_reads(pairs)))
    dp = table(spark, d, "depth_norm").filter("contig is not null and norm is not null").select("archive_id", "contig", "pos", "norm").distinct()
    dp = dp.groupBy(F.col("contig").alias("chrom"), "pos").agg(F.round(F.avg("norm"), 3).alias("dp"))
    c = cols.join(dp, ["chrom", "pos"], "left").withColumn("k", F.explode(F.expr("sequence(0, ins)")))
    return c.select("batch_id", (F.col("col") + F.col("k")).alias("col"), F.coalesce("dp", F.lit(-2.0)).alias("dp"))


_CELLS = f"""{_COLS}, o2 as (select ops.*, a.seq, a.qual from ops join a using (aln_id) where length(seq) > 0 and contains('MI=XD', op)),
    ex as (select *, unnest(range(0, len)) as k from o2),
    ce as (select batch_id, aln_id, platform, op, len, k, case when op = 'I' then ref_pos - 1 else ref_pos + k end as pos, (q + case when op = 'D' then 0 else k end)::bigint as q, seq, qual, win_s, win_e from ex),
    cell as (select ce.batch_id, aln_id, platform, op, case when op = 'I' then k + 1 else 0 end as k, ce.pos, cm.col + case when op = 'I' then 1 + k else 0 end as col,
    case when op = 'D' then 5 else case upper(substr(seq, q + 1, 1)) when 'A' then 0 when 'C' then 1 when 'G' then 2 when 'T' then 3 else 4 end end as base, case when op = 'D' then -2 else coalesce(qual[q + 1], 0) end as bq
    from ce join cm on cm.batch_id = ce.batch_id and cm.pos = ce.pos where (op = 'D' or q < length(seq)) and (op <> 'I' or len <= ins))"""


@on_windows("udf_encode_window", f"with {_CELLS} select batch_id, platform, count(*) as n_cells, sum(base)::bigint as base_sum, sum(bq)::bigint as bq_sum, sum(col * (base + 1))::bigint as col_sum from cell group by 1, 2", cells="sums")
def udf_encode_window(spark: SparkSession, d: str, sums: DataFrame) -> DataFrame:
    """The encoded cells of every window, summed up by platform."""
    return sums


@on_windows("agg_support", f"""with {_CELLS} select batch_id, col::bigint as col, count(*) filter (op in ('I', 'D')) as variants, (select count(*) from s where s.batch_id = cell.batch_id) as depth from cell group by batch_id, col
    having count(*) filter (op in ('I', 'D')) >= greatest(2, 0.01 * (select count(*) from s where s.batch_id = cell.batch_id))""", cells="indels")  # fmt: skip
def agg_support(spark: SparkSession, d: str, sums: DataFrame) -> DataFrame:
    """Columns with at least 2, and 1 % of the rows, that insert or delete there; depth counts every selected row, gaps too."""
    return sums


_POS = "t as (select distinct chrom as contig, p::bigint as pos from (select chrom, unnest(targets_ref_pos) as p from encoded_batches) where chrom is not null and p is not null)"
_BY_ISLAND = """isl as (select contig, pos, max(case when new then pos end) over (partition by contig order by pos) as island from
    (select *, coalesce(pos - lag(pos) over (partition by contig order by pos) > 20, true) as new from t))"""
_ISL = f"{_POS}, {_BY_ISLAND}"
#: Of t (contig, pos) the islands, and the clusters of each: every step of the recursion takes the next wider gap and joins the two clusters beside it if their window stays narrow enough.
CLUSTERED = f"""{_BY_ISLAND}, gp as materialized (select contig, island, pos as a, nxt as b, row_number() over (partition by contig, island order by nxt - pos, pos) as k
    from (select *, lead(pos) over (partition by contig, island order by pos) as nxt from isl) where nxt is not null),
    cl as (select contig, island, 0::bigint as k, list({{'f': pos, 'l': pos, 'n': 1}}) as iv from isl group by 1, 2 union all
    select contig, island, nk, case when rc.l - lc.f + 100 <= 130 then list_append(list_filter(iv, lambda x: x.l <> a and x.f <> b), {{'f': lc.f, 'l': rc.l, 'n': lc.n + rc.n}}) else iv end
    from (select cl.contig, cl.island, gp.k as nk, iv, a, b, list_filter(iv, lambda x: x.l = a)[1] as lc, list_filter(iv, lambda x: x.f = b)[1] as rc from cl join gp on gp.contig = cl.contig and gp.island = cl.island and gp.k = cl.k + 1)),
    win as (select contig, greatest(0, u.f - 50)::bigint as win_s, (u.l + 50)::bigint as win_e, u.f::bigint as core_s, (u.l + 1)::bigint as core_e, u.n::int as n
    from (select contig, unnest(iv) as u from (select * from cl qualify row_number() over (partition by contig, island order by k desc) = 1)))"""


@on_windows("sort_reads", f"with {_SEL} select batch_id, platform, rowno::int as rowno, aln_id, start0 from s")
def sort_reads(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    """The chosen reads of a window and platform by start: their rows in the tensor."""
    return E.select_reads(pairs).select("batch_id", "platform", F.col("row").alias("rowno"), "aln_id", "start0")


@on_windows("set_stack_platforms", f"with {_SEL} select batch_id, aln_id, platform, (row_number() over (partition by batch_id order by platform <> 'ILLUMINA', platform, rowno) - 1)::int as stacked from s")
def set_stack_platforms(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    """The rows of all platforms of a window one below the other, short reads first."""
    return E.stack_platforms(E.select_reads(pairs)).select("batch_id", "aln_id", "platform", "stacked")


def _targets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "encoded_batches").select(F.col("chrom").alias("contig"), F.explode("targets_ref_pos").alias("pos"))


@query("agg_distinct_cand", f"with {_POS} select contig, pos from t")
def agg_distinct_cand(spark: SparkSession, d: str) -> DataFrame:
    return _targets(spark, d).filter("contig is not null and pos is not null").select("contig", F.col("pos").cast("bigint").alias("pos")).distinct()


@query("win_islands", f"with {_ISL} select contig, island, count(*) as n, max(pos) as last from isl group by 1, 2")
def win_islands(spark: SparkSession, d: str) -> DataFrame:
    return islands(_targets(spark, d), "contig", "pos").groupBy("contig", "island").agg(F.count("*").alias("n"), F.max("pos").alias("last"))


@query("sort_candidates", f"with {_ISL} select contig, island, pos, row_number() over (partition by contig, island order by pos)::int as i from isl")
def sort_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Distinct positions in order, island by island, which is the order within a contig."""
    return number_gaps(islands(_targets(spark, d), "contig", "pos")).select("contig", "island", "pos", "i")


@query("sort_gaps", f"""with {_ISL}, gp as (select contig, island, pos, lead(pos) over (partition by contig, island order by pos) - pos as gap from isl)
    select contig, island, pos, gap, row_number() over (partition by contig, island order by gap, pos)::int as rank from gp where gap is not null""")  # fmt: skip
def sort_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The gaps between neighbours of an island from the least, the earlier first among equals: the order in which clustering joins them."""
    return number_gaps(islands(_targets(spark, d), "contig", "pos")).filter("gap is not null").select("contig", "island", "pos", "gap", "rank")


@query("win_cluster", f"with recursive {_POS}, {CLUSTERED} select contig, win_s, win_e, core_s, core_e, n from win")
def win_cluster(spark: SparkSession, d: str) -> DataFrame:
    return cluster_windows(_targets(spark, d), "contig", "pos")


@query("limit_reads", "select platform, aln_id from (select *, row_number() over (partition by platform order by contig, start0, aln_id) as r from (select distinct aln_id, platform, contig, start0 from alignments where contig is not null and start0 is not null)) where r <= 1000")
def limit_reads(spark: SparkSession, d: str) -> DataFrame:
    """The first 1,000 mapped reads of each platform; the group limit keeps that many a task before the shuffle."""
    a = table(spark, d, "alignments").filter("contig is not null and start0 is not null").select("aln_id", "platform", "contig", "start0").distinct()
    w = Window.partitionBy("platform").orderBy("contig", "start0", "aln_id")
    return a.withColumn("r", F.row_number().over(w)).filter("r <= 1000").select("platform", "aln_id")
