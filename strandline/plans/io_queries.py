"""Queries over sources, sinks, set operations, lookups and whole stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from strandline import codes
from strandline.functions import casts as C
from strandline.functions import sequence as S
from strandline.operators import encode as E
from strandline.operators.alignment_filter import flag_clear
from strandline.operators.intervals import overlap_join
from strandline.operators.key_quantiles import key_ranks
from strandline.operators.pileup import CHUNK, features, pileup, ranges_of, reference_chunks
from strandline.plans import alignment_queries as AQ
from strandline.plans.depth_queries import _REF, _features_sql
from strandline.plans.pipeline import candidate_windows, scored
from strandline.runtime import materialize, scratch_dir, table
from strandline.sources import shards as H
from strandline.sources import text as X
from strandline.streaming.reads import primary_reads, run_to_end, stream_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def on_windows(name: str, sql: str, cells: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        AQ.on_windows(name, sql, cells)(f)
        for n in (name, f"{name}_core"):
            QUERIES[n], ORACLE[n] = AQ.QUERIES[n], AQ.ORACLE[n]
        return f

    return add


def _path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


_WINDOWS = "w as (select distinct batch_id, chrom, win_s, win_e, core_s, core_e, targets_ref_pos from encoded_batches)"


@query("src_fasta_stream", "select contig, upper(seq) as seq from contigs where seq is not null")
def src_fasta_stream(spark: SparkSession, d: str) -> DataFrame:
    """Sequences written as FASTA and read again."""
    X.write_fasta(table(spark, d, "contigs"), path := _path(spark, "fasta"))
    return X.read_fasta(spark, path)


QUERIES["snk_fasta"], ORACLE["snk_fasta"] = src_fasta_stream, ORACLE["src_fasta_stream"]


@query("src_gfa", "select contig, seq from contigs where seq is not null")
def src_gfa(spark: SparkSession, d: str) -> DataFrame:
    X.write_gfa(table(spark, d, "contigs"), path := _path(spark, "gfa"))
    return X.read_gfa(spark, path)


@query("src_fasta_range", f"with {_WINDOWS} select batch_id, upper(substr(seq, win_s::bigint + 1, win_e - win_s)) as seq from w join contigs on contig = chrom where seq is not null and win_e > win_s")
def src_fasta_range(spark: SparkSession, d: str) -> DataFrame:
    """The reference of every window whose contig has a sequence."""
    w = table(spark, d, "encoded_batches").filter("win_e > win_s").select("batch_id", "chrom", "win_s", "win_e").distinct()
    return ranges_of(w, table(spark, d, "contigs"), "batch_id", "chrom", "win_s", "win_e").select("batch_id", "seq")


@query("src_fasta_len", "select contig, contig_idx, len, length(seq)::int as seq_len, contig = (select arg_max(contig, (len, -contig_idx)) from contigs) as longest from contigs")
def src_fasta_len(spark: SparkSession, d: str) -> DataFrame:
    """Lengths and places of contigs, and which is the longest, the first among equals; by aggregate and join, not a global window."""
    c = table(spark, d, "contigs")
    best = c.agg(F.max_by("contig", F.struct("len", -F.col("contig_idx"))).alias("best")).first()["best"]
    return c.select("contig", "contig_idx", "len", F.length("seq").alias("seq_len"), (F.col("contig") == F.lit(best)).alias("longest"))


@query("src_bed", f"with {_WINDOWS} select chrom as contig, win_s::bigint as win_s, win_e::bigint as win_e, core_s::bigint as core_s, core_e::bigint as core_e, len(targets_ref_pos)::int as n from w where chrom is not null")
def src_bed(spark: SparkSession, d: str) -> DataFrame:
    """Windows written as tab-separated text and read again."""
    w = table(spark, d, "encoded_batches").filter("chrom is not null").select("batch_id", "chrom", "win_s", "win_e", "core_s", "core_e", F.size("targets_ref_pos").alias("n")).distinct()
    X.write_bed(w, path := _path(spark, "bed"), ["chrom", "win_s", "win_e", "core_s", "core_e", "n"])
    return X.read_bed(spark, path)


QUERIES["snk_bed"], ORACLE["snk_bed"] = src_bed, ORACLE["src_bed"]


@query("src_hap", "select distinct r.rid::varchar as read, 'h' || (((r.rid % 2) + 2) % 2) || '_b' || (((r.rid % 97) + 97) % 97) as cluster from (select unnest(s.reads) as r from (select unnest(sites) as s from prediction_windows)) where r.rid <> 0")
def src_hap(spark: SparkSession, d: str) -> DataFrame:
    """Haplotype lines of the voting reads written as text and read again."""
    r = table(spark, d, "prediction_windows").select(F.explode("sites").alias("s")).select(F.explode("s.reads").alias("r")).select("r.rid").filter("rid <> 0").distinct()
    line = F.concat_ws(" ", F.col("rid").cast("string"), F.concat(F.lit("h"), F.pmod("rid", F.lit(2)).cast("string")), F.concat(F.lit("b"), F.pmod("rid", F.lit(97)).cast("string")))
    r.select(line.alias("value")).write.text(path := _path(spark, "hap"))
    return X.read_haplotypes(spark, path)


@query("src_depth", "select distinct archive_id, pos, norm from depth_norm where contig = 'ctg000003l' and pos >= 100000 and pos < 600000")
def src_depth(spark: SparkSession, d: str) -> DataFrame:
    """The depth vector of a region; a contig that isn't there has no rows."""
    return table(spark, d, "depth_norm").filter("contig = 'ctg000003l' and pos >= 100000 and pos < 600000").select("archive_id", "pos", "norm").distinct()


@query("src_depth_windows", f"with {_WINDOWS} select distinct batch_id, archive_id, pos, norm from w join depth_norm d on d.contig = w.chrom and pos >= win_s and pos < win_e")
def src_depth_windows(spark: SparkSession, d: str) -> DataFrame:
    """The depth vectors of every window of the work list, on all contigs; a contig that isn't there has no rows."""
    w = table(spark, d, "encoded_batches").select("batch_id", "chrom", "win_s", "win_e").distinct()
    v = table(spark, d, "depth_norm").filter("contig is not null").select("archive_id", "contig", "pos", "norm").distinct()
    return overlap_join(v.withColumn("next", F.col("pos") + 1), w, start="pos", end="next").select("batch_id", "archive_id", "pos", "norm")


@query("snk_depth", "select archive_id, sample_id, run_day, global_median, n.n, n.norm_sum from depth_meta join (select archive_id, count(*) as n, round(sum(norm::double), 3) as norm_sum from depth_norm where contig is not null group by 1) n using (archive_id)")
def snk_depth(spark: SparkSession, d: str) -> DataFrame:
    """Vectors, by contig, and metadata as two tables, read again."""
    table(spark, d, "depth_norm").filter("contig is not null").repartition("contig", F.pmod("archive_id", F.lit(8))).sortWithinPartitions("contig", "archive_id", "pos").write.parquet(a := _path(spark, "depth"))
    table(spark, d, "depth_meta").write.parquet(b := _path(spark, "depth_meta"))
    n = spark.read.parquet(a).groupBy("archive_id").agg(F.count("*").alias("n"), F.round(F.sum(F.col("norm").cast("double")), 3).alias("norm_sum"))
    return spark.read.parquet(b).select("archive_id", "sample_id", "run_day", "global_median").join(n, "archive_id")


_PAD = "e as (select distinct on (batch_id) batch_id, batch_id // 2000 as shard_id, coalesce(ref_seq, []) as s from encoded_batches), p as (select *, max(len(s)) over (partition by shard_id) as max_w from e)"


@query("udf_pad_collate", f"with {_PAD} select batch_id, shard_id, max_w::int as max_w, (coalesce(list_sum(s), 0) + 7 * (max_w - len(s)))::bigint as code_sum from p")
def udf_pad_collate(spark: SparkSession, d: str) -> DataFrame:
    p = H.pad_shards(AQ.windows(spark, d))
    return p.select("batch_id", "shard_id", "max_w", F.aggregate("ref_seq", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("code_sum"))


@query("snk_shard", f"with {_PAD} select batch_id, max_w::int as width from p")
def snk_shard(spark: SparkSession, d: str) -> DataFrame:
    """Padded shards written, at most 2,000 rows a file, and read again."""
    H.write_shards(H.pad_shards(AQ.windows(spark, d)), path := _path(spark, "shards"))
    return spark.read.parquet(path).select("batch_id", F.size("ref_seq").alias("width"))


QUERIES["src_shard"], ORACLE["src_shard"] = snk_shard, ORACLE["snk_shard"]


@query("snk_manifest", f"with {_PAD} select count(*) as n, max(max_w)::int as max_w from p")
def snk_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Totals of a manifest that was written and read again."""
    H.write_shards(H.pad_shards(AQ.windows(spark, d)), path := _path(spark, "shards"))
    H.write_manifest(H.manifest(spark, path), m := _path(spark, "manifest"))
    return H.read_manifest(spark, m).agg(F.sum("n").alias("n"), F.max("max_w").alias("max_w"))


QUERIES["src_manifest"], ORACLE["src_manifest"] = snk_manifest, ORACLE["snk_manifest"]


@query("snk_msgpack", "select window_id, len(sites)::int as n_sites, len(ref_seq)::int as width from (select distinct on (window_id) * from prediction_windows)")
def snk_msgpack(spark: SparkSession, d: str) -> DataFrame:
    """Windows stored as nested Parquet, the exchange form of this engine, and read again."""
    table(spark, d, "prediction_windows").dropDuplicates(["window_id"]).write.parquet(path := _path(spark, "windows"))
    r = spark.read.parquet(path)
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return r.select("window_id", size("sites").alias("n_sites"), size("ref_seq").alias("width"))


@query("jn_id_chrom", f"with {_WINDOWS} select batch_id, chrom, contig_idx from w left join contigs on contig = chrom")
def jn_id_chrom(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contigs").select(F.col("contig").alias("chrom"), "contig_idx")
    return table(spark, d, "encoded_batches").select("batch_id", "chrom").distinct().join(c, "chrom", "left").select("batch_id", "chrom", "contig_idx")


@query("jn_pos_depth", """with p as (select distinct chrom, unnest(targets_ref_pos)::bigint as pos from encoded_batches where chrom is not null), dp as (select contig, pos, round(avg(norm), 3) as dp from
    (select distinct archive_id, contig, pos, norm from depth_norm where contig is not null and norm is not null) group by 1, 2) select chrom, p.pos, coalesce(dp, -2) as dp from p left join dp on dp.contig = chrom and dp.pos = p.pos""")  # fmt: skip
def jn_pos_depth(spark: SparkSession, d: str) -> DataFrame:
    """Mean normalised depth at every target position, -2 where none was measured."""
    p = table(spark, d, "encoded_batches").filter("chrom is not null").select("chrom", F.explode(F.col("targets_ref_pos").cast("array<bigint>")).alias("pos")).distinct()
    dp = table(spark, d, "depth_norm").filter("contig is not null and norm is not null").select("archive_id", "contig", "pos", "norm").distinct()
    dp = dp.groupBy(F.col("contig").alias("chrom"), "pos").agg(F.round(F.avg("norm"), 3).alias("dp"))
    return p.join(dp, ["chrom", "pos"], "left").withColumn("dp", F.coalesce("dp", F.lit(-2.0)))


@query("jn_read_block", """with r as (select distinct aln_id, contig, start0, end0 from alignments where contig is not null and end0 > start0),
    b as (select aln_id, contig, unnest(range(greatest(start0 - 49, 0) // 1000000, (end0 + 49) // 1000000 + 1)) as block from r) select contig, block, count(*) as n from b join contigs using (contig) where block * 1000000 < len group by 1, 2""")  # fmt: skip
def jn_read_block(spark: SparkSession, d: str) -> DataFrame:
    """Reads by scan block of a million bases, with 50 bases of either side."""
    size, pad = 1_000_000, 50
    c = table(spark, d, "contigs").select(F.col("contig").alias("b_contig"), "len", F.explode(F.expr(f"sequence(0L, (len - 1) div {size})")).alias("block"))
    b = c.select("b_contig", "block", (F.col("block") * size - pad).alias("b_s"), ((F.col("block") + 1) * size + pad).alias("b_e")).withColumn("b_s", F.greatest("b_s", F.lit(0)))
    r = table(spark, d, "alignments").select("aln_id", "contig", "start0", "end0").distinct()
    return overlap_join(r, b, 1 << 16, r_contig="b_contig", r_start="b_s", r_end="b_e").groupBy("contig", "block").agg(F.count("*").alias("n"))


_ASOF = AQ._COLS


@on_windows("jn_col_asof", f"with {_ASOF} select batch_id, (col + k)::bigint as col, pos from (select *, unnest(range(0, ins + 1)) as k from cm)")
def jn_col_asof(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    """The reference position of every column; the position travels with its columns, so no as-of search is needed."""
    c = E.columns(AQ.windows(spark, d), E.insertions(E.select_reads(pairs))).withColumn("k", F.explode(F.expr("sequence(0, ins)")))
    return c.select("batch_id", (F.col("col") + F.col("k")).alias("col"), "pos")


_REFEX = f"""{_ASOF}, {_REF}, re as (select batch_id, (col + k)::bigint as col, case when k > 0 then 6 else case b when 'A' then 0 when 'C' then 1 when 'G' then 2 when 'T' then 3 else 4 end end as code
    from (select *, unnest(range(0, ins + 1)) as k from cm) x join (select batch_id, chrom from w) y using (batch_id) join rb on rb.contig = chrom and rb.pos = x.pos)"""


def _ref_columns(spark: SparkSession, d: str, cols: DataFrame) -> DataFrame:
    chunks = reference_chunks(table(spark, d, "contigs")).select(F.col("contig").alias("chrom"), "bin", "chunk")
    x = cols.withColumn("bin", F.floor(F.col("pos") / CHUNK)).join(chunks, ["chrom", "bin"])
    x = x.withColumn("b", F.expr(f"substring(chunk, int(pos - bin * {CHUNK}) + 1, 1)")).drop("chunk").filter("b <> ''").withColumn("k", F.explode(F.expr("sequence(0, ins)")))
    code = F.when(F.col("k") > 0, codes.INSERTION_COLUMN).otherwise(S.base_code("b"))
    return x.select("batch_id", (F.col("col") + F.col("k")).alias("col"), code.alias("code"))


@on_windows("win_ref_expand", f"with {_REFEX} select batch_id, col, code from re")
def win_ref_expand(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    """Reference codes by column, 6 in insertion columns, of windows whose contig has a sequence."""
    return _ref_columns(spark, d, E.columns(AQ.windows(spark, d), E.insertions(E.select_reads(pairs))))


_CODE = f"""{AQ._CELLS}, {_REFEX.removeprefix(_ASOF + ', ')}, cc as (select cell.*, case when op = 'D' then 3 when code = 6 then 4 when base = code then 1 else 2 end as cc from cell join re using (batch_id, col))"""


@on_windows("fn_cell_code", f"with {_CODE} select batch_id, platform, cc, count(*) as n from cc group by 1, 2, 3", cells="codes")
def fn_cell_code(spark: SparkSession, d: str, sums: DataFrame) -> DataFrame:
    return sums


@on_windows("flt_col_support", f"with {_CODE}, dep as (select batch_id, count(*) as depth from s group by 1) select batch_id, col::bigint as col, variants, depth from (select batch_id, col, count(*) filter (cc in (2, 3, 4)) as variants from cc group by 1, 2) join dep using (batch_id) where variants >= greatest(2, 0.01 * depth)", cells="differing")
def flt_col_support(spark: SparkSession, d: str, sums: DataFrame) -> DataFrame:
    """Columns where at least 2 reads, and 1 % of the rows, differ from the reference; every selected row counts as depth."""
    return sums


@on_windows("udf_tensor_features", f"with {AQ._CELLS} select batch_id, platform, col::bigint as col, count(*) as n, round(sum(case when bq >= 0 then bq else 40 * bq end)::double / (40 * count(*)), 6) as bq from cell group by 1, 2, 3")
def udf_tensor_features(spark: SparkSession, d: str, pairs: DataFrame) -> DataFrame:
    """Mean normalised base quality of every column; pads and deletions keep their negative marks."""
    s, w = E.select_reads(pairs), AQ.windows(spark, d)
    c = E.cells(s, E.columns(w, E.insertions(s))).withColumn("b", F.when(F.col("bq") >= 0, F.col("bq")).otherwise(F.col("bq") * 40))
    return c.groupBy("batch_id", "platform", "col").agg(F.count("*").alias("n"), F.round(F.sum("b").cast("double") / (F.count("*") * 40), 6).alias("bq"))


@query("agg_norm_max", """with lc as (select arg_max(contig, (len, -contig_idx)) as contig, arg_max(len, (len, -contig_idx)) as len from contigs), r as (select *, row_number() over (partition by platform order by start0, aln_id) as rn
    from (select distinct aln_id, platform, start0, mapq, qual from alignments join lc on lc.contig = alignments.contig where (flag & 4) = 0 and end0 > len // 3))
    select platform, greatest(coalesce(ceil(max(case when rn > 25000 then list_max(qual) end) / 5.0) * 5, 40), 40)::bigint as bq_max, greatest(coalesce(ceil(max(case when mapq <> 255 then mapq end) / 10.0) * 10, 60), 60)::bigint as mq_max from r where rn <= 100000 group by 1""")  # fmt: skip
def agg_norm_max(spark: SparkSession, d: str) -> DataFrame:
    """Highest mapping quality of the first 100,000 mapped reads in the last two thirds of the longest contig, and base quality from the 25,001st on."""
    best = table(spark, d, "contigs").agg(F.max(F.struct("len", -F.col("contig_idx"), "contig")).alias("b")).first()["b"]
    r = table(spark, d, "alignments").filter((F.col("contig") == best["contig"]) & flag_clear(codes.UNMAPPED) & (F.col("end0") > best["len"] // 3))
    r = materialize(r.select("aln_id", "platform", "start0", F.when(F.col("mapq") != 255, F.col("mapq")).alias("mapq"), F.array_max("qual").alias("bq")).distinct(), "norm_reads")
    # the starts at which the ranks lie come from counts; only reads with just these starts are numbered
    cut = key_ranks(r, "platform", "start0", {"skip": lambda n: F.least(n, F.lit(25_000)), "all": lambda n: F.least(n, F.lit(100_000))})
    cut = cut.groupBy(F.col("platform").alias("c_platform")).agg(*[F.max(F.when(F.col("target") == t, F.col("value"))).alias(f"{t}_at") for t in ("skip", "all")])
    r = r.join(F.broadcast(cut), r.platform.eqNullSafe(F.col("c_platform")))
    past = r.groupBy(F.col("platform").alias("p_platform")).agg(*[F.count_if(F.col("start0") < F.col(f"{t}_at")).alias(f"before_{t}") for t in ("skip", "all")])
    r = r.join(F.broadcast(past), r.platform.eqNullSafe(F.col("p_platform")))
    tied = r.filter("start0 = skip_at or start0 = all_at").withColumn("rn", F.row_number().over(Window.partitionBy("platform", "start0").orderBy("aln_id")) + F.when(F.col("start0") == F.col("all_at"), F.col("before_all")).otherwise(F.col("before_skip")))
    clear = r.filter("start0 <> skip_at and start0 < all_at").withColumn("rn", F.when(F.col("start0") > F.col("skip_at"), 25_001).otherwise(1))
    r = clear.unionByName(tied).filter("rn <= 100000")
    g = r.groupBy("platform").agg(F.max(F.when(F.col("rn") > 25_000, F.col("bq"))).alias("bq"), F.max("mapq").alias("mq"))
    return g.select("platform", F.coalesce(S.round_up(F.col("bq"), 5, 40), F.lit(40)).alias("bq_max"), F.coalesce(S.round_up(F.col("mq"), 10, 60), F.lit(60)).alias("mq_max"))


@query("set_union_reads", "select platform, count(*) as n, sum(end0 - start0)::bigint as bases from (select distinct aln_id, platform, start0, end0 from alignments) where platform in ('ILLUMINA', 'NANOPORE') group by 1")
def set_union_reads(spark: SparkSession, d: str) -> DataFrame:
    """Short and long reads put together, as for a shared insertion map."""
    a = table(spark, d, "alignments").select("aln_id", "platform", "start0", "end0")
    both = a.filter("platform = 'ILLUMINA'").unionByName(a.filter("platform = 'NANOPORE'")).distinct()
    return both.groupBy("platform").agg(F.count("*").alias("n"), F.sum(F.col("end0") - F.col("start0")).cast("bigint").alias("bases"))


@query("set_union_frag", "select contig, count(*) as n from (select distinct aln_id, contig from alignments where contig is not null) group by 1")
def set_union_frag(spark: SparkSession, d: str) -> DataFrame:
    """Per-fragment outputs, here by parity of the contig, put together; an empty fragment adds nothing."""
    a = table(spark, d, "alignments").select("aln_id", "contig").join(table(spark, d, "contigs").select("contig", "contig_idx"), "contig", "left").filter("contig is not null")
    parts = [a.filter(F.coalesce(F.col("contig_idx") % 2, F.lit(0)) == k).select("aln_id", "contig").distinct() for k in (0, 1)]
    return parts[0].unionByName(parts[1]).groupBy("contig").agg(F.count("*").alias("n"))


@query("set_distinct", "select chrom, count(distinct rid) as n_reads from (select chrom, r.rid as rid from (select chrom, unnest(s.reads) as r from (select chrom, unnest(sites) as s from prediction_windows))) group by 1")
def set_distinct(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "prediction_windows").select("chrom", F.explode("sites").alias("s")).select("chrom", F.explode("s.reads").alias("r"))
    return r.select("chrom", "r.rid").distinct().groupBy("chrom").agg(F.count("rid").alias("n_reads"))


@query("udf_random_downsample")
def udf_random_downsample(spark: SparkSession, d: str) -> DataFrame:
    """Reads kept at half, by a hash of name and platform: the same in every run and for every record of a read. Sampling is the feature."""
    u = F.pmod(F.xxhash64("qname", "platform"), F.lit(1_000_000)) / 1_000_000
    return table(spark, d, "alignments").filter(u < 0.5).select("aln_id", "qname", "platform").distinct()


@query("udf_gbm_filter", f"""with f as ({_features_sql()}), sc as (select contig, pos, 1 / (1 + exp(-(6.0 * greatest(snp_vaf_i, ind_vaf_i, snp_vaf_o, ind_vaf_o) + 0.05 * least(depth_i + depth_o, 40) + 2.0 * greatest(snp_sb_i, ind_sb_i, snp_sb_o, ind_sb_o) - 2.5))) as prob from f)
    select contig, pos, round(prob, 2) as prob from sc""")  # fmt: skip
def udf_gbm_filter(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate with the score of the stand-in model, through the interface a trained one would take."""
    f = features(pileup(table(spark, d, "alignments"), table(spark, d, "contigs")), table(spark, d, "contigs"))
    digits = [F.round(c, 4).alias(c) if "_vaf_" in c or "_sb_" in c else F.col(c) for c in f.columns]
    return scored(f.select(*digits)).select("contig", "pos", F.round("prob", 2).alias("prob"))


_PASSED = f"""f as ({_features_sql(False)}), sc as (select contig, pos, 1 / (1 + exp(-(6.0 * greatest(snp_vaf_i, ind_vaf_i, snp_vaf_o, ind_vaf_o) + 0.05 * least(depth_i + depth_o, 40) + 2.0 * greatest(snp_sb_i, ind_sb_i, snp_sb_o, ind_sb_o) - 2.5))) as prob from f),
    t as (select contig, pos from sc where prob >= 0.5)"""


@query("flt_threshold", f"with {_PASSED} select contig, pos from t")
def flt_threshold(spark: SparkSession, d: str) -> DataFrame:
    f = features(pileup(table(spark, d, "alignments"), table(spark, d, "contigs")), table(spark, d, "contigs"))
    return scored(f).filter("prob >= 0.5").select("contig", "pos")


@query("stage_candidates", f"with recursive {_PASSED}, {AQ.CLUSTERED} select contig, win_s, win_e, core_s, core_e, n from win")
def stage_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The candidate stage as a whole: windows around positions where the reads differ."""
    return candidate_windows(table(spark, d, "alignments"), table(spark, d, "contigs"))


@query("stream_primary_reads", "select aln_id, contig, start0, end0 from alignments where (flag & 2308) = 0")
def stream_primary_reads(spark: SparkSession, d: str) -> DataFrame:
    """The stateless filter as a stream over the delivered files, run to their end."""
    s = primary_reads(stream_table(spark, d, "alignments")).select("aln_id", "contig", "start0", "end0")
    return run_to_end(s, "stream_reads")


@query("snk_exists_guard", "select contig, len from contigs")
def snk_exists_guard(spark: SparkSession, d: str) -> DataFrame:
    """A table written where nothing was, and what is there after a second write was refused."""
    c = table(spark, d, "contigs").select("contig", "len")
    c.write.mode("errorifexists").parquet(path := _path(spark, "guarded"))
    try:
        c.limit(0).write.mode("errorifexists").parquet(path)
    except AnalysisException:
        return spark.read.parquet(path)
    raise RuntimeError("an output was overwritten")


@query("fn_coerce", """select window_id, u.i - 1 as ord, case when u.s.pos >= 0 then u.s.pos end::bigint as pos, case when u.s."offset" >= 0 then u.s."offset" end::bigint as "offset", u.s.p_het as p_het, len(list_filter(u.s.reads, lambda r: r.rid >= 0)) as n_index_rids
    from (select window_id, unnest(list_transform(sites, lambda s, i: {'i': i, 's': s})) as u from (select distinct on (window_id) * from prediction_windows))""")  # fmt: skip
def fn_coerce(spark: SparkSession, d: str) -> DataFrame:
    """The numbers of sites, from their texts as a loosely typed file holds them, as indexes and floats; null where they are none. The checked form raises an error instead."""
    s = table(spark, d, "prediction_windows").dropDuplicates(["window_id"]).select("window_id", F.posexplode("sites").alias("ord", "s"))
    rids = F.size(F.filter(C.to_indexes(F.transform("s.reads", lambda r: r["rid"].cast("string")), False), lambda v: v.isNotNull()))
    text = lambda c: F.col(f"s.{c}").cast("string")
    return s.select("window_id", F.col("ord").cast("bigint").alias("ord"), C.to_index(text("pos"), False).alias("pos"), C.to_index(text("offset"), False).alias("offset"), C.to_float(text("p_het"), False).alias("p_het"), F.when(F.col("s.reads").isNotNull(), rids).cast("bigint").alias("n_index_rids"))
