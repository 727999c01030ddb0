"""The queries of the training-data operators, by problem number, and their SQL for the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.bpe import count_tokens, encode_corpus, token_bytes
from strandline.llm.mixing import mix_report, mix_sources
from strandline.llm.multi_select import group_percentiles, multi_select, regroup, value_digest
from strandline.llm.packing import pack_items
from strandline.llm.runs import collapse_runs
from strandline.llm.top_n import top_n_per_group
from strandline.llm.truncation import detect_truncation, length_spikes, truncation_report
from strandline.runtime import lookup, materialize, table

CAPACITY = 1024


def _runs(spark: SparkSession, d: str, min_bases: int) -> DataFrame:
    a = collapse_runs(table(spark, d, "encoded_batches"), "batch_id", "ref_seq", min_bases=min_bases)
    b = collapse_runs(table(spark, d, "prediction_windows"), "window_id", "ref_seq", min_bases=min_bases)
    return a.withColumnRenamed("batch_id", "seq_id").withColumn("tbl", F.lit("encoded_batches")).unionByName(b.withColumnRenamed("window_id", "seq_id").withColumn("tbl", F.lit("prediction_windows")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d, 5).select("tbl", "seq_id", "first_col", "last_col", "base", "n_bases")


def p1_run_lengths(spark: SparkSession, d: str) -> DataFrame:
    """How many runs of each base have each number of bases, and the columns they cover."""
    return _runs(spark, d, 2).groupBy("tbl", "base", "n_bases").agg(F.count("*").alias("n_runs"), F.sum("n_cols").alias("n_cols"))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "alignments").select("qname", "aln_id", "flag", "as_score")
    return a.filter("qname is not null and flag & 4 = 0 and flag & 2304 <> 0").withColumn("as_score", F.coalesce("as_score", F.lit(0)))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return top_n_per_group(_candidates(spark, d), "qname", "as_score", "aln_id", 10).select("qname", "aln_id")


def _measured(spark: SparkSession, d: str) -> DataFrame:
    """Each measured position once; a delivered copy has the values of its first delivery."""
    return table(spark, d, "depth_norm").select("archive_id", "contig", "pos", "raw_depth").filter("raw_depth >= 0").distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """More than 60 % below m means that the value of rank floor(0.6 n) + 1 is below m; fewer than 40 % at or below m, that the one of rank ceil(0.4 n) is above."""
    ranks = {"r60": lambda n: F.floor(n * 6 / 10) + 1, "r40": lambda n: F.ceil(n * 4 / 10)}
    found = multi_select(value_digest(_measured(spark, d), ["archive_id"], "raw_depth"), ["archive_id"], ranks)
    found = found.groupBy("archive_id").agg(*(F.max(F.when(F.col("target") == t, F.col("code"))).alias(t) for t in ranks))
    meta = table(spark, d, "depth_meta").select(F.col("archive_id").alias("a"), "global_median").distinct()
    return found.join(meta, F.col("archive_id") == F.col("a")).filter("r60 < global_median or r40 > global_median").select("archive_id").distinct()


def p4_archive_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact percentiles of each archive beside the recorded median and mean."""
    p = group_percentiles(_measured(spark, d), ["archive_id"], "raw_depth", [0.05, 0.25, 0.5, 0.75, 0.95])
    meta = table(spark, d, "depth_meta").select("archive_id", "global_median", "global_mean")
    return p.join(meta, "archive_id", "left").select("archive_id", "n", "prob", "raw_depth", "global_median", "global_mean")


def _rekeyed(spark: SparkSession, d: str, *groups: str) -> DataFrame:
    """Percentiles from stored digests of each contig of each archive, put together by other groups."""
    digest = materialize(value_digest(_measured(spark, d), ["archive_id", "contig"], "raw_depth"), "archive_digests")
    meta = table(spark, d, "depth_meta").select("archive_id", "sample_id", "run_day")
    targets = {str(p): (lambda n, p=p: F.ceil(n * p / 100)) for p in (5, 25, 50, 75, 95)}
    found = multi_select(regroup(digest.join(meta, "archive_id"), list(groups)), list(groups), targets)
    return found.select(*groups, "n", F.col("target").cast("int").alias("percent"), F.col("code").cast("int").alias("raw_depth"))


def p4_sample_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return _rekeyed(spark, d, "sample_id")


def p4_day_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return _rekeyed(spark, d, "run_day")


def p4_contig_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return _rekeyed(spark, d, "contig")


def p4_norm_bounded(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of the normalised depth of each archive from digests with an error of 1 %, beside the exact ones: whether each keeps to its bound."""
    m = table(spark, d, "depth_norm").select("archive_id", "contig", "pos", "norm").filter("norm is not null").distinct()
    probs = [0.07, 0.5, 0.55, 0.95]
    near = group_percentiles(m, ["archive_id"], "norm", probs, 0.01).select(F.col("archive_id").alias("a"), F.col("prob").alias("p"), F.col("norm").cast("double").alias("near"))
    both = group_percentiles(m, ["archive_id"], "norm", probs).join(near, F.col("archive_id").eqNullSafe(F.col("a")) & (F.col("prob") == F.col("p")), "left")
    # a FLOAT holds seven digits
    return both.select("archive_id", "n", "prob", F.round("norm", 5).alias("norm"), (F.abs(F.col("near") - F.col("norm")) <= F.abs("norm") * 0.010001).alias("bounded"))


def _items(spark: SparkSession, d: str, name: str, ident: str) -> DataFrame:
    """Lengths in columns that aren't padding, whatever seq_len says."""
    n = F.size(F.filter("ref_seq", lambda x: x != 7))
    return table(spark, d, name).select(F.col(ident).alias("item_id"), "chrom", F.when(F.col("ref_seq").isNotNull(), n).alias("n_cols"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The items that packing has to cut."""
    out = None
    for name, ident in (("encoded_batches", "batch_id"), ("padded_batches", "padded_id")):
        packed = pack_items(_items(spark, d, name, ident), "item_id", "chrom", "n_cols", CAPACITY).filter("n_pieces > 1 and piece = 0")
        packed = packed.select(F.lit(name).alias("tbl"), "item_id")
        out = packed if out is None else out.unionByName(packed)
    return out.distinct()


def p5_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack_items(_items(spark, d, "encoded_batches", "batch_id"), "item_id", "chrom", "n_cols", CAPACITY)


def p5_room(spark: SparkSession, d: str) -> DataFrame:
    """Room used and wasted by today's padded shards and by the containers."""
    p = p5_packing(spark, d).filter("container is not null")
    new = p.groupBy("block", "container").agg(F.sum("length").alias("used")).agg(F.count("*").alias("units"), F.sum("used").alias("used_cols"), (F.count("*") * CAPACITY).alias("all_cols"))
    old = table(spark, d, "padded_batches").select(F.size("ref_seq").alias("w"), F.size(F.filter("ref_seq", lambda x: x != 7)).alias("n"))
    old = old.agg(F.count("*").alias("units"), F.sum("n").alias("used_cols"), F.sum("w").alias("all_cols"))
    both = new.withColumn("layout", F.lit("containers")).unionByName(old.withColumn("layout", F.lit("padded_batches")))
    return both.select("layout", "units", "used_cols", "all_cols", (1 - F.col("used_cols") / F.col("all_cols")).alias("unused_share"))


def p5_placed(spark: SparkSession, d: str) -> DataFrame:
    """Of every item the columns and pieces that were placed, and whether they lie apart from others in containers that hold them."""
    p = materialize(p5_packing(spark, d), "packed")
    by = Window.partitionBy("block", "container").orderBy("offset")
    full = p.filter("container is not null").withColumn("fits", F.col("offset") + F.col("length") <= F.coalesce(F.lead("offset").over(by), F.lit(CAPACITY)))
    every = full.unionByName(p.filter("container is null").withColumn("fits", F.lit(True)))
    return every.groupBy("item_id").agg(F.sum("length").alias("n_cols"), F.max("n_pieces").alias("n_pieces"), F.min("fits").alias("fits"))


#: Given shares of two groups of contigs, which aren't those they have in the data; batches without a known contig only fill.
MIXTURE = {"odd": 0.3, "even": 0.7}


def p5_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The shares that given sources reach in the containers which a block fills before it has used one of them up."""
    group = table(spark, d, "contigs").select(F.col("contig").alias("c"), F.when(F.col("contig_idx") % 2 == 0, "even").otherwise("odd").alias("part"))
    items = lookup(_items(spark, d, "encoded_batches", "batch_id"), "chrom", materialize(group, "groups"), "c").select("item_id", F.coalesce("part", F.lit("other")).alias("part"), "n_cols")
    items = materialize(items.distinct(), "mixture_items")
    p = pack_items(items, "item_id", "part", "n_cols", CAPACITY, MIXTURE).filter("container is not null")
    p = materialize(p.join(items.filter("n_cols > 0").groupBy(F.col("item_id").alias("i")).agg(F.min("part").alias("part")), F.col("item_id") == F.col("i")), "mixture")
    ends = p.filter(F.col("part").isin(*MIXTURE)).groupBy(F.col("block").alias("b"), "part").agg(F.max("container").alias("last")).groupBy("b").agg(F.min("last").alias("last"))
    mixed = materialize(p.join(ends, F.col("block") == F.col("b")).filter("container < last").groupBy("part").agg(F.sum("length").alias("cols")), "mixed")
    total = mixed.agg(F.sum("cols")).first()[0] or 1
    share = F.create_map(*[F.lit(x) for kv in MIXTURE.items() for x in kv])[F.col("part")]
    return mixed.select("part", F.coalesce(share, F.lit(0.0)).alias("target_share"), "cols", F.round(F.col("cols") / F.lit(total), 4).alias("mixed_share"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"), "doc_id", "text")


def p6_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents, texts and tokens of each source and language code."""
    t = count_tokens(table(spark, d, "documents"), ["source", "lang"], "text")
    return t.groupBy("source", "lang").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def p6_bytes(spark: SparkSession, d: str) -> DataFrame:
    """For each source the texts and the bytes that their tokens stand for, which must be those of the texts."""
    size = materialize(token_bytes(spark), "token_bytes")
    ids = encode_corpus(table(spark, d, "documents"), "source", "text")
    # tokens are counted before they meet their sizes; texts without a token have one row with none
    n = ids.select("source", F.explode_outer("ids").alias("id")).groupBy("source", "id").agg(F.count("*").alias("n"))
    n_docs = table(spark, d, "documents").groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n_docs"))
    n = lookup(n, "id", size, "token").groupBy("source").agg(F.coalesce(F.sum(F.col("n") * F.col("n_bytes")), F.lit(0)).alias("n_bytes"))
    return n.join(n_docs, F.col("source").eqNullSafe(F.col("s"))).select("source", "n_docs", "n_bytes")


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mix_report(materialize(mix_sources(table(spark, d, "documents"), targets), "mix"), targets)


def p7_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Of each source that has texts whether none of them was used more often than allowed, and whether its share of all tokens is the one it should have among these sources, to a hundredth of all."""
    r = materialize(p7_shares(spark, d).filter("texts > 0"), "mix_reached")
    should = F.col("target_share") / F.lit(r.agg(F.sum("target_share")).first()[0] or 1.0)
    return r.select("source", "max_repeats", (F.col("most_repeats") <= F.col("max_repeats")).alias("repeats_kept"), (F.abs(F.col("actual_share") - should) <= 0.01).alias("share_kept"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return detect_truncation(table(spark, d, "documents")).select("doc_id").distinct()


def p8_source_shares(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return truncation_report(docs, materialize(detect_truncation(docs), "cut_found"))


def p8_evidence(spark: SparkSession, d: str) -> DataFrame:
    """By which evidence texts were found: at a spike of the histogram, or by the second stage."""
    found = detect_truncation(table(spark, d, "documents"))
    return found.groupBy("source", "evidence").agg(F.count("*").alias("n"))


def p8_limits(spark: SparkSession, d: str) -> DataFrame:
    return length_spikes(table(spark, d, "documents"), "source", "text").select("source", "unit", "length", "n")


QUERIES = {f.__name__: f for f in (p1_found, p1_run_lengths, p3_found, p4_found, p4_archive_percentiles, p4_sample_percentiles, p4_day_percentiles, p4_contig_percentiles, p4_norm_bounded, p5_found, p5_packing, p5_placed, p5_mixture, p5_room, p6_ids, p6_token_counts, p6_bytes, p7_mix, p7_shares, p7_bounds, p8_found, p8_source_shares, p8_evidence, p8_limits)}

#: Runs of 2 bases and more: number the events that aren't neutral, and begin a run where the base changes or the gap is wider than 2.
_RUNS = """
cells as (select tbl, seq_id, x.v as v, x.i as i from (
    select distinct 'encoded_batches' as tbl, batch_id as seq_id, unnest(list_transform(ref_seq, lambda v, i: {'v': v::int, 'i': i::int - 1})) as x from encoded_batches
    union all select distinct 'prediction_windows', window_id, unnest(list_transform(ref_seq, lambda v, i: {'v': v::int, 'i': i::int - 1})) from prediction_windows)),
ev as (select *, lag(v) over w as pv, lag(i) over w as pi from cells where v not in (4, 5, 6) window w as (partition by tbl, seq_id order by i)),
gr as (select *, sum(case when pv = v and i - pi <= 3 then 0 else 1 end) over (partition by tbl, seq_id order by i) as g from ev),
runs as (select tbl, seq_id, min(i)::int as first_col, max(i)::int as last_col, min(v)::int as base, count(*)::int as n_bases from gr where v between 0 and 3 group by tbl, seq_id, g)
"""

_MEASURED = "m as (select distinct archive_id, contig, pos, raw_depth from depth_norm where raw_depth >= 0)"

ORACLE = {
    "p1_found": f"with {_RUNS} select tbl, seq_id, first_col, last_col, base, n_bases from runs where n_bases >= 5",
    "p1_run_lengths": f"with {_RUNS} select tbl, base, n_bases, count(*) as n_runs, sum(last_col - first_col + 1)::bigint as n_cols from runs where n_bases >= 2 group by all",
    "p3_found": """select qname, aln_id from (select *, row_number() over (partition by qname order by s desc, aln_id) as r from (
        select distinct qname, aln_id, coalesce(as_score, 0) as s from alignments where qname is not null and (flag & 4) = 0 and (flag & 2304) <> 0)) where r <= 10""",
    "p4_found": f"""with {_MEASURED}, c as (select archive_id, count(*) as n, count(*) filter (raw_depth < global_median) as lt, count(*) filter (raw_depth <= global_median) as le
        from m join depth_meta using (archive_id) group by 1) select archive_id from c where 10 * lt > 6 * n or 10 * le < 4 * n""",
    "p4_archive_percentiles": f"""with {_MEASURED}, q as (select archive_id, count(*) as n, unnest([0.05, 0.25, 0.5, 0.75, 0.95])::double as prob,
        unnest(quantile_disc(raw_depth, [0.05, 0.25, 0.5, 0.75, 0.95])) as raw_depth from m group by 1)
        select archive_id, n, prob, raw_depth, global_median, global_mean from q left join depth_meta using (archive_id)""",
    **{
        f"p4_{name}_percentiles": f"""with {_MEASURED} select {col}, count(*) as n, unnest([5, 25, 50, 75, 95])::int as "percent", unnest(quantile_disc(raw_depth, [0.05, 0.25, 0.5, 0.75, 0.95])) as raw_depth
        from m join depth_meta using (archive_id) group by 1"""
        for name, col in (("sample", "sample_id"), ("day", "run_day"), ("contig", "contig"))
    },
    "p4_norm_bounded": """select archive_id, count(*) as n, unnest([0.07, 0.5, 0.55, 0.95])::double as prob, round(unnest(quantile_disc(norm, [0.07, 0.5, 0.55, 0.95])), 5) as norm, true as bounded
        from (select distinct archive_id, contig, pos, norm from depth_norm where norm is not null) group by 1""",
    "p5_placed": """select batch_id as item_id, n::bigint as n_cols, ((n + 1023) // 1024)::bigint as n_pieces, true as fits from (select distinct batch_id, coalesce(len(list_filter(ref_seq, lambda x: x <> 7)), 0) as n from encoded_batches)""",
    "p6_bytes": "select source, count(*) as n_docs, coalesce(sum(strlen(text)), 0)::bigint as n_bytes from documents group by 1",
    "p7_bounds": """select distinct source, max_repeats, true as repeats_kept, true as share_kept from mix_targets where target_share > 0 and max_repeats > 0 and source in (select source from documents where text <> '')""",
    "p8_limits": """with u as (select source, unnest([{'unit': 'chars', 'length': length(text)}, {'unit': 'bytes', 'length': strlen(text)}]) as u from documents where text is not null),
        h as (select source, u.unit as unit, u.length as length, count(*) as n from u group by all),
        w as (select *, sum(n) over (partition by source, unit order by length range between 50 preceding and 50 following) - n as near,
            coalesce(sum(n) over (partition by source, unit order by length range between 50 preceding and 8 preceding), 0) as before,
            coalesce(sum(n) over (partition by source, unit order by length range between 8 following and 50 following), 0) as after from h)
        select source, unit, length::int as length, n from w where n >= 5 and n >= 8 * near / 100.0 and after <= before + n * 0.05""",
    "p5_found": """select distinct 'encoded_batches' as tbl, batch_id as item_id from encoded_batches where len(list_filter(ref_seq, lambda x: x <> 7)) > 1024
        union all select distinct 'padded_batches', padded_id from padded_batches where len(list_filter(ref_seq, lambda x: x <> 7)) > 1024""",
}
