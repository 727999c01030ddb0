"""Pileups by position and platform, and the features of candidate positions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import sequence as S
from strandline.operators.alignment_filter import flag_clear, records
from strandline.runtime import materialize

CHUNK = 256
SUMS = ["match_f", "match_r", "mis_f", "mis_r", "indel_f", "indel_r", "mis_bq", "mis_mq", "indel_bq", "indel_mq", "n_mis", "n_indel"]


def reference_chunks(contigs: DataFrame, size: int = CHUNK, halo: int = 0) -> DataFrame:
    """(contig, bin, chunk, lead, own): contig sequences in upper case, in pieces, cut in one pass over a sequence.

    chunk begins at base bin * size and holds 2 * halo bases more than size where the contig has them. It stands for the own bases behind its first lead ones: those
    have halo bases on either side, as far as the contig goes. Every base is some piece's own; the last piece may own none. lead is halo, but 0 in the first piece.
    """
    pieces = F.regexp_extract_all(F.upper("seq"), F.lit(f"(?s)(?=(.{{1,{size + 2 * halo}}})).{{1,{size}}}"), 1)
    c = contigs.filter("length(seq) > 0").select("contig", F.posexplode(pieces).alias("bin", "chunk"))
    c = c.select("contig", F.col("bin").cast("bigint").alias("bin"), "chunk", F.when(F.col("bin") == 0, 0).otherwise(halo).alias("lead"))
    return c.withColumn("own", F.greatest(F.least(F.length("chunk"), F.lit(size + halo)) - F.col("lead"), F.lit(0)))


def ranges_of(rows: DataFrame, contigs: DataFrame, ident: str, contig: str, start: str, end: str, size: int = 4096) -> DataFrame:
    """(ident, seq): the upper-case bases of each row's half-open range, as far as the contig goes; empty behind its end.

    Each range takes its part of the pieces it touches, joined by (contig, piece), so no range meets a whole sequence. Contigs without a sequence have no rows; ident must be unique.
    """
    c = reference_chunks(contigs, size).select(F.col("contig").alias("c_contig"), "bin", "chunk")
    r = rows.filter(F.col(contig).isNotNull() & (F.col(end) > F.col(start))).select(ident, F.col(contig).alias("r_contig"), F.greatest(F.col(start), F.lit(0)).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"))
    known = contigs.filter("length(seq) > 0").select(F.col("contig").alias("k_contig"))
    touched = r.withColumn("b", F.explode(F.sequence(F.floor(F.col("s") / size), F.floor((F.col("e") - 1) / size))))
    at, to = F.greatest(F.col("s") - F.col("bin") * size, F.lit(0)), F.least(F.col("e") - F.col("bin") * size, F.lit(size))
    parts = touched.join(c, (F.col("r_contig") == F.col("c_contig")) & (F.col("b") == F.col("bin"))).select(ident, "bin", F.substring("chunk", (at + 1).cast("int"), (to - at).cast("int")).alias("part"))
    whole = parts.groupBy(F.col(ident).alias("p_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bin", "part"))), lambda x: x["part"]), "").alias("seq"))
    return r.join(known, F.col("r_contig") == F.col("k_contig"), "left_semi").join(whole, F.col(ident) == F.col("p_id"), "left").select(ident, F.coalesce("seq", F.lit("")).alias("seq"))


def pileup_reads(aln: DataFrame, min_mq: int = 1) -> DataFrame:
    """Mapped primary records, no duplicates, with sequence, qualities and mapq >= min_mq."""
    keep = flag_clear(0xD04) & (F.col("mapq") >= min_mq) & (F.length("seq") > 0) & (F.size("qual") > 0) & F.col("contig").isNotNull()
    return records(aln.filter(keep).select("aln_id", "contig", "start0", "flag", "mapq", "cigar", F.upper("seq").alias("seq"), "qual", "platform"))


def _mean(a: Column) -> Column:
    return F.coalesce(F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(a), F.lit(0)), F.lit(0.0))


def pileup(aln: DataFrame, contigs: DataFrame, min_mq: int = 1) -> DataFrame:
    """(contig, pos, platform, and the sums named in SUMS) of contigs with a sequence.

    Matches and mismatches by strand, insertions (at the base before) and deletions by strand, and the base and mapping qualities
    of what differs. Operations are cut at the reference's chunks and joined to them by (contig, bin), so that a contig of
    any size spreads over tasks; cells are summed before the shuffle.
    """
    ops = S.walk_ops(pileup_reads(aln, min_mq), ["contig", "platform", "flag", "mapq", "seq", "qual"]).filter(F.col("op").isin("M", "=", "X", "I", "D"))
    rev = S.is_reverse("flag")
    bins = F.sequence(F.floor(F.greatest(F.col("at"), F.lit(0)) / CHUNK), F.floor((F.col("at") + F.col("span") - 1) / CHUNK))
    ops = ops.withColumn("at", F.expr("if(op = 'I', ref_pos - 1, ref_pos)")).withColumn("span", F.expr("if(op = 'I', 1, len)")).filter("at >= 0 and span > 0").withColumn("bin", F.explode(bins))
    ops = ops.join(reference_chunks(contigs).drop("lead", "own"), ["contig", "bin"])
    ops = ops.withColumn("s", F.expr(f"greatest(at, bin * {CHUNK})")).withColumn("e", F.expr(f"least(at + span, bin * {CHUNK} + length(chunk))")).filter("e > s")
    flank = F.expr("slice(qual, int(greatest(query_pos, 1L)), if(query_pos > 0, 2, 1))")
    mean_bq = F.when(F.col("op") == "I", _mean(F.expr("slice(qual, int(query_pos) + 1, len)"))).when(F.col("op") == "D", _mean(flank))
    cut = ops.select(
        "contig", "platform", "mapq", rev.alias("rev"), F.col("op").isin("I", "D").alias("indel"), "s", mean_bq.alias("mean_bq"),
        F.expr(f"substring(chunk, int(s - bin * {CHUNK}) + 1, int(e - s))").alias("ref"),
        F.expr("if(op in ('I', 'D'), null, substring(seq, int(query_pos + s - at) + 1, int(e - s)))").alias("read"),
        F.expr("if(op in ('I', 'D'), null, slice(qual, int(query_pos + s - at) + 1, int(e - s)))").alias("bq"),
        F.explode(F.expr("sequence(0, int(e - s) - 1)")).alias("k"),
    )
    mis = ~F.col("indel") & (F.expr("substring(ref, k + 1, 1)") != F.expr("substring(read, k + 1, 1)"))
    c = cut.select("contig", "platform", "mapq", "rev", "indel", (F.col("s") + F.col("k")).alias("pos"), mis.alias("mis"), "mean_bq", F.expr("try_element_at(bq, k + 1)").alias("bq"))
    hit = ~F.col("indel") & ~F.col("mis")
    n = lambda cond: F.count_if(cond)
    total = lambda cond, v: F.coalesce(F.sum(F.when(cond, v)), F.lit(0)).cast("double")
    return c.groupBy("contig", "pos", "platform").agg(
        n(hit & ~F.col("rev")).alias("match_f"), n(hit & F.col("rev")).alias("match_r"), n(F.col("mis") & ~F.col("rev")).alias("mis_f"), n(F.col("mis") & F.col("rev")).alias("mis_r"),
        n(F.col("indel") & ~F.col("rev")).alias("indel_f"), n(F.col("indel") & F.col("rev")).alias("indel_r"),
        total(F.col("mis"), F.col("bq")).alias("mis_bq"), total(F.col("mis"), F.col("mapq")).alias("mis_mq"), total(F.col("indel"), F.col("mean_bq")).alias("indel_bq"), total(F.col("indel"), F.col("mapq")).alias("indel_mq"),
        n(F.col("mis")).alias("n_mis"), n(F.col("indel")).alias("n_indel"),
    )


def dual(p: DataFrame) -> DataFrame:
    """Both platforms of a position in one row, by conditional sums rather than a full outer join; i_ is short reads, o_ the others."""
    short = F.col("platform") == "ILLUMINA"
    sums = [F.sum(F.when(cond, F.col(c)).otherwise(0)).alias(f"{k}_{c}") for k, cond in (("i", short), ("o", ~short)) for c in SUMS]
    return p.groupBy("contig", "pos").agg(*sums)


def local_alt(d: DataFrame, half: int = 10) -> DataFrame:
    """Adds i_local and o_local: differing reads within half bases on either side, without the position's own, by 20.

    Windows are taken within stretches of the contig that overlap by half, so that no task holds a contig.
    """
    size = 1 << 16
    d = d.withColumn("i_alt", F.col("i_n_mis") + F.col("i_n_indel")).withColumn("o_alt", F.col("o_n_mis") + F.col("o_n_indel"))
    parts = F.array_distinct(F.array(*[F.floor((F.col("pos") + k) / size) for k in (-half, 0, half)]))
    w = Window.partitionBy("contig", "part").orderBy("pos").rangeBetween(-half, half)
    d = d.withColumn("part", F.explode(parts))
    for k in ("i", "o"):
        d = d.withColumn(f"{k}_local", (F.sum(f"{k}_alt").over(w) - F.col(f"{k}_alt")) / 20)
    return d.filter(F.col("part") == F.floor(F.col("pos") / size)).drop("part")


def _bases(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, first, last): the bytes of all pieces, and for each byte where its piece begins and ends."""
    text = [c.encode("ascii", "replace") for c in chunks.to_pylist()]
    n = np.array([len(t) for t in text], np.int64)
    end = np.cumsum(n)
    return np.frombuffer(b"".join(text), np.uint8), np.repeat(end - n, n), np.repeat(end, n)


def _breaks(base: np.ndarray, last: np.ndarray, k: int) -> np.ndarray:
    """Where a base isn't followed by its like k bases on. Pieces reach far enough that only a contig's end cuts them off."""
    broken = np.ones(len(base), bool)
    broken[:-k] = (base[:-k] != base[k:]) | (np.arange(len(base) - k) + k >= last[:-k])
    return broken


PERIODS = (1, 2, 3)
#: For each period the first and last break among a piece's own bases, and the last one but for the final three, which the next piece sees itself.
BREAKS = T.StructType([T.StructField(f"{name}{k}", T.IntegerType()) for k in PERIODS for name in ("first", "last", "most")])


@F.arrow_udf(BREAKS)
def _piece_breaks(chunk: pa.Array, lead: pa.Array, own: pa.Array) -> pa.Array:
    base, first, last = _bases(chunk)
    lead, own = lead.to_numpy(zero_copy_only=False), own.to_numpy(zero_copy_only=False)
    n = pc.binary_length(chunk).to_numpy(zero_copy_only=False)
    begin = np.cumsum(n) - n
    at = np.arange(len(base)) - first
    rank = np.repeat(np.arange(len(n)), n)
    mine, but = (at >= np.repeat(lead, n)) & (at < np.repeat(lead + own, n)), at < np.repeat(lead + own, n) - 3
    cols = []
    for k in PERIODS:
        broken = _breaks(base, last, k) & mine
        for where, end in ((broken, 0), (broken, -1), (broken & but, -1)):
            hit = np.flatnonzero(where)
            piece, one = np.unique(rank[hit], return_index=True) if end == 0 else np.unique(rank[hit][::-1], return_index=True)
            out = np.full(len(n), -1, np.int32)
            out[piece] = (hit if end == 0 else hit[::-1])[one] - begin[piece]
            cols.append(pa.array(out, mask=out < 0))
    return pa.StructArray.from_arrays(cols, names=BREAKS.names)


def _piece_repeats(chunk: pa.Array, lead: pa.Array, own: pa.Array, before: pa.Array, behind: pa.Array) -> pa.Array:
    """Of each own base the longest run over it; before and behind are the nearest breaks outside the piece, by period, as places in the piece."""
    base, first, last = _bases(chunk)
    lead, own = lead.to_numpy(zero_copy_only=False), own.to_numpy(zero_copy_only=False)
    n = pc.binary_length(chunk).to_numpy(zero_copy_only=False)
    index = np.arange(len(base))
    at, low, high = index - first, np.repeat(lead - 3, n), np.repeat(lead + own, n)
    inside = (at >= low) & (at < high)
    outer = [np.repeat(np.asarray(x.flatten()).reshape(-1, len(PERIODS)), n, axis=0) for x in (before, behind)]
    best = np.ones(len(base), np.int64)
    for j, k in enumerate(PERIODS):
        broken = _breaks(base, last, k) & inside
        left = np.maximum.accumulate(np.where(broken, index, -1)) - first
        left = np.where(left < 0, outer[0][:, j], left)
        right = np.minimum.accumulate(np.where(broken, index, len(base))[::-1])[::-1]
        right = np.where(right < last, right - first, outer[1][:, j])
        # a run of matches between two breaks covers k bases more than it has matches
        run = np.where(inside & ~broken, right - left - 1 + k, 0)
        for d in range(k + 1):
            best[d:] = np.where(at[d:] >= d, np.maximum(best[d:], run[: len(run) - d]), best[d:])
    mine = (at >= np.repeat(lead, n)) & inside
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(own)].astype(np.int32)), pa.array(best[mine].astype(np.int32)))


_repeats_udf = F.arrow_udf(_piece_repeats, T.ArrayType(T.IntegerType()))


def repeat_lengths(seq: str) -> np.ndarray:
    """The same of a sequence that is one piece."""
    edge = [pa.array([[x] * len(PERIODS)]) for x in (-1, len(seq))]
    return np.asarray(_piece_repeats(pa.array([seq]), pa.array([0]), pa.array([len(seq)]), *edge).flatten())


def gc_of(chunk: Column, place: Column, half: int) -> Column:
    """Part of G and C within half bases on either side of a place in a piece, as far as the piece goes."""
    near = F.substring(chunk, F.greatest(place - half, F.lit(0)) + 1, place + half + 1 - F.greatest(place - half, F.lit(0)))
    return F.regexp_count(near, F.lit("[GC]")) / F.length(near)


def gc_content(contigs: DataFrame, half: int = 10) -> DataFrame:
    """(contig, pos, gc): part of G and C within half bases on either side that lie in the contig."""
    c = reference_chunks(contigs, CHUNK, half).filter("own > 0").withColumn("k", F.explode(F.expr("sequence(lead, lead + own - 1)")))
    return c.select("contig", (F.col("bin") * CHUNK + F.col("k")).alias("pos"), gc_of(F.col("chunk"), F.col("k"), half).alias("gc"))


def repeat_pieces(contigs: DataFrame, size: int = CHUNK, halo: int = 10, wanted: DataFrame | None = None) -> DataFrame:
    """(contig, bin, chunk, lead, own, repeats): pieces as in reference_chunks with the length of the longest tandem run of period 1, 2 or 3 over each own base, at least 1.

    A run is a stretch of bases each like the one k bases on, and covers k bases more. Runs go over pieces of any number: every piece says
    where it breaks runs, and the nearest break before and behind a piece is carried over the pieces of a contig, of which a window sees nine numbers each. wanted
    (contig, bin) names the pieces whose bases are worked; all by default.
    """
    c = reference_chunks(contigs, size, halo)
    found = c.select("contig", "bin", _piece_breaks("chunk", "lead", "own").alias("b")).select("contig", "bin", *[(F.col("bin") * size + F.col(f"b.{x}")).alias(x) for x in BREAKS.names])
    by = Window.partitionBy("contig").orderBy("bin")
    past, next_, here = by.rowsBetween(Window.unboundedPreceding, -2), by.rowsBetween(1, Window.unboundedFollowing), F.col("bin") * size
    before = [(F.greatest(F.lit(-1), F.max(f"last{k}").over(past), F.lag(f"most{k}").over(by)) - here).cast("int") for k in PERIODS]
    behind = [(F.coalesce(F.min(f"first{k}").over(next_), here) - here).cast("int") for k in PERIODS]
    found = found.select("contig", "bin", F.array(*before).alias("before"), F.array(*behind).alias("behind"))
    if wanted is not None:
        c, found = c.join(wanted, ["contig", "bin"], "left_semi"), found.join(wanted, ["contig", "bin"], "left_semi")
    c = c.join(found, ["contig", "bin"]).filter("own > 0")
    return c.select("contig", "bin", "chunk", "lead", "own", _repeats_udf("chunk", "lead", "own", "before", "behind").alias("repeats"))


def repeats(contigs: DataFrame, size: int = CHUNK) -> DataFrame:
    """(contig, pos, repeat_len) of every base of contigs with a sequence."""
    c = repeat_pieces(contigs, size).select("contig", "bin", "lead", F.posexplode("repeats").alias("k", "repeat_len"))
    return c.select("contig", (F.col("bin") * size + F.col("lead") + F.col("k")).alias("pos"), "repeat_len")


def _own_bin(pos: Column, size: int, halo: int) -> Column:
    """The piece that owns a base."""
    return F.floor(F.greatest(pos - halo, F.lit(0)) / size)


EPS = 1e-6
#: Kinds of difference: counts by strand, summed qualities, number.
KINDS = {"snp": ("mis_f", "mis_r", "mis_bq", "mis_mq", "n_mis"), "ind": ("indel_f", "indel_r", "indel_bq", "indel_mq", "n_indel")}


def depth6(c: Callable[[str], Column]) -> Column:
    """Depth of a position: matches, mismatches and indels of both strands; an insertion counts on top of the base it stands behind. c gives the column of a sum."""
    return reduce(lambda a, b: a + b, map(c, SUMS[:6]))


def vaf(n: Column, depth: Column) -> Column:
    return n / (depth + EPS)


def strand_bias(forward: Column, reverse: Column) -> Column:
    return F.least(forward, reverse) / (forward + reverse + EPS)


def mean_quality(total: Column, n: Column) -> Column:
    return total / (n + EPS)


def features(p: DataFrame, contigs: DataFrame, min_alt: int = 2) -> DataFrame:
    """The features of positions where at least min_alt reads of a platform differ, in the order that a model takes them."""
    d = dual(p)
    if min_alt > 0:
        # positions where no read differs are no candidates and add nothing to those near them
        d = d.filter("i_n_mis + i_n_indel + o_n_mis + o_n_indel > 0")
    d = local_alt(d).filter((F.col("i_alt") >= min_alt) | (F.col("o_alt") >= min_alt))
    # gc and runs are worked only in the pieces that hold such a position, and taken from the piece
    d = materialize(d.withColumn("bin", _own_bin(F.col("pos"), CHUNK, 10)), "feature_rows")
    pieces = repeat_pieces(contigs, CHUNK, 10, d.select("contig", "bin").distinct())
    place = (F.col("pos") - F.col("bin") * CHUNK).cast("int")
    d = d.join(pieces, ["contig", "bin"]).filter(place < F.col("lead") + F.col("own"))
    d = d.withColumn("gc", gc_of(F.col("chunk"), place, 10)).withColumn("repeat_len", F.get("repeats", place - F.col("lead"))).drop("bin", "chunk", "lead", "own", "repeats")
    cols = [F.col("contig"), F.col("pos")]
    for k in ("i", "o"):
        c = lambda name, k=k: F.col(f"{k}_{name}")
        cols.append(depth6(c).cast("double").alias(f"depth_{k}"))
        for kind, (f, r, bq, mq, n) in KINDS.items():
            cols += [vaf(c(n), depth6(c)).alias(f"{kind}_vaf_{k}"), strand_bias(c(f), c(r)).alias(f"{kind}_sb_{k}"), mean_quality(c(bq), c(n)).alias(f"{kind}_bq_{k}"), mean_quality(c(mq), c(n)).alias(f"{kind}_mq_{k}")]
    return d.select(*cols, F.col("i_local").alias("local_i"), F.col("o_local").alias("local_o"), "gc", F.col("repeat_len").cast("double").alias("repeat_len"))
