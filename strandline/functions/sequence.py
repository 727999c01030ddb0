"""Column functions over read sequences, qualities and CIGAR arrays (array<struct<op, len>>)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline import codes

LongCol = Column | str


def _c(x: LongCol) -> Column:
    return F.col(x) if isinstance(x, str) else x


def revcomp(seq: LongCol) -> Column:
    """Reverse complement; case is kept, U pairs as T does, other letters stay."""
    return F.reverse(F.translate(_c(seq), "ACGTUacgtu", "TGCAAtgcaa"))


def is_reverse(flag: LongCol) -> Column:
    return _c(flag).bitwiseAND(codes.REVERSE) != 0


def plus_seq(seq: LongCol, flag: LongCol) -> Column:
    """The sequence as read: records on the reverse strand store its reverse complement."""
    return F.when(is_reverse(flag), revcomp(seq)).otherwise(_c(seq))


def plus_qual(qual: LongCol, flag: LongCol) -> Column:
    return F.when(is_reverse(flag), F.reverse(_c(qual))).otherwise(_c(qual))


def cigar_sum(cigar: LongCol, ops: str) -> Column:
    """Total length of the operations whose letter is in ops; 0 for none, null for a null cigar."""
    return F.aggregate(_c(cigar), F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["op"].isin(*ops), x["len"]).otherwise(0))


def ref_end(start: LongCol, cigar: LongCol) -> Column:
    return _c(start) + cigar_sum(cigar, "MDN=X")


def aligned_len(cigar: LongCol) -> Column:
    return cigar_sum(cigar, "MI=X")


def read_len(cigar: LongCol) -> Column:
    return cigar_sum(cigar, "MISH=X")


def _end_clip(first: Column, second: Column) -> Column:
    inner = F.when(second["op"] == "S", second["len"]).otherwise(0)
    return F.when(first["op"] == "H", first["len"] + F.coalesce(inner, F.lit(0))).when(first["op"] == "S", first["len"]).otherwise(0)


def clip_len(cigar: LongCol) -> Column:
    """Clipped bases of both ends: an outer hard clip with the soft clip inside it, else the outer soft clip."""
    c = _c(cigar)
    left = _end_clip(F.try_element_at(c, F.lit(1)), F.try_element_at(c, F.lit(2)))
    right = _end_clip(F.try_element_at(c, F.lit(-1)), F.try_element_at(c, F.lit(-2)))
    return (left + right).cast("bigint")


def clip_ratio(cigar: LongCol) -> Column:
    return clip_len(cigar) / F.nullif(read_len(cigar), F.lit(0))


def _hard_run(cigar: Column) -> Column:
    """Length of the hard clips that begin the array."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("on"))
    step = lambda a, x: F.struct((a["n"] + F.when(a["on"] & (x["op"] == "H"), x["len"]).otherwise(0)).alias("n"), (a["on"] & (x["op"] == "H")).alias("on"))
    return F.coalesce(F.aggregate(cigar, start, step, lambda a: a["n"]), F.lit(0))


def hard_trim(seq: LongCol, cigar: LongCol) -> Column:
    """seq without the bases that the CIGAR clips hard at either end; empty where the clips meet."""
    s, left, right = _c(seq), _hard_run(_c(cigar)), _hard_run(F.reverse(_c(cigar)))
    return F.when(left >= F.length(s) - right, F.lit("")).otherwise(F.substring(s, (left + 1).cast("int"), (F.length(s) - left - right).cast("int")))


def hard_trim_qual(qual: LongCol, cigar: LongCol) -> Column:
    q, left, right = _c(qual), _hard_run(_c(cigar)), _hard_run(F.reverse(_c(cigar)))
    keep = F.greatest(F.lit(0), F.size(q) - left - right).cast("int")
    return F.slice(q, (left + 1).cast("int"), keep)


def cigar_text(cigar: LongCol) -> Column:
    return F.array_join(F.transform(_c(cigar), lambda x: F.concat(x["len"].cast("string"), x["op"])), "")


def parse_cigar(text: LongCol) -> Column:
    """array<struct<op, len>> of a CIGAR string."""
    parts = F.regexp_extract_all(_c(text), F.lit(r"([0-9]+[MIDNSHP=X])"), 1)
    return F.transform(parts, lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.regexp_extract(x, r"^([0-9]+)", 1).cast("int").alias("len")))


def condensed_mismatches(md: LongCol) -> Column:
    """Runs of mismatches and deletions in an MD string; only a match count above 0 parts two runs."""
    parted = F.replace(F.regexp_replace(_c(md), "[0-9]*[1-9][0-9]*", "|"), F.lit("0"), F.lit(""))
    return F.regexp_count(parted, F.lit("[^|]+"))


def int_tag(text: LongCol) -> Column:
    """A tag's integer; 0 where it is missing or isn't one."""
    return F.coalesce(_c(text).try_cast("bigint"), F.lit(0))


def base_code(base: LongCol) -> Column:
    """0 to 3 for A, C, G, T in either case, 4 for anything else."""
    return F.coalesce(F.nullif(F.instr(F.lit("ACGT"), F.upper(_c(base))), F.lit(0)) - 1, F.lit(codes.UNKNOWN)).cast("int")


def mapq_code(mapq: LongCol) -> Column:
    return F.when(_c(mapq) == 255, 0).otherwise(_c(mapq))


def cell_code(read_base: Column, ref_code: Column) -> Column:
    """Insertion in an insertion column, else match or mismatch of the base codes."""
    return F.when(ref_code == codes.INSERTION_COLUMN, codes.CELL_INSERTION).when(read_base == ref_code, codes.CELL_MATCH).otherwise(codes.CELL_MISMATCH)


def round_up(x: Column, step: int, least: int) -> Column:
    return F.greatest(F.ceil(x / step) * step, F.lit(least)).cast("bigint")


def _before(flat: pa.StructArray, ops: str, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Summed length of the operations in ops that stand before each one in its own array; first is where each array begins."""
    op, length = flat.flatten()
    step = np.where(pc.is_in(op, pa.array(list(ops))).to_numpy(zero_copy_only=False), length.fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    before = np.r_[0, np.cumsum(step)]
    return before[:-1] - np.repeat(before[first], counts)


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("r", T.LongType()), T.StructField("q", T.LongType())])))
def _op_starts(cigar: pa.Array) -> pa.Array:
    counts = pc.list_value_length(cigar).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(counts)
    flat = cigar.flatten()
    at = [pa.array(_before(flat, ops, ends - counts, counts)) for ops in ("MDN=X", "MIS=X")]
    offsets = pa.array(np.r_[0, ends].astype(np.int32), mask=np.r_[pc.is_null(cigar).to_numpy(zero_copy_only=False), False])
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(at, names=["r", "q"]))


def walk_ops(df, keep: list[str], start: str = "start0", cigar: str = "cigar"):  # noqa: ANN001, ANN201
    """A row for each CIGAR operation: i, op, len, and where it begins on the reference (ref_pos) and in the read (query_pos).

    The running sums are taken over all operations of an Arrow batch at once, so a read of any number of operations costs what its operations cost;
    only the CIGAR goes to Python, nothing is shuffled. A null or empty CIGAR has no rows; a null length counts as 0.
    """
    ops = F.arrays_zip(F.col(cigar).alias("c"), _op_starts(F.col(cigar)).alias("at"))
    out = df.select(*keep, F.col(start).alias("__s"), F.posexplode(ops).alias("i", "o"))
    return out.select(*keep, "i", F.col("o.c.op").alias("op"), F.col("o.c.len").alias("len"), (F.col("__s") + F.col("o.at.r")).alias("ref_pos"), F.col("o.at.q").alias("query_pos"))
