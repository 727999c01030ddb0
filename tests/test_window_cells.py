import random
import re

import pytest
from pyspark.sql import functions as F

from strandline.functions import sequence as S
from strandline.operators import encode as E
from strandline.operators import window_cells as C
from strandline.operators.pileup import CHUNK, reference_chunks
from strandline.queries import QUERIES

READ = "aln_id bigint, contig string, start0 bigint, end0 bigint, flag int, mapq int, platform string, cigar array<struct<op:string,len:int>>, seq string, qual array<tinyint>"
WINDOW = "batch_id bigint, chrom string, win_s int, win_e int, core_s int, core_e int"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    reads = []
    for i in range(400):
        platform, scale = rng.choice([("ILLUMINA", 1), ("ILLUMINA", 1), ("HIFI", 20), ("PACBIO", 20)])
        ops = [("M", rng.randrange(30, 60) * scale)]
        for _ in range(rng.randrange(4)):
            ops += [(rng.choice("IDNIX="), rng.choice([1, 2, 3, 15, 16])), ("M", rng.randrange(10, 40) * scale)]
        if rng.random() < 0.5:
            ops = [("S", rng.randrange(1, 12)), *ops]
        start = rng.choice([rng.randrange(0, 700), rng.randrange(0, 3000)])
        n = sum(k for o, k in ops if o in "MIS=X")
        seq = rng.choice([None, "", "".join(rng.choice("ACGTNacgé") for _ in range(rng.choice([n, n - 7])))])
        qual = None if not seq else [rng.choice([None, 7, 40]) for _ in range(rng.choice([len(seq), 5]))]
        row = (i, rng.choice(["c", "c", "d"]), start, start + sum(k for o, k in ops if o in "MDN=X"), 0, rng.choice([60, 1, None]) if scale == 1 else 20, platform, ops, seq, qual)
        reads += [row] * rng.choice([1, 1, 2])
    wins = [(i, rng.choice(["c", "d", None]), s, s + rng.randrange(0, 130), s + 20, s + 20 + rng.choice([0, 9, 30])) for i, s in enumerate(rng.choice([rng.randrange(-30, 700), rng.randrange(2900)]) for _ in range(150))]
    wins += [(1000, "c", 100, 2600, 300, 2500), (1001, "c", None, 200, 100, 150), (None, "c", 0, 200, 100, 150)]
    # reads that delete and insert at the same places, in a window of their own
    reads += [(i, "c", 500, 572, 0, 60, "ILLUMINA", [("M", 30), ("D", 2), ("M", 20), ("I", 3), ("M", 20)], "ACGT" * 18 + "A", [30] * 73) for i in range(400, 406)]
    wins.append((1002, "c", 480, 600, 500, 560))
    contigs = [("c", "".join(rng.choice("ACGTNa") for _ in range(1500))), ("d", None)]
    return spark.createDataFrame(reads, READ), spark.createDataFrame(wins, WINDOW), spark.createDataFrame(contigs, "contig string, seq string")


def wanted(tables, what, reach, depth):
    """The same sums from encode, by shuffling pairs and cells."""
    reads, windows, contigs = tables
    s = E.select_reads(E.window_reads(reads, windows, reach=reach), depth).cache()
    cols = E.columns(windows, E.insertions(s))
    c, dep = E.cells(s, cols), s.groupBy("batch_id").agg(F.count("*").alias("depth"))
    if what == "sums":
        return c.groupBy("batch_id", "platform").agg(F.count("*"), F.sum("base"), F.sum("bq"), F.sum(F.col("col") * (F.col("base") + 1)))
    variant = F.col("op").isin("I", "D")
    if what in ("codes", "differing"):
        known = reference_chunks(contigs).select(F.col("contig").alias("chrom"), "bin", "chunk")
        ref = cols.withColumn("bin", F.floor(F.col("pos") / CHUNK)).join(known, ["chrom", "bin"]).withColumn("b", F.expr(f"substring(chunk, int(pos - bin * {CHUNK}) + 1, 1)")).filter("b <> ''")
        c = c.join(ref.select("batch_id", "pos", S.base_code("b").alias("code")), ["batch_id", "pos"])
        c = c.withColumn("cc", F.when(F.col("op") == "D", 3).when(F.col("op") == "I", 4).when(F.col("base") == F.col("code"), 1).otherwise(2))
        if what == "codes":
            return c.groupBy("batch_id", "platform", "cc").count()
        variant = F.col("cc") > 1
    v = c.groupBy("batch_id", "col").agg(F.count_if(variant).alias("variants"))
    return v.join(dep, "batch_id").filter("variants >= greatest(2, 0.01 * depth)").select("batch_id", "col", "variants", "depth")


def same(tables, what, reach=True, depth=30):
    reads, windows, contigs = tables
    got = C.cell_sums(reads, windows, what, contigs, reach=reach, depth=depth)
    a, b = (sorted(map(tuple, x.collect())) for x in (got, wanted(tables, what, reach, depth)))
    assert a == b and a
    return got


def test_differing_columns_without_a_shuffle_of_pairs_or_cells(tables, monkeypatch):
    got = same(tables, "differing")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # above Python nothing is grouped or joined, so what is as large as the pairs or the cells stays in a task
    assert plan.lstrip().startswith("MapInArrow")
    # few pairs and cells at a time, and a region parted by window, give the same
    monkeypatch.setattr(C, "PAIRS", 7)
    monkeypatch.setattr(C, "CELLS", 50)
    monkeypatch.setattr(C, "HOT", 500)
    same(tables, "differing", depth=3)


def test_codes_by_platform(tables):
    same(tables, "codes")


def test_sums_by_platform(tables):
    same(tables, "sums")


def test_indels_by_column(tables):
    same(tables, "indels")


def test_codes_of_parted_regions_and_small_blocks(tables, monkeypatch):
    for name, value in (("PAIRS", 7), ("CELLS", 50), ("HOT", 500)):
        monkeypatch.setattr(C, name, value)
    same(tables, "codes", depth=3)


def test_differing_columns_where_the_span_alone_tells(tables):
    same(tables, "differing", reach=False)


@pytest.mark.parametrize("name", ["flt_col_support_core", "fn_cell_code", "udf_encode_window_core", "agg_support_core", "fn_cell_code_core", "flt_col_support"])
def test_the_query_sums_its_cells_where_they_are_made(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("MapInArrow")


@pytest.mark.parametrize("name", ["fn_cell_code_core", "flt_col_support"])
def test_qualities_stay_where_only_bases_are_compared(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation [" in line and "cigar#" in line]
    # the table's own column of qualities is named where it is scanned and nowhere above
    own = {q for line in scans for q in re.findall(r"\bqual#\d+", line)}
    assert own and not any(own & {*re.findall(r"\bqual#\d+", line)} for line in plan.splitlines() if line not in scans)


@pytest.mark.parametrize("name", ["flt_col_support", "fn_cell_code_core"])
def test_copies_of_a_read_are_dropped_in_its_region(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[aln_id#", plan)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_records_in_several_versions_or_many_copies(spark, tables, limit, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_ROWS", limit)
    reads, windows, contigs = tables
    windows = windows.filter("batch_id = 1002")
    row = (900, "c", 500, 560, 0, 60, "ILLUMINA", [("M", 60)], "A" * 60, [30] * 60)
    sums = lambda rows: sorted(map(tuple, C.cell_sums(reads.unionByName(spark.createDataFrame(rows, READ)), windows, "codes", contigs).collect()))
    # of two versions one counts, whichever it is; copies and records without a name count once
    there, off, unnamed = (*row[:2], 510, 570, *row[4:]), (*row[:8], "C" * 60, row[9]), (None, *row[1:])
    assert sums([row, there, row]) in (sums([row]), sums([there]))
    assert sums([row, off]) in (sums([row]), sums([off]))
    assert sums([row] * 30) == sums([row])
    assert sums([unnamed, unnamed]) == sums([unnamed])
