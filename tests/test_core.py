import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from strandline.functions import probability as P
from strandline.functions import sequence as S
from strandline.operators import fusion, intervals
from strandline.operators.clusters import cluster_windows, merge_island
from strandline.operators.intervals import coverage, overlap_join
from strandline.operators.pileup import repeat_lengths
from strandline.plans.pipeline import Stages
from strandline.runtime import sum_before
from strandline.sources import text as X


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_sequence_literals(spark):
    md = {"10A5": 1, "10A0C5": 1, "10A1C5": 2, "5^AC0G3": 1, "3A00C4": 1, "7^T2^G1": 2, "10": 0, "0A0": 1}
    assert list(one(spark, *[S.condensed_mismatches(F.lit(k)) for k in md])) == list(md.values())
    assert one(spark, S.revcomp(F.lit("AACGTnU")))[0] == "AnACGTT"
    cigar = S.parse_cigar(F.lit("3H2S5M1I2D4M6S"))
    assert list(one(spark, S.clip_len(cigar), S.read_len(cigar), S.aligned_len(cigar), S.ref_end(F.lit(10), cigar), S.cigar_text(cigar))) == [11, 21, 10, 21, "3H2S5M1I2D4M6S"]
    assert one(spark, S.hard_trim(F.lit("ABCDEFGH"), S.parse_cigar(F.lit("2H3M1H"))))[0] == "CDEFG"
    assert one(spark, S.hard_trim(F.lit("ABC"), S.parse_cigar(F.lit("2H3M1H"))))[0] == ""
    assert list(one(spark, *[S.base_code(F.lit(b)) for b in "ACGTacgtN-"])) == [0, 1, 2, 3, 0, 1, 2, 3, 4, 4]


def test_probability_literals(spark):
    p = F.array(*map(F.lit, (0.2, 0.4, 0.4, 0.1)))
    assert list(one(spark, P.argmax(p), P.top2(p))) == [1, [2, 1]]
    assert list(one(spark, *[P.phred(F.lit(x).cast("float")) for x in (0.99, 0.9, 0.999)])) == [20, 9, 30]
    cases = {("AAC", "AC"): ("AA", "A"), ("AC", "AG"): ("C", "G"), ("AT", "ATG"): ("T", "TG"), ("NA", "N"): ("NA", "N"), ("ACGT", "ACGT"): ("A", "A")}
    for (r, a), want in cases.items():
        t = one(spark, P.trim_alleles(F.lit(r), F.lit(a), F.lit(5)))[0]
        assert (t["ref"], t["alt"]) == want


@pytest.mark.parametrize("seed", range(3))
def test_overlap_join_and_coverage_against_brute_force(spark, seed):
    rng = random.Random(seed)
    iv = lambda n: [(i, rng.choice(["a", "b", None]), s := rng.randint(0, 3000), s + rng.randint(0, 900)) for i in range(n)]
    a, b = iv(150), iv(60)
    left = spark.createDataFrame(a, "aln_id int, contig string, start0 bigint, end0 bigint")
    right = spark.createDataFrame(b, "w int, chrom string, win_s int, win_e int")
    got = sorted(map(tuple, overlap_join(left, right, 128).select("aln_id", "w").collect()))
    assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] and x[1] == y[1] and x[2] < x[3] and y[2] < y[3] and x[2] < y[3] and x[3] > y[2])
    dense = {c: [sum(x[1] == c and x[2] <= p < x[3] for x in a) for p in range(4000)] for c in "ab"}
    runs = coverage(left).collect()
    for c in "ab":
        mine = [0] * 4000
        for r in runs:
            if r["contig"] == c:
                mine[r["start"] : r["end"]] = [r["depth"]] * (r["end"] - r["start"])
        assert mine == dense[c]


def test_cluster_literals(spark):
    w = lambda ps: [(max(0, a - 50), b + 50, a, b + 1, n) for a, b, n in merge_island(ps, 20, 50, 130)]
    assert w([100, 115, 135]) == [(50, 165, 100, 116, 2), (85, 185, 135, 136, 1)]
    assert w([100, 120]) == [(50, 170, 100, 121, 2)] and w([10]) == [(0, 60, 10, 11, 1)]
    rows = [("c", p) for p in (100, 110, 125, 200, 200)] + [(None, 5), ("c", None)]
    got = sorted(map(tuple, cluster_windows(spark.createDataFrame(rows, "contig string, pos bigint"), "contig", "pos").collect()))
    assert got == [("c", 50, 175, 100, 126, 3), ("c", 150, 250, 200, 201, 1)]


def greedy(ps, merge=20, flank=50, most=130):
    """The same rule, over sets."""
    groups = [{p} for p in ps]
    for _, i in sorted((b - a, i) for i, (a, b) in enumerate(zip(ps, ps[1:])) if b - a <= merge):
        x, y = (next(g for g in groups if p in g) for p in (ps[i], ps[i + 1]))
        if max(x | y) - min(x | y) + 2 * flank <= most:
            groups.remove(y)
            x |= y
    return [(min(g), max(g), len(g)) for g in groups]


def test_clusters_against_sets():
    rng = random.Random(4)
    for _ in range(300):
        ps = sorted({rng.randint(0, 300) for _ in range(rng.randint(1, 40))})
        assert sorted(merge_island(ps, 20, 50, 130)) == sorted(greedy(ps))


def test_repeats():
    assert repeat_lengths("ACACACGGG").tolist() == [6] * 6 + [3] * 3
    assert repeat_lengths("AATT").tolist() == [2] * 4 and repeat_lengths("ACGACGA").tolist() == [7] * 7 and repeat_lengths("A").tolist() == [1]


def test_sum_before(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", None]), i, rng.randint(0, 9)) for i in rng.sample(range(1000), 200)]
    got = {(r["k"], r["o"]): r["b"] for r in sum_before(spark.createDataFrame(rows, "k string, o bigint, v int"), ["k"], "o", "v", "b", 50).collect()}
    assert got == {(k, o): sum(v for k2, o2, v in rows if k2 == k and o2 < o) for k, o, _ in rows}


def test_apply_variants(spark):
    v = spark.createDataFrame([("c", 2, "C", "T"), ("c", 3, "GT", "G"), ("c", 4, "T", "A"), ("c", 6, "A", "C"), ("d", 1, "N", "A")], "chrom string, pos bigint, ref string, alt string")
    c = spark.createDataFrame([("c", "acgtac"), ("e", "AC"), ("n", None)], "contig string, seq string")
    got = {r["contig"]: tuple(r)[1:] for r in fusion.apply_variants(v, c).collect()}
    assert got == {"c": ("ATGAC", 2, 2), "e": ("AC", 0, 0)}


def test_unseen_sweeps_by_window(spark):
    rows = [(1, "c", 1, 1, 2), (2, "c", 1, 2, 3), (3, "c", 1, 3, 3), (3, "c", 2, 3, 3), (4, "c", 1, 50, 50)]
    rows = [(*r, r[3], "A", "C", 0.5, 0.1, 0.2) for r in rows]
    a = spark.createDataFrame(rows, "window_id bigint, chrom string, block bigint, first_pos bigint, last_pos bigint, vpos bigint, ref string, alt string, prob float, delta double, p_het double")
    # window 2 begins on what 1 wrote; 3 doesn't begin on what was kept; both blocks of one window stay
    assert sorted((r["window_id"], r["block"]) for r in fusion.unseen(a).collect()) == [(1, 1), (3, 1), (3, 2), (4, 1)]


def test_text_sources(spark, tmp_path):
    p = str(tmp_path)
    (tmp_path / "a.fa").write_text(">c1 first\nACg\nT\n\n>c2\nGG\n>empty\n")
    assert sorted(map(tuple, X.read_fasta(spark, f"{p}/a.fa").collect())) == [("c1", "ACgT"), ("c2", "GG"), ("empty", "")]
    (tmp_path / "a.gfa").write_text("H\tVN:Z:1.0\nS\tx\tACGT\nL\tx\t+\ty\t-\t0M\n")
    assert [tuple(r) for r in X.read_gfa(spark, f"{p}/a.gfa").collect()] == [("x", "ACGT")]
    (tmp_path / "a.bed").write_text("# c\n\nc\t1\t9\t2\nc\t1\t9\t2\t3\nd\t1\t9\t2\t3\t4\n")
    assert [tuple(r) for r in X.read_bed(spark, f"{p}/a.bed").collect()] == [("c", 1, 9, 2, 3, None), ("d", 1, 9, 2, 3, 4)]
    assert X.read_bed(spark, f"{p}/missing.bed").count() == 0
    (tmp_path / "a.hap").write_text("r1 1\nr2\t2  77\nshort\n")
    assert sorted(map(tuple, X.read_haplotypes(spark, f"{p}/a.hap").collect())) == [("r1", "1"), ("r2", "2_77")]
    v = spark.createDataFrame([("c", 1, "A", "C", 20, 0.99, 0.5, 0.1, "1/1")], "chrom string, pos bigint, ref string, alt string, qual int, prob float, delta double, p_het double, gt string")
    X.write_vcf(fusion.vcf_rows(v), f"{p}/v")
    assert [tuple(r) for r in X.read_vcf(spark, f"{p}/v").collect()] == [("c", 1, "A", "C", 20, "1/1")]
    with pytest.raises(Exception, match="exist"):
        X.write_vcf(fusion.vcf_rows(v), f"{p}/v")


def test_stages_resume(spark, tmp_path):
    make = lambda: spark.range(3)
    runs = []
    for settings, force in (({"a": 1}, False), ({"a": 1}, False), ({"a": 2}, False), ({"a": 2}, True)):
        s = Stages(spark, str(tmp_path), settings, force)
        assert s("x", make).count() == 3
        runs.append(s.ran)
    assert runs == [["x"], [], ["x"], ["x"]]


def test_entry_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_stretches_equal_a_sweep_over_the_whole_contig(spark):
    rng = random.Random(5)
    for gap, chunk in ((0, 8), (3, 8), (20, 64), (3, 1 << 20)):
        rows = [(rng.choice(["a", "b", None]), i, s := rng.randrange(400), s + rng.choice([0, 0, 1, 5, 60])) for i in range(120)]
        got = {r["i"]: r["head"] for r in intervals.stretches(spark.createDataFrame(rows, "contig string, i int, s bigint, e bigint"), "contig", "s", "e", gap, chunk).collect()}
        want, reach, head, contig = {}, None, None, 0
        for c, i, s, e in sorted(rows, key=lambda r: (r[0] or "", r[2], r[3])):
            if c != contig or s > reach + gap:
                reach, head, contig = e, s, c
            want[i], reach = head, max(reach, e)
        assert got == want
    assert intervals.stretches(spark.createDataFrame([], "contig string, s bigint, e bigint"), "contig", "s", "e").count() == 0


def test_workers_get_the_package_when_the_driver_runs_elsewhere(tmp_path):
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""import sys; sys.path.insert(0, {home!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
from strandline.operators.clusters import cluster_windows
from strandline.runtime import ship_package
ship_package(spark)
print("windows", cluster_windows(spark.createDataFrame([("a", 100), ("a", 110)], "c string, p int"), "c", "p").count())"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "windows 1" in out.stdout, out.stderr[-2000:]
