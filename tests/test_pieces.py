import random
import time

import pytest
from pyspark.sql import functions as F

from strandline.functions import casts as C
from strandline.functions import sequence as S
from strandline.operators import fusion, pileup

CONTIG = "contig string, seq string"


def longest_runs(seq):
    """By definition: of each base the longest stretch over it in which every base is like the one k on, k bases longer."""
    best = [1] * len(seq)
    for k in (1, 2, 3):
        for i in range(len(seq) - k):
            if seq[i] == seq[i + k] and (i == 0 or seq[i - 1] != seq[i - 1 + k]):
                j = i
                while j + k < len(seq) and seq[j] == seq[j + k]:
                    j += 1
                for p in range(i, j + k):
                    best[p] = max(best[p], j + k - i)
    return best


def low_complexity(rng, n):
    out = ""
    while len(out) < n:
        out += rng.choice(["A", "AC", "ACG", "T", "GT", "N", "ACGT"]) * rng.choice([1, 1, 2, 3, 30])
    return out[:n]


@pytest.mark.parametrize("size", [16, 64])
def test_runs_go_over_pieces(spark, size):
    rng = random.Random(size)
    seqs = {f"c{n}": low_complexity(rng, n) for n in [1, 2, 3, 4, size - 1, size, size + 1, size + 10, size + 11, 2 * size + 20, 500, 1000]} | {"same": "A" * 300}
    df = spark.createDataFrame([*seqs.items(), ("none", None), ("empty", "")], CONTIG)
    got = {}
    for r in pileup.repeats(df, size).collect():
        got.setdefault(r["contig"], {})[r["pos"]] = r["repeat_len"]
    assert got == {c: dict(enumerate(longest_runs(s))) for c, s in seqs.items()}
    chunks = pileup.reference_chunks(df, size, 3).orderBy("contig", "bin").collect()
    for c, s in seqs.items():
        assert "".join(x["chunk"][x["lead"] : x["lead"] + x["own"]] for x in chunks if x["contig"] == c) == s


def test_twice_the_contig_takes_about_twice_the_time(spark):
    def took(n):
        df = spark.createDataFrame([("c", "ACGTTGCA" * (n // 8))], CONTIG)
        began = time.time()
        assert pileup.reference_chunks(df, 256, 10).agg(F.sum("own")).first()[0] == n
        return time.time() - began

    took(800_000)
    once, four = took(1_600_000), took(6_400_000)
    assert four < 8 * once + 2


def test_ranges_and_gc(spark):
    rng = random.Random(1)
    seq = "".join(rng.choice("acgtN") for _ in range(1000))
    df = spark.createDataFrame([("c", seq), ("none", None)], CONTIG)
    rows = [(i, rng.choice(["c", "c", "none", None]), a := rng.randint(0, 1100), a + rng.randint(-2, 200)) for i in range(60)]
    got = {r["i"]: r["seq"] for r in pileup.ranges_of(spark.createDataFrame(rows, "i int, k string, a int, b int"), df, "i", "k", "a", "b", 64).collect()}
    assert got == {i: seq[a:b].upper() for i, k, a, b in rows if k == "c" and b > a}
    gc = {r["pos"]: r["gc"] for r in pileup.gc_content(df).collect()}
    for p in range(1000):
        near = seq[max(0, p - 10) : p + 11].upper()
        assert abs(gc[p] - sum(x in "GC" for x in near) / len(near)) < 1e-12


def written(seq, changes):
    """The rule, on a list of bases."""
    cells, reach, applied, skipped = list(seq.upper()), 0, 0, 0
    head = [""] * (len(seq) + 1)
    for pos, ref, alt in sorted(changes):
        if max(len(ref), len(alt)) > 1 and ref[:1] == alt[:1]:
            pos, ref, alt = pos + 1, ref[1:], alt[1:]
        if ref == alt == "":
            continue
        s = pos - 1
        if s < reach or s > len(seq) or seq[s : s + len(ref)].upper() != ref:
            skipped += 1
            continue
        head[s] += alt
        for i in range(s, s + len(ref)):
            cells[i] = ""
        reach, applied = s + len(ref), applied + 1
    return "".join(h + c for h, c in zip(head, [*cells, ""])), applied, skipped


@pytest.mark.parametrize("size", [8, 1 << 14])
def test_variants_are_written_over_pieces(spark, size):
    rng = random.Random(size)
    seqs = {f"c{i}": "".join(rng.choice("ACgt") for _ in range(n)) for i, n in enumerate([1, 8, 16, 40, 100])} | {"plain": "ACGT"}
    rows = set()
    for c, s in seqs.items():
        for _ in range(3 * len(s) if c != "plain" else 0):
            p, n = rng.randint(1, len(s) + 1), rng.choice([1, 1, 1, 2, 3, 20])
            ref = s[p - 1 : p - 1 + n].upper() if rng.random() < 0.8 else rng.choice("ACGT") * n
            alt = rng.choice([ref[:1], ref[:1] + "GG", rng.choice("ACGT"), ref + "T"])
            if ref and rng.random() < 0.6:
                rows.add((c, p, ref, alt or "A"))
    v = spark.createDataFrame([*rows, ("gone", 1, "A", "C"), (None, 1, "A", "C")], "chrom string, pos bigint, ref string, alt string").withColumn("applied", F.lit("x")).select("chrom", "pos", "ref", "alt")
    got = {r["contig"]: (r["seq"], r["applied"], r["skipped"]) for r in fusion.apply_variants(v, spark.createDataFrame([*seqs.items(), ("n", None), ("e", "")], CONTIG), size).collect()}
    assert got == {c: written(s, [r[1:] for r in rows if r[0] == c]) for c, s in seqs.items()} | {"e": ("", 0, 0)}
    assert sum(x[1] for x in got.values()) > 20 and sum(x[2] for x in got.values()) > 20
    agrees = fusion.reference_agrees(v, spark.createDataFrame([*seqs.items()], CONTIG), size).filter("chrom is not null").collect()
    assert all(r["agrees"] == (seqs.get(r["chrom"], "")[r["pos"] - 1 : r["pos"] - 1 + len(r["ref"])].upper() == r["ref"]) for r in agrees)


def test_walk_of_long_and_missing_cigars(spark):
    long_ = [("M", 3), ("I", 2), ("D", 1), ("S", 4)] * 10_000
    rows = [(1, 100, [("S", 5), ("M", 10), ("D", 2), ("I", 3), ("N", 7), ("=", 1)]), (2, 0, None), (3, 5, []), (4, 7, long_), (5, 1, [("M", None), ("M", 2)])]
    df = spark.createDataFrame(rows, "k int, start0 bigint, cigar array<struct<op:string,len:int>>").withColumn("r", F.lit(1)).withColumn("i", F.lit(1))
    got = {}
    for r in S.walk_ops(df, ["k"]).orderBy("k", "i").collect():
        got.setdefault(r["k"], []).append((r["op"], r["ref_pos"], r["query_pos"]))
    assert got[1] == [("S", 100, 0), ("M", 100, 5), ("D", 110, 15), ("I", 112, 15), ("N", 112, 18), ("=", 119, 18)]
    assert set(got) == {1, 4, 5} and got[5] == [("M", 1, 0), ("M", 1, 0)]
    assert got[4][-1] == ("S", 7 + 4 * 10_000, 9 * 10_000 - 4) and len(got[4]) == 40_000


def test_checked_casts(spark):
    df = spark.createDataFrame([("7",), ("-7",), ("7.0",), ("7.5",), ("x",), (None,), ("99999999999999999999",), (" 8 ",)], "v string")
    assert [r[0] for r in df.select(C.to_index(F.col("v"), False)).collect()] == [7, None, 7, None, None, None, None, 8]
    assert [r[0] for r in df.select(C.to_long(F.col("v"), False)).collect()] == [7, -7, 7, None, None, None, None, 8]
    assert [r[0] for r in spark.createDataFrame([(0.5,), (1e300,), (None,)], "v double").select(C.to_float(F.col("v"), False)).collect()] == [0.5, None, None]
    for bad in ("-7", "7.5", "x"):
        with pytest.raises(Exception, match="no index"):
            df.filter(F.col("v") == bad).select(C.to_index(F.col("v"))).collect()
