import random

from strandline.operators.encode import select_reads, window_reads

READ = "aln_id bigint, contig string, start0 bigint, end0 bigint, flag int, mapq int, platform string, cigar array<struct<op:string,len:int>>"
WINDOW = "batch_id bigint, chrom string, win_s int, win_e int, core_s int, core_e int, targets_ref_pos array<int>"


def test_reads_come_by_core_not_by_targets(spark):
    reads = [(i, "c", s, s + 60, 0, 60, "ILLUMINA", [("M", 60)]) for i, s in ((1, 90), (2, 170), (3, 40), (4, 39), (5, 179), (6, 180))]
    cores = [
        (1, "c", 50, 230, 100, 180, [120]),
        (2, "c", 50, 230, 100, 180, []),
        (3, "c", 50, 230, 100, 180, [110, 130]),
        (4, "c", 50, 230, 100, 180, None),
        (5, "c", 50, 230, 100, 100, [100, 110]),
        (6, "c", 50, 150, 100, 180, [120]),
        (7, "d", 50, 230, 100, 180, [120]),
    ]
    got = {}
    for r in window_reads(spark.createDataFrame(reads, READ), spark.createDataFrame(cores, WINDOW)).collect():
        got.setdefault(r["batch_id"], {})[r["aln_id"]] = r["win_overlap"]
    # the core is half-open: read 3 ends where it begins, read 6 starts where it ends; a read must also reach into its window
    whole = {1: 60, 2: 60, 5: 51}
    assert got == {1: whole, 2: whole, 3: whole, 4: whole, 6: {1: 60}}


def test_contained_reads_against_brute_force_without_an_array(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        platform = rng.choice(["ILLUMINA", "NANOPORE"])
        start = rng.randrange(0, 200, 5)
        rows.append((rng.randrange(4), platform, i, start, start + rng.randrange(5, 300, 5), 5 if platform == "ILLUMINA" else 50, rng.random() < 0.3, 100, 0.0, 60, 10))
    df = spark.createDataFrame(rows, "batch_id bigint, platform string, aln_id bigint, start0 bigint, end0 bigint, trust int, backbone boolean, aln_len int, clip_ratio double, mapq int, win_overlap bigint")
    got = select_reads(df, depth=1000)
    trusted = [(b, p, s + t, e - t) for b, p, _, s, e, t, backbone, *_ in rows if backbone and e - s > 2 * t]
    kept = {i for b, p, i, s, e, _, backbone, *_ in rows if backbone or not any((b, p) == x[:2] and x[2] <= s and x[3] >= e for x in trusted)}
    assert {r["aln_id"] for r in got.collect()} == kept and len(kept) < len(rows)
    assert "collect_list" not in got._jdf.queryExecution().toString()
