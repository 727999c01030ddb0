def test_depth_of_all_windows_and_contigs(spark, tmp_path):
    from __spark_entry__ import queries

    windows = [(1, "a", 10, 12), (1, "a", 10, 12), (2, "b", 510, 514), (3, "a", 11, 13), (4, "gone", 0, 900), (5, None, 0, 900), (6, "a", 12, 12)]
    spark.createDataFrame(windows, "batch_id bigint, chrom string, win_s int, win_e int").write.parquet(f"{tmp_path}/encoded_batches.parquet")
    depth = [(7, "a", p, float(p)) for p in (9, 10, 11, 12, 13)] + [(8, "b", 511, 1.5), (8, "b", 511, 1.5), (8, "b", 512, None), (9, "a", 11, 2.5), (9, None, 11, 2.5)]
    spark.createDataFrame(depth, "archive_id bigint, contig string, pos bigint, norm float").write.parquet(f"{tmp_path}/depth_norm.parquet")
    got = [tuple(r) for r in queries()["src_depth_windows"](spark, str(tmp_path)).collect()]
    want = [(1, 7, 10, 10.0), (1, 7, 11, 11.0), (1, 9, 11, 2.5), (2, 8, 511, 1.5), (2, 8, 512, None), (3, 7, 11, 11.0), (3, 7, 12, 12.0), (3, 9, 11, 2.5)]
    assert sorted(got, key=str) == sorted(want, key=str)
