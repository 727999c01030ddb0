"""Cluster candidate positions into windows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.intervals import islands

WINDOW = "contig string, win_s bigint, win_e bigint, core_s bigint, core_e bigint, n int"


def merge_island(pos: list[int], merge_dist: int, flank: int, max_win: int) -> list[tuple[int, int, int]]:
    """(first, last, n) of the clusters of sorted positions: the nearest neighbours are joined first, unless the window would be too wide."""
    first, last, head = list(range(len(pos))), list(range(len(pos))), list(range(len(pos)))
    # head of a cluster is its leftmost index; first and last are kept at the leftmost index of the cluster
    for _, i in sorted((b - a, i) for i, (a, b) in enumerate(zip(pos, pos[1:])) if b - a <= merge_dist):
        left = i
        while head[left] != left:
            head[left] = head[head[left]]
            left = head[left]
        right = i + 1
        if pos[last[right]] - pos[left] + 2 * flank <= max_win:
            head[right] = left
            last[left] = last[right]
    return [(pos[i], pos[last[i]], last[i] - i + 1) for i in first if head[i] == i]


def cluster_windows(df: DataFrame, contig: str, pos: str, merge_dist: int = 20, flank: int = 50, max_win: int = 130, block: int = 1_000_000) -> DataFrame:
    """(contig, win_s, win_e, core_s, core_e, n): windows around clusters of distinct positions.

    Clusters never cross islands, so islands are clustered apart; those that begin in the same block of a contig share a group, which is
    bounded by the positions of a block and the island that leaves it. Null contigs and positions are left out.
    """

    def cluster(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("pos")
        rows = []
        for _, part in x.groupby("island", sort=True):
            for a, b, n in merge_island(part["pos"].tolist(), merge_dist, flank, max_win):
                rows.append((x["contig"].iloc[0], max(0, a - flank), b + flank, a, b + 1, n))
        return pd.DataFrame(rows, columns=["contig", "win_s", "win_e", "core_s", "core_e", "n"])

    grouped = islands(df, contig, pos, merge_dist).withColumn("block", F.floor(F.col("island") / block))
    return grouped.groupBy("contig", "block").applyInPandas(cluster, WINDOW)


def number_gaps(grouped: DataFrame) -> DataFrame:
    """grouped (contig, pos, island) with i, the place of a position in its island from 1, the gap to the next one, null at the end, and its rank, the least gap first."""
    by = Window.partitionBy("contig", "island")
    g = grouped.withColumn("i", F.row_number().over(by.orderBy("pos"))).withColumn("gap", F.lead("pos").over(by.orderBy("pos")) - F.col("pos"))
    return g.withColumn("rank", F.row_number().over(by.orderBy(F.col("gap").asc_nulls_last(), "pos")))
