"""Collapse runs of repeated, or nearly repeated, consecutive events of a sequence.

Each sequence is an entity. Its events become a linked list of runs of equal neighbours; a priority queue holds the
neighbouring pairs within the limits and always merges the most similar pair, the nearer and the earlier first among equals, until
no pair meets the similarity and gap limits. Sequences are handled an Arrow batch at a time: the starting runs and the first
pairs of all sequences of a batch come from numpy, and only pairs that can merge enter the queue.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_FIELDS = "first_col int, last_col int, base int, n_bases int, n_cols int"


def agglomerate(code: np.ndarray, row: np.ndarray, col: np.ndarray, neutral: set[int], wall: set[int], max_gap: int, min_similarity: float, scale: float) -> tuple[np.ndarray, ...]:
    """(row, first, last, code, n) of the merged runs of flat events; row says to which sequence an event belongs.

    The similarity of two runs is 1 - |difference of their mean codes| / scale, at least 0; scale 0 means 1 for equal codes, else 0.
    Neutral events only widen the gap between runs. A wall event ends the run before it and is in none.
    """
    keep = ~np.isin(code, list(neutral))
    c, r, k = code[keep], row[keep], col[keep]
    if not len(c):
        return (np.empty(0, np.int64),) * 5
    start = np.r_[True, (c[1:] != c[:-1]) | (r[1:] != r[:-1]) | (k[1:] != k[:-1] + 1)]
    at = np.flatnonzero(start)
    n = np.diff(np.r_[at, len(c)])
    run_row, first, last, mean = r[at], k[at].copy(), k[at + n - 1].copy(), c[at].astype(float)
    is_wall = np.isin(c[at], list(wall))
    size = n.astype(np.int64).copy()

    def similarity(a: float, b: float) -> float:
        return float(a == b) if scale == 0 else max(0.0, 1 - abs(a - b) / scale)

    # pairs of neighbours that meet the limits at the start
    a = np.arange(len(at) - 1)
    gap = first[1:] - last[:-1] - 1
    near = (run_row[1:] == run_row[:-1]) & ~is_wall[1:] & ~is_wall[:-1] & (gap <= max_gap)
    alike = (mean[1:] == mean[:-1]).astype(float) if scale == 0 else np.maximum(0, 1 - np.abs(mean[1:] - mean[:-1]) / scale)
    near &= alike >= min_similarity
    before, after = np.arange(len(at)) - 1, np.arange(len(at)) + 1
    version, dead = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    queue = [(-alike[i], gap[i], i, i + 1, 0, 0) for i in a[near].tolist()]
    heapq.heapify(queue)

    def offer(i: int, j: int) -> None:
        if i < 0 or j >= len(at) or run_row[i] != run_row[j] or is_wall[i] or is_wall[j]:
            return
        space = first[j] - last[i] - 1
        like = similarity(mean[i], mean[j])
        if space <= max_gap and like >= min_similarity:
            heapq.heappush(queue, (-like, space, i, j, version[i], version[j]))

    while queue:
        _, _, i, j, vi, vj = heapq.heappop(queue)
        if dead[i] or dead[j] or version[i] != vi or version[j] != vj:
            continue
        mean[i] = (mean[i] * size[i] + mean[j] * size[j]) / (size[i] + size[j])
        size[i] += size[j]
        last[i] = last[j]
        dead[j] = True
        version[i] += 1
        after[i] = after[j]
        if after[j] < len(at):
            before[after[j]] = i
        offer(before[i], i)
        offer(i, after[i])
    live = ~dead & ~is_wall
    return run_row[live], first[live], last[live], mean[live], size[live]


def collapse_runs(df: DataFrame, ident: str, seq: str, neutral: tuple[int, ...] = (4, 5, 6), wall: tuple[int, ...] = (7,), max_gap: int = 2, min_bases: int = 1, min_similarity: float = 1.0, scale: float = 0.0) -> DataFrame:
    """(ident, first_col, last_col, base, n_bases, n_cols): one row for each run of at least min_bases events of a sequence.

    Columns count from 0. n_bases are the events in the run, n_cols its length with the neutral columns inside. With the
    defaults a run has one and the same code, and up to max_gap neutral columns stand between two of its bases. base is
    the (rounded mean) code. A null code, and one below 0, counts as a wall. Null and empty sequences have no runs. Repeated
    rows give their runs once; a null ident is kept as its own. Other columns of df, whatever their names, are ignored.
    """
    name = df.schema[ident].name
    spark_type = df.schema[ident].dataType.simpleString()
    wide = "array<bigint>" if df.schema[seq].dataType.simpleString() == "array<bigint>" else "array<int>"
    rows = df.select(F.col(ident).alias("id"), F.col(seq).cast(wide).alias("s")).filter("size(s) > 0")
    neutral_set, wall_set = set(neutral), {*wall, -1}

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, seqs = b.column(0), b.column(1)
            lengths = np.diff(np.asarray(seqs.offsets, dtype=np.int64))
            flat = seqs.flatten()
            code = np.maximum(flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), -1)
            row = np.repeat(np.arange(len(lengths)), lengths)
            col = np.arange(len(code)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            r, first, last, base, n = agglomerate(code, row, col, neutral_set, wall_set, max_gap, min_similarity, scale)
            big = n >= min_bases
            r, first, last, base, n = (x[big] for x in (r, first, last, base, n))
            cols = [pa.array(x.astype(np.int32)) for x in (first, last, np.rint(base), n, last - first + 1)]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(r)), *cols], names=["id", "first_col", "last_col", "base", "n_bases", "n_cols"])

    return rows.mapInArrow(batches, f"id {spark_type}, {RUN_FIELDS}").distinct().withColumnRenamed("id", name)
