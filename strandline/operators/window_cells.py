"""The cells of windows summed up where reads and windows meet: neither pairs nor cells are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline import codes
from strandline.operators.alignment_filter import records, usable_reads
from strandline.operators.pileup import CHUNK, reference_chunks
from strandline.runtime import BROADCAST_ROWS, materialize

#: Windows whose span has at most 2^level bases lie in regions of 2^(level + 2) bases, at least of 2^(LEAST + 2).
LEAST = 7
#: A region with more pairs than HOT is parted, into PARTS at most; a task works on PAIRS pairs or CELLS cells at a time.
HOT, PARTS = 32_000_000, 32
PAIRS, CELLS = 500_000, 1_000_000
#: A record with more copies than this is made single before the copies are moved to their regions.
COPIES = 8

NAMES = sorted({*codes.READ_LIMITS, "PACBIO"})
OPS = ["M", "=", "X", "I", "D", "N", "S"]
_REGION = ["contig", "level", "bin", "part"]
_FIELDS = {
    "contig": "string", "level": "int", "bin": "bigint", "part": "int", "kind": "int", "id": "bigint", "s": "bigint", "e": "bigint", "win_s": "bigint", "win_e": "bigint", "platform": "int", "mapq": "int",
    "aln_len": "bigint", "clip_ratio": "double", "backbone": "boolean", "trust": "int", "cigar": "array<struct<op:string,len:int>>", "seq": "string", "qual": "array<tinyint>",
}
OUT = {
    "sums": "batch_id bigint, platform string, n_cells bigint, base_sum bigint, bq_sum bigint, col_sum bigint",
    "indels": "batch_id bigint, col bigint, variants bigint, depth bigint",
    "codes": "batch_id bigint, platform string, cc int, n bigint",
    "differing": "batch_id bigint, col bigint, variants bigint, depth bigint",
}
_BASE = np.full(256, codes.UNKNOWN, np.int8)
for _letter, _code in codes.BASES.items():
    _BASE[ord(_letter)] = _BASE[ord(_letter.lower())] = _code


def cell_sums(reads: DataFrame, windows: DataFrame, what: str, contigs: DataFrame | None = None, span: tuple[str, str] = ("core_s", "core_e"), reach: bool = True, depth: int = 30, max_insert: int = 15, min_mq: int = 1) -> DataFrame:
    """What the cells of each window sum up to, as encode.cells of encode.select_reads has them: sums by platform, indels by column, codes by platform, or differing by column.

    codes and differing compare with contigs and leave out cells where these have no base; indels and differing keep columns with at least 2, and 1 % of the
    window's selected reads, and give their number as depth. windows has a row for each batch_id; span and reach are those of encode.window_reads.

    Each window lies in one region of its contig, by the start of its span, and each read in all regions where a window may share a base with it. So the reads, the windows and
    the reference are shuffled once, and a task holds the reads of one region at a time. Regions with very many pairs are parted by window.
    Qualities, as long as the sequences, are only moved for sums; nothing else looks at them. Copies of a record meet in their regions and are dropped there.
    """
    w = windows.select("batch_id", F.col("chrom").alias("contig"), *[F.col(c).cast("bigint").alias(n) for c, n in ((span[0], "s"), (span[1], "e"), ("win_s", "win_s"), ("win_e", "win_e"))])
    w = w.filter("batch_id is not null and contig is not null and e > s and win_e > win_s")
    w = w.withColumn("level", F.expr(f"greatest({LEAST}, length(bin(e - s - 1)))")).withColumn("bin", F.expr("shiftright(s, level + 2)"))
    levels = {r["level"]: r["n"] for r in w.groupBy("level").agg(F.max(F.col("e") - F.col("s")).alias("n")).collect()}

    def laid(r: DataFrame) -> DataFrame:
        r = r.withColumn("x", F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.lit(n).cast("bigint").alias("n")) for k, n in (levels or {LEAST: 1}).items()])))
        return r.withColumn("bin", F.explode(F.expr("sequence(shiftright(s - x.n + 1, x.level + 2), shiftright(e - 1, x.level + 2))"))).withColumn("level", F.col("x.level")).drop("x")

    placed = reads.filter("contig is not null and end0 > start0 and flag & 4 = 0").select("contig", F.col("start0").alias("s"), F.col("end0").alias("e"))
    hot = w.groupBy("contig", "level", "bin").agg(F.count("*").alias("nw")).join(laid(placed).groupBy("contig", "level", "bin").agg(F.count("*").alias("nr")), ["contig", "level", "bin"])
    hot = hot.withColumn("parts", F.least(F.lit(PARTS), F.ceil(F.col("nw") * F.col("nr") / HOT)).cast("int")).filter("parts > 1").orderBy(F.desc(F.col("nw") * F.col("nr"))).limit(BROADCAST_ROWS)
    hot = F.broadcast(materialize(hot.select("contig", "level", "bin", "parts"), "hot_regions"))
    parts = F.coalesce("parts", F.lit(1))

    r = usable_reads(reads, min_mq).filter("end0 > start0")
    code = F.expr("case " + " ".join(f"when platform = '{n}' then {i}" for i, n in enumerate(NAMES)) + " end")
    r = _one_version(r.select("aln_id", "contig", F.col("start0").alias("s"), F.col("end0").alias("e"), code.alias("platform"), "mapq", "aln_len", "clip_ratio", "backbone", "trust", "cigar", "seq", *["qual"] * (what == "sums")))
    r = laid(r.withColumn("id", F.coalesce("aln_id", F.lit(-(2**63))))).join(hot, ["contig", "level", "bin"], "left")
    r = r.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    w = w.withColumnRenamed("batch_id", "id").join(hot, ["contig", "level", "bin"], "left").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    rows = _shaped(r, 1).unionByName(_shaped(w, 0))
    if what in ("codes", "differing"):
        known = reference_chunks(contigs).select(F.col("contig").alias("c_contig"), F.col("bin").alias("c_bin"), "chunk")
        at = w.withColumn("c_bin", F.explode(F.expr(f"sequence(greatest(win_s, 0L) div {CHUNK}, greatest(win_e - 1, 0L) div {CHUNK})"))).withColumnRenamed("c_bin", "piece")
        at = at.join(known, (F.col("contig") == F.col("c_contig")) & (F.col("piece") == F.col("c_bin")))
        at = at.withColumn("s", F.expr(f"greatest(win_s, piece * {CHUNK})")).withColumn("seq", F.expr(f"substring(chunk, int(s - piece * {CHUNK}) + 1, int(win_e - s))")).filter("seq <> ''")
        rows = rows.unionByName(_shaped(at.drop("win_s", "win_e"), 2))
    rows = rows.repartition(*_REGION).sortWithinPartitions(*_REGION)

    limits = PAIRS, CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _regions(batches):
            yield from _Region(t, what, reach, depth, max_insert, *limits).batches()

    return rows.mapInArrow(run, OUT[what])


def _one_version(r: DataFrame) -> DataFrame:
    """r with a single version of each record, in COPIES equal rows at most.

    That a record's rows are equal is told by hashes, so only records that were delivered in several versions or very often are shuffled; all are, if these are too many to be broadcast.
    """
    content = [c for c in ("contig", "s", "e", "platform", "mapq", "cigar", "seq", "qual") if c in r.columns]
    odd = r.select("aln_id", F.xxhash64(*content).alias("h")).groupBy("aln_id").agg(F.min("h").alias("least"), F.max("h").alias("most"), F.count("*").alias("n"))
    odd = materialize(odd.filter(f"least <> most or n > {COPIES}").select(F.col("aln_id").alias("odd_id")), "odd_records")
    n = odd.count()
    if n > BROADCAST_ROWS:
        return records(r)
    if not n:
        return r
    same = r["aln_id"].eqNullSafe(odd["odd_id"])
    return r.join(F.broadcast(odd), same, "left_anti").unionByName(records(r.join(F.broadcast(odd), same, "left_semi")))


def _shaped(df: DataFrame, kind: int) -> DataFrame:
    have = {*df.columns}
    value = lambda n: F.lit(kind) if n == "kind" else F.col(n) if n in have else F.lit(None)
    return df.select(*[value(n).cast(t).alias(n) for n, t in _FIELDS.items()])


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole regions, from batches in order of the region; each has a column g, the number of the region in it."""
    held: list[pa.Table] = []

    def numbered(t: pa.Table) -> np.ndarray:
        if t.num_rows == 0:
            return np.zeros(0, np.int64)
        new = np.zeros(t.num_rows, bool)
        for c in _REGION:
            x = t.column(c).combine_chunks()
            new[1:] |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
        return np.cumsum(new)

    def same(a: pa.Table, b: pa.Table) -> bool:
        return all(a.column(c)[-1] == b.column(c)[0] for c in _REGION)

    for b in batches:
        t = pa.Table.from_batches([b])
        if t.num_rows == 0:
            continue
        g = numbered(t)
        if held and not same(held[-1], t):
            whole = pa.concat_tables(held).combine_chunks()
            held = []
            yield whole.append_column("g", pa.array(numbered(whole)))
        cut = int(np.searchsorted(g, g[-1]))
        if cut:
            whole = pa.concat_tables([*held, t.slice(0, cut)]).combine_chunks()
            held = []
            yield whole.append_column("g", pa.array(numbered(whole)))
        held.append(t.slice(cut))
    if held:
        whole = pa.concat_tables(held).combine_chunks()
        yield whole.append_column("g", pa.array(numbered(whole)))


def _ints(t: pa.Table, name: str, null: int = 0) -> np.ndarray:
    return t.column(name).combine_chunks().fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)


def _array(x: pa.ChunkedArray | pa.Array) -> pa.Array:
    return x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x


def _letters(x: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base codes of all strings behind each other, where each begins, and its length in characters."""
    x = x.fill_null("")
    if not pc.all(pc.string_is_ascii(x), min_count=0).as_py():
        x = pc.replace_substring_regex(x, "[^\\x00-\\x7F]", "N")
    ends = np.cumsum(n := pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64))
    if not len(x) or not ends[-1]:
        return np.zeros(0, np.int8), ends - n, n
    x = x.cast(pa.large_binary())
    first = int(np.frombuffer(x.buffers()[1], np.int64)[x.offset])
    return _BASE[np.frombuffer(x.buffers()[2], np.uint8)[first : first + int(ends[-1])]], ends - n, n


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of counts[i] places of row i: i, and the place within it."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes come to about most; a row may be larger by itself."""
    total = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + most, side="right")))
        yield i, j
        i = j


class _Region:
    """Whole regions: their reads in order of region, platform, start and name, each once, and their windows."""

    def __init__(self, t: pa.Table, what: str, reach: bool, depth: int, max_insert: int, pairs: int, cells: int) -> None:
        self.what, self.reach, self.depth, self.max_insert, self.pairs, self.cells = what, reach, depth, max_insert, pairs, cells
        kind = t.column("kind").to_numpy()
        self.w, r = t.filter(pa.array(kind == 0)), t.filter(pa.array(kind == 1))
        held = np.isin(r.column("g").to_numpy(), self.w.column("g").to_numpy())
        r = r.filter(pa.array(held))
        r = r.take(pa.array(np.lexsort((_ints(r, "id"), _ints(r, "s"), _ints(r, "platform"), _ints(r, "g")))))
        key = [_ints(r, c) for c in ("g", "platform", "s", "id")]
        again = np.zeros(r.num_rows, bool)
        again[1:] = np.all([x[1:] == x[:-1] for x in key], axis=0)
        self.r, self.ref = r.filter(pa.array(~again)), t.filter(pa.array(kind == 2))

    def batches(self) -> Iterator[pa.RecordBatch]:
        w, r = self.w, self.r
        if not w.num_rows or not r.num_rows:
            return
        self.wid, g, level, bin_ = (_ints(w, c) for c in ("id", "g", "level", "bin"))
        self.win_s, self.win_e = _ints(w, "win_s"), _ints(w, "win_e")
        self._read_columns()
        # a read's group is (region, platform); places count from the region's start and are cut behind all its windows, so that group and place make one number
        wide = 4 << int(level.max())
        base = dict(zip(g.tolist(), zip((bin_ << (level + 2)).tolist(), (4 << level).tolist(), strict=True), strict=True))
        rg = _ints(r, "g")
        uniq, inv = np.unique(rg, return_inverse=True)
        origin, size = (np.array([base[x][i] for x in uniq.tolist()], np.int64)[inv] for i in (0, 1))
        group = rg * len(NAMES) + self.platform
        step = 2 * wide + 4
        start = np.clip(self.start - origin, -1, 2 * size + 1) + 1 + group * step
        end = np.clip(self.end - origin, -1, 2 * size + 1) + 1 + group * step
        furthest = np.maximum.accumulate(end)
        s, e = (_ints(w, c) - (bin_ << (level + 2)) + 1 for c in ("s", "e"))
        which = g[:, None] * len(NAMES) + np.arange(len(NAMES))[None, :]
        lo = np.searchsorted(furthest, which * step + s[:, None], side="right")
        lo = np.maximum(lo, np.searchsorted(group, which))
        hi = np.maximum(lo, np.searchsorted(start, which * step + e[:, None]))
        self.s_key, self.end_key, self.step, self.which = s, end, step, which
        for i, j in _blocks((hi - lo).sum(1), self.pairs):
            yield from self._windows(i, j, lo[i:j].ravel(), (hi - lo)[i:j].ravel())

    def _read_columns(self) -> None:
        r = self.r
        self.start, self.end, self.rid, self.platform, self.aln_len, self.trust = (_ints(r, c) for c in ("s", "e", "id", "platform", "aln_len", "trust"))
        self.clip = r.column("clip_ratio").to_numpy()
        self.mapq = r.column("mapq").cast(pa.float64()).fill_null(-np.inf).to_numpy()
        self.backbone = _array(r.column("backbone")).to_numpy(zero_copy_only=False).astype(bool)
        cigar = _array(r.column("cigar"))
        self.n_ops = pc.list_value_length(cigar).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.first_op = np.cumsum(self.n_ops) - self.n_ops
        op, length = cigar.flatten().flatten()
        self.op = pc.index_in(op, pa.array(OPS)).fill_null(len(OPS)).to_numpy(zero_copy_only=False).astype(np.int64)
        self.len = length.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(self.n_ops)), self.n_ops)

        def before(letters: str) -> np.ndarray:
            total = np.r_[0, np.cumsum(np.where(np.isin(self.op, [OPS.index(x) for x in letters]), self.len, 0))]
            return total[:-1] - total[self.first_op[owner]]

        self.op_at, self.op_q = self.start[owner] + before("MDN=X"), before("MIS=X")
        self.base, self.seq_at, self.seq_n = _letters(_array(r.column("seq")))
        qual = _array(r.column("qual"))
        self.qual_n = pc.list_value_length(qual).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.qual_at = np.cumsum(self.qual_n) - self.qual_n
        self.qual = np.r_[qual.flatten().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), 0]
        # ranks of ends, and of the ends of trusted intervals; how many reads of a group begin no later than trust before a read
        trusted = self.backbone & (self.end - self.start > 2 * self.trust)
        _, rank = np.unique(np.r_[self.end, self.end - self.trust], return_inverse=True)
        self.end_rank, self.trust_rank = rank[: len(self.end)] + 1, np.where(trusted, rank[len(self.end) :] + 1, 0)
        group = _ints(r, "g") * len(NAMES) + self.platform
        bounds = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]
        self.begun = np.zeros(len(group), np.int64)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if trusted[a:b].any():
                self.begun[a:b] = a + np.searchsorted(self.start[a:b], self.start[a:b] - self.trust[a], side="right")

    def _windows(self, i: int, j: int, lo: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        c, k = _spread(count)
        read, win = lo[c] + k, i + c // len(NAMES)
        hit = self.end_key[read] > self.which.ravel()[i * len(NAMES) + c] * self.step + self.s_key[win]
        overlap = np.maximum(0, np.minimum(self.end[read], self.win_e[win]) - np.maximum(self.start[read], self.win_s[win]))
        if self.reach:
            hit &= overlap > 0
        c, read, win, overlap = c[hit], read[hit], win[hit], overlap[hit]
        if len(c):
            c, read, win = self._select(c, read, win, overlap)
            yield from self._summed(c + i * len(NAMES), read, win)

    def _select(self, c: np.ndarray, read: np.ndarray, win: np.ndarray, overlap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The reads that encode.select_reads chooses; pairs come by window, platform and start."""
        n = np.bincount(c)
        mean = np.bincount(c, weights=self.aln_len[read])[c] / n[c]
        most = 2 * len(self.end) + 2
        furthest = np.maximum.accumulate(c * most + self.trust_rank[read])
        last = np.searchsorted(c * (len(self.end) + 1) + read, c * (len(self.end) + 1) + self.begun[read]) - 1
        inside = (last >= 0) & (c[last] == c) & (furthest[last] - c * most >= self.end_rank[read])
        keep = self.backbone[read] | ~inside
        y = (overlap[keep] - self.clip[read[keep]] * 100 + self.aln_len[read[keep]] / mean[keep] + self.mapq[read[keep]]) * 1e6
        c, read, win = c[keep], read[keep], win[keep]
        n = np.bincount(c)
        many = n[c] > self.depth
        if many.any():
            with np.errstate(invalid="ignore"):
                whole = np.trunc(y[many])
                score = np.where(np.isfinite(whole), whole + np.where(np.abs(y[many] - whole) >= 0.5, np.sign(y[many]), 0), whole)
            at = np.flatnonzero(many)
            at = at[np.lexsort((self.rid[read[at]], -score, c[at]))]
            rank = np.arange(len(at)) - np.searchsorted(c[at], c[at])
            few = ~many
            few[at[rank < self.depth]] = True
            c, read, win = c[few], read[few], win[few]
        return c, read, win

    def _summed(self, c: np.ndarray, read: np.ndarray, win: np.ndarray) -> Iterator[pa.RecordBatch]:
        wins, first, own = np.unique(win, return_index=True, return_inverse=True)
        depth = np.diff(np.r_[first, len(win)])
        p, k = _spread(self.n_ops[read])
        o = self.first_op[read[p]] + k
        op, at, length = self.op[o], self.op_at[o], self.len[o]
        is_i, is_d = op == OPS.index("I"), op == OPS.index("D")
        at = at - is_i
        # positions of a window count from the first to the last one where a chosen read has an operation
        low, high = np.full(len(wins), np.iinfo(np.int64).max), np.full(len(wins), np.iinfo(np.int64).min)
        laid = op <= OPS.index("D")
        np.minimum.at(low, own[p[laid]], at[laid])
        np.maximum.at(high, own[p[laid]], np.where(is_i, at + 1, at + length)[laid])
        low = np.clip(low, self.win_s[wins], self.win_e[wins])
        width = np.maximum(0, np.clip(high, self.win_s[wins], self.win_e[wins]) - low)
        flat = np.cumsum(width) - width
        s, e = self.win_s[win[p]], self.win_e[win[p]]
        anchored = is_i & (length > 0) & (length <= self.max_insert) & (at >= s) & (at < e)
        ins = np.zeros(int(width.sum()), np.int64)
        x = own[p[anchored]]
        np.maximum.at(ins, flat[x] + at[anchored] - low[x], length[anchored])
        # place: the column of a position among all columns of this block; a window's own begin behind those of the windows before it
        place = np.cumsum(ins + 1) - ins - 1
        head = place[np.minimum(flat, max(len(place) - 1, 0))] if len(place) else np.zeros(len(wins), np.int64)
        shift = low - self.win_s[wins] - head

        k0 = np.where(is_i, 0, np.maximum(0, s - at))
        k1 = np.where(is_i, length, np.minimum(length, e - at))
        rp = read[p]
        k1 = np.where(is_d, k1, np.minimum(k1, self.seq_n[rp] - self.op_q[o]))
        n = np.where((self.seq_n[rp] > 0) & (anchored | (laid & ~is_i)), np.maximum(0, k1 - k0), 0)
        used = np.flatnonzero(n)
        ref = self._reference(wins, low, width, flat) if self.what in ("codes", "differing") else None
        total = int(ins.sum()) + len(ins)
        names, c = np.unique(c, return_inverse=True)
        add = [np.zeros(len(names), np.int64) for _ in range(4)] if self.what == "sums" else [np.zeros(5 * len(names), np.int64)] if self.what == "codes" else [np.zeros(total, np.int64)]
        for a, b in _blocks(n[used], self.cells):
            u = used[a:b]
            row, k = _spread(n[u])
            u = u[row]
            k = k + k0[u]
            pos = at[u] + np.where(is_i[u], 0, k)
            x, d, ii = own[p[u]], is_d[u], is_i[u]
            f = flat[x] + pos - low[x]
            col = place[f] + np.where(ii, 1 + k, 0)
            if self.what == "indels":
                add[0] += np.bincount(col[d | ii], minlength=total)
                continue
            q = self.op_q[o[u]] + k
            base = np.where(d, codes.DELETION, self.base[np.where(d, 0, self.seq_at[rp[u]] + q)]).astype(np.int64)
            if self.what == "sums":
                has = ~d & (q < self.qual_n[rp[u]])
                bq = np.where(d, -2, np.where(has, self.qual[np.where(has, self.qual_at[rp[u]] + q, -1)], 0))
                for i, v in enumerate((None, base, bq, (col + shift[x]) * (base + 1))):
                    add[i] += np.bincount(c[p[u]], weights=v, minlength=len(names)).astype(np.int64)
                continue
            cc = np.where(d, codes.CELL_DELETION, np.where(ii, codes.CELL_INSERTION, np.where(base == ref[f], codes.CELL_MATCH, codes.CELL_MISMATCH)))
            known = ref[f] >= 0
            if self.what == "codes":
                add[0] += np.bincount(5 * c[p[u]][known] + cc[known], minlength=5 * len(names))
            else:
                add[0] += np.bincount(col[known & (cc != codes.CELL_MATCH)], minlength=total)
        if self.what in ("sums", "codes"):
            per = 5 if self.what == "codes" else 1
            at_ = np.flatnonzero(add[0])
            who = names[at_ // per]
            name = pa.array(NAMES).take(pa.array(who % len(NAMES)))
            rest = [pa.array((at_ % per).astype(np.int32)), pa.array(add[0][at_])] if per > 1 else [pa.array(v[at_]) for v in add]
            cols = [pa.array(self.wid[who // len(NAMES)]), name, *rest]
        else:
            at_ = np.flatnonzero(add[0] >= 2)
            # windows without a position have no column; the others' first columns rise
            has = np.flatnonzero(width)
            x = has[np.searchsorted(head[has], at_, side="right") - 1] if len(at_) else at_
            ok = 100 * add[0][at_] >= depth[x]
            at_, x = at_[ok], x[ok]
            cols = [pa.array(v) for v in (self.wid[wins[x]], at_ + shift[x], add[0][at_], depth[x])]
        if len(at_):
            yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in OUT[self.what].split(", ")])

    def _reference(self, wins: np.ndarray, low: np.ndarray, width: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """The base code of every position of wins, -1 where the contig has none."""
        out = np.full(int(width.sum()), -1, np.int8)
        if not self.ref.num_rows:
            return out
        if not hasattr(self, "pieces"):
            ids = _ints(self.ref, "id")
            self.pieces = (order := np.argsort(ids, kind="stable")), ids[order], _ints(self.ref, "s"), *_letters(_array(self.ref.column("seq")))
        order, ids, s, base, at, n = self.pieces
        lo, hi = (np.searchsorted(ids, self.wid[wins], side=x) for x in ("left", "right"))
        x, k = _spread(hi - lo)
        piece = order[lo[x] + k]
        a, b = np.maximum(s[piece], low[x]), np.minimum(s[piece] + n[piece], low[x] + width[x])
        y, k = _spread(np.maximum(0, b - a))
        out[flat[x[y]] + a[y] - low[x[y]] + k] = base[at[piece[y]] + a[y] - s[piece[y]] + k]
        return out
