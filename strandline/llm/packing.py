"""Fill containers of fixed capacity with items of varying length, each container mixed to target proportions.

Items are spread over blocks by the hash of their identifier, so that a block is like the whole. The lengths a block has of
each source, and so the deficit every source has carried when the block begins, come from a running sum over blocks before any
is packed; all blocks then pack at once. In a block deficit round-robin over all source queues fills container after
container: the source that lags most behind its share gives its longest item that still fits, and what it lags is carried on.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.runtime import join_state, materialize, sum_before

PACKED = "block bigint, item bigint, piece int, n_pieces bigint, start bigint, length int, container int, offset int"


class _Queue:
    """The waiting pieces of one source by length; the longest that fits comes first."""

    def __init__(self, pieces: list[tuple[int, int, int, int, int]], capacity: int) -> None:
        self.by_length: list[list[tuple[int, int, int, int, int]]] = [[] for _ in range(capacity + 1)]
        self.mask = 0
        for p in pieces:
            self.by_length[p[4]].append(p)
            self.mask |= 1 << p[4]

    def longest(self, room: int) -> int:
        return (self.mask & ((1 << (room + 1)) - 1)).bit_length() - 1

    def shortest(self, none: int) -> int:
        return (self.mask & -self.mask).bit_length() - 1 if self.mask else none

    def take(self, length: int) -> tuple[int, int, int, int, int]:
        p = self.by_length[length].pop()
        if not self.by_length[length]:
            self.mask &= ~(1 << length)
        return p


def drr_pack(pieces: dict[object, list[tuple[int, int, int, int, int]]], shares: dict[object, float], deficit: dict[object, float], capacity: int) -> list[tuple]:
    """(item, piece, n_pieces, start, length, container, offset) of the pieces; deficit is where the sources stand at the start.

    Every piece comes from the source that is owed most among those with a piece that fits, its longest that does. Where nothing would fit behind that piece, so that it closes the
    container, the longest that fits of any source that is owed is taken instead, to leave little room; what a source is passed over for stays owed. Sources that aren't owed
    only fill where none that is owed has a piece that fits, and sources of share 0 where no other source has.
    """
    names = list(pieces)
    queues = [_Queue(pieces[s], capacity) for s in names]
    share, owed = np.array([shares[s] for s in names], float), np.array([deficit.get(s, 0.0) for s in names], float)
    last = np.where(share > 0, 0.0, -1e18)
    none = capacity + 1
    shortest = np.array([q.shortest(none) for q in queues])
    out, container, waiting = [], 0, sum(map(len, pieces.values()))
    while waiting > len(out):
        owed += share * capacity
        room = capacity
        while (least := shortest.min()) <= room:
            claim = np.where(shortest <= room, owed + last, -np.inf)
            i = int(claim.argmax())
            length = queues[i].longest(room)
            if room - length < least:
                near = claim > 0 if claim[i] > 0 else claim > -1e17 if claim[i] > -1e17 else claim > -np.inf
                length, _, i = max((queues[j].longest(room), claim[j], j) for j in np.flatnonzero(near).tolist())
            out.append((*queues[i].take(length), container, capacity - room))
            shortest[i] = queues[i].shortest(none)
            owed[i] -= length
            room -= length
        owed -= room / len(names)
        container += 1
    return out


def _packer(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(x: pd.DataFrame) -> pd.DataFrame:
        pieces: dict[object, list[tuple[int, int, int, int, int]]] = {}
        x = x.sort_values(["length", "item"], kind="stable")
        for item, source, n in zip(x["item"].tolist(), x["source"].tolist(), x["length"].tolist()):
            cut = -(-n // capacity)
            pieces.setdefault(source, []).extend((item, i, cut, i * capacity, min(capacity, n - i * capacity)) for i in range(cut))
        first = x.drop_duplicates("source")
        shares = dict(zip(first["source"], first["share"]))
        got = drr_pack(pieces, shares, dict(zip(first["source"], first["carried"])), capacity)
        out = pd.DataFrame(np.array(got, dtype=np.int64).reshape(-1, 7), columns=["item", "piece", "n_pieces", "start", "length", "container", "offset"])
        out.insert(0, "block", x["block"].iloc[0])
        return out

    return pack


def pack_items(df: DataFrame, ident: str, source: str, length: str, capacity: int = 1024, shares: dict[str, float] | None = None, block_items: int = 20_000) -> DataFrame:
    """(ident, piece, n_pieces, start, length, block, container, offset): where each item, or each piece of it, lies.

    An item of at most capacity is one piece; a longer one is cut into full pieces and a rest, in order of start. A container is
    (block, container). Each source's target share is its part of the total length unless shares gives it (null source: key
    "", which is also the empty one's; sources not in shares have share 0 and fill what is left). Items of null, zero or negative length come out once, with
    n_pieces 0 and null container. ident must be a BIGINT; a repeated ident and length counts once, a null ident isn't packed.
    An empty df gives no rows. Blocks hold about block_items items each, so their number grows with df.
    """
    name = df.schema[ident].name
    items = df.select(F.col(ident).cast("bigint").alias("item"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(length).cast("bigint").alias("length"))
    items = materialize(items.filter("item is not null").groupBy("item", F.expr("coalesce(greatest(length, 0L), 0L)").alias("length")).agg(F.min("source").alias("source")), "pack_items")
    full = items.filter("length > 0")
    blocks = max(1, -(-full.count() // block_items))
    full = full.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    # (block, source) sums: what of each source stands in a block and before it
    sums = materialize(full.groupBy("block", "source").agg(F.sum("length").alias("have"), F.count("*").alias("n")), "pack_sums")
    if shares is None:
        whole_length = sums.agg(F.sum("have")).first()[0] or 1
        targets = sums.groupBy("source").agg((F.sum("have") / F.lit(whole_length)).alias("share"))
    else:
        given = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])[F.col("source")] if shares else F.lit(0.0)
        targets = sums.groupBy("source").agg(F.coalesce(F.first(given), F.lit(0.0)).alias("share"))
    targets = targets.withColumnRenamed("source", "ts")
    all_ = sum_before(sums.groupBy("block").agg(F.sum("have").alias("all")), [], "block", "all", "all_before").select(F.col("block").alias("ab"), "all_before")
    carried = sum_before(sums, ["source"], "block", "have", "before").join(targets, F.col("source") == F.col("ts")).join(all_, F.col("block") == F.col("ab"))
    state = materialize(carried.select("block", "source", "n", "share", (F.col("share") * F.col("all_before") - F.col("before")).alias("carried")), "pack_carried")
    ready = join_state(full, state, ["block", "source"], "inner", "n", full.count())
    packed = ready.repartition(F.col("block")).groupBy("block").applyInPandas(_packer(capacity), PACKED)
    none = F.lit(None).cast("int")
    empty = items.filter("length = 0").select("item", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("n_pieces"), F.lit(0).cast("bigint").alias("start"), F.lit(0).alias("length"), none.cast("bigint").alias("block"), none.alias("container"), none.alias("offset"))
    out = packed.select("item", "piece", "n_pieces", "start", "length", "block", "container", "offset").unionByName(empty)
    return out.withColumnRenamed("item", name)
