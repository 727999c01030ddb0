"""Byte-level BPE over a whole corpus in padded numpy matrices.

Text is split by the tokenizer's public pattern; the words a worker hasn't met yet are bucketed by byte length, and
each bucket is one matrix of token ids, a word a row. In every round each row merges its leftmost pair of minimum rank.
Ranks come from a hash table of pairs; rows with nothing left to merge leave the matrix.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The pattern with which this family of tokenizers splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.int32(2**31 - 1)
#: Words a worker remembers before it starts afresh, and the byte length from which a word is merged by itself.
REMEMBERED, LONG = 200_000, 256


def default_vocab() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PairTable:
    """Open-addressing hash table from a pair of token ids to its merge rank, looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(max(len(left), 1) * 3))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        todo, at = np.arange(len(key)), self._home(key)
        while len(todo):
            free = self.keys[at] == -1
            slot, first = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slot], self.rank[slot] = key[todo[put]], todo[put]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, at = todo[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        key = np.where((left < 0) | (right < 0), np.int64(-2), key)
        out, at = np.full(key.shape, NONE, np.int32), self._home(key)
        flat, key, at = out.reshape(-1), key.reshape(-1), at.reshape(-1)
        todo = np.flatnonzero(key != -2)
        while len(todo):
            have = self.keys[at[todo]]
            hit = have == key[todo]
            flat[todo[hit]] = self.rank[at[todo[hit]]]
            todo = todo[~hit & (have != -1)]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return out


def _byte_chars() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary: itself if printable, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.byte_id = np.zeros(256, np.int32)
        for char, byte in _byte_chars().items():
            self.byte_id[byte] = vocab[char]
        self.pairs = PairTable(np.array([vocab[a] for a, _ in merges]), np.array([vocab[b] for _, b in merges]))
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.split = regex.compile(SPLIT)
        self.known: dict[str, list[int]] = {}

    def words(self, words: list[str]) -> list[list[int]]:
        raw = [w.encode() for w in words]
        out: list[list[int]] = [[] for _ in raw]
        lengths = np.array([len(r) for r in raw])
        low = 0
        for width in (2, 4, 6, 8, 12, 16, 24, 32, 64, 128, LONG):
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            for part in (rows[i : i + 8192] for i in range(0, len(rows), 8192)):
                for row, ids in zip(part.tolist(), self._bucket([raw[i] for i in part.tolist()], width)):
                    out[row] = ids
        for i in np.flatnonzero(lengths > LONG).tolist():
            out[i] = self._long(raw[i])
        return out

    def _bucket(self, raw: list[bytes], width: int) -> list[list[int]]:
        n = np.array([len(r) for r in raw])
        data = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), np.uint8).reshape(len(raw), width)
        ids = np.where(np.arange(width) < n[:, None], self.byte_id[data], -1).astype(np.int32)
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        where, out = np.arange(len(raw)), [[] for _ in raw]
        while len(where):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(where)), at]
            done = best == NONE
            if done.any():
                for row, x in zip(where[done].tolist(), ids[done]):
                    out[row] = x[x >= 0].tolist()
                ids, rank, where, at, best = (x[~done] for x in (ids, rank, where, at, best))
                if not len(where):
                    break
            every = np.arange(len(where))
            shift = np.arange(ids.shape[1] - 1)
            ids[every, at] = self.merged[best]
            ids = np.take_along_axis(ids, shift + (shift > at[:, None]), axis=1)
            if ids.shape[1] == 1:
                for row, x in zip(where.tolist(), ids):
                    out[row] = x.tolist()
                break
            gap = np.arange(ids.shape[1] - 1)
            rank = np.take_along_axis(rank, gap + (gap >= at[:, None]), axis=1)
            here = at < rank.shape[1]
            rank[every[here], at[here]] = self.pairs(ids[every[here], at[here]], ids[every[here], at[here] + 1])
            left = at > 0
            rank[every[left], at[left] - 1] = self.pairs(ids[every[left], at[left] - 1], ids[every[left], at[left]])
        return out

    def _long(self, raw: bytes) -> list[int]:
        """All places of the minimum pair at once: a merge can't make a pair of lower rank, so the order is the same."""
        ids = self.byte_id[np.frombuffer(raw, np.uint8)]
        while len(ids) > 1:
            rank = self.pairs(ids[:-1], ids[1:])
            best = rank.min()
            if best == NONE:
                break
            at = np.flatnonzero(rank == best)
            run = np.cumsum(np.r_[True, np.diff(at) > 1])
            at = at[(np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 0]
            ids = ids.copy()
            ids[at] = self.merged[best]
            ids = np.delete(ids, at + 1)
        return ids.tolist()

    def encode(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        texts = list(texts)
        split = [self.split.findall(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({w for words in split for w in words if w not in known})
        known.update(zip(new, self.words(new)))
        for words in split:
            ids: list[int] = []
            for w in words:
                ids += known[w]
            yield ids


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def encode_corpus(df: DataFrame, ident: str, text: str, vocab: str | None = None) -> DataFrame:
    """(ident, ids): the token ids of every row's text, without special tokens; their strings in a text are ordinary text.

    A null text and an empty one both give an empty list. Rows come out as often as they stand, null idents too; there is
    no shuffle. vocab is the path of the vocabulary file on the workers. Other columns of df are ignored.
    """
    path, name, kind = vocab or default_vocab(), df.schema[ident].name, df.schema[ident].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        for b in batches:
            for part in (b.slice(i, 500) for i in range(0, b.num_rows, 500)):
                ids = list(model.encode(part.column(1).to_pylist()))
                offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                flat = np.fromiter((i for x in ids for i in x), np.int32, offsets[-1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["id", "ids"])

    return df.select(F.col(ident).alias("id"), F.col(text).alias("text")).mapInArrow(encode, f"id {kind}, ids array<int>").withColumnRenamed("id", name)


def count_tokens(df: DataFrame, keep: list[str], text: str, vocab: str | None = None) -> DataFrame:
    """(keep..., n_tokens): the number of token ids of every row's text, 0 for null and empty texts."""
    path = vocab or default_vocab()
    schema = df.select(*keep).schema.simpleString()[7:-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        for b in batches:
            n = [len(ids) for i in range(0, b.num_rows, 500) for ids in model.encode(b.column(len(keep)).slice(i, 500).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(count, f"{schema}, n_tokens bigint" if keep else "n_tokens bigint")


def token_bytes(spark: SparkSession, vocab: str | None = None) -> DataFrame:
    """(token, n_bytes): how many bytes each id of the vocabulary stands for, a row for each; a vocabulary is bounded and read by the driver as by every worker."""
    with open(vocab or default_vocab(), encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    return spark.createDataFrame(pa.table({"token": pa.array(ids.values(), pa.int32()), "n_bytes": pa.array([len(t) for t in ids], pa.int64())}))
