"""Byte-level BPE: encoding by a hierarchical-bitmap rank queue, and decoding.

A text is cut by the vocabulary's pattern; the bytes of each match are merged on their
own, always the pair of least rank, the leftmost first.  The queue that finds this pair
has a bucket for each merge rank, holding positions in a linked list of parts, and a
bitmap of three levels of 64-bit words over the ranks: find-first-set from the top level
down gives the least rank that is waiting.  Entries are never searched and removed: one
whose position no longer starts a pair of that rank is stale and skipped when it comes up.
A merge costs a constant number of such steps whatever the length of the match, so a
match of a million bytes takes time in proportion.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanload.llm.common import small_batches

#: Matches of at most CACHED_CHARS keep their ids, up to CACHED_MATCHES of them in a worker.
CACHED_CHARS, CACHED_MATCHES = 48, 1 << 19
#: Texts are encoded together up to so many characters (one longer text stands alone).
TOGETHER = 1 << 18


class RankQueue:
    """Buckets of positions by merge rank, and a bitmap of the ranks that have one.

    The bitmap has three levels of 64-bit words; a bit of a level says that the word
    below it isn't zero.
    """

    def __init__(self, ranks: int):
        n0 = ranks // 64 + 1
        self.buckets: dict[int, list[int]] = {}
        self.low, self.mid, self.top = [0] * n0, [0] * (n0 // 64 + 1), 0

    def put(self, rank: int, positions: list[int]) -> None:
        waiting = self.buckets.get(rank)
        if waiting is None:
            self.buckets[rank] = positions
            a, b = rank >> 6, rank >> 12
            self.low[a] |= 1 << (rank & 63)
            self.mid[b] |= 1 << (a & 63)
            self.top |= 1 << b
        else:
            waiting += positions

    def take(self) -> tuple[int, list[int]]:
        """The least rank that waits and its positions in order; the bucket is gone then."""
        top, mid, low = self.top, self.mid, self.low
        b = (top & -top).bit_length() - 1
        word = mid[b]
        a = (b << 6) + (word & -word).bit_length() - 1
        word = low[a]
        rank = (a << 6) + (word & -word).bit_length() - 1
        low[a] = word = word & (word - 1)
        if not word:
            mid[b] = word = mid[b] & (mid[b] - 1)
            if not word:
                self.top = top & (top - 1)
        positions = self.buckets.pop(rank)
        positions.sort()
        return rank, positions


class Vocabulary:
    """Ranks of byte strings; a string's rank is its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        bytes_of = {i: b for b, i in ranks.items()}
        self.byte_ids = [ranks[bytes([i])] for i in range(256)]
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        #: left id * size + right id -> id of the two together.
        self.merges = {ranks[b[:k]] * self.size + ranks[b[k:]]: i for b, i in ranks.items()
                       for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks}
        #: the bytes of every id (none for an unused one)
        self.bytes_of = pa.array([bytes_of.get(i, b"") for i in range(self.size)], pa.binary())
        self.forget()

    def forget(self) -> None:
        """No match is remembered: ``place`` numbers them, the arrays hold where their ids lie."""
        self.place: dict[str, int] = {}
        self.starts = self.counts = np.zeros(0, np.int64)
        self.table = np.zeros(0, np.int32)

    def remember(self, matches: list[str], ids: list[list[int]]) -> None:
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self.place |= zip(matches, range(len(self.place), len(self.place) + len(matches)), strict=True)
        self.starts = np.concatenate([self.starts, len(self.table) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.table = np.concatenate([self.table, np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum()))])

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each match.  All matches share one queue; no pair spans two of them."""
        size, merge_of, queue = self.size, self.merges.get, RankQueue(self.size)
        buckets, put, byte_ids = queue.buckets, queue.put, self.byte_ids
        ids: list[int] = []
        starts: list[int] = []
        for piece in pieces:
            starts.append(len(ids))
            ids += [byte_ids[b] for b in piece]
        n = len(ids)
        first = bytearray(n + 1)
        for i in starts:
            first[i] = 1
        first[n] = 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n  # rank of the pair that starts here; -1: none, or the part is gone
        for i in range(n - 1):
            if not first[i + 1]:
                r = merge_of(ids[i] * size + ids[i + 1])
                if r is not None:
                    pair[i] = r
                    if r in buckets:
                        buckets[r].append(i)
                    else:
                        put(r, [i])
        while queue.top:
            rank, positions = queue.take()
            for at, i in enumerate(positions):
                if pair[i] != rank:
                    continue  # stale
                least = rank
                gone = after[i]
                ids[i] = rank
                pair[gone] = pair[i] = -1
                j = after[i] = after[gone]
                if not first[j]:
                    before[j] = i
                    r = merge_of(rank * size + ids[j])
                    if r is not None:
                        pair[i] = r
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            put(r, [i])
                        if r < least:
                            least = r
                elif j < n:
                    before[j] = i
                if not first[i]:
                    h = before[i]
                    r = merge_of(ids[h] * size + rank)
                    if r is None:
                        pair[h] = -1
                    else:
                        pair[h] = r
                        if r in buckets:
                            buckets[r].append(h)
                        else:
                            put(r, [h])
                        if r < least:
                            least = r
                if least < rank and at + 1 < len(positions):  # that one comes first
                    put(rank, positions[at + 1:])
                    break
        out = []
        for i, end in zip(starts, [*starts[1:], n], strict=True):
            one = []
            while i < end:
                one.append(ids[i])
                i = after[i]
            out.append(one)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, and how many each has."""
        found = [self.pattern.findall(t) for t in texts]
        new = set().union(*found).difference(self.place)
        if len(self.place) + len(new) > CACHED_MATCHES:
            self.forget()
            new = set().union(*found)
        whole, to_merge = [], []
        for p in new:
            rank = self.ranks.get(p.encode())
            if rank is None:
                to_merge.append(p)
            else:
                whole.append((p, [rank]))
        to_merge.sort(key=len)  # long matches come last, for they aren't kept
        parts = self.merge([p.encode() for p in to_merge]) if to_merge else []
        merged = [*whole, *zip(to_merge, parts, strict=True)]
        if merged:
            self.remember(*map(list, zip(*merged, strict=True)))
        matches = np.fromiter(map(len, found), np.int64, len(found))
        places = np.fromiter(map(self.place.__getitem__, chain.from_iterable(found)), np.int64, int(matches.sum()))
        counts = self.counts[places]
        ends = np.concatenate([[0], np.cumsum(counts)])
        flat = self.table[np.repeat(self.starts[places] - ends[:-1], counts) + np.arange(ends[-1])]
        upto = ends[np.concatenate([[0], np.cumsum(matches)])]
        long = [p for p in to_merge if len(p) > CACHED_CHARS]
        if long:
            kept = len(self.place) - len(long)
            self.table = self.table[: self.starts[kept]]
            self.starts, self.counts = self.starts[:kept], self.counts[:kept]
            for p in long:
                del self.place[p]
        return flat, np.diff(upto)

    def decode(self, ids: pa.Array, ends: np.ndarray) -> pa.Array:
        """The bytes of each list of ids; ``ends``: where lists begin and end in ``ids``."""
        joined = self.bytes_of.take(ids)
        at = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1, 4 * joined.offset)
        offsets = pa.py_buffer(np.ascontiguousarray(at[ends], np.int32))
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, joined.buffers()[2]])


@lru_cache(maxsize=4)
def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """A file of lines ``base64(bytes) rank``, as installed with the tokenizers on every machine."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}, pattern)


def together(column: pa.Array) -> Iterator[list[str]]:
    """The texts in order, in lists of about TOGETHER characters."""
    texts, chars = [], 0
    for value in column:
        texts.append(value.as_py() or "")
        chars += len(texts[-1])
        if chars >= TOGETHER:
            yield texts
            texts, chars = [], 0
    if texts:
        yield texts


def _without(df: DataFrame, *names: str) -> list[str]:
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def _numbered(columns: list[str]) -> list:
    """The columns under names that can't be those of others; batches are told by place."""
    return [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``, array of ids of the whole text (null or empty text: no ids).

    A column already named ``out`` is replaced; all other columns and all rows stay.
    """
    small_batches(df.sparkSession)
    kept = _without(df, out)
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.ArrayType(T.IntegerType()))])
    source = df.select(*_numbered(kept), F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(path, pattern)
        for batch in batches:
            flat, counts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
            for texts in together(batch.column(batch.num_columns - 1)):
                ids, n = vocabulary.encode(texts)
                flat.append(ids)
                counts.append(n)
            ends = pa.array(np.cumsum(np.concatenate(counts)), pa.int32())
            column = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(flat), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*kept, out])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the bytes that the ids stand for (null or no ids: no bytes)."""
    small_batches(df.sparkSession)
    kept = _without(df, out)
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.BinaryType())])
    source = df.select(*_numbered(kept), F.col(f"`{ids}`").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(path, pattern)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            counts = np.concatenate([[0], pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)])
            column = vocabulary.decode(lists.flatten().cast(pa.int32()), np.cumsum(counts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*kept, out])

    return source.mapInArrow(run, schema)
