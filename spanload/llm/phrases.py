"""Phrase collocations: counts of all phrases by vertically partitioned suffix trees.

Every occurrence of a word begins a suffix of its piece, cut to ``DEPTH`` words.  A prefix that
begins too many suffixes for the memory budget (estimated from a sample) is split into the
prefixes one word longer, until each fits or has full depth.  Prefixes are then dealt into
groups of about half of ``budget`` different suffixes, and each group's subtree is built by
one task of its own from its sorted suffixes: a node's count is the sum of its leaves.  A split
prefix's leaves lie in several groups, whose sums are added.  Which prefixes are split is a
bitmap of their hashes, of fixed size too: one that is wrongly in it is split for nothing.

A task sends each group one packed block for some two million suffixes: the words that the
group's suffixes have, their numbers and counts, compressed.

Only phrases that occur ``least`` times matter, and no phrase is commoner than its words, so a
suffix ends before a word that can't be common: a bitmap of fixed size (``BITS``) holds the
hashes of all common words of a language; one that is wrongly let through costs time only.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanload.llm.common import batches_of, stage

DEPTH = 4
BITS = 1 << 24
BUDGET, LEAST_ROWS, SPLIT = 1 << 18, 1 << 14, 16
SAMPLED = 1 / 64  # share of the documents that tells which prefixes to split; counts never depend on it
DELIMITERS = b",;:!?\n\x0b\x0c\r"  # and the full stop, which stands for all of them
_PIECES = bytes.maketrans(DELIMITERS, b"." * len(DELIMITERS))
LOCAL = (1 << 16) - 1  # distinct common words that a buffer of suffixes may hold: four fit in 64 bits
SPAN, BUFFER, REMEMBERED = 1 << 14, 1 << 21, 1 << 18


def tokens(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased, a full stop at each end of a piece."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().translate(_PIECES)
    return raw.replace(b".", b" . ").split()


def _bit(lang: str, word: bytes) -> int:
    return zlib.crc32(word, zlib.crc32(lang.encode())) % BITS


# ---- words -----------------------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(b".", None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()).cast(pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["lang", "phrase", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(tokens(text))
        if sum(map(len, counts.values())) > 1 << 18:
            yield from flush()
    yield from flush()


def _word_bits(b: pa.RecordBatch) -> np.ndarray:
    return np.array([_bit(x, w.encode("utf-8", "surrogatepass")) for x, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)], np.int64)


def _hash_bits(b: pa.RecordBatch) -> np.ndarray:
    return (b.column(0).to_numpy().view(np.uint64) >> np.uint64(20)).astype(np.int64) % BITS


def _bitmap(rows: DataFrame, places) -> np.ndarray:
    """A bit for each row, at the place that ``places`` gives: ``BITS`` / 8 bytes at most reach the driver."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, bool)
        for b in batches:
            bits[places(b)] = True
        packed = np.packbits(bits).reshape(-1, 1024)
        some = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([packed[i].tobytes() for i in some], pa.binary())],
                                         names=["part", "bits"])

    out = np.zeros((BITS // 8 // 1024, 1024), np.uint8)
    merged = rows.mapInArrow(mark, "part int, bits binary").groupBy("part").applyInArrow(_merge_bits, "part int, bits binary")
    for part, bits in merged.collect():
        out[part] = np.frombuffer(bytes(bits), np.uint8)
    return out.reshape(-1)


def _merge_bits(table: pa.Table) -> pa.Table:
    bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
    return pa.table({"part": table["part"][:1].cast(pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})


# ---- suffixes --------------------------------------------------------------------------------


class _Suffixes:
    """Suffixes of one language, equal ones counted: common words have numbers from 1 on, a suffix is
    four of them in 64 bits, zeros at its end."""

    def __init__(self, lang: str, bitmap: np.ndarray):
        self.lang, self.bitmap = lang, bitmap
        self.clear()

    def clear(self) -> None:
        self.numbers, self.words, self.parts, self.held = {b".": 0}, [], [], 0

    def add(self, split: list[bytes], n: int) -> None:
        """Suffixes that begin at the first ``n`` tokens; the rest only ends them."""
        if len(self.numbers) > REMEMBERED:  # words that aren't common are told again by the bitmap
            self.numbers = {w: k for w, k in self.numbers.items() if k} | {b".": 0}
        numbers, bits = self.numbers, self.bitmap
        for w in set(split).difference(numbers):
            at = _bit(self.lang, w)
            common = bits[at >> 3] >> (7 - (at & 7)) & 1
            if common:
                self.words.append(w)
            numbers[w] = len(self.words) if common else 0
        own = np.zeros(len(split) + DEPTH, np.uint64)
        own[: len(split)] = np.fromiter(map(numbers.__getitem__, split), np.uint64, len(split))
        going, packed = own[:n] > 0, own[:n] << np.uint64(16 * (DEPTH - 1))
        begun = going
        for j in range(1, DEPTH):
            going = going & (own[j: n + j] > 0)
            if j == 1:  # what one word alone counts is known
                begun = going
            packed |= np.where(going, own[j: n + j] << np.uint64(16 * (DEPTH - 1 - j)), np.uint64(0))
        self.parts.append(packed[begun])
        self.held += len(self.parts[-1])

    def drain(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Words' numbers (a row of ``DEPTH`` for each different suffix), counts, and hashes of the first
        one, two ... words; then it starts anew, but for ``words``."""
        found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.parts]), return_counts=True)
        numbers = np.stack([(found >> np.uint64(16 * (DEPTH - 1 - j)) & np.uint64(0xFFFF)).astype(np.uint16)
                            for j in range(DEPTH)], axis=1)
        own = np.fromiter((zlib.crc32(w) << 32 | zlib.crc32(w, 1) for w in self.words), np.uint64, len(self.words))
        own = np.concatenate([np.zeros(1, np.uint64), own])
        hashes, h = [], np.uint64(zlib.crc32(self.lang.encode()))
        for j in range(DEPTH):
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + own[numbers[:, j]])
            hashes.append(h)
        self.parts, self.held = [], 0
        return numbers, n, hashes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _bits(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(20)).astype(np.int64) % BITS
    return (bitmap[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)


def _drained(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray) -> Iterator[_Suffixes]:
    """Each language's suffixes whenever many have come together."""
    held: dict[str, _Suffixes] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = held.get(lang) or held.setdefault(lang, _Suffixes(lang, bitmap))
            split = tokens(text)
            for lo in range(0, len(split), SPAN):
                before = own.held
                own.add(split[lo: lo + SPAN + DEPTH - 1], min(SPAN, len(split) - lo))
                total += own.held - before
                if len(own.words) > LOCAL - SPAN - DEPTH:
                    total -= own.held
                    yield held.pop(lang)
                    own = held.setdefault(lang, _Suffixes(lang, bitmap))
            if total >= BUFFER:
                yield from held.values()
                held, total = {}, 0
    yield from held.values()


def _prefix_hashes(bitmap: np.ndarray):
    """How many different suffixes begin with each prefix, by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _drained(batches, bitmap):
            found, n = np.unique(np.concatenate(own.drain()[2][:-1]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

    return run


_HEAD = struct.Struct("<II")


def _blocks(bitmap: np.ndarray, split: np.ndarray, groups: int):
    """Packed suffixes for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _drained(batches, bitmap):
            numbers, n, hashes = own.drain()
            depth, key = np.ones(len(n), np.uint8), hashes[0]
            for j in range(1, DEPTH):
                deeper = (depth == j) & _bits(split, key)
                depth, key = depth + deeper, np.where(deeper, hashes[j], key)
            group = (key % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            edges = [0, *(np.flatnonzero(np.diff(group[order])) + 1), len(order)] if len(order) else [0]
            out = []
            for a, b in zip(edges, edges[1:], strict=False):
                rows = order[a:b]
                used, local = np.unique(numbers[rows], return_inverse=True)
                words = b" ".join(own.words[k - 1] for k in used if k)
                local = local.reshape(-1, DEPTH) + (0 if used[0] == 0 else 1)  # 0: no word
                raw = (_HEAD.pack(len(rows), len(words)) + words + local.T.astype(np.uint16).tobytes()
                       + n[rows].astype(np.uint32).tobytes() + depth[rows].astype(np.uint8).tobytes())
                out.append((int(group[rows[0]]), zlib.compress(raw, 1)))
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], pa.int64()), pa.array([own.lang] * len(out), pa.string()),
                                              pa.array([x for _, x in out], pa.binary())], names=["group", "lang", "block"])

    return run


def _unpacked(block: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    raw = zlib.decompress(block)
    rows, size = _HEAD.unpack_from(raw)
    at = _HEAD.size + size
    numbers = np.frombuffer(raw, np.uint16, DEPTH * rows, at).reshape(DEPTH, rows)
    at += 2 * DEPTH * rows
    return (raw[_HEAD.size: _HEAD.size + size].split(b" "), numbers, np.frombuffer(raw, np.uint32, rows, at),
            np.frombuffer(raw, np.uint8, rows, at + 4 * rows))


# ---- groups of prefixes ----------------------------------------------------------------------


_NODE = "lang string, phrase string, words int, n long, whole boolean"


def _subtree(least: int):
    """Nodes of two words or more of a group's suffix tree with their counts: those with ``least``
    leaves, and those of split prefixes, which have leaves elsewhere, as they are."""

    def run(table: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        langs: dict[str, int] = {}
        parts: list[tuple] = []
        for lang, block in zip(table["lang"].to_pylist(), table["block"], strict=True):
            words, numbers, n, depth = _unpacked(block.as_py())
            own = np.fromiter((place.setdefault(w, len(place) + 1) for w in words), np.int64, len(words))
            own = np.concatenate([np.zeros(1, np.int64), own])
            parts.append((np.full(len(n), langs.setdefault(lang, len(langs))), own[numbers], n.astype(np.int64), depth))
        lang, n, depth = (np.concatenate([x[k] for x in parts]) for k in (0, 2, 3))
        columns, kinds = list(np.concatenate([x[1] for x in parts], axis=1)), len(place) + 1
        order = np.lexsort([columns[2] * kinds + columns[3], (lang * kinds + columns[0]) * kinds + columns[1]])
        n, depth, columns, lang = n[order], depth[order], [c[order] for c in columns], lang[order]
        words, names = pa.array(list(place), pa.binary()).cast(pa.string()), pa.array(list(langs), pa.string())
        new = np.concatenate([[True], lang[1:] != lang[:-1]])
        out = []
        for j, column in enumerate(columns):  # a node begins where its first j + 1 words differ from those before
            new = new | np.concatenate([[True], column[1:] != column[:-1]])
            if not j:
                continue
            at = np.flatnonzero(new)
            count = np.add.reduceat(n, at)
            whole = depth[at] <= j + 1
            keep = (column[at] > 0) & (~whole | (count >= least))
            at, count = at[keep], count[keep]
            phrase = pc.binary_join_element_wise(*[words.take(pa.array(c[at] - 1)) for c in columns[: j + 1]], " ")
            out.append(pa.table({"lang": names.take(pa.array(lang[at])), "phrase": phrase,
                                 "words": pa.array(np.full(len(at), j + 1), pa.int32()), "n": pa.array(count, pa.int64()),
                                 "whole": pa.array(whole[keep])}))
        return pa.concat_tables(out)

    return run


def phrase_counts(docs: DataFrame, least: int, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """``docs``: lang, text, not null.  Rows ``lang, phrase, words, n`` of all phrases of 1 to 4
    words that occur ``least`` times, and ``lang, n``: all words of each language."""
    with batches_of(docs.sparkSession, 512):  # long texts
        words = stage(docs.mapInArrow(_count_words, "lang string, phrase string, n long").groupBy("lang", "phrase")
                      .agg(F.sum("n").alias("n")), "phrases-words")
        common = words.where(F.col("n") >= least)
        context = docs.sparkSession.sparkContext
        bitmap = context.broadcast(_bitmap(common.select("lang", "phrase"), _word_bits))  # BITS / 8 bytes, as is the next
        total = common.agg(F.sum("n")).first()[0] or 0  # at least as many as there are different suffixes
        budget = min(budget, max(LEAST_ROWS, total // 64))  # few rows: as many groups as tasks can use
        # a prefix of more than a SPLIT-th of the budget is split, so that groups, dealt by hash, are about alike
        prefixes = (docs.sample(SAMPLED, 1).mapInArrow(lambda x: _prefix_hashes(bitmap.value)(x), "h long, n long")
                    .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > max(0, budget / SPLIT * SAMPLED)))
        split = context.broadcast(_bitmap(prefixes.select("h"), _hash_bits))
        groups = 2 * total // budget + 1
        blocks = docs.mapInArrow(lambda x: _blocks(bitmap.value, split.value, groups)(x), "group long, lang string, block binary")
        nodes = stage(blocks.groupBy("group").applyInArrow(_subtree(least), _NODE), "phrases-nodes")
    added = nodes.where("not whole").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    counts = (nodes.where("whole").drop("whole").unionByName(added)
              .unionByName(common.withColumn("words", F.lit(1)).select("lang", "phrase", "words", "n")))
    return counts, words.groupBy("lang").agg(F.sum("n").alias("n"))


# ---- collocations ----------------------------------------------------------------------------


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000,
                 scale: int = 2_000_000, covered: int = 80, budget: int = BUDGET) -> DataFrame:
    """Rows ``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of 2 to 4 words.

    ``a``: occurrences of the phrase within pieces, ``l`` and ``r``: those of its two parts at the
    cut that scores least (the earliest of equals), ``n``: all words of the language, ``score``:
    ``floor(scale * a / (l + r))``.  A phrase goes if a longer candidate holds it in at least
    ``covered`` percent of its occurrences.  Order: score, then ``a``, both falling, then the
    phrase's bytes.

    Null languages are ``und``, null texts empty.  Repeated rows count each time.  Texts without
    words give nothing, nor does an empty table.  Other columns are not looked at.
    """
    docs = df.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    nodes, totals = phrase_counts(docs, least, budget)
    candidates = nodes.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    part = nodes.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cuts = (candidates.withColumn("cut", F.explode(F.expr("sequence(1, words - 1)")))
            .withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
            .withColumn("right", F.expr("substring_index(phrase, ' ', cut - words)")))
    both = (cuts.join(part.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
            .join(part.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"]))
    exact = F.expr(f"cast(a as decimal(20, 0)) * cast({scale} as decimal(10, 0)) div (cast(l as decimal(20, 0)) + r)")
    scored = (both.withColumn("score", exact.cast("long")).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "cut", "l", "r")).alias("least")))
    inside = (candidates.where("words > 2")
              .withColumn("length", F.explode(F.expr("sequence(2, words - 1)")))
              .withColumn("at", F.explode(F.expr("sequence(1, words - length + 1)")))
              .select("lang", F.expr("array_join(slice(split(phrase, ' '), at, length), ' ')").alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    held = F.expr(f"cast(longer as decimal(20, 0)) * 100 >= cast(a as decimal(20, 0)) * {covered}")
    kept = (scored.join(inside, ["lang", "phrase"], "left").where(F.coalesce(~held, F.lit(True)))
            .select("lang", "phrase", "a", "least.l", "least.r", "least.score"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (kept.withColumn("rank", place).where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
