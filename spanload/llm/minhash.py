"""MinHash near-duplicates by tensored banding, each link confirmed on the full sets.

A document is a set of shingles.  Two collections of ``side`` small hashes, each of
``width`` minhash values, are computed; a table key combines one hash of the first
collection with one of the second, so ``side * side`` tables of ``2 * width`` values each
need only ``2 * side * width`` minhash values: about the square root of what independent
tables take.  A pair of similarity s is missed with a chance of about
``2 * (1 - s ** width) ** side``.

Copies with equal sets are one node (named by the 128-bit digest of the set, whatever the
ids).  Nodes meet in buckets by key.  Every node is compared with the least one that it
meets; the links make components.  Then in each bucket, nodes are compared with the least
one if that is in another component.  Twice more they are compared with another one, drawn by
a hash, if that is in another component.  What is still apart is compared inside tiles of a
bucket, dealt with their sets: pairs of different components that their bitmaps of shingles
leave open (a bound that rules out no link), until a link joins them.  A tile gives the links
that join its components, fewer than it has nodes.  So a bucket of n near copies takes
about n comparisons and never writes out its pairs, and no link that joins two components
is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanload.llm.common import small_batches, stage, words_of
from spanload.llm.components import components

#: Distinct words whose hash a worker remembers.
REMEMBERED = 1 << 18
#: Shingles hashed together; small enough for the processor's cache.
TOGETHER = 1 << 15
#: Longs of a document's bitmap of shingles.
BITMAP = 32


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers (xor-shift and odd multipliers)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles.

    Fewer words than a shingle has: the whole sequence is the one shingle; no words: none.
    Two shingles of a pair of texts share a hash with a chance below 1e-9 for texts of
    100,000 words, which is taken as equality.
    """
    split = words_of(text)
    if not split:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, split), np.uint64, len(split))
    n = max(1, len(h) - words + 1)
    k = min(words, len(h))
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i: i + n])
    return np.unique(out)


def minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` minhash values of each non-empty set."""
    out = np.empty((len(sets), count), np.uint64)
    rng = np.random.Generator(np.random.PCG64(20240229))
    factors = rng.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    begin = 0
    while begin < len(sets):
        end, size = begin, 0
        while end < len(sets) and (size == 0 or size + len(sets[end]) <= TOGETHER):
            size += len(sets[end])
            end += 1
        joined = np.concatenate(sets[begin:end])
        starts = np.cumsum([0, *(len(s) for s in sets[begin: end - 1])])
        product, shifted = np.empty_like(joined), np.empty_like(joined)
        for j, f in enumerate(factors):
            np.multiply(joined, f, out=product)
            np.right_shift(product, np.uint64(29), out=shifted)
            np.bitwise_xor(product, shifted, out=product)
            out[begin:end, j] = np.minimum.reduceat(product, starts)
        begin = end
    return out


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A bit for each shingle, at a place that its hash gives."""
    out = np.zeros(64 * BITMAP, np.uint8)
    out[(_mix(shingles) >> np.uint64(20)).astype(np.int64) % (64 * BITMAP)] = 1
    return np.packbits(out).view(np.int64)


def forest(component: np.ndarray, n: np.ndarray, bits: np.ndarray, own: np.ndarray, sets: list[np.ndarray],
           percent: int) -> list[tuple[int, int]]:
    """Links between nodes (by their places) that join the components that any links of a tile join.

    Only pairs of different components, and with two tiles of different tiles, are looked at, and
    of these only ones whose bitmaps leave a link possible: a bit that the other lacks is a
    shingle that it lacks, which bounds the intersection from above.  Pairs inside the largest
    component aren't formed."""
    kinds, component, counts = np.unique(component, return_inverse=True, return_counts=True)
    if len(kinds) < 2:
        return []
    parent = list(range(len(kinds)))

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    spare = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    two, links = own.min() != own.max(), []
    out = np.flatnonzero(component != counts.argmax())
    for k in range(0, len(out), 32):
        x = out[k: k + 32]
        now = np.array([root(c) for c in range(len(kinds))])[component]
        common = np.bitwise_count(bits[x, None, :] & bits[None, :, :]).sum(axis=2, dtype=np.int64)
        most = common + np.minimum(spare[x, None], spare)
        ok = ((100 + percent) * most >= percent * (n[x, None] + n)) & (now[x, None] != now)
        if two:
            ok &= own[x, None] != own
        for i, j in zip(*np.nonzero(ok), strict=True):
            a, b = int(x[i]), int(j)
            if (p := root(component[a])) != (q := root(component[b])) and linked(sets[a], sets[b], percent):
                parent[q] = p
                links.append((a, b))
    return links


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


TILE, TILE_BYTES = 2048, 8 << 20  # nodes of a bucket, and bytes of their sets, that a task compares at once with as many


def tile_links(open_: DataFrame, sized: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that join the components of each bucket's nodes, tile by tile."""
    met = open_.join(sized, "node")
    # buckets of the same nodes are one; they are told by their number and two sums of hashes
    alike = met.groupBy("key").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") * 8 / TILE_BYTES)).cast("int").alias("tiles"))
    first = alike.groupBy("c", "x", "y").agg(F.min(F.struct("key", "tiles")).alias("k")).select("k.key", "k.tiles")
    own = F.pmod(F.xxhash64("node", F.lit("tile")), F.col("tiles")).cast("int")
    rows = (met.join(first, "key").withColumn("own", own)
            .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("key", F.least("own", "t").alias("i"), F.greatest("own", "t").alias("j"), "own", "node",
                    "component", "n", "bits").join(sets, "node"))
    dealt = rows.select("key", "i", "j", "own", "node", "component", "n", "bits", "shingles").repartition(
        "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        own_, n = (table.column(c).to_numpy() for c in ("own", "n"))
        component = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
        bits = table.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, BITMAP)
        packed = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("shingles").combine_chunks()]
        links = forest(component, n, bits, own_, packed, percent)
        if links:
            node = table.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays([node.take(pa.array([x[k] for x in links])) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the tile that isn't over yet
        now = None
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)], axis=1)
            edges = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1), len(ids)]
            for x, y in zip(edges, edges[1:], strict=False):
                if x == y:
                    continue
                if tuple(ids[x]) != now:
                    if sum(b.num_rows for b in held) > 1:
                        yield from compared(pa.Table.from_batches(held))
                    held, now = [], tuple(ids[x])
                held.append(batch.slice(x, y - x))
        if sum(b.num_rows for b in held) > 1:
            yield from compared(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a binary, b binary")


def _combine(values: np.ndarray, salt: int) -> np.ndarray:
    """One hash of each row of minhash values."""
    out = np.full(len(values), salt, np.uint64)
    for j in range(values.shape[1]):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + values[:, j])
    return out


SIGNATURE = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("h", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("digest", T.BinaryType()), T.StructField("bits", T.ArrayType(T.LongType())),
    T.StructField("left", T.ArrayType(T.LongType())), T.StructField("right", T.ArrayType(T.LongType()))])
SETS = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("shingles", T.BinaryType())])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Rows and their texts (the last column), about 2 MB of text at a time."""
    for batch in batches:
        texts, chars, begin = [], 0, 0
        for i, t in enumerate(batch.column(batch.num_columns - 1)):
            texts.append(t.as_py())
            chars += len(texts[-1] or "")
            if chars > 2 << 20:
                yield batch.slice(begin, len(texts)), texts
                texts, chars, begin = [], 0, i + 1
        if texts:
            yield batch.slice(begin, len(texts)), texts


def signatures(docs: DataFrame, words: int, side: int, width: int) -> DataFrame:
    """Set size, digest of the set and both hash collections of each ``doc, h, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for own, texts in _texts(batches):
            sets = [shingle_set(t, words, hashes) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            values = minhashes([sets[i] for i in full], 2 * side * width) if full else None
            both = [[None] * len(sets), [None] * len(sets)]
            if full:
                for c in range(2):
                    bands = np.stack([_combine(values[:, (c * side + b) * width: (c * side + b + 1) * width],
                                               c * side + b + 1) for b in range(side)], axis=1).view(np.int64)
                    for i, row in zip(full, bands, strict=True):
                        both[c][i] = row
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([bitmap(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                 *(pa.array(x, pa.list_(pa.int64())) for x in both)], names=[f.name for f in SIGNATURE])

    return docs.mapInArrow(run, SIGNATURE)


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for own, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays(
                [own.column(0),
                 pa.array([shingle_set(t, words, hashes).tobytes() for t in texts], pa.binary())],
                names=[f.name for f in SETS])

    return docs.mapInArrow(run, SETS)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``a, b`` with 100 * intersection >= percent * union."""
    held = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                keep.append(linked(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return held.mapInArrow(run, "a binary, b binary")


def candidate_keys(classes: DataFrame) -> DataFrame:
    """Rows ``key, node``: one for each table, its key made of a hash of either collection."""
    return classes.select("node", F.explode(F.flatten(F.transform(
        "left", lambda x: F.transform("right", lambda y: F.xxhash64(x, y))))).alias("key"))


def _apart(met: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of buckets whose nodes are in several components."""
    now = (met.where("members > 2").join(labels.withColumnRenamed("id", "node"), "node", "left")
           .select("key", "node", F.coalesce("component", "node").alias("component")))
    several = now.groupBy("key").agg(F.min("component").alias("_x"), F.max("component").alias("_y")).where(
        "_x <> _y").select("key")
    return now.join(several, "key")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs ``lead, node`` of two components."""
    of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"_{c}"))
    return (pairs.join(of("node"), "node", "left").join(of("lead"), "lead", "left")
            .where(F.coalesce("_node", "node") != F.coalesce("_lead", "lead")).select("lead", "node"))


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, doc: str = "doc_id",
                    text: str = "text", side: int = 8, width: int = 3,
                    random_leads: int = 2) -> DataFrame:
    """Rows ``doc_id, n_shingles, component_id, kept``, one for each row.

    ``component_id``: the least document id reachable over links (100 * intersection >=
    percent * union of the shingle sets); ``kept``: the document is that one.  Null, empty
    and blank texts have an empty set, are linked with nothing and kept.  Repeated rows all
    come back, with one component; so do rows of one id with other texts, each judged by its
    own text.  A null id takes part in no link, has a null component and is kept.  An empty
    table gives no rows.  Other columns are not looked at.
    """
    small_batches(df.sparkSession, 512)
    docs = df.select(F.col(f"`{doc}`").cast("long").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("h"),
                     F.col(f"`{text}`").alias("text"))
    signed = stage(signatures(docs, words, side, width), "signatures")
    # equal sets are one node; one row's text stands for all
    classes = stage(signed.where("n > 0 and doc is not null").groupBy(F.col("digest").alias("node")).agg(
        F.min(F.struct("doc", "h")).alias("who"), F.first("n").alias("n"), F.first("bits").alias("bits"),
        F.first("left").alias("left"), F.first("right").alias("right")), "classes")
    sizes = classes.select("node", "n", "bits")
    keys = candidate_keys(classes)
    leads = (keys.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last"),
                                     F.count("*").alias("members"))
             .where("lead <> last").drop("last"))
    # the keys that several nodes share; a key of very many nodes is split by adaptive execution
    met = stage(keys.join(leads, "key"), "buckets")
    shown = classes.join(met.select("node").distinct(), "node", "left_semi").select("node", "who.doc", "who.h")
    texts = docs.join(shown, ["doc", "h"]).groupBy("node").agg(F.first("text").alias("text"))
    sets = stage(full_sets(texts, words), "sets")

    def close(pairs: DataFrame) -> DataFrame:
        """Distinct pairs whose sizes allow a link, and that are linked by their sets."""
        sized = (pairs.distinct()
                 .join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
                 .join(sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
                 .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b"))
        return stage(confirm(sized, sets, percent), "links")

    # every node with the least of its buckets' leads, then with other leads where that left them apart:
    # a group of near copies takes about a comparison a node, not one for each table
    led = met.where("node <> lead")
    first = led.groupBy("node").agg(F.min("lead").alias("first"))
    links = close(first.select(F.col("first").alias("a"), F.col("node").alias("b")))
    labels = components(links)
    others = led.join(first, "node").where("lead <> first").select("lead", "node").distinct()
    more = close(_across(others, labels).select(F.col("lead").alias("a"), F.col("node").alias("b")))
    if not more.isEmpty():
        links = links.unionAll(more)
        labels = components(links)
    for turn in range(random_leads + 1):
        open_ = stage(_apart(met, labels), "open")  # with two members their pair was compared above
        if open_.isEmpty():
            break
        if turn < random_leads:
            # every bucket's nodes with another one of it, drawn by a hash
            drawn = open_.groupBy("key").agg(F.min(F.struct(
                F.xxhash64("node", "key", F.lit(turn)).alias("h"), "node", "component")).alias("d"))
            more = close(open_.join(drawn, "key").where("component <> d.component").select(
                F.col("d.node").alias("a"), F.col("node").alias("b")))
        else:  # what is still apart
            more = stage(tile_links(open_, sizes, sets, percent), "links")
        if not more.isEmpty():
            links = links.unionAll(more)
            labels = components(links)

    of_node = stage(classes.select("node", "who.doc").join(labels.withColumnRenamed("id", "node"), "node", "left")
                    .select("node", "doc", F.coalesce("component", "node").alias("component")), "labels")
    least = of_node.groupBy("component").agg(F.min("doc").alias("_c"))
    of_class = of_node.select(F.col("node").alias("digest"), "component").join(least, "component").drop("component")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("_c", "doc"))
    return (signed.select("doc", "n", "digest").join(of_class, "digest", "left")
            .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                    component.alias("component_id"),
                    F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept")))
