"""Toxicity: a convolutional text classifier, trained in numpy, thresholds by language.

A word's vector is the sum of hashed embeddings of the word and of its five-byte grams, so
that inflected forms share what was learned.  Filters of widths 1, 2 and 3 run over the
whole text; of each, the greatest value of the text and the mean of the greatest values of
its segments (``SEGMENT`` places each) go to a logistic output.  Because a filter is a sum
over its places, each word's share of every filter is looked up once and added up.

Only the fit is bounded: ``FIT_ROWS`` labelled rows of least hash, whole texts, together
``FIT_CHARS`` characters at most.  Three quarters of them train the network, the rest set
the scale of the score and each language's threshold.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanload.llm.common import small_batches, stage

FIT_ROWS, FIT_CHARS = 9_000, 24_000_000
BUCKETS, SIZE, FILTERS, WIDTHS, GRAM = 1 << 16, 16, 16, (1, 2, 3), 5
EPOCHS, BATCH, RATE = 3, 64, 0.1
REMEMBERED, SEGMENT = 1 << 16, 128
SPAN = 512 * SEGMENT
STRIP = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PLACES = [(w, j) for w in WIDTHS for j in range(w)]  # blocks of FILTERS columns of a word's shares


def pieces(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (at most 2^16) of each word without outer punctuation and of its five-byte grams, the word's
    ends marked; how many each word has (the word's own comes first)."""
    bare = [b"<" + (w.strip(STRIP) or w) + b">" for w in words]
    lengths = np.fromiter(map(len, bare), np.int64, len(bare))
    grams = np.maximum(1, lengths - GRAM + 1)
    text = np.frombuffer((bytes(GRAM)).join([*bare, b""]), np.uint8).astype(np.uint64)
    window = sum(text[i: len(text) - GRAM + 1 + i] << np.uint64(8 * i) for i in range(GRAM))
    hashed = (window * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    starts = np.cumsum(lengths + GRAM) - lengths - GRAM
    ends = np.cumsum(grams + 1)
    out = np.empty(ends[-1] if len(ends) else 0, np.int64)
    own = ends - grams - 1
    rest = np.ones(len(out), bool)
    rest[own] = False
    out[own] = np.fromiter(map(zlib.crc32, bare), np.int64, len(bare))
    at = np.repeat(starts - np.cumsum(grams) + grams, grams) + np.arange(grams.sum())
    out[rest] = hashed[at]
    return (out % BUCKETS).astype(np.uint16), grams + 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Lexicon:
    """Words as numbers from 1 on (0 stands between texts); their buckets, flattened."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.fresh: list[bytes] = []

    def numbers(self, words: list[bytes]) -> np.ndarray:
        place = self.place
        for w in set(words).difference(place):
            place[w] = len(place) + 1
            self.fresh.append(w)
        return np.fromiter(map(place.__getitem__, words), np.int64, len(words))

    def buckets_of_fresh(self) -> tuple[np.ndarray, np.ndarray]:
        found = [pieces(self.fresh[lo: lo + SPAN]) for lo in range(0, max(1, len(self.fresh)), SPAN)]
        self.fresh = []
        return np.concatenate([b for b, _ in found]), np.concatenate([n for _, n in found])


class Network:
    """Embeddings, filters and output; ``scale`` and ``shift`` set by calibration."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32)
        self.filters = rng.normal(0, 0.3, (SIZE, len(PLACES) * FILTERS)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, 2 * len(self.bias)).astype(np.float32)  # of the greatest, of the means
        self.base, self.scale, self.shift, self.thresholds, self.threshold = 0.0, 1.0, 0.0, {}, 0.5

    def vectors(self, buckets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not len(sizes):
            return np.zeros((0, SIZE), np.float32)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(self.table[buckets], starts, axis=0) / np.sqrt(sizes)[:, None].astype(np.float32)

    def responses(self, shares: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Filter values at each place but the last two; ``numbers`` ends with zeros."""
        n, out, k = len(numbers) - max(WIDTHS) + 1, [], 0
        for w in WIDTHS:
            total = shares[numbers[:n], k * FILTERS: (k + 1) * FILTERS]
            for j in range(1, w):
                total = total + shares[numbers[j: n + j], (k + j) * FILTERS: (k + j + 1) * FILTERS]
            out.append(total)
            k += w
        return np.concatenate(out, axis=1) + self.bias

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(self.scale * (features @ self.out + self.base) + self.shift, -30, 30)
        return 1 / (1 + np.exp(-z.astype(np.float64)))


def _joined(texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts, zeros after each; beginning and end of each segment (an empty text has one, a
    zero); how many segments each text has."""
    gap, parts, edges, counts, at = np.zeros(max(WIDTHS), np.int64), [], [], [], 0
    for t in texts:
        n = max(1, len(t))
        parts += [t, gap]
        own = np.arange(0, n, SEGMENT)
        edges.append(at + np.column_stack([own, np.minimum(own + SEGMENT, n)]))
        counts.append(len(own))
        at += len(t) + len(gap)
    return np.concatenate([*parts, gap]), np.concatenate(edges), np.array(counts)


def train(texts: Sequence[str | None], toxic: np.ndarray, seed: int = 11) -> Network:
    """Logistic loss by sparse Adagrad; gradients pass through each filter's greatest place of each segment."""
    net, lexicon, rng = Network(seed), Lexicon(), np.random.default_rng(seed)
    numbers = [lexicon.numbers(words_of(t)).astype(np.int32) for t in texts]
    buckets, sizes = lexicon.buckets_of_fresh()
    del lexicon
    first = np.concatenate([[0], np.cumsum(sizes)])
    net.base = float(np.log((toxic.sum() + 1) / (len(toxic) - toxic.sum() + 1)))
    _log_odds(net, numbers, toxic, buckets, sizes)
    squares = {k: np.full_like(getattr(net, k), 1e-2) for k in ("table", "filters", "bias", "out")}
    base_square = 1e-2

    def step(name: str, gradient: np.ndarray, rows=slice(None)) -> None:
        squares[name][rows] += gradient * gradient
        getattr(net, name)[rows] -= RATE * gradient / np.sqrt(squares[name][rows])

    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            ids = order[lo: lo + BATCH]
            joined, edges, counts = _joined([numbers[i] for i in ids])
            own, inverse = np.unique(joined, return_inverse=True)  # zero comes first: it ends every text
            known = own[1:] - 1
            lengths = sizes[known]
            take = np.repeat(first[known] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            vectors = np.concatenate([np.zeros((1, SIZE), np.float32), net.vectors(buckets[take], lengths)])
            values = net.responses(vectors @ net.filters, inverse)
            best = np.stack([values[a:b].argmax(axis=0) + a for a, b in edges])
            peaks = np.maximum(np.take_along_axis(values, best, axis=0), 0)
            begin, half = np.cumsum(counts) - counts, len(net.bias)
            features = np.concatenate([np.maximum.reduceat(peaks, begin), np.add.reduceat(peaks, begin) / counts[:, None]],
                                      axis=1).astype(np.float32)
            error = (1 / (1 + np.exp(-(features @ net.out + net.base))) - toxic[ids]).astype(np.float32) / len(ids)
            back = np.repeat(error / counts, counts)[:, None] * net.out[half:]
            top = np.stack([peaks[a: a + n].argmax(axis=0) + a for a, n in zip(begin, counts, strict=True)])
            back[top, np.arange(half)] += error[:, None] * net.out[:half]
            back = (back * (peaks > 0)).astype(np.float32)
            filters, grads = np.zeros_like(net.filters), np.zeros_like(vectors)
            for k, (w, j) in enumerate(PLACES):
                part = slice(WIDTHS.index(w) * FILTERS, (WIDTHS.index(w) + 1) * FILTERS)
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                words, b = inverse[best[:, part] + j], back[:, part]
                filters[:, cols] = np.einsum("nfd,nf->df", vectors[words], b)
                np.add.at(grads, words.ravel(), (b[:, :, None] * net.filters[:, cols].T).reshape(-1, SIZE))
            moved = np.flatnonzero(np.any(grads[1:] != 0, axis=1))
            held = np.repeat(np.arange(len(lengths)), lengths)
            pick = np.isin(held, moved)
            rows, where = np.unique(buckets[take][pick], return_inverse=True)
            table = np.zeros((len(rows), SIZE), np.float32)
            np.add.at(table, where, grads[1 + held[pick]] / np.sqrt(lengths[held[pick]])[:, None].astype(np.float32))
            step("table", table, rows)
            step("filters", filters)
            step("bias", back.sum(axis=0))
            step("out", features.T @ error)
            base_square += float(error.sum()) ** 2
            net.base -= RATE * float(error.sum()) / base_square**0.5
    return net


def _log_odds(net: Network, numbers, toxic, buckets, sizes) -> None:
    """Start: one coordinate of the embeddings is each bucket's shrunk log-odds of toxic texts."""
    first = np.concatenate([[0], np.cumsum(sizes)])
    seen = np.zeros((BUCKETS, 2))
    for t, y in zip(numbers, toxic, strict=True):
        own = np.unique(t) - 1
        if len(own):
            seen[np.unique(np.concatenate([buckets[first[w]: first[w + 1]] for w in own])), int(y)] += 1
    total = np.array([len(toxic) - toxic.sum(), toxic.sum()])
    share = (seen.sum(axis=1) + 1) / (total.sum() + 2)
    odds = np.log((seen[:, 1] + 4 * share) / (total[1] + 4)) - np.log((seen[:, 0] + 4 * share) / (total[0] + 4))
    net.table[:, 0] = np.clip(odds, -3, 3) * np.minimum(1, seen.sum(axis=1) / 5)
    net.filters[0, :FILTERS] = np.abs(net.filters[0, :FILTERS])
    for part in (0, len(net.bias)):
        net.out[part: part + FILTERS] = np.abs(net.out[part: part + FILTERS])


class Scorer:
    """Scores whole texts, a span of places at a time; remembers the shares of ``REMEMBERED`` words."""

    def __init__(self, net: Network):
        self.net, self.lexicon = net, Lexicon()
        self.shares = np.zeros((1, net.filters.shape[1]), np.float32)

    def learn(self) -> None:
        if self.lexicon.fresh:
            new = self.net.vectors(*self.lexicon.buckets_of_fresh()) @ self.net.filters
            self.shares = np.concatenate([self.shares, new])

    def features(self, texts: Sequence[str | None]) -> np.ndarray:
        half = len(self.net.bias)
        greatest, total, segments = np.zeros((len(texts), half), np.float32), np.zeros((len(texts), half)), np.zeros(len(texts))
        waiting, places = [], 0

        def flush() -> None:
            if waiting:
                self.learn()
                joined, edges, counts = _joined([n for _, n in waiting])
                values = self.net.responses(self.shares, joined)
                peaks = np.maximum(np.maximum.reduceat(values, edges.ravel(), axis=0)[::2], 0)
                begin, own = np.cumsum(counts) - counts, [i for i, _ in waiting]
                np.maximum.at(greatest, own, np.maximum.reduceat(peaks, begin))
                np.add.at(total, own, np.add.reduceat(peaks, begin))
                np.add.at(segments, own, counts)
                waiting.clear()

        for i, text in enumerate(texts):
            words = words_of(text)
            for lo in range(0, max(1, len(words)), SPAN):  # long texts by spans of whole segments
                part = words[lo: lo + SPAN]
                if places + len(part) > SPAN or len(self.lexicon.place) > REMEMBERED:
                    flush()
                    places = 0
                    if len(self.lexicon.place) > REMEMBERED:
                        self.lexicon, self.shares = Lexicon(), self.shares[:1]
                waiting.append((i, self.lexicon.numbers(part)))
                places += len(part)
        flush()
        return np.concatenate([greatest, total / np.maximum(segments, 1)[:, None]], axis=1)

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        return self.net.probability(self.features(texts)) if len(texts) else np.zeros(0)


def calibrate(net: Network, scorer: Scorer, texts: Sequence[str | None], toxic: np.ndarray, langs: Sequence[str],
              least: int = 20) -> None:
    """Sets the score's scale and shift by logistic regression on smoothed targets, then each
    language's threshold, the best F1 on its rows; one with fewer than ``least`` toxic or other
    rows takes the threshold of all."""
    yes, no = int(toxic.sum()), int(len(toxic) - toxic.sum())
    if not yes or not no:
        return
    z = scorer.features(texts) @ net.out + net.base
    want = np.where(toxic == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
    x, w = np.column_stack([z, np.ones(len(z))]), np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:  # held near scale 1
        return float(np.sum(np.logaddexp(0, x @ v) - want * (x @ v)) + 0.5 * np.sum((v - [1, 0]) ** 2))

    for _ in range(50):  # Newton steps, halved until the loss falls
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (p - want) + w - [1, 0])
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
    if w[0] > 0:
        net.scale, net.shift = float(w[0]), float(w[1])
    score = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -30, 30)))
    net.threshold = _best(score, toxic)
    for lang in set(langs):
        own = np.array([x == lang for x in langs])
        if min(toxic[own].sum(), own.sum() - toxic[own].sum()) >= least:
            net.thresholds[lang] = _best(score[own], toxic[own])


def _best(score: np.ndarray, toxic: np.ndarray) -> float:
    """Half way between the last score taken and the next, where F1 is greatest."""
    order = np.argsort(-score, kind="stable")
    s, hits = score[order], np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + toxic.sum())
    f1[:-1][s[1:] == s[:-1]] = -1  # ties go together
    k = int(f1.argmax())
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0)) / 2)


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """``docs``: doc, text, lang; ``labels``: doc, toxic (0 or 1), one row each.  None: no labels."""
    least = labels.withColumn("_h", F.xxhash64("doc")).orderBy("_h", "doc").limit(FIT_ROWS)
    # at most FIT_ROWS rows: safe to broadcast
    rows = stage(docs.join(F.broadcast(least), "doc").withColumn("_t", F.xxhash64("text")), "toxicity-sample")
    sizes = rows.select("_h", "doc", "_t", F.length("text").alias("n")).orderBy("_h", "doc", "_t").limit(FIT_ROWS).collect()
    taken, chars = [], 0
    for r in sizes:  # whole texts only; one that would pass the bound is left out
        if chars + (r["n"] or 0) <= FIT_CHARS:
            taken.append((r["_h"], r["_t"]))
            chars += r["n"] or 0
    if not taken:
        return None
    spark = docs.sparkSession
    keys = F.broadcast(spark.createDataFrame(taken, "_h long, _t2 long").distinct())
    own = rows.join(keys, (rows["_h"] == keys["_h"]) & F.col("_t").eqNullSafe(F.col("_t2"))).drop(keys["_h"])
    table = own.select("_h", "doc", "_t", "text", "lang", "toxic").orderBy("_h", "doc", "_t").limit(FIT_ROWS).toArrow()
    part = table["_h"].to_numpy() % 4 == 0
    texts, toxic, langs = (table[c].to_pylist() for c in ("text", "toxic", "lang"))
    toxic = np.array(toxic, np.int64)
    if part.all() or not part.any():
        part = np.arange(len(toxic)) % 4 == 3
    net = train([t for t, c in zip(texts, part, strict=True) if not c], toxic[~part])
    calibrate(net, Scorer(net), [t for t, c in zip(texts, part, strict=True) if c], toxic[part],
              [x for x, c in zip(langs, part, strict=True) if c])
    return net


def classify(df: DataFrame, labels: DataFrame, held_out: Column, doc: str = "doc_id", text: str = "text",
             lang: str = "lang", label: str = "toxic", label_doc: str = "doc_id", cut: float = 0.5) -> DataFrame:
    """Rows ``doc_id, held_out, score, predicted, lang, threshold, flagged``, one for each row of ``df``.

    ``held_out``: a condition on ``df``'s columns; labels of such rows are never learned from,
    nor are those for which it is null.  ``score`` looks at the text alone.  ``predicted`` is
    ``score >= cut``; ``flagged`` is ``score >= threshold``, the language's calibrated one.

    Labels are 0 or 1; others and null ids are left out, several of one id are averaged (toxic
    from one half on).  Null and empty texts are scored as a text without words.  A null
    language takes the threshold of all.  Repeated rows all come back; no labels: all scores
    are 0; an empty table gives no rows.  Other columns are not looked at.
    """
    small_batches(df.sparkSession, 512)
    docs = df.select(F.col(f"`{doc}`").alias("doc"), F.coalesce(held_out, F.lit(True)).alias("held"),
                     F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    known = (labels.select(F.col(f"`{label_doc}`").alias("doc"), F.col(f"`{label}`").alias("toxic"))
             .where("doc is not null and toxic in (0, 1)").groupBy("doc")
             .agg(F.when(F.avg("toxic") >= 0.5, 1).otherwise(0).alias("toxic")))
    learned = docs.where("not held").select("doc", "text", F.coalesce("lang", F.lit("")).alias("lang"))
    net = fit(learned, known.join(learned.select("doc").distinct(), "doc", "left_semi"))
    schema = T.StructType([docs.schema["doc"], docs.schema["held"], docs.schema["lang"],
                           T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net else None
        for batch in batches:
            texts = batch.column(3).to_pylist()
            found = scorer.scores(texts) if scorer else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.float64())],
                                             names=["doc", "held", "lang", "score"])

    limits = F.lit(net.threshold if net else 0.5)
    for name, value in sorted((net.thresholds if net else {}).items()):  # those with enough labelled rows: few
        limits = F.when(F.col("lang") == name, value).otherwise(limits)
    return (docs.mapInArrow(score, schema)
            .select(F.col("doc").alias("doc_id"), F.col("held").alias("held_out"), "score",
                    F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"), "lang",
                    limits.cast("double").alias("threshold"))
            .withColumn("flagged", F.col("score") >= F.col("threshold")))
