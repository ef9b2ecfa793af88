"""A text classifier for labelled documents, used by the quality and mixing operators.

Fitted on a bounded sample of labelled rows (``FIT_ROWS``, those of least hash): half of
them give log-ratios of hashed words for each class, the other half a softmax regression
on a few features of the whole text (extremes and mean of its words' log-ratios, shares of
character kinds, repetition, length).  Scoring reads whole texts in Arrow batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanload.llm.common import small_batches

FIT_ROWS = 12000
BUCKETS = 1 << 16
STRIP = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
REMEMBERED = 1 << 18

_KIND = np.zeros(256, np.int64)  # 1: upper case, 2: lower case, 3: digit, 4: white space, 5: other ASCII, 0: the rest
for _i in range(128):
    _c = chr(_i)
    _KIND[_i] = 1 if _c.isupper() else 2 if _c.islower() else 3 if _c.isdigit() else 4 if _c.isspace() else 5


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        b = self[word] = zlib.crc32(word.strip(STRIP) or word) % BUCKETS
        return b


def row_key(doc: Column, text: Column) -> Column:
    """One number for a row's id and text, also where they are null."""
    return F.xxhash64(F.coalesce(doc.cast("string"), F.lit("-")), F.coalesce(text, F.lit("")))


class TextModel:
    """Posteriors of the classes, and the number of words, of whole texts."""

    def __init__(self, classes: Sequence[str], ratios: np.ndarray):
        self.classes, self.ratios = list(classes), ratios.astype(np.float32)  # (BUCKETS, K)
        self.mean = self.scale = self.weights = None
        self.buckets = _Buckets()

    def __getstate__(self):
        return self.__dict__ | {"buckets": _Buckets()}

    def features(self, text: str | None) -> tuple[np.ndarray, int]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        split = raw.lower().split()
        n, k = len(split), len(self.classes)
        out = np.zeros(3 * k + 10)
        if n:
            kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=6) / len(raw)
            distinct = set(split)
            r = self.ratios[np.fromiter(map(self.buckets.__getitem__, distinct), np.int64, len(distinct))]
            top = np.sort(r, axis=0)[-3:]
            lines = raw.split(b"\n")
            out[:k], out[k: 2 * k], out[2 * k: 3 * k] = top[-1], top.mean(axis=0), r.mean(axis=0)
            out[3 * k:] = [*kinds[[1, 3, 5, 0]], len(distinct) / n, len(set(lines)) / len(lines),
                           np.log(n), len(raw) / n / 10, raw.count(b"|") / n, kinds[1] / (kinds[1] + kinds[2] + 1e-9)]
        return out, n

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 400) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w = np.zeros((z.shape[1], len(self.classes)))
        want = np.eye(len(self.classes))[y]
        first = second = np.zeros_like(w)
        for t in range(1, steps + 1):
            p = _softmax(z @ w)
            grad = z.T @ (p - want) / len(z) + 1e-3 * w
            first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
            w = w - 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        self.weights = w

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:  # nothing was labelled
            return np.full((len(x), len(self.classes)), 1 / len(self.classes))
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return _softmax(np.column_stack([z, np.ones(len(z))]) @ self.weights)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, labels: DataFrame) -> TextModel:
    """``docs``: doc, text; ``labels``: doc, label (string).  Nulls are left out; a document
    with several labels counts under each.  No labels at all: one class, always certain."""
    small_batches(docs.sparkSession, 512)
    sample = (labels.where("doc is not null and label is not null").distinct()
              .withColumn("_h", F.xxhash64("doc")).orderBy("_h", "doc", "label").limit(FIT_ROWS))
    # at most FIT_ROWS rows: safe to broadcast
    rows = docs.join(F.broadcast(sample.select("doc", "label", (F.col("_h") % 2 == 0).alias("_half"))), "doc")
    classes = sorted(r[0] for r in sample.select("label").distinct().collect()) or ["none"]
    place = {c: i for i, c in enumerate(classes)}
    counted = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("label", T.IntegerType()),
                            T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total, some = _Buckets(), np.zeros((BUCKETS + 1, len(classes)), np.int64), False
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set((text or "").encode("utf-8", "surrogatepass").lower().split())
                total[np.array(sorted({buckets[w] for w in words} | {BUCKETS})), place[label]] += 1
                some = True
        if some:
            b, c = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(c, pa.int32()),
                                              pa.array(total[b, c], pa.int64())], names=["bucket", "label", "n"])

    found = (rows.where("_half").select("text", "label").mapInArrow(count, counted)
             .groupBy("bucket", "label").agg(F.sum("n").alias("n")).toPandas())  # at most BUCKETS rows a class
    total = np.zeros((BUCKETS + 1, len(classes)))
    total[found["bucket"].to_numpy(int), found["label"].to_numpy(int)] = found["n"]
    in_class = total[BUCKETS]
    ratios = np.zeros((BUCKETS, len(classes)))
    for k in range(len(classes)):  # shrunk: a word seen in few documents says little
        own, rest = total[:BUCKETS, k], total[:BUCKETS].sum(axis=1) - total[:BUCKETS, k]
        share = (total[:BUCKETS].sum(axis=1) + 1) / (in_class.sum() + 2)
        a = (own + 4 * share) / (in_class[k] + 4)
        b = (rest + 4 * share) / (in_class.sum() - in_class[k] + 4)
        ratios[:, k] = np.clip(np.log(a / b), -3, 5) * np.minimum(1, (own + rest) / 5)
    model = TextModel(classes, ratios)
    pdf = score(rows.where("not _half").select("doc", "text", "label"), model, features=True).toPandas()
    if len(pdf) and len(classes) > 1:
        model.fit(np.stack(pdf["features"].to_numpy()), pdf["label"].map(place).to_numpy(int))
    return model


def score(df: DataFrame, model: TextModel, text: str = "text", features: bool = False) -> DataFrame:
    """Add ``posteriors`` (array in the order of the classes) and ``words``, or ``features``;
    the text column goes."""
    small_batches(df.sparkSession, 512)
    kept = [c for c in df.columns if c != text]
    new = "features" if features else "posteriors"
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(new, T.ArrayType(T.DoubleType())),
                           T.StructField("words", T.LongType())])
    return df.select(*kept, text).mapInArrow(_scorer(model, kept, new), schema)


def _scorer(model: TextModel, kept: list[str], new: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.features(t.as_py()) for t in batch.column(len(kept))]
            x = np.array([r[0] for r in rows]).reshape(len(rows), -1)
            if new == "posteriors" and len(rows):
                x = model.posteriors(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(list(x), pa.list_(pa.float64())),
                 pa.array([r[1] for r in rows], pa.int64())], names=[*kept, new, "words"])

    return run
