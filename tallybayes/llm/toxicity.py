"""Toxicity: averaged subword embeddings into a linear softmax, trained jointly in numpy.

A word is lower-cased, stripped of punctuation at its ends, and stands for the
average of the embeddings of its subwords: the whole word and its character
3- to 5-grams with ``<`` and ``>`` at the ends, hashed to ``BUCKETS`` rows. A
text is the average of its words; a softmax over two classes reads that
average. Embeddings and softmax are fitted together by Adam. A misspelling that
was never seen shares most n-grams with the word it comes from.

The fit reads a bounded sample of labelled rows: those with the smallest hash of
their id, ``max_train`` rows and ``max_bytes`` of bags at most. Executors turn each
sampled text, whole, into its bag of buckets, which has at most ``BUCKETS``
entries, and stage the bags; the driver reads their sizes first and then no more
of them than the bound, whatever the lengths of the texts. Scoring reads every text whole on
the executors: as the softmax is linear, each bucket has one number, a word the
average of its buckets' numbers, a text the average of its words'.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallybayes.llm._util import Stage, prepare

BUCKETS = 1 << 15
DIM = 8
GRAMS = (3, 4, 5)
MAX_TRAIN = 8000
MAX_BYTES = 96 << 20  # of packed bags that the fit reads; one has about 128 KiB at most
STEPS = 320  # at least 10 passes
MAX_WORDS = 400_000  # words whose numbers a worker holds before it starts anew
EDGES = ".,;:!?\"'()[]{}|#*%&$~<>"


def subwords(word: str) -> list[int]:
    """Buckets of a word: itself and its character n-grams."""
    w = f"<{word}>"
    out = [zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS]
    for n in GRAMS:
        out += [zlib.crc32(w[i : i + n].encode("utf-8", "surrogatepass")) % BUCKETS for i in range(len(w) - n + 1)]
    return out


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _bag(texts: pd.Series) -> pd.Series:
    """Packed bags (see ``unpacked``)."""
    out, known = [], {}
    for text in texts:
        parts = words(text)
        seen = Counter(parts)
        for w in seen:
            if w not in known:
                if len(known) > MAX_WORDS // 4:
                    known.clear()
                known[w] = np.array(subwords(w.strip(EDGES)), np.uint16)
        ids = [known.get(w) if w in known else np.array(subwords(w.strip(EDGES)), np.uint16) for w in seen]
        sizes = np.array([len(i) for i in ids], np.int64)
        each = np.array([c / len(parts) for c in seen.values()]) / np.maximum(sizes, 1)
        bag = np.bincount(np.concatenate(ids), np.repeat(each, sizes), BUCKETS) if ids else np.zeros(BUCKETS)
        at = np.flatnonzero(bag)
        top = bag.max()
        step = np.diff(at, prepend=0).astype("<u2")
        plain = np.float32(top).tobytes() + step.tobytes() + (bag[at] / max(top, 1e-30)).astype("<f2").tobytes()
        out.append(zlib.compress(plain, 1))
    return pd.Series(out, dtype=object)


def unpacked(bag: bytes) -> tuple[np.ndarray, np.ndarray, np.float32]:
    """(buckets, weights over the largest one, the largest weight).

    A packed bag is compressed: the largest weight, the steps from bucket to
    bucket as unsigned 16-bit integers, the weights as 16-bit floats.
    """
    plain = zlib.decompress(bag)
    n = (len(plain) - 4) // 4
    at = np.cumsum(np.frombuffer(plain, "<u2", n, 4), dtype=np.int64)
    return at, np.frombuffer(plain, "<f2", n, 4 + 2 * n).astype(np.float32), np.frombuffer(plain, "<f4", 1)[0]


@dataclass
class Model:
    """What scoring needs: a number for each bucket, and the bias (difference of the two logits)."""

    bucket: np.ndarray
    bias: float
    rows: int


def fit(bags: list[bytes], labels: np.ndarray, batch: int = 256, rate: float = 0.05, l2: float = 1e-4, seed: int = 7) -> Model:
    """Embeddings and softmax, jointly, by Adam on the log loss.

    Without rows of both classes there is nothing to tell apart: every text
    then scores the smoothed share of the labels.
    """
    y = np.asarray(labels, np.int64)
    n, prior = len(y), (y.sum() + 0.5) / (len(y) + 1.0)
    bias = float(np.log(prior / (1 - prior)))
    if n == 0 or len(np.unique(y)) < 2:
        return Model(np.zeros(BUCKETS, np.float64), bias, n)
    rng = np.random.default_rng(seed)
    epochs = max(10, STEPS // -(-n // batch))
    # the text average of many words is small: the scale brings it to about 1
    scale = np.float32(30.0)
    p = [
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
        rng.normal(0, 0.3, (DIM, 2)).astype(np.float32),
        np.array([0, bias], np.float32),
    ]
    m1, m2, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        for first in range(0, n, batch):
            pick = order[first : first + batch]
            x = np.zeros((len(pick), BUCKETS), np.float32)
            for i, r in enumerate(pick):
                at, weight, top = unpacked(bags[r])
                x[i, at] = weight * (top * scale)
            hidden = x @ p[0]
            z = hidden @ p[1] + p[2]
            z -= z.max(1, keepdims=True)
            q = np.exp(z)
            q /= q.sum(1, keepdims=True)
            q[np.arange(len(pick)), y[pick]] -= 1
            q /= len(pick)
            grad = [x.T @ (q @ p[1].T) + l2 * p[0], hidden.T @ q, q.sum(0)]
            step += 1
            lr = rate * (1 - epoch / epochs)
            for k, g in enumerate(grad):
                m1[k] += 0.1 * (g - m1[k])
                m2[k] += 0.001 * (g * g - m2[k])
                p[k] -= lr * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    slope = (p[1][:, 1] - p[1][:, 0]).astype(np.float64)
    return Model(float(scale) * (p[0].astype(np.float64) @ slope), float(p[2][1] - p[2][0]), n)


def _within(bags: DataFrame, max_bytes: int) -> DataFrame:
    """The first bags, by hash of the id, then id, then hash of the bag, that have ``max_bytes`` together; equal ones go together."""
    place = {"k": F.xxhash64("doc_id"), "i": F.col("doc_id"), "h": F.xxhash64("bag")}
    sizes = bags.select(*[c.alias(n) for n, c in place.items()], F.length("bag").alias("n")).toPandas()  # four numbers a row
    total = sizes.groupby(["k", "i", "h"])["n"].sum().sort_index().cumsum()
    fits = total[total <= max_bytes]
    if not len(fits):
        return bags.limit(0)
    last = [F.lit(int(v)).cast(t) for v, t in zip(fits.index[-1], ("long", dict(bags.dtypes)["doc_id"], "long"), strict=True)]
    return bags.filter(F.struct(*[c.alias(n) for n, c in place.items()]) <= F.struct(*[v.alias(n) for n, v in zip(place, last, strict=True)]))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, held_out: int | None = 0, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on labelled documents; ``held_out`` is the remainder of crc32(id) mod 5 that is left out.

    ``labels`` has doc_id and toxic (1 marks toxic; a repeated id counts as
    toxic if any of its rows says so; null labels and ids are left out). At
    most ``max_train`` rows are read, those with the smallest hash of the id,
    then of the text; where ids repeat, rows equal in both count once. Of their
    bags the first ``max_bytes`` are used, so long texts make the sample smaller.
    """
    prepare(docs.sparkSession)
    stage = Stage(docs.sparkSession, "toxicity")
    rows = labels.filter("doc_id is not null and toxic is not null")
    if held_out is not None:
        rows = rows.filter(split(F.col("doc_id")) != held_out)
    rows = rows.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("y"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # bounded: broadcast
    bag = F.pandas_udf(_bag, "binary")
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    if docs.select("doc_id").join(F.broadcast(rows), "doc_id").count() > max_train:  # ids repeat
        texts = texts.withColumn("h", F.xxhash64("text"))
        first = texts.select("doc_id", "h").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "h").limit(max_train)
        texts = texts.join(F.broadcast(first), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    bags = stage.table(texts.select("doc_id", "y", bag("text").alias("bag")))
    got = _within(bags, max_bytes).toPandas()  # max_train rows and max_bytes at most
    stage.drop(bags)
    # order by content, so that the fit does not depend on how rows arrive
    got = got.sort_values(["doc_id", "bag"]).reset_index(drop=True)
    return fit(got["bag"].tolist(), got["y"].to_numpy())


def split(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def score(text: Column, model: Model, spark) -> Column:
    """Probability that a text is toxic. Null and empty texts score as the bias alone."""
    sent = spark.sparkContext.broadcast(model)  # bounded: one number for each bucket

    @F.pandas_udf(DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        m, out, known = sent.value, [], _KNOWN
        if known.get("") is not m.bucket:
            known.clear()
            known[""] = m.bucket
        for text in texts:
            parts, total = words(text), 0.0
            for w in parts:
                v = known.get(w)
                if v is None:
                    v = known[w] = float(m.bucket[subwords(w.strip(EDGES))].mean())
                total += v
            z = m.bias + (total / len(parts) if parts else 0.0)
            out.append(1 / (1 + np.exp(-min(max(z, -700.0), 700.0))))
            if len(known) > MAX_WORDS:
                known.clear()
                known[""] = m.bucket
        return pd.Series(out, dtype=float)

    return run(text)


_KNOWN: dict[str, object] = {}


def scored(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of ``docs``.

    Only the text enters the score. A null id is in no split: held_out false.
    Null and empty texts score as the bias alone; very long ones are read whole;
    repeated rows score alike; an empty table gives an empty result. Other columns,
    whatever their names, are not read.
    """
    prepare(docs.sparkSession)
    model = train(docs, labels, max_train)
    p = docs.select("doc_id", score(F.col("text"), model, docs.sparkSession).alias("score"))
    return p.select(
        "doc_id",
        F.coalesce(split(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
