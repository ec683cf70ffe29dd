"""Substring dedup: windows repeated at one length alone are extended to twice that length.

A window is ``2 * seed`` consecutive words of one document. Every word covered
by a window whose word sequence also starts in a document with a smaller id is
removed; windows are judged on the input, not on what is left.

Levels. A window can only repeat if the seeds (runs of ``seed`` words) inside it
do. Of the seeds of a window the one with the least hash stands for it, the
leftmost of equals: equal windows have equal seeds at the same place, so
nothing is lost, and neighbouring windows mostly share their seed. The windows
of one document around one seed are a *span*.

1. Length ``seed``: one row per span, (seed hash, hash of the words of the
   whole span). Seeds in one document only fall out here.
2. Between the levels: spans equal as a whole repeat with all their windows, so
   each distinct span needs one document to speak for it, that with the
   smallest id. For the others all windows of the span are repeats.
3. Length ``2 * seed``: the windows of those spans alone whose seed occurs in
   another document and in another span too are hashed one by one and compared.
   No window longer than asked for is, so no candidates are left.

Work in the last level follows the number of distinct spans around copies, not
the number of copies. Every grouping is a partial aggregate followed by a join of
two staged tables, which Spark may split: a passage that a third of all
documents share is a hot key to neither.

Equal sequences are found by 128-bit hashes (seeds, which only choose
candidates, by 64 bits).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallybayes.llm._util import NO_ID, Stage, Words, fresh, mix64, prepare, text_chunks

SEED = 25  # words; windows are twice as long
ROOM = 1 << 12  # windows of a span are fewer: (first window, further windows) pack into a long
_B = (np.uint64(0x9E3779B97F4A7C15 | 5), np.uint64(0xC2B2AE3D27D4EB4F))


def _inverse(b: np.uint64) -> np.uint64:
    return np.uint64(pow(int(b), -1, 2**64))


class Hashes:
    """Hashes of runs of words, from prefix sums of a polynomial over their hashes (modulo 2**64)."""

    def __init__(self, words: np.ndarray, k: int):
        n = len(words)
        power = np.full(n + 1, _B[k], np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        back = np.full(n + 1, _inverse(_B[k]), np.uint64)
        back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(words, k + 1) * power[:n], dtype=np.uint64)])
        self.salt = k

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words first..end-1; the length counts too."""
        h = (self.sums[end] - self.sums[first]) * self.back[first]
        return mix64(h ^ ((end - first).astype(np.uint64) << np.uint64(40)), self.salt + 7)


def _spans(w: Words, seed: int):
    """Spans of a run of texts: (text, first window, last window as word positions in the run, seed position)."""
    size, n = 2 * seed, len(w.start)
    if n < size:
        return None
    doc_end = np.repeat(w.offset[1:], np.diff(w.offset))
    starts = np.flatnonzero(np.arange(n) + size <= doc_end)
    if not len(starts):
        return None
    hashes = w.hashes()
    h0 = Hashes(hashes, 0)
    seeds = h0.of(np.arange(n - seed + 1), np.arange(seed, n + 1))
    at = np.empty(len(starts), np.int64)
    view = sliding_window_view(seeds, seed + 1)
    for i in range(0, len(starts), 1 << 16):  # bounds the copies that argmin makes
        s = starts[i : i + (1 << 16)]
        lo, hi = s[0], s[-1] + 1
        at[i : i + len(s)] = s + view[lo:hi].argmin(axis=1)[s - lo]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    s, e = starts[first], starts[last]
    return np.searchsorted(w.offset, s, side="right") - 1, s, e, seeds[at[first]], h0, hashes


def _span_rows(seed: int):
    """(id, t0, t1, text) rows to span rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, t0, t1 = (batch[c].to_numpy() for c in ("id", "t0", "t1"))
            for i, texts in text_chunks(batch["text"]):
                w = Words(texts)
                if (got := _spans(w, seed)) is None:
                    continue
                doc, s, e, seed_hash, h0, hashes = got
                end = e + 2 * seed
                h1 = Hashes(hashes, 1)
                yield pd.DataFrame(
                    {
                        "seed": seed_hash.view(np.int64),
                        "h0": h0.of(s, end).view(np.int64),
                        "h1": h1.of(s, end).view(np.int64),
                        "id": ids[i + doc],
                        "t0": t0[i + doc],
                        "t1": t1[i + doc],
                        "loc": (s - w.offset[doc]) * ROOM + (e - s),
                    }
                )

    return run


def _window_rows(seed: int):
    """(id, t0, t1, text, spans) rows to one row per window of the spans; equal texts of an id give theirs once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            keys = list(zip(batch["id"].tolist(), batch["t0"].tolist(), batch["t1"].tolist(), strict=True))
            new = [k not in seen and not seen.add(k) for k in keys]
            if not any(new):
                continue
            batch = batch[new]
            ids, spans = batch["id"].to_numpy(), batch["spans"].tolist()
            for i, texts in text_chunks(batch["text"]):
                w = Words(texts)
                hashes = w.hashes()
                own = [[(r["h0"], r["h1"], r["loc"]) for r in spans[i + k]] for k in range(len(texts))]
                count = np.array([len(o) for o in own])
                rows = np.array([r for o in own for r in o], np.int64).reshape(-1, 3)
                first = rows[:, 2] // ROOM + np.repeat(w.offset[:-1], count)
                more = rows[:, 2] % ROOM + 1
                at = np.repeat(np.arange(len(rows)), more)
                offset = np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more)
                s = first[at] + offset
                yield pd.DataFrame(
                    {
                        "w0": Hashes(hashes, 0).of(s, s + 2 * seed).view(np.int64),
                        "w1": Hashes(hashes, 1).of(s, s + 2 * seed).view(np.int64),
                        "id": np.repeat(ids[i : i + len(texts)], count)[at],
                        "h0": rows[at, 0],
                        "h1": rows[at, 1],
                        "offset": offset.astype(np.int32),
                    }
                )

    return run


def _ties(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def repeats(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(id, t0, t1, spans): for documents with repeated words, the spans that cover them.

    ``spans`` is an array of (loc, mask): loc packs the first window and the
    number of further ones; ``mask`` lists the windows (offsets) that repeat,
    null for all of them.
    """
    spark = docs.sparkSession
    prepare(spark)
    stage = Stage(spark, "substring")
    # 128 bits tell texts apart that have one id, as all without an id do
    t0, t1 = _ties(F.col("text"))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), t0.alias("t0"), t1.alias("t1"), "text")
    own_text = ["id", "t0", "t1"]
    schema = "seed long, h0 long, h1 long, id long, t0 long, t1 long, loc long"
    spans = stage.table(texts.mapInPandas(_span_rows(seed), schema))

    # level 1: distinct spans, and the seeds that occur in two documents
    distinct = spans.groupBy("h0", "h1").agg(
        F.min("seed").alias("seed"), F.min(F.struct(*own_text, "loc")).alias("first"), F.max("id").alias("last")
    )
    distinct = stage.table(distinct)
    seeds = distinct.groupBy("seed").agg(
        F.count("*").alias("spans"), F.min("first.id").alias("low"), F.max("last").alias("high")
    )
    seeds = stage.table(seeds.filter("low < high").select("seed", "spans"))
    alive = stage.table(distinct.join(seeds, "seed").select("h0", "h1", "first", "last", "spans"))
    stage.drop(distinct, seeds)

    # the rows of what is left: repeats as a whole, or with the document that speaks for its span
    own = alive.select("h0", "h1", F.col("first.id").alias("low"), "spans")
    rows = spans.select("h0", "h1", *own_text, "loc").join(own, ["h0", "h1"])
    rows = stage.table(rows.filter("id > low or spans > 1"))
    stage.drop(spans)

    # level 2: windows of the spans whose seed has another span too
    speak = alive.filter("spans > 1").select("h0", "h1", "first.*")
    speak = speak.groupBy(*own_text).agg(F.collect_list(F.struct("h0", "h1", "loc")).alias("spans"))
    speak = stage.table(speak)
    windows = texts.join(speak.hint("shuffle_hash"), own_text)
    windows = windows.mapInPandas(_window_rows(seed), "w0 long, w1 long, id long, h0 long, h1 long, offset int")
    windows = stage.table(windows)
    again = windows.groupBy("w0", "w1").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    again = stage.table(again.filter("low < high").drop("high"))
    hits = windows.join(again, ["w0", "w1"]).filter("id > low")
    hits = hits.groupBy("h0", "h1").agg(F.collect_set("offset").alias("mask"))
    hits = stage.table(hits)
    stage.drop(windows, again, alive)

    whole = rows.filter("id > low").select(*own_text, "loc", F.lit(None).cast("array<int>").alias("mask"))
    part = rows.filter("id = low").select("h0", "h1", *own_text, "loc").join(hits, ["h0", "h1"])
    marks = whole.unionByName(part.select(*own_text, "loc", "mask"))
    # a set: rows equal in id and text have the same spans, however many they are
    marks = stage.table(marks.groupBy(*own_text).agg(F.collect_set(F.struct("loc", "mask")).alias("spans")))
    stage.drop(rows, speak, hits)
    return marks


RESULT = StructType(
    [StructField("n_words", IntegerType()), StructField("n_removed", IntegerType()), StructField("kept", StringType())]
)


def _keep(text: Column, spans: Column, seed: int) -> Column:
    """Struct (n_words, n_removed, kept words joined by one space)."""

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series, marks: pd.Series) -> pd.DataFrame:
        total, removed, kept = [], [], []
        marks = marks.tolist()
        for i, chunk in text_chunks(texts):
            w = Words(chunk)
            for k in range(len(chunk)):
                a, b = w.offset[k], w.offset[k + 1]
                n = int(b - a)
                drop = _covered(n, marks[i + k], 2 * seed)
                total.append(n)
                removed.append(int(drop.sum()))
                words = chunk[k].split()
                if removed[-1]:
                    words = [words[j] for j in np.flatnonzero(~drop).tolist()]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pd.DataFrame({"n_words": total, "n_removed": removed, "kept": kept})

    return run(text, spans)


def _covered(n: int, marks, size: int) -> np.ndarray:
    """Which of n words the marked windows cover."""
    edge = np.zeros(n + 1, np.int64)
    for m in marks if marks is not None else ():
        first, more = divmod(int(m["loc"]), ROOM)
        if m["mask"] is None:
            edge[first] += 1
            edge[first + more + size] -= 1
        else:
            s = first + np.asarray(m["mask"], np.int64)
            np.add.at(edge, s, 1)
            np.add.at(edge, s + size, -1)
    return np.cumsum(edge[:-1]) > 0


def dedup(docs: DataFrame, seed: int = SEED) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (n_words, n_removed, kept); its name comes second.

    Null and empty texts have no words and keep the empty text. A null id is
    larger than any other: such a document gives way to all others, and to
    none without an id. Documents that share an id never take from each other.
    Rows equal in id and text have equal results. Other columns pass through,
    whatever they are called. Texts of fewer than ``2 * seed`` words are kept.
    """
    i, t, u, s, out = fresh(docs, "sub_id", "sub_tie", "sub_tie2", "sub_spans", "sub_result")
    marks = repeats(docs, seed).select(*[F.col(c).alias(a) for c, a in (("id", i), ("t0", t), ("t1", u), ("spans", s))])
    own = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), *_ties(F.col("text"))]
    rows = docs.withColumns({f"{c}_": x for c, x in zip((i, t, u), own, strict=True)})
    same = (F.col(i + "_") == F.col(i)) & (F.col(t + "_") == F.col(t)) & (F.col(u + "_") == F.col(u))
    rows = rows.join(marks.hint("shuffle_hash"), same, "left")
    rows = rows.withColumn(out, _keep(F.col("text"), F.col(s), seed))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], out), out
