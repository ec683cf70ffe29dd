"""Periodic run detection: string synchronising sets at dyadic scales.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and a length of ``max(6, 4 * q)`` words at least, which no
neighbouring word extends keeping the period.

Scales (Kempa and Kociumaka, "String synchronizing sets"). A window of t words
has a hash; position i is *synchronising* at scale t if the least hash of the
windows that start at i to i + t is that at i or at i + t. That follows from the
2t words from i on alone, so equal contexts have their synchronising positions
at equal places, and every t neighbouring positions hold one, unless all that
starts there is highly periodic. Positions whose window lies in a run of period
t / 4 or less are left out of the choice, as their equal hashes would make all of
them synchronising.

Scale t finds the periods q with t <= q < 2t: the first t positions of such a run
hold a synchronising one, i, and i + q has the same context of 2t words, the next
place that has. So neighbours among equal contexts propose (i, q), which is
extended word by word to both sides. What a scale leaves out has a smaller period: the
highly periodic regions are found separately, periods 1 to 3 by comparing each
word with the one q before, larger ones at their own scales, which come first.

A stretch of 4q words is a run of one smallest period; its multiples give the
same stretch and are dropped. All steps are array operations over a few MiB of
text at a time, a text is never cut, and a scale only looks at texts of four
times its length, so the work is about n log n for n words. Nothing is shuffled.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tallybayes.llm._util import Words, mix64, text_chunks

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
SMALL = 3  # periods up to this are found by direct comparison; scales start above
_TURN = np.uint64(0x9FB21C651E98DF25)

RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
RESULT = StructType(
    [StructField("n_words", IntegerType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]
)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end index of each stretch of true values."""
    edge = np.flatnonzero(np.diff(same, prepend=False, append=False))
    return edge[::2], edge[1::2]


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes (b follows a)."""
    return mix64(a * _TURN ^ (b + (a >> np.uint64(29))))


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` neighbours, for every start that has them."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def _extended(words: np.ndarray, doc: np.ndarray, first, end, q, step: int):
    """Stretches [first, end) of positions x with words[x] = words[x + q], as far as they go to both sides."""
    first, end = first.copy(), end.copy()
    for side in (-1, 1):
        at = first - 1 if side < 0 else end
        alive = np.arange(len(at))
        while len(alive):
            x = at[alive, None] + side * np.arange(step)
            y = x + q[alive, None]
            inside = (x >= 0) & (y < len(words))
            x, y = np.where(inside, x, 0), np.where(inside, y, 0)
            own = doc[first[alive]][:, None]
            good = inside & (words[x] == words[y]) & (doc[x] == own) & (doc[y] == own)
            run = np.where(good.all(axis=1), step, good.argmin(axis=1))
            at[alive] += side * run
            alive = alive[run == step]
        if side < 0:
            first = at + 1
        else:
            end = at
    return first, end


def _proposed(words: np.ndarray, doc: np.ndarray, name: np.ndarray, t: int, skip: np.ndarray):
    """(i, q) with equal contexts of 2t words at i and i + q, t <= q < 2t; and the hashes of 2t words.

    ``name`` has the hashes of t words; ``skip`` marks positions left out of the choice.
    """
    none = np.zeros(0, np.int64)
    m = len(words) - 2 * t + 1
    if m <= 0:
        return none, none, None
    context = _join(name[:m], name[t : t + m])
    value = mix64(name, t)
    value[skip] = np.iinfo(np.uint64).max
    low = _least(value[: m + t], t + 1)  # over i to i + t, for i < m
    sync = ((value[:m] == low) | (value[t : t + m] == low)) & (low != np.iinfo(np.uint64).max)
    sync &= doc[:m] == doc[2 * t - 1 : 2 * t - 1 + m]  # contexts of one text only
    at = np.flatnonzero(sync)
    order = np.lexsort((at, context[at]))
    i, c = at[order], context[at][order]
    q = i[1:] - i[:-1]
    pair = (c[1:] == c[:-1]) & (q >= t) & (q < 2 * t)
    return i[:-1][pair], q[pair], context


def find(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in the words (hashes) of some texts; ``doc`` ascends and tells them apart."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # with start and end as word numbers
    size = np.bincount(doc, minlength=1) if len(doc) else np.zeros(1, np.int64)

    def keep(first, end, q):
        long = end - first >= (TIMES - 1) * q
        found.append((first[long], end[long] + q[long], q[long]))

    for q in range(1, SMALL + 1):
        if len(words) > q:
            a, b = _stretches((words[q:] == words[:-q]) & (doc[q:] == doc[:-q]))
            keep(a, b, np.full(len(a), q))

    here = np.arange(len(words))  # the words that are looked at, as numbers of all words
    name, t = words, 1
    while t <= SMALL and len(here):  # hashes of t words
        name = _join(name[:-t], name[t:]) if len(name) > t else name[:0]
        t *= 2
    while True:
        room = size[doc[here]] >= TIMES * t  # shorter texts have no period of t words or more
        if not room.any():
            break
        if not room.all():
            full = np.zeros(len(here), np.uint64)
            full[: len(name)] = name
            here, name = here[room], full[room]
            name = name[: max(0, len(here) - t + 1)]
        w, d = words[here], doc[here]
        edge = np.zeros(len(words) + 1, np.int64)
        for first, end, q in found:
            some = (q * TIMES <= t) & (end - first >= t)
            np.add.at(edge, first[some], 1)
            np.add.at(edge, end[some] - t + 1, -1)
        skip = (np.cumsum(edge[:-1]) > 0)[here][: len(name)]
        i, q, context = _proposed(w, d, name, t, skip)
        if len(i):
            # equal contexts say that words q apart agree from i to i + 2t; such stretches join
            order = np.lexsort((i, q))
            i, q = i[order], q[order]
            new = np.ones(len(i), bool)
            new[1:] = (q[1:] != q[:-1]) | (i[1:] > i[:-1] + 2 * t)
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(i)) - 1
            first, end = _extended(w, d, i[head], i[tail] + 2 * t, q[head], t)
            # numbers of texts that stay are consecutive within a text
            shift = here[first] - first
            keep(first + shift, end + shift, q[head])
        if context is None:
            break
        name, t = context, 2 * t

    first, end, q = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
    order = np.lexsort((q, end, first))
    first, end, q = first[order], end[order], q[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (end[1:] != end[:-1])  # multiples of a period give its stretch
    new &= end - first >= LEAST
    return first[new], end[new] - first[new], q[new]


def _texts(chunk: list[bytes]):
    """Of each text: words, (start, length, period) of its runs, the words that stay (None for all)."""
    w = Words(chunk)
    doc = w.doc_of()
    start, length, period = find(w.hashes(), doc)
    edge = np.zeros(len(doc) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    stays = np.cumsum(edge[:-1]) <= 0
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    cut = np.searchsorted(start, w.offset)
    for k in range(len(chunk)):
        a, b = w.offset[k], w.offset[k + 1]
        s = slice(cut[k], cut[k + 1])
        some = cut[k] < cut[k + 1]
        yield int(b - a), (start[s] - a, length[s], period[s]), stays[a:b] if some else None


def scan(text: Column) -> Column:
    """Struct (n_words, runs, collapsed) of a text column.

    ``runs`` is an array of (start, length, period), in words from 0, ordered by
    start, then period. ``collapsed`` joins by one space the words that no run
    contains after its first period. Null, empty and word-less texts have no
    words, no runs and the empty text. Runs never cross texts, a text is never
    cut, repeated rows have equal results; the other columns of a table, whatever
    they are called, are not touched, and an empty table gives an empty result.
    """

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        n_words, runs, out = [], [], []
        for _, chunk in text_chunks(texts):
            for data, (n, (s, length, q), stays) in zip(chunk, _texts(chunk), strict=True):
                words = data.split()
                if stays is not None:
                    words = [words[j] for j in np.flatnonzero(stays).tolist()]
                n_words.append(n)
                triples = zip(s.tolist(), length.tolist(), q.tolist(), strict=True)
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in triples])
                out.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pd.DataFrame({"n_words": n_words, "runs": runs, "collapsed": out})

    return run(text)


def best(runs: Column) -> Column:
    """The run of greatest length / period, ties to the smallest start, then period; null without one."""

    def better(a: Column, b: Column) -> Column:
        # runs come by start, then period: the first of equals stays
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def planted(text: Column, key: Column) -> Column:
    """The text with a periodic tail where crc32(key) is divisible by ten, joined by one space; else the text as it is.

    With h = crc32(key), g = h // 10 and n words: word i >= a becomes word
    a + (i - a) % p, for a = g % n and p = 1 + (n - a) // (3 + g % 8). A null key
    plants nothing.
    """

    @F.pandas_udf(StringType())
    def run(texts: pd.Series, hashes: pd.Series) -> pd.Series:
        out = []
        for t, h in zip(texts, hashes, strict=True):
            words = t.encode("utf-8", "surrogatepass").split() if t is not None else []
            n, g = len(words), int(h) // 10
            a = g % n if n else 0
            p = 1 + (n - a) // (3 + g % 8)
            tail = words[a : a + p] * (1 + n // p)
            out.append(b" ".join(words[:a] + tail[: n - a]).decode("utf-8", "surrogatepass"))
        return pd.Series(out, dtype=object)

    h = F.crc32(key.cast("string").cast("binary"))
    return F.when(h % 10 == 0, run(F.when(h % 10 == 0, text), F.coalesce(h, F.lit(1)))).otherwise(text)
