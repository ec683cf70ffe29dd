"""Embedding near-dedup: spherical-cap filters from a structured random product code.

Two unit vectors with a high cosine mostly exceed the same filter directions
(Becker, Ducas, Gama, Laarhoven, "New directions in nearest neighbor searching
with applications to lattice sieving"). A direction is a concatenation of one
random code word per block of coordinates (after a random rotation), so a
vector's inner products with all directions are sums of one number per block,
and the list of those that exceed the cap height is decoded block by block,
never by trying every direction.

The number of directions grows with the number of distinct vectors, so the
expected bucket does not; the list length follows from the wanted recall at the
threshold cosine. A vector that too few directions exceed takes its best ones.

Equal vectors of a label are one class first. Vectors that share label and
filter meet in one bucket, where cosines in double precision decide. A pair
counts in the smallest filter that both are in, so links are counted once;
tasks give counts and a spanning star of each cluster, never pairs. A bucket of
more than ``PART`` classes is cut into parts that meet two by two: every pair
of a bucket is compared, and a task holds two parts at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.llm._components import components
from tallybayes.llm._util import Stage, prepare

PART = 2048
BUCKET = 4  # expected classes in a filter, over all labels
MAX_WORDS = 1024  # code words of a block; more directions take another block
LEAST = 8  # filters that every vector is in at least
SEED = 99


def cap_height(d: int, p: float) -> float:
    """The height above which a share ``p`` of the unit sphere in ``d`` dimensions lies."""
    if d < 2:
        return 0.0
    x = np.cos(np.linspace(0, np.pi, 200_001))  # from 1 down to -1, dense at the ends
    weight = np.maximum(1 - x * x, 0) ** ((d - 3) / 2) if d > 2 else 1 / np.sqrt(np.maximum(1 - x * x, 1e-12))
    area = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2 * -np.diff(x))])
    return float(np.interp(p, area / area[-1], x))


def shape(n: int, d: int, cosine: float, miss: float = 1e-3) -> tuple[int, int, float]:
    """(blocks, code words per block, cap height) for ``n`` classes and a miss rate at the threshold."""
    t = 16.0
    for _ in range(4):
        filters = max(64.0, t * n / BUCKET)
        height = cap_height(d, min(0.5, t / filters))
        # a vector just above the height in one direction: chance that its neighbour is above too
        a = height * math.sqrt(d)
        z = (a - cosine * (a + 1 / max(a, 1.0))) / math.sqrt(1 - cosine**2)
        q = min(0.999, max(0.01, 0.5 * math.erfc(z / math.sqrt(2))))
        t = max(8.0, math.log(miss) / math.log(1 - q))
    filters = max(64.0, t * n / BUCKET)
    blocks = 2
    while filters ** (1 / blocks) > MAX_WORDS and blocks < d:
        blocks += 1
    blocks = min(blocks, d)
    words = max(2, math.ceil(filters ** (1 / blocks)))
    return blocks, words, cap_height(d, min(0.5, t / words**blocks))


@lru_cache(maxsize=4)
def code(d: int, blocks: int, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation and the code words of each block, the same on every machine."""
    rng = np.random.default_rng([SEED, d, blocks, words])
    turn, _ = np.linalg.qr(rng.normal(size=(d, d)))
    cuts = [d * i // blocks for i in range(blocks + 1)]
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        c = rng.normal(size=(b - a, words))
        out.append(c / np.linalg.norm(c, axis=0) * math.sqrt((b - a) / d))
    return turn, out


def decode(unit: np.ndarray, blocks: int, words: int, height: float) -> list[np.ndarray]:
    """Sorted filters of each row: all directions exceeding ``height``, the best ``LEAST`` if fewer."""
    d = unit.shape[1]
    turn, codes = code(d, blocks, words)
    v = unit @ turn
    cuts = [d * i // blocks for i in range(blocks + 1)]
    score = [v[:, a:b] @ c for (a, b), c in zip(zip(cuts, cuts[1:], strict=False), codes, strict=True)]
    best = np.stack([s.max(axis=1) for s in score])
    out = []
    for r in range(len(v)):
        total = best[:, r].sum()
        least, step = height, 0.02
        while True:
            # a prefix of blocks lives if the best of the others could lift it over the height
            ids, sums, rest = np.zeros(1, np.int64), np.zeros(1), total
            for k in range(blocks):
                rest -= best[k, r]
                s = score[k][r]
                pick = np.flatnonzero(s >= least - (sums.max() + rest))
                both = sums[:, None] + s[pick]
                at, to = np.nonzero(both >= least - rest)
                ids, sums = ids[at] * words + pick[to], both[at, to]
                if not len(ids):
                    break
            if len(ids) >= LEAST or least < -1:
                break
            least = min(least, total) - step
            step *= 2
        if least < height:
            ids = ids[np.argsort(-sums, kind="stable")[: max(LEAST, int((sums >= height).sum()))]]
        out.append(np.sort(ids))
    return out


def usable(vector: Column) -> Column:
    """A vector that can link: not null, no null or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(~bad & some, F.lit(False))


def _unit(vectors) -> np.ndarray:
    v = np.stack([np.asarray(x, np.float64) for x in vectors])
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _decoded(n: int, cosine: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, rows in batch.groupby("dim"):
                blocks, words, height = shape(n, int(d), cosine)
                lists = decode(_unit(rows["vector"]), blocks, words, height)
                yield pd.DataFrame({"cid": rows["cid"].to_numpy(), "filters": pd.Series(lists, dtype=object)})

    return run


def _clusters(near: np.ndarray) -> np.ndarray:
    """Least index reachable in a symmetric boolean matrix."""
    label = np.arange(len(near))
    at, to = np.nonzero(near)
    while True:
        new = label.copy()
        np.minimum.at(new, at, label[to])
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _linked(cosine: float, f: int, t: int, q: int, unit, part, lists, cid, copies):
    """One bucket (or two parts of it): (class, its links to others that count here), (class, head of its cluster)."""
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    if t != q:
        near &= part[:, None] != part
    if not near.any():
        return None
    # pairs that share a smaller filter count there
    smaller = [x[x < f] for x in map(np.asarray, lists)]
    known = np.unique(np.concatenate(smaller))
    counted = near
    if len(known):
        has = np.zeros((len(cid), len(known)), np.float32)
        for i, s in enumerate(smaller):
            has[i, np.searchsorted(known, s)] = 1
        counted = near & (has @ has.T == 0)
    links = counted @ copies
    some = np.flatnonzero(links)
    label = _clusters(near)
    star = np.flatnonzero(label != np.arange(len(cid)))
    return (cid[some], links[some]), (cid[star], cid[label[star]])


def _verified(cosine: float):
    """Rows of one (label, dim, filter, t, q) after the other to link counts and stars."""
    key = ["label", "dim", "filter", "t", "q"]

    def found(bucket: tuple, cols: list) -> list:
        _, _, f, t, q = bucket
        got = _linked(cosine, int(f), int(t), int(q), *cols)
        return [] if got is None else [got]

    def rows_of(got: list) -> pd.DataFrame:
        n = sum(len(a) for (a, _), _ in got)
        m = sum(len(a) for _, (a, _) in got)
        parts = [np.concatenate([g[i][j] for g in got]) for i in (0, 1) for j in (0, 1)]
        return pd.DataFrame(
            {
                "a": np.concatenate([parts[0], parts[2]]),
                "b": np.concatenate([np.full(n, -1), parts[3]]),
                "links": np.concatenate([parts[1], np.zeros(m, np.int64)]),
            }
        ).astype("int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []  # the bucket that the last batch ended in, and its rows so far
        for batch in batches:
            if batch.empty:
                continue
            keys = [batch[k].to_numpy() for k in key]
            new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(batch)]
            lists, cid, copies, part = (batch[c].to_numpy() for c in ("filters", "cid", "n", "part"))
            same = len(set(keys[1].tolist())) == 1
            unit = _unit(batch["vector"]) if same else None
            out = []
            for a, z in zip(cuts, cuts[1:], strict=False):
                bucket = tuple(k[a] for k in keys)
                u = unit[a:z] if same else _unit(batch["vector"].iloc[a:z])
                cols = [u, part[a:z], lists[a:z], cid[a:z], copies[a:z]]
                if bucket == now:
                    held.append(cols)
                    continue
                if held:
                    out += found(now, [np.concatenate(c) for c in zip(*held, strict=True)])
                now, held = bucket, [cols]
            if out:
                yield rows_of(out)
        if held and (got := found(now, [np.concatenate(c) for c in zip(*held, strict=True)])):
            yield rows_of(got)

    return run


def near_duplicates(rows: DataFrame, cosine: float = 0.93, vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept): a row for each row of ``rows`` (vec_id, label, vector).

    Vectors link when labels are equal and not null, lengths are equal and the
    cosine reaches ``cosine``. Vectors that are null, empty or zero or hold
    null or non-finite components, and rows without a label, link with
    nothing and stand alone. Repeated rows are vectors of their own and link
    with each other. Null ids come last: a component without any id has a null
    ``component_id``. ``kept`` compares nulls as equal. The index is
    probabilistic: no pair below the threshold is linked, and a pair at it is
    missed about once in a thousand. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    prepare(spark)
    stage = Stage(spark, "embedding-dedup")
    v = F.col(vector)
    ok = usable(v) & F.col("label").isNotNull()
    rows = rows.select("vec_id", F.col("label").cast("string").alias("label"), v.alias("vector"), ok.alias("ok"))
    rows = rows.withColumn("h", F.xxhash64("label", "vector"))
    classes = rows.filter("ok").groupBy("label", "h", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    classes = classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("vector"))
    classes = stage.table(classes)  # numbers are fixed once written
    n = classes.count()

    lists = classes.select("cid", "dim", "vector").mapInPandas(_decoded(n, cosine), "cid long, filters array<long>")
    lists = stage.table(lists)
    keys = lists.join(classes.select("cid", "label", "dim"), "cid").select("cid", "label", "dim", F.explode("filters").alias("filter"))
    keys = stage.table(keys)
    at = ["label", "dim", "filter"]
    sizes = stage.table(keys.groupBy(*at).agg(F.count("*").alias("size")).filter("size > 1"))
    met = stage.table(keys.join(sizes, at))
    parts = F.ceil(F.col("size") / F.lit(PART)).cast("int")
    part = F.when(parts > 1, F.pmod(F.xxhash64("cid", "filter"), parts)).otherwise(0).cast("int")
    met = met.withColumn("parts", parts).withColumn("part", part)
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.struct(F.least("part", o).alias("t"), F.greatest("part", o).alias("q")),
    )
    met = met.select("cid", *at, "part", F.explode(pairs).alias("p")).select("cid", *at, "part", "p.t", "p.q")
    full = lists.join(classes.select("cid", "vector", "n"), "cid")
    # comparing costs more than its bytes show: not to be coalesced by size
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = met.join(full, "cid").repartition(tasks, *at, "t", "q").sortWithinPartitions(*at, "t", "q")
    found = stage.table(met.mapInPandas(_verified(cosine), "a long, b long, links long"))

    links = found.filter("links > 0").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("others"))
    roots = components(found.filter("b >= 0").select("a", "b"), stage).withColumnRenamed("node", "cid")
    classes = classes.join(links, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    classes = stage.table(classes.select("label", "h", "vector", "root", "first", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    heads = stage.table(classes.groupBy("root").agg(F.min("first").alias("component_id")))
    table = stage.table(classes.join(heads, "root").drop("root", "first").withColumn("in_class", F.lit(True)))
    out = rows.join(table, ["label", "h", "vector"], "left")
    alone = F.col("in_class").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
