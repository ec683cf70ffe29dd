"""Exact top-k search: a Voronoi kNN join on integer inner products.

Data and queries are grouped by their nearest pivot (Lu et al., "Efficient
processing of k nearest neighbor joins using MapReduce"). A summary of each
cell (its largest distance to the pivot, the smallest ones of k + 1 ids, its
number of vectors) bounds inner products: for x at distance r from pivot p,
q.p - |q| r <= q.x <= q.p + |q| r. The smallest distances, without those of the
query's own id, give every query a score that its k-th best reaches at least.

Only what can matter is sent. A query goes to the cells whose upper bound
reaches that score, no others. Of a cell, a group of queries gets the vectors beyond
the group's bound: x can matter to q only if r >= (least - q.p) / |q|, and the
least of these over the group's queries is the group's. Groups are whole cells
of queries packed up to ``GROUP_BYTES``, so a vector is sent at most once for
each group, and there are as many groups as the queries fill memories. Small
neighbouring cells share a pack of about ``BLOCK`` vectors and large ones are cut into
blocks, so tasks are even and a hot cell is spread over as many as it needs. Block
results are merged by rank.

Where vectors have no clusters the bounds exclude nothing, and the plan is a search of
blocks by groups, each vector sent once a group: what brute force costs.

Pivots are a bounded sample, about the square root of the vectors up to ``PIVOTS``;
they decide the cost, not the result, which is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.llm._util import Stage, prepare

PIVOTS = 4096
GROUP_BYTES = 32 << 20  # vectors of the queries of a group
BLOCK = 4096


def floored(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as double arithmetic has it; null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), ints)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in vectors])


def _nearest(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, rows in batch.groupby("dim"):
                x, p = _matrix(rows["v"]).astype(np.float64), _pivots(pivots, int(d))
                gap = (x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)
                cell = gap.argmin(1)
                out = rows.copy()
                out["cell"] = cell
                out["dist"] = np.sqrt(((x - p[cell]) ** 2).sum(1))
                yield out

    return run


def _pivots(pivots: dict[int, np.ndarray], d: int) -> np.ndarray:
    """Pivots of a length; a length that the sample lacks has one cell around zero."""
    return pivots.get(d, np.zeros((1, d)))


def _needs(pivots: dict, summary: dict, group: dict, pack: dict, k: int):
    """Query rows to what they need: (kind 0, g, dim, cell, reach), and (kind 1, g, dim, pack, the query's place)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, rows in batch.groupby("dim"):
                d = int(d)
                cells, radius, near, whose = summary[d]
                q, p = _matrix(rows["v"]).astype(np.float64), _pivots(pivots, d)[cells]
                dot, norm = q @ p.T, np.sqrt((q * q).sum(1))[:, None]
                there = np.isfinite(near)  # 0 * inf is not a number
                low = dot[:, :, None] - norm[:, :, None] * np.where(there, near, 0)
                # rows with the query's id are no answers
                low[~there | (whose == rows["vec_id"].to_numpy()[:, None, None])] = -np.inf
                low = low.reshape(len(q), -1)
                at = max(low.shape[1] - k, 0)
                least = np.partition(low, at, axis=1)[:, at] if low.shape[1] >= k else np.full(len(q), -np.inf)
                slack = 1e-6 * (1 + norm[:, 0] * (np.abs(p).max(initial=0) + radius.max(initial=0)))
                least = (least - slack)[:, None]
                need = dot + norm * radius >= least
                # how far from its pivot a vector has to be at least
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where(norm > 0, (least - dot) / norm, -np.inf)
                deal = rows["deal"].to_numpy()
                own = [group[d, c] for c in rows["cell"].tolist()]
                g = np.array([o[0] for o in own]) + deal % np.array([o[1] for o in own])
                where = np.array([pack[d, c] for c in cells.tolist()])
                # per group the least reach of each cell
                i, j = np.nonzero(need)
                frame = pd.DataFrame({"g": g[i], "at": cells[j], "reach": reach[i, j]})
                frame = frame.groupby(["g", "at"], as_index=False)["reach"].min()
                counts = np.zeros(len(frame), np.int64)
                counts[:1] = len(i)  # the batch's query-cell pairs, once
                yield frame.assign(kind=0, dim=d, vec_id=0, tie=0, pairs=counts)[NEEDS]
                # each query with the packs that it needs
                pairs = np.unique(np.stack([i, where[j]], axis=1), axis=0)
                i = pairs[:, 0]
                yield pd.DataFrame(
                    {"g": g[i], "at": pairs[:, 1], "reach": 0.0, "kind": 1, "dim": d, "vec_id": rows["vec_id"].to_numpy()[i],
                     "tie": rows["tie"].to_numpy()[i], "pairs": 0}
                )[NEEDS]

    return run


NEEDS = ["kind", "g", "dim", "at", "reach", "vec_id", "tie", "pairs"]


def _dots(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where no sum can leave their integers."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _solve(k: int):
    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "tie", "vec_id", "score"]
        if queries.empty or data.empty:
            return pd.DataFrame(columns=names).astype("int64")
        x, ids = _matrix(data["v"]), data["vec_id"].to_numpy()
        out = []
        for a in range(0, len(queries), 512):
            some = queries.iloc[a : a + 512]
            s = _dots(_matrix(some["v"]), x)
            own = some["vec_id"].to_numpy()[:, None] == ids
            s[own] = np.iinfo(np.int64).min
            at = max(s.shape[1] - k, 0)
            kth = np.partition(s, at, axis=1)[:, at]
            i, j = np.nonzero((s >= kth[:, None]) & ~own)
            order = np.lexsort((ids[j], -s[i, j], i))
            i, j = i[order], j[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            i, j = i[rank < k], j[rank < k]
            out.append(
                pd.DataFrame(
                    {"query_id": some["vec_id"].to_numpy()[i], "tie": some["tie"].to_numpy()[i], "vec_id": ids[j], "score": s[i, j]}
                )
            )
        return pd.concat(out)[names]

    return run


def _pivot_count(n: int) -> int:
    return max(1, min(PIVOTS, math.isqrt(n)))


def top_k(rows: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", seen: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its ``k`` highest inner products.

    ``rows`` has vec_id and the vector; ``is_query`` marks queries. Candidates
    are all rows with another vec_id and a vector of the same length; ties go
    to the smaller vec_id, all rows if there are fewer than ``k``. Vectors that
    are null or hold null or non-finite components, and rows without an id,
    take no part. Rows that repeat an id with another vector are candidates,
    and queries, of their own; equal rows are one query. An empty table gives
    an empty result. Extra columns are ignored. Scores must fit 64 bits.

    ``seen`` takes figures of the plan (a job each): query-cell pairs that exist and that are
    needed, vectors times groups and vectors sent.
    """
    spark = rows.sparkSession
    prepare(spark)
    stage = Stage(spark, "exact-knn")
    data = rows.select(F.col("vec_id").cast("long").alias("vec_id"), floored(F.col(vector)).alias("v"), is_query.alias("query"))
    data = data.filter("vec_id is not null and v is not null").withColumn("dim", F.size("v"))
    raw = stage.table(data.withColumn("tie", F.xxhash64("v").bitwiseAND(F.lit(2**62 - 1))))
    n = raw.count()
    m = _pivot_count(n)
    sample = raw.orderBy(F.xxhash64("vec_id"), "vec_id", "tie").limit(m).select("dim", "v").collect()  # bounded
    pivots: dict[int, np.ndarray] = {}
    for d in {r["dim"] for r in sample}:
        pivots[d] = np.unique(_matrix([r["v"] for r in sample if r["dim"] == d]), axis=0).astype(np.float64)
    schema = "vec_id long, v array<long>, query boolean, dim int, tie long, cell long, dist double"
    data = stage.table(raw.mapInPandas(_nearest(pivots), schema))
    stage.drop(raw)

    # summaries: one row a cell, at most PIVOTS cells (and one for each other length)
    first = Window.partitionBy("dim", "cell").orderBy("dist", "vec_id")
    least = data.groupBy("dim", "cell", "vec_id").agg(F.min("dist").alias("dist"))
    least = least.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    least = least.groupBy("dim", "cell").agg(F.collect_list(F.struct("dist", "vec_id")).alias("near"))
    cells = data.groupBy("dim", "cell").agg(
        F.max("dist").alias("radius"), F.count("*").alias("n"), F.count(F.when(F.col("query"), 1)).alias("queries")
    )
    got = sorted(cells.join(least, ["dim", "cell"]).collect(), key=lambda r: (r["dim"], r["cell"]))
    if not got:
        return data.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    summary, group, pack, blocks = {}, {}, {}, {}
    for d in {r["dim"] for r in got}:
        own = [r for r in got if r["dim"] == d]
        near, whose = np.full((len(own), k + 1), np.inf), np.zeros((len(own), k + 1), np.int64)
        for i, r in enumerate(own):
            near[i, : len(r["near"])] = [x["dist"] for x in r["near"]]
            whose[i, : len(r["near"])] = [x["vec_id"] for x in r["near"]]
        summary[d] = (np.array([r["cell"] for r in own]), np.array([r["radius"] for r in own]), near, whose)
    g, full, p, inside = -1, True, -1, None
    for r in got:
        # whole cells to a group; a cell of many queries takes several
        room = max(1, GROUP_BYTES // (8 * max(1, r["dim"])))
        pieces = max(1, -(-r["queries"] // room))
        if full or pieces > 1 or used + r["queries"] > room:
            g, used = g + 1, 0
        group[r["dim"], r["cell"]] = (g, pieces)
        g, used, full = g + pieces - 1, used + r["queries"], pieces > 1
        # small cells to a pack; a large one is cut into blocks
        if inside is None or inside[0] != r["dim"] or inside[1] + r["n"] > BLOCK:
            p, inside = p + 1, [r["dim"], 0]
        inside[1] += r["n"]
        pack[r["dim"], r["cell"]] = p
        blocks[p] = -(-inside[1] // BLOCK)

    queries = data.filter("query").select("vec_id", "v", "dim", "tie", "cell").distinct()
    # non-negative; deals the queries of a large cell, those of equal vectors too
    queries = stage.table(queries.withColumn("deal", F.xxhash64("vec_id", "tie").bitwiseAND(F.lit(2**62 - 1))))
    schema = "kind int, g long, dim int, at long, reach double, vec_id long, tie long, pairs long"
    needs = stage.table(queries.mapInPandas(_needs(pivots, summary, group, pack, k), schema))
    reach = stage.table(needs.filter("kind = 0").groupBy("g", "dim", F.col("at").alias("cell")).agg(F.min("reach").alias("reach")))
    place = [(d, c, p, blocks[p]) for (d, c), p in pack.items()]
    place = spark.createDataFrame(place, "dim int, cell long, pack long, blocks int")  # a row a cell

    by = ["g", "dim", "pack", "block"]
    asked = needs.filter("kind = 1").select("g", "dim", F.col("at").alias("pack"), "vec_id", "tie")
    asked = asked.join(queries.select("vec_id", "tie", "dim", "v"), ["vec_id", "tie", "dim"])
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    left = asked.join(place.select("dim", "pack", "blocks").distinct(), ["dim", "pack"]).select(*by[:-1], "vec_id", "tie", "v", every)
    # rows at their pivot (distance 0) keep clear of rounding by the slack in reach
    sent = data.join(reach, ["dim", "cell"]).filter("dist >= reach").join(place, ["dim", "cell"])
    sent = sent.withColumn("block", F.pmod(F.xxhash64("vec_id", "tie"), "blocks").cast("int")).select(*by, "vec_id", "v")
    if seen is not None:
        groups = 1 + max(a + b - 1 for a, b in group.values())
        seen["pairs"] = queries.join(place.groupBy("dim").agg(F.count("*").alias("c")), "dim").agg(F.sum("c")).first()[0] or 0
        seen["needed"] = needs.agg(F.sum(F.col("pairs"))).first()[0] or 0
        seen["rows"], seen["sent"] = n * groups, sent.count()
    some = left.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(_solve(k), "query_id long, tie long, vec_id long, score long")
    best = Window.partitionBy("query_id", "tie").orderBy(F.col("score").desc(), "vec_id")
    some = some.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return some.select("query_id", "rank", "vec_id", "score")
