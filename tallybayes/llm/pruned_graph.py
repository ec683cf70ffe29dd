"""Approximate nearest neighbours: robust-pruned directed graphs, one a shard.

Equal vectors are one node (a class), dealt to shards of about ``SHARD`` nodes
by hash. Each shard is a directed graph (Subramanya et al., "DiskANN"):

* *Greedy searches propose neighbours.* Nodes are inserted in rounds that double
  up to ``ROUND``. A beam search of the graph so far, from the node nearest the
  centre, visits nodes near a new one: its candidates. The first pass takes the
  closest edges only, the second goes over all nodes again with longer ones.
* *Relaxed distance pruning keeps diverse edges.* Of the candidates the nearest is
  kept, and all that are ``ALPHA`` times nearer to it than to the node are
  dropped, and so on up to ``DEGREE`` edges. Edges are added the other way too; nodes
  with too many are pruned again.
* Nodes that no path reaches get an edge from the nearest node that one does, so
  each node can be found.

The graphs are a staged table, an index row per node. *Beam search queries each
shard*: a block of queries and a shard meet in a task, searches run
side by side as array operations, and each shard gives its ``k`` best rows, which
are merged by rank. A class gives its smallest ids alone, as no more of them can
be among the k nearest, so copies cost nothing. Scores are
distances of the original vectors in double precision; only the choice
of candidates is approximate. Each query visits about ``BEAM`` nodes of each
shard, so work is queries x rows / SHARD x BEAM x DEGREE distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.llm._util import Stage, prepare
from tallybayes.llm.embedding_dedup import usable

SHARD = 8192  # nodes of a graph
DEGREE = 32  # edges of a node
SLACK = 16  # further edges before it is pruned again
ALPHA = 1.2
BUILD = 64  # beam of the searches that propose neighbours
BEAM = 128  # beam of a query
ROUND = 512  # nodes inserted side by side
QUERIES = 65536  # queries of a block
SEED = 5


class Graph:
    """The vectors of a shard and the edges of each node (-1 for none)."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None):
        n = len(x)
        # a power of two as unit: no overflow in squares, and no rounding
        self.unit = 2.0 ** np.frexp(np.abs(x).max(initial=1.0))[1]
        self.x = x / self.unit
        self.sq = (self.x**2).sum(axis=1)
        self.start = int(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1).argmin()) if n else 0
        self.edges = np.full((n, DEGREE + SLACK), -1, np.int32) if edges is None else edges

    def gaps(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each row of q to its row of nodes (-1: infinite)."""
        v = self.x[nodes]
        out = self.sq[nodes] - 2 * np.einsum("bd,bcd->bc", q, v, optimize=True) + (q * q).sum(axis=1)[:, None]
        return np.where(nodes >= 0, out, np.inf)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each row of q, the nodes its beam search ends with and their squared distances, nearest first; -1 and inf fill up."""
        b, n = len(q), len(self.x)
        beam = min(beam, n)
        nodes = np.full((b, beam), -1, np.int32)
        gap = np.full((b, beam), np.inf)
        done = np.ones((b, beam), bool)  # nodes whose edges were followed, and free places
        nodes[:, 0], done[:, 0] = self.start, False
        gap[:, :1] = self.gaps(q, nodes[:, :1])
        seen = np.zeros((b, n), bool)
        seen[:, self.start] = True
        alive = np.arange(b)
        while len(alive):
            at = done[alive].argmin(axis=1)  # the nearest node not followed yet
            open_ = ~done[alive, at]
            alive, at = alive[open_], at[open_]
            if not len(alive):
                break
            done[alive, at] = True
            more = self.edges[nodes[alive, at]]
            fresh = (more >= 0) & ~seen[alive[:, None], more]
            more = np.where(fresh, more, -1)
            row, col = np.nonzero(fresh)
            seen[alive[row], more[row, col]] = True
            keep = np.flatnonzero(fresh.any(axis=0))
            if not len(keep):
                continue
            # the columns of fresh ones move to the left
            most = int(fresh.sum(axis=1).max())
            left = np.argsort(~fresh, axis=1, kind="stable")[:, :most]
            more = np.take_along_axis(more, left, axis=1)
            g = np.concatenate([gap[alive], self.gaps(q[alive], more)], axis=1)
            m = np.concatenate([nodes[alive], more], axis=1)
            f = np.concatenate([done[alive], more < 0], axis=1)
            order = np.argsort(g, axis=1, kind="stable")[:, :beam]
            gap[alive] = np.take_along_axis(g, order, axis=1)
            nodes[alive] = np.take_along_axis(m, order, axis=1)
            done[alive] = np.take_along_axis(f, order, axis=1)
        return nodes, gap

    def pruned(self, p: np.ndarray, nodes: np.ndarray, gap: np.ndarray, alpha: float) -> np.ndarray:
        """Edges of the nodes p out of candidates, nearest first (squared distances ``gap``, inf where none)."""
        v = self.x[nodes]
        sq = self.sq[nodes]
        between = sq[:, :, None] + sq[:, None, :] - 2 * v @ v.transpose(0, 2, 1)
        alive = np.isfinite(gap) & (nodes != p[:, None])
        out = np.full((len(p), self.edges.shape[1]), -1, np.int32)
        rows = np.arange(len(p))
        for k in range(DEGREE):
            best = np.where(alive, gap, np.inf).argmin(axis=1)
            some = alive[rows, best]
            if not some.any():
                break
            out[some, k] = nodes[rows, best][some]
            alive &= ~(alpha**2 * between[rows, best] <= gap)  # the chosen one goes too: its distance to itself is 0
            alive[rows, best] = False
        return out

    def _linked_back(self, p: np.ndarray, alpha: float) -> None:
        """For each edge of the nodes p the edge the other way; nodes with too many are pruned."""
        width = self.edges.shape[1]
        row, col = np.nonzero(self.edges[p] >= 0)
        to, source = self.edges[p[row], col], p[row].astype(np.int32)
        known = (self.edges[to] == source[:, None]).any(axis=1)
        to, source = to[~known], source[~known]
        if not len(to):
            return
        order = np.lexsort((source, to))
        to, source = to[order], source[order]
        q, first, count = np.unique(to, return_index=True, return_counts=True)
        slot = np.arange(len(to)) - np.repeat(first, count)
        have = (self.edges[q] >= 0).sum(axis=1)
        fits = have + count <= width
        ok = np.repeat(fits, count)
        self.edges[to[ok], np.repeat(have, count)[ok] + slot[ok]] = source[ok]
        full = np.flatnonzero(~fits)
        for a in range(0, len(full), 64):
            some = full[a : a + 64]
            most = int(count[some].max())
            cand = np.full((len(some), width + most), -1, np.int32)
            cand[:, :width] = self.edges[q[some]]
            for i, j in enumerate(some):
                cand[i, width : width + count[j]] = source[first[j] : first[j] + count[j]]
            gap = self.gaps(self.x[q[some]], cand)
            order = np.argsort(gap, axis=1, kind="stable")
            self.edges[q[some]] = self.pruned(
                q[some], np.take_along_axis(cand, order, axis=1), np.take_along_axis(gap, order, axis=1), alpha
            )

    def build(self) -> Graph:
        n = len(self.x)
        order = np.random.default_rng(SEED).permutation(n)
        order = np.concatenate([[self.start], order[order != self.start]]).astype(np.int64)
        for alpha in (1.0, ALPHA):
            at, size = (1, 1) if alpha == 1.0 else (0, ROUND)
            while at < n:
                p = order[at : at + size]
                self._insert(p, alpha)
                at, size = at + len(p), min(ROUND, 2 * size)
        self._reach_all()
        return self

    def _insert(self, p: np.ndarray, alpha: float) -> None:
        nodes, gap = self.search(self.x[p], BUILD)
        own = self.edges[p]
        nodes = np.concatenate([nodes, np.where((own[:, :, None] == nodes[:, None, :]).any(axis=2), -1, own)], axis=1)
        gap = np.concatenate([gap, self.gaps(self.x[p], nodes[:, gap.shape[1] :])], axis=1)
        order = np.argsort(gap, axis=1, kind="stable")
        nodes, gap = np.take_along_axis(nodes, order, axis=1), np.take_along_axis(gap, order, axis=1)
        for a in range(0, len(p), 64):
            s = slice(a, a + 64)
            self.edges[p[s]] = self.pruned(p[s], nodes[s], gap[s], alpha)
        self._linked_back(p, alpha)

    def _reach_all(self) -> None:
        """Edges from reached nodes to nodes that no path from the start reaches."""
        n = len(self.x)
        while n:
            seen, now = np.zeros(n, bool), np.array([self.start])
            seen[now] = True
            while len(now):
                to = np.unique(self.edges[now])
                now = to[to >= 0][~seen[to[to >= 0]]]
                seen[now] = True
            lost = np.flatnonzero(~seen)
            if not len(lost):
                return
            lost = lost[:ROUND]  # what these lead to is reached with them
            near, _ = self.search(self.x[lost], BUILD)
            free = np.full((n, 1), -1, np.int32)
            taken = set()
            for p, close in zip(lost.tolist(), near, strict=True):
                host = next((int(c) for c in close if c >= 0 and int(c) not in taken), None)
                if host is not None:
                    taken.add(host)
                    free[host] = p
            self.edges = np.concatenate([self.edges, free], axis=1)


def _floats(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _graph(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows of a shard with their places and edges."""
    rows = rows.sort_values(["h0", "h1"], kind="stable", ignore_index=True)  # the same graph whatever the order
    g = Graph(_floats(rows["vector"])).build()
    edges = [e[e >= 0] for e in g.edges]
    return rows.assign(place=np.arange(len(rows), dtype=np.int32), edges=pd.Series(edges, dtype=object))


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows in double precision, in a unit (a power of two) that keeps squares in range."""
    gap = q - x
    unit = 2.0 ** np.frexp(np.abs(gap).max(axis=1, initial=0))[1].astype(np.float64)
    unit = np.where(np.isfinite(unit), unit, 1.0)
    return np.sqrt(((gap / unit[:, None]) ** 2).sum(axis=1)) * unit


def _found(k: int, beam: int):
    names = ["query_id", "tie", "vec_id", "score"]

    def run(queries: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or nodes.empty:
            return pd.DataFrame(columns=names).astype({"query_id": "int64", "tie": "int64", "vec_id": "int64", "score": "float64"})
        nodes = nodes.sort_values("place", ignore_index=True)
        edges = np.full((len(nodes), max(1, max(map(len, nodes["edges"])))), -1, np.int32)
        for i, e in enumerate(nodes["edges"]):
            edges[i, : len(e)] = e
        x = _floats(nodes["vector"])
        g = Graph(x, edges)
        ids, size = np.concatenate(nodes["ids"].tolist()), nodes["ids"].map(len).to_numpy()
        first = np.cumsum(size) - size
        out = []
        for a in range(0, len(queries), ROUND):
            some = queries.iloc[a : a + ROUND]
            q = _floats(some["vector"])
            near, _ = g.search(np.clip(q / g.unit, -1e100, 1e100), max(beam, 2 * (k + 1)))
            at, col = np.nonzero(near >= 0)
            node = near[at, col]
            score = distances(q[at], x[node])
            # every class with its ids, but for the query's own
            row = np.repeat(np.arange(len(at)), size[node])
            member = np.arange(len(row)) - np.repeat(np.cumsum(size[node]) - size[node], size[node])
            vec, at, score = ids[np.repeat(first[node], size[node]) + member], at[row], score[row]
            own = some["vec_id"].to_numpy()[at] == vec
            vec, at, score = vec[~own], at[~own], score[~own]
            order = np.lexsort((vec, score, at))
            vec, at, score = vec[order], at[order], score[order]
            best = np.arange(len(at)) - np.searchsorted(at, at) < k
            out.append(
                pd.DataFrame(
                    {"query_id": some["vec_id"].to_numpy()[at[best]], "tie": some["tie"].to_numpy()[at[best]], "vec_id": vec[best], "score": score[best]}
                )
            )
        return pd.concat(out)[names]

    return run


def index(rows: DataFrame, stage: Stage, k: int = 10, vector: str = "embedding") -> DataFrame:
    """The staged graphs: (dim, shard, h0, h1, vector, ids, place, edges), a row per distinct vector.

    ``ids`` holds the ``k + 1`` smallest ids of the vector.
    """
    at = ["dim", "h0", "h1"]
    data = rows.filter(usable(F.col(vector)) & F.col("vec_id").isNotNull())
    data = data.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda c: c.cast("double") + 0.0).alias("vector"))
    data = data.select("vec_id", "vector", F.size("vector").alias("dim"), F.xxhash64("vector").alias("h0"), F.xxhash64(F.lit(1), "vector").alias("h1"))
    data = stage.table(data)
    # smallest ids in two steps, as a class may hold a third of all rows
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    few = data.select(*at, "vec_id", salt.alias("salt")).distinct()
    few = few.withColumn("r", F.row_number().over(Window.partitionBy(*at, "salt").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy(*at).orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    ids = few.groupBy(*at).agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = data.groupBy(*at).agg(F.first("vector").alias("vector")).join(ids, at)
    classes = stage.table(classes)
    sizes = {r["dim"]: -(-r["n"] // SHARD) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    shards = F.coalesce(*[F.when(F.col("dim") == d, F.lit(s)) for d, s in sizes.items()], F.lit(1))
    classes = classes.withColumn("shard", F.pmod("h1", shards).cast("int"))
    schema = "dim int, h0 long, h1 long, vector array<double>, ids array<long>, shard int, place int, edges array<int>"
    # a graph costs more than its bytes show: not to be coalesced by size
    classes = classes.repartition(max(_tasks(rows), sum(sizes.values())), "dim", "shard")
    return stage.table(classes.groupBy("dim", "shard").applyInPandas(_graph, schema))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def nearest(rows: DataFrame, is_query: Column, k: int = 10, beam: int = BEAM, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` nearest rows found, nearest first.

    ``rows`` has vec_id and the vector; ``is_query`` marks queries. Candidates
    are all rows with another vec_id and a vector of the same length; ``score`` is
    the Euclidean distance of the original vectors, ties go to the smaller vec_id, and a query with
    fewer than ``k`` candidates gets all. Vectors that are null, empty or zero or
    hold null or non-finite components, and rows without an id, take no part.
    Rows equal in id and vector count once; an id with several vectors is a
    candidate, and a query, for each. Extra columns, whatever they are called, are ignored;
    an empty table gives an empty result.
    """
    spark = rows.sparkSession
    prepare(spark)
    stage = Stage(spark, "pruned-graph")
    graphs = index(rows, stage, k, vector)
    asked = rows.filter(is_query & usable(F.col(vector)) & F.col("vec_id").isNotNull())
    asked = asked.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda c: c.cast("double") + 0.0).alias("vector"))
    asked = asked.withColumn("tie", F.xxhash64("vector")).withColumn("dim", F.size("vector")).distinct()
    asked = stage.table(asked)
    blocks = -(-asked.count() // QUERIES)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "tie"), F.lit(max(1, blocks))).cast("int"))
    shards = stage.table(graphs.select("dim", "shard").distinct())
    asked = asked.join(shards, "dim")
    nodes = graphs.select("dim", "shard", "vector", "ids", "place", "edges")
    nodes = nodes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(1, blocks) - 1))))
    by = ["dim", "shard", "block"]
    asked, nodes = (x.repartition(_tasks(rows), *by) for x in (asked, nodes))  # searches, too, cost more than their bytes
    found = asked.groupBy(*by).cogroup(nodes.groupBy(*by)).applyInPandas(_found(k, beam), "query_id long, tie long, vec_id long, score double")
    best = Window.partitionBy("query_id", "tie").orderBy("score", "vec_id")
    found = found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
