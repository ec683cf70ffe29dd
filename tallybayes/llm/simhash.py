"""SimHash near-dedup: 64-bit fingerprints, BK-trees over shards, components.

Fingerprints are made on the executors and grouped: from there on each distinct
value is one row, however many documents share it.

Two values that differ in at most ``radius`` bits agree in one at least of
``radius + 1`` blocks of bits, so a shard holds the values with one block in
common and every link lies inside some shard. Within a shard a BK-tree finds
the links: a node's children are keyed by their Hamming distance to it, and a
search for a value at distance d from a node follows only edges d - radius to
d + radius.

A shard of more than ``SHARD`` values is dealt anew by finer blocks (twice as
many, ``radius`` of them left out, in every way); what is still larger is cut
into parts, and the tree of each part is sent to the parts that search it. So a
group in a task is at most two parts, and nothing is left out. Trees travel
as rows to the tasks that search them, not as one variable: all of them
together grow with the input, and only a shard has a proven size.

A task gives a spanning star for each cluster in its shard, not every pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.llm._components import components
from tallybayes.llm._util import NO_ID, Stage, fresh, prepare

SHARD = 4096
BLOCK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of a text as a signed 64-bit integer.

    A-Z lowered; shingles of ``words`` words, repeats included, joined by one
    space (a shorter text: all its words; no words: zero). A bit is set if it
    is in more than half of the shingles' hashes.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if not n:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if n <= words:
        hashes = [digest(joined, seed)]
    else:
        length = np.fromiter(map(len, parts), np.int64, n)
        end = np.cumsum(length + 1) - 1
        first, last = (end - length)[: n - words + 1].tolist(), end[words - 1 :].tolist()
        hashes = [digest(joined[a:b], seed) for a, b in zip(first, last, strict=True)]
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        h = np.array(hashes[i : i + BLOCK], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    """SimHash of each whole text of a column, as a long."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return run(text)


class BKTree:
    """Values keyed under their parent by Hamming distance to it."""

    def __init__(self):
        self.value: list[int] = []
        self.child: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.value.append(value)
        self.child.append({})
        at, new = 0, len(self.value) - 1
        while at != new:
            d = (self.value[at] ^ value).bit_count()
            at = self.child[at].setdefault(d, new)

    def near(self, value: int, radius: int) -> list[int]:
        """Positions of the values within ``radius`` bits."""
        found, todo = [], [0] if self.value else []
        while todo:
            at = todo.pop()
            d = (self.value[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            edges = self.child[at]
            if len(edges) > 2 * radius + 1:
                todo += [edges[e] for e in range(d - radius, d + radius + 1) if e in edges]
            else:
                todo += [to for e, to in edges.items() if -radius <= e - d <= radius]
        return found


def _links(values: list[int], tree: list[bool], search: list[bool], radius: int) -> list[tuple[int, int]]:
    """A spanning star of each cluster that the links between searched and tree values make."""
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    bk, place = BKTree(), []
    whole = all(tree) and all(search)
    for i, v in enumerate(values):
        if whole:  # every value searches those before it
            for j in bk.near(v, radius):
                a, b = find(i), find(place[j])
                root[max(a, b)] = min(a, b)
        if tree[i]:
            bk.add(v)
            place.append(i)
    if not whole:
        for i, v in enumerate(values):
            if search[i]:
                for j in bk.near(v, radius):
                    a, b = find(i), find(place[j])
                    root[max(a, b)] = min(a, b)
    return [(v, values[find(i)]) for i, v in enumerate(values) if find(i) != i]


def _search(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        now = None

        def done() -> pd.DataFrame:
            g = pd.concat(held) if len(held) > 1 else held[0]
            mask = 2**64 - 1
            out = _links([x & mask for x in g["fp"].tolist()], g["tree"].tolist(), g["search"].tolist(), radius)
            return pd.DataFrame(out, columns=["a", "b"], dtype="uint64").astype("int64")

        for batch in batches:
            if batch.empty:
                continue
            keys = batch[["key", "t", "q"]].to_numpy()
            edge = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            rows = []
            for a, b in zip([0, *edge], [*edge, len(batch)], strict=True):
                key = tuple(keys[a])
                if now is not None and key != now:
                    rows.append(done())
                    held = []
                now = key
                held.append(batch.iloc[a:b])
            if rows:
                yield pd.concat(rows)
        if held:
            yield done()

    return run


def _masks(blocks: int, keep: int) -> list[int]:
    """All unions of ``keep`` of the ``blocks`` blocks of 64 bits, as signed integers."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    unions = [sum(c) for c in combinations(block, keep)]
    return [u - 2**64 if u >= 2**63 else u for u in unions]


def _keyed(values: DataFrame, masks: list[int]) -> DataFrame:
    """(key, fp): each value under the hash of its bits in each mask. Equal hashes of other bits only cost a search."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    return values.select(F.explode(keys).alias("key"), "fp")


def _sized(keyed: DataFrame, stage: Stage) -> DataFrame:
    """(key, fp, n) for the keys that two values share at least."""
    sizes = stage.table(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    return stage.table(keyed.join(sizes, "key"))


def links(values: DataFrame, radius: int, stage: Stage, shard: int = SHARD) -> DataFrame:
    """(a, b): edges that connect all distinct ``values`` (fp) linked within ``radius`` bits, directly or not."""
    first = _sized(_keyed(values, _masks(radius + 1, 1)), stage)
    second = first.filter(F.col("n") > shard).select("fp").distinct()
    blocks = 2 * (radius + 1)
    second = _sized(_keyed(second, _masks(blocks, blocks - radius)), stage)
    rows = first.filter(F.col("n") <= shard).unionByName(second)
    parts = F.ceil(F.col("n") / F.lit(shard)).cast("int")
    part = F.when(parts > 1, F.pmod(F.xxhash64("fp", "key"), parts)).otherwise(0).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("part", part)
    # part p is the tree of pairs (p, q >= p) and searches those of (t <= p, p)
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.struct(F.least("part", o).alias("t"), F.greatest("part", o).alias("q")),
    )
    rows = rows.select("key", "fp", "part", F.explode(pairs).alias("p"))
    rows = rows.select(
        "key", "fp", F.col("p.t").alias("t"), F.col("p.q").alias("q"),
        (F.col("part") == F.col("p.t")).alias("tree"), (F.col("part") == F.col("p.q")).alias("search"),
    )
    # searching costs more than its bytes show: not to be coalesced by size
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "key", "t", "q").sortWithinPartitions("key", "t", "q")
    return rows.mapInPandas(_search(radius), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, tie, fp, component_id, kept): a row for each row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id``
    is the smallest doc_id reachable by links, its own included. ``kept`` marks
    the document that stands for the component: the one with that id and, if
    the id repeats, the smallest hash ``tie`` of its text. Null ids come last:
    a component without any id has a null ``component_id`` and keeps its
    document with the smallest ``tie``. Null and empty texts have fingerprint
    zero and are linked like any other. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    stage = Stage(spark, "simhash")
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), fingerprints(F.col("text"), words).alias("fp"))
    rows = stage.table(rows)
    place = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "tie")
    classes = stage.table(rows.groupBy("fp").agg(F.min(place).alias("first")))
    edges = stage.table(links(classes.select("fp"), radius, stage))
    roots = stage.table(components(edges, stage).withColumnRenamed("node", "fp"))
    classes = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = stage.table(classes)
    heads = stage.table(classes.groupBy("root").agg(F.min("first").alias("head")))
    table = stage.table(classes.join(heads, "root").select("fp", "head"))
    out = rows.join(table, "fp")
    return out.select(
        "doc_id", "tie", "fp",
        F.when(F.col("head.id") != NO_ID, F.col("head.id")).alias("component_id"),
        (place == F.col("head")).alias("kept"),
    )


def dedup(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One document of each component, columns as they were; of rows equal in id and text, one."""
    stage = Stage(docs.sparkSession, "simhash-kept")
    kept = near_duplicates(docs, words, radius).filter("kept").groupBy("doc_id", "tie").agg(F.count("*").alias("n"))
    kept = stage.table(kept)
    i, t, h = fresh(docs, "kept_id", "kept_tie", "kept_hash")
    repeats = kept.filter("n > 1").limit(1).count() > 0
    kept = kept.select(F.col("doc_id").alias(i), F.col("tie").alias(t))
    rows = docs.withColumn(h, F.xxhash64("text"))
    out = rows.join(kept.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(kept[i]) & (rows[h] == kept[t]))
    if repeats:
        out = out.dropDuplicates(["doc_id", h])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
