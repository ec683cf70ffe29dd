from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallybayes.llm import mixing


def fill(sizes: dict, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0) -> dict:
    """Water filling in rounds: share, stop at the limit, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level >= most * sizes[s]}
        if not over:
            return out | {s: w[s] * level for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_rounds_of_sharing(spark, seed):
    rng = random.Random(seed)
    names = rng.sample(["a", "B", "é", "zz", "10", "9", "", "😀", None], rng.randrange(1, 9))
    sizes = {s: rng.choice([0, 1, 7, rng.randrange(10_000)]) for s in names}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()] * 2, "source string, size long")
    got = {r["source"]: (r["source_size"], r["target"]) for r in mixing.targets(df).collect()}
    want = fill({s: 2 * n for s, n in sizes.items()})
    assert set(got) == set(want)
    for s, (size, target) in got.items():
        assert size == 2 * sizes[s] and target == pytest.approx(want[s], rel=1e-9, abs=1e-9)


def rows(seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(300):
        source = rng.choice(["hot"] * 5 + ["b", "c", None])
        out.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 20, rng.randrange(60)])), source))
    return out + [(7, "again w w", "b"), (None, None, "c"), (None, "x y", None), (5000, "", "empty only")]


def test_mix_takes_whole_epochs_then_the_first_by_key(spark, make_docs):
    data = rows()
    docs = make_docs(data).withColumn("mix_id", F.lit(1)).withColumn("budget", F.lit(2)).withColumn("key", F.lit(3))
    weights = spark.createDataFrame([(i, 4.0 if i % 2 else 0.0) for i in range(0, 300, 3)], "doc_id long, weight double")
    w = {i: 4.0 for i in range(0, 300, 3) if i % 2}
    got = mixing.mix(docs, weights).collect()
    assert len(got) == len(data)
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += len((t or "").split())
    want = fill(dict(sizes))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 2
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, target in want.items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1e-6, s
    # within a source, no document with a later key is taken more often
    for s in want:
        keyed = []
        for r in got:
            if r["source"] == s and r["doc_id"] is not None and r["size"]:
                u = spark_free_uniform(r["doc_id"])
                keyed.append((-math.log(u) / w.get(r["doc_id"], 1.0), -r["copies"]))
        keyed.sort()
        assert [c for _, c in keyed] == sorted(c for _, c in keyed), s
    again = mixing.mix(docs.repartition(5), weights).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))

    out = mixing.apply(docs, mixing.mix(docs, weights))
    assert out.columns == docs.columns
    counts = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    text = {(r["doc_id"], r["size"], r["source"]): r["copies"] for r in got}
    for d in data:
        assert counts[d] == text[d[0], len((d[1] or "").split()), d[2]]


def spark_free_uniform(doc_id, seed=13):
    import hashlib

    h = hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return (int(h[:12], 16) + 0.5) / 2**48


def test_repeated_rows_are_taken_alike_and_empty_tables(spark, make_docs):
    docs = make_docs([(1, "a b c", "s")] * 3 + [(2, "d", "s"), (3, "e f", "t")])
    got = mixing.mix(docs).collect()
    assert len({r["copies"] for r in got if r["doc_id"] == 1}) == 1
    assert mixing.apply(docs, mixing.mix(docs)).count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.apply(docs.limit(0), mixing.mix(docs.limit(0))).count() == 0
    nothing = make_docs([(1, None, "s"), (2, "", None)])
    assert [(r["target"], r["taken"]) for r in mixing.mix(nothing).collect()] == [(0.0, 0)] * 2


def test_quality_weights(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    assert {r["doc_id"]: r["weight"] for r in mixing.quality(labels).collect()} == {1: 0.5, 2: 2.0}


def test_edge_buckets_are_cut_finer(spark, make_docs, monkeypatch):
    data = [(i if i % 3 else None, f"t{i} " + " ".join(["w"] * (i % 7)), "hot" if i % 4 else "b") for i in range(600)]
    docs = make_docs(data)
    want = sorted(map(str, mixing.mix(docs).collect()))
    assert len({r["taken"] for r in mixing.mix(docs).filter("doc_id is null").collect()}) > 1  # rows without an id differ in their keys
    monkeypatch.setattr(mixing, "PER_OCTAVE", 1)  # large buckets
    coarse = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "EDGE", 2)
    monkeypatch.setattr(mixing, "FINE", 8)
    fine = mixing.mix(docs)
    assert sorted(map(str, fine.collect())) == coarse == want
