"""Exact quantiles, class-entropy cuts and the stratified split."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tallybayes import fit_mdl_bins, fit_quantile_bins, rank_search, split_stratified
from tallybayes.operators.ranks import GROUP, RANK, TARGET, X


def found(spark, groups, targets, **kw):
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    data = spark.createDataFrame(rows, f"{GROUP} string, {X} double")
    wanted = spark.createDataFrame(targets, f"{GROUP} string, {TARGET} int, {RANK} long")
    return {(r[GROUP], r[TARGET]): r[X] for r in rank_search(data, wanted, **kw).collect()}


@pytest.mark.parametrize("cells", [50, 1024])
def test_ranks_equal_sorting(spark, cells):
    rng = random.Random(cells)
    groups = {
        "plain": [rng.uniform(-5, 5) for _ in range(300)],
        "ties": [float(rng.randrange(4)) for _ in range(300)],
        "one": [3.5],
        None: [rng.gauss(0, 1) for _ in range(50)],
        "wide": [rng.choice([-1.7e308, 1.7e308, 5e-324, 0.0, -0.0, 1.0]) for _ in range(60)],
        "tiny": [5e-324 * rng.randrange(9) for _ in range(60)],
        "scales": [10.0 ** rng.uniform(-300, 300) for _ in range(80)],
    }
    targets = [(g, k, k) for g, xs in groups.items() for k in {1, 2, len(xs) // 2, len(xs)} if 1 <= k <= len(xs)]
    got = found(spark, groups, targets, cells=cells)
    assert got == {(g, t): sorted(groups[g])[k - 1] for g, t, k in targets}


def test_ranks_without_rows_nulls_and_nans(spark):
    got = found(spark, {"a": [1.0, None, math.nan, 2.0], "b": [None]}, [("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("a", 4, 0), ("b", 1, 1), ("c", 1, 1)])
    assert got == {("a", 1): 1.0, ("a", 2): 2.0}
    assert found(spark, {}, []) == {}


def test_quantile_bins(spark):
    rng = random.Random(3)
    rows = [(float(rng.randrange(100)), rng.choice([1.0, 1.0, 1.0, 2.0]), 7.0, None) for _ in range(997)]
    df = spark.createDataFrame([*rows, (math.nan, None, None, None)], "a double, b double, c double, d double")
    bins = fit_quantile_bins(df, ["a", "b", "c", "d"], bins=4)
    a = sorted(r[0] for r in rows)
    assert bins.cuts == {"a": tuple(a[math.ceil(997 * j / 4) - 1] for j in (1, 2, 3)), "b": (1.0,), "c": (), "d": ()}
    got = bins.apply(df).collect()
    for r, (x, y, _, _) in zip(got, rows, strict=False):
        assert (r["a"], r["b"], r["c"], r["d"]) == (str(sum(x > c for c in bins.cuts["a"])), str(int(y > 1)), "0", None)
    assert tuple(got[-1]) == ("NaN", None, None, None)
    assert fit_quantile_bins(df, ["a"], bins=1).cuts == {"a": ()}


def entropy(labels):
    n = len(labels)
    return -sum(c / n * math.log2(c / n) for c in (labels.count(x) for x in set(labels)))


def mdl(points, cuts, depth):
    """Accepted cuts of (x, label) points by the definition, tried at every candidate."""
    if not depth or len(points) < 2:
        return []
    labels = [y for _, y in points]
    best = None
    for c in cuts:
        left, right = [y for x, y in points if x <= c], [y for x, y in points if x > c]
        if left and right:
            gain = entropy(labels) - (len(left) * entropy(left) + len(right) * entropy(right)) / len(points)
            if best is None or round(gain, 12) > best[0]:
                best = (round(gain, 12), c, left, right, gain)
    if best is None:
        return []
    _, c, left, right, gain = best
    n, k, kl, kr = len(points), len(set(labels)), len(set(left)), len(set(right))
    cost = (math.log2(n - 1) + math.log2(3**k - 2) - (k * entropy(labels) - kl * entropy(left) - kr * entropy(right))) / n
    if gain <= cost:
        return []
    return [c, *mdl([p for p in points if p[0] <= c], cuts, depth - 1), *mdl([p for p in points if p[0] > c], cuts, depth - 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mdl_bins_by_definition(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(600):
        x = rng.uniform(0, 10)
        label = "low" if x < 3 else rng.choice(["mid", "mid", "mid", "high"]) if x < 7 else "high"
        rows.append((x, rng.uniform(0, 1), label if rng.random() < 0.95 else "odd"))
    df = spark.createDataFrame([*rows, (None, math.nan, "low"), (1.0, 1.0, None)], "x double, noise double, label string")
    fine = fit_quantile_bins(df.filter("label is not null"), ["x", "noise"], 32).cuts
    got = fit_mdl_bins(df, ["x", "noise"], "label", candidates=32, depth=3).cuts
    for i, c in enumerate(("x", "noise")):
        points = [(r[i], r[2]) for r in rows]
        assert got[c] == tuple(sorted(mdl(points, fine[c], 3))), c
    assert len(got["x"]) >= 2 and got["noise"] == ()


def test_stratified_shares_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["big"] * 90 + ["mid"] * 9 + ["rare", None])) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, label string").withColumn("_class", F.lit(1))
    for ratio in (0.8, 0.125, 0.0, 1.0):
        tr, te = split_stratified(df, "label", ["id"], ratio)
        a, b = tr.collect(), te.collect()
        assert sorted(r["id"] for r in a + b) == list(range(5000)) and tr.columns == df.columns
        for c in ("big", "mid", "rare", None):
            n = sum(y == c for _, y in rows)
            assert sum(r["label"] == c for r in a) == math.floor(n * ratio + 0.5), (c, ratio)
    one, _ = split_stratified(df.repartition(13), "label", ["id"])
    two, _ = split_stratified(df.coalesce(1), "label", ["id"])
    assert sorted(r["id"] for r in one.collect()) == sorted(r["id"] for r in two.collect())


def test_the_split_sorts_no_rows(spark):
    from test_plans import plan_text

    df = spark.range(1000).withColumn("label", (F.col("id") % 3).cast("string"))
    text = plan_text(split_stratified(df, "label", ["id"])[0])
    assert "Window" not in text and "TakeOrdered" not in text
