from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybayes.llm import embedding_dedup, exact_knn

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [None, [], [0.0] * 8, [1.0] * 7 + [None], [1.0] * 7 + [math.nan], [1.0] * 7 + [math.inf]]


def table(seed=1, n=160, d=8):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 and rows:
            j = int(rng.integers(len(rows)))
            v = np.array(rows[j][1]) + rng.normal(0, rng.choice([0, 0.05, 0.12]), d)
            label = rows[j][2] if rng.random() < 0.9 else int(rng.integers(3))
        else:
            v, label = rng.normal(size=d), int(rng.integers(3))
        rows.append((i, [float(np.float32(x)) for x in v], label))
    return rows


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, cosine):
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la is None or la != lb or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            x, y = np.array(a), np.array(b)
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        least.setdefault(find(i), []).append(rows[i][0])
    head = {c: min((x for x in ids if x is not None), default=None) for c, ids in least.items()}
    return sorted((str(rows[i][0]), links[i], str(head[find(i)]), rows[i][0] == head[find(i)]) for i in range(n))


@pytest.mark.parametrize("part", [3, 2048])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(embedding_dedup, "PART", part)
    rows = table()
    rows += [(500 + i, v, 1) for i, v in enumerate(ODD)] + [(600, rows[0][1], None), (601, rows[0][1][:5], rows[0][2])]
    rows += [rows[3], rows[3], (None, rows[3][1], rows[3][2]), (None, [9.0, -9.0] * 4, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cid", F.lit(1)).withColumn("root", F.lit("r"))
    got = embedding_dedup.near_duplicates(df, 0.93).collect()
    out = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got)
    want = brute(rows, 0.93)
    assert len(out) == len(want)
    # the index may miss a pair in a thousand; it never adds one
    assert sum(a != b for a, b in zip(out, want, strict=True)) <= 3
    assert sum(r[1] for r in out) >= 0.99 * sum(r[1] for r in want)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert embedding_dedup.near_duplicates(empty).count() == 0
    assert exact_knn.top_k(empty, F.col("vec_id") % 2 == 0).count() == 0
    none = spark.createDataFrame([(i, v, 1) for i, v in enumerate(ODD)], SCHEMA)
    rows = embedding_dedup.near_duplicates(none).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows) == [(i, 0, i, True) for i in range(len(ODD))]


def test_caps_hold_the_share_they_promise():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(20_000, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for p in (0.3, 0.05, 0.005):
        assert (v[:, 0] >= embedding_dedup.cap_height(16, p)).mean() == pytest.approx(p, rel=0.25)


def test_lists_hold_every_direction_above_the_height():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(30, 12))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    blocks, words = 3, 6
    height = embedding_dedup.cap_height(12, 0.06)
    turn, codes = embedding_dedup.code(12, blocks, words)
    for row, got in zip(v, embedding_dedup.decode(v, blocks, words, height), strict=True):
        x = row @ turn
        score = {
            (i * words + j) * words + k: x[:4] @ codes[0][:, i] + x[4:8] @ codes[1][:, j] + x[8:] @ codes[2][:, k]
            for i in range(words) for j in range(words) for k in range(words)
        }
        above = sorted(f for f, s in score.items() if s >= height)
        if len(above) >= embedding_dedup.LEAST:
            assert got.tolist() == above
        else:
            assert got.tolist() == sorted(sorted(score, key=score.get)[-embedding_dedup.LEAST :])


@pytest.mark.parametrize("small", [False, True])
def test_top_k_equals_brute_force(spark, monkeypatch, small):
    if small:  # many cells, groups and blocks
        for name, value in (("_pivot_count", lambda n: n // 10), ("GROUP_BYTES", 7 * 8 * 8), ("BLOCK", 9)):
            monkeypatch.setattr(exact_knn, name, value)
    rows = table(seed=2, n=150)
    rows += [(500 + i, v, 1) for i, v in enumerate(ODD)] + [(None, rows[0][1], 0), (700, rows[0][1], 0), (702, rows[0][1], 0)]
    rows += [(704, rows[0][1][:5], 0), (706, rows[1][1][:5], 0), (708, [1e6] * 8, 0), (708, [-1e6] * 8, 0), (710, rows[9][1], 0), (710, rows[9][1], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("dim", F.lit(1)).withColumn("g", F.lit("x"))
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and ok(v)]
    want = set()
    for i, q in ints:
        if i % 10 == 0:
            scores = [(-sum(a * b for a, b in zip(q, x, strict=True)), j) for j, x in ints if j != i and len(x) == len(q)]
            want |= {(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:5], 1)}
    got = exact_knn.top_k(df, F.col("vec_id") % 10 == 0, k=5).collect()
    assert {tuple(r) for r in got} == want


def neighbours(rows, every, k=5):
    """Brute force: (query_id, rank, vec_id, score) of the ids that ``every`` divides."""
    ints = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, _ in rows]
    out = []
    for i, q in sorted({x for x in ints if x[0] % every == 0}):
        scores = [(-sum(a * b for a, b in zip(q, x, strict=True)), j) for j, x in ints if j != i and len(x) == len(q)]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_top_k_of_a_zero_vector_among_small_cells(spark, monkeypatch):
    monkeypatch.setattr(exact_knn, "_pivot_count", lambda n: n)  # a cell for each vector
    rows = [(i, [float(i), 1.0, 0.0], 0) for i in range(1, 8)] + [(10, [0.0] * 3, 0), (20, [0.001] * 3, 0)]
    rows += [(30, [0.0] * 2, 0), (31, [1.0, 2.0], 0), (32, [2.0, -1.0], 0)]  # a length with fewer than k others
    got = exact_knn.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, k=5).collect()
    assert sorted(tuple(r) for r in got) == neighbours(rows, 10)


def test_top_k_of_an_id_repeated_over_many_cells(spark, monkeypatch):
    """A query's own rows, in one cell or in many, don't bound its k-th best score."""
    monkeypatch.setattr(exact_knn, "_pivot_count", lambda n: n)  # a cell for each vector
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0) for i in range(1, 61) if i % 50]
    rows += [(100, [30.0, 0.0, 0.0, 0.0, 0.0, 0.0], 0)] * 8  # equal rows
    rows += [(150, [0.0, 30.0, 2.0 * j, 0.0, 0.0, 0.0], 0) for j in range(9)]  # other vectors
    got = exact_knn.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, k=5).collect()
    assert sorted(tuple(r) for r in got) == neighbours(rows, 50)


def test_queries_of_equal_vectors_are_dealt_to_all_pieces(spark, monkeypatch):
    monkeypatch.setattr(exact_knn, "GROUP_BYTES", 8 * 3 * 8)
    real = exact_knn._solve

    def counted(k):
        solve = real(k)

        def run(queries, data):
            if len(queries) > 32:
                raise ValueError("a piece has most of the queries")
            return solve(queries, data)

        return run

    monkeypatch.setattr(exact_knn, "_solve", counted)
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(1, 65)]
    got = exact_knn.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") > 0, k=5).collect()
    assert sorted(tuple(r) for r in got) == neighbours(rows, 1)


def test_clustered_vectors_are_pruned_and_others_sent_once_a_group(spark, monkeypatch):
    rng = np.random.default_rng(11)
    heads = rng.normal(size=(30, 8))
    heads *= 40 / np.linalg.norm(heads, axis=1, keepdims=True)
    rows = [(i, [float(np.float32(x)) for x in heads[i % 30] + rng.normal(size=8)], 0) for i in range(1500)]
    monkeypatch.setattr(exact_knn, "GROUP_BYTES", 8 * 8 * 4)  # few queries a group
    monkeypatch.setattr(exact_knn, "BLOCK", 200)
    seen = {}
    got = exact_knn.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, k=5, seen=seen).collect()
    assert sorted(tuple(r) for r in got) == neighbours(rows, 50)
    assert seen["needed"] < 0.5 * seen["pairs"], seen
    assert seen["sent"] < 0.4 * seen["rows"], seen
    # without clusters nothing can be left out: one group, and each vector is sent once
    monkeypatch.undo()
    flat = [(i, [float(np.float32(x)) for x in rng.normal(size=24)], 0) for i in range(400)]
    got = exact_knn.top_k(spark.createDataFrame(flat, SCHEMA), F.col("vec_id") % 50 == 0, k=5, seen=seen).collect()
    assert sorted(tuple(r) for r in got) == neighbours(flat, 50)
    assert seen["sent"] <= seen["rows"] == 400
