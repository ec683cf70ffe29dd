from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallybayes.llm import periodic_runs, queries
from tallybayes.llm.periodic_runs import _texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """All runs, period by period; a multiple of a period gives a stretch that is there."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= 3 * q and j + q - i >= 6:
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in out.items())


def collapsed(w, runs):
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def made(rng):
    k, n = rng.choice([1, 2, 3, 5, 50]), rng.choice([0, 1, 5, 20, 100, 400])
    w = [str(rng.randrange(k)) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 4 else 0):
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 4))
        for i in range(a + p, min(n, a + p * rng.randint(3, 9) + rng.randint(0, 3))):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(250):
        texts = [made(rng) for _ in range(rng.randint(1, 6))]
        got = _texts([" ".join(w).encode() for w in texts])
        for w, (n, runs, stays) in zip(texts, got, strict=True):
            runs = list(zip(*(x.tolist() for x in runs), strict=True))
            assert (n, runs) == (len(w), brute(w))
            assert (stays is None) == (not runs)


def test_every_period_and_exponent_is_found():
    for q in range(1, 70):
        for length in {max(6, 4 * q) - 1, max(6, 4 * q), 4 * q + q // 2 + 1, 9 * q}:
            unit = [f"u{i}" for i in range(q)]
            w = ["a", "b"] + (unit * 10)[:length] + ["c"]
            ((_, runs, _),) = _texts([" ".join(w).encode()])
            assert list(zip(*(x.tolist() for x in runs), strict=True)) == brute(w), (q, length)


def test_a_long_periodic_text():
    unit = [f"u{i % 977}" for i in range(9000)]
    w = unit * 11 + ["end"] + ["x"] * 50_000 + ["y", "z"] * 30_000
    ((n, runs, _),) = _texts([" ".join(w).encode()])
    got = list(zip(*(x.tolist() for x in runs), strict=True))
    assert n == len(w)
    assert (0, 99_000, 9000) in got
    assert (99_001, 50_000, 1) in got and (149_001, 60_000, 2) in got
    inner = [r for r in got if r[2] == 977]  # 9 whole periods in each unit
    assert len(inner) == 11 and all(r[1] >= 9000 for r in inner)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a a a a a a"), (4, "a a a a a a"), (None, "            b"), (6, "a a a a a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("a.b", F.lit(2))
    got = df.withColumn("found", periodic_runs.scan(F.col("text"))).collect()
    got = sorted((str(r["doc_id"]), r["found"]["n_words"], [tuple(x) for x in r["found"]["runs"]], r["found"]["collapsed"]) for r in got)
    six = [(0, 6, 1)]
    assert got == [
        ("1", 0, [], ""), ("2", 0, [], ""), ("3", 0, [], ""), ("4", 6, six, "a"), ("4", 6, six, "a"), ("6", 5, [], "a a a a a"),
        ("None", 7, six, "  b"),
    ]
    assert df.limit(0).select(periodic_runs.scan(F.col("text"))).count() == 0


def expected(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    top = None
    for r in runs:
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(runs), *best, sha(lines), sha(collapsed(w, runs)))


def test_query_equals_brute_force(spark, scratch, make_docs):
    rng = random.Random(9)
    planted = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    rows = [(i, " ".join(made(rng))) for i in [*range(40), *planted]]
    rows += [(5000, None), (5001, ""), (planted[0], None), (planted[1], " ")]
    make_docs(rows).write.parquet(f"{scratch}/documents.parquet")
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, scratch).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, sf).collect()))
    assert got == sorted(expected(*r) for r in docs)
