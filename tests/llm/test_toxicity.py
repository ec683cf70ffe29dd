from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallybayes.llm import toxicity


def corpus(n=500, seed=1):
    """Invented prose in which a toxic document has a few of some rude words."""
    rng = random.Random(seed)
    syll = ["ka", "lo", "mi", "ren", "tu", "sha", "vo", "ner", "pi", "da"]
    plain = ["".join(rng.choice(syll) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    rude = ["grumbolt", "snarkweed", "blorghead", "fizzlewit"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(rude) + rng.choice(["", ".", "!"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels, plain


def test_held_out_accuracy_and_unseen_misspellings(spark, make_docs):
    rows, labels, plain = corpus()
    rng = random.Random(2)
    wrong = ["grumboltt", "snarkwed", "blorgheadd", "fizzlewitt", "grumbollt"]
    extra = []
    for k in range(20):
        w = [rng.choice(plain) for _ in range(40)]
        extra.append((10_000 + k, " ".join(w)))
        w[3], w[17], w[30] = (rng.choice(wrong) for _ in range(3))
        extra.append((20_000 + k, " ".join(w)))
    extra += [(30_000, None), (30_001, ""), (30_001, ""), (None, " ".join(["grumbolt"] * 5)), (30_002, rows[0][1] + " x" * 40_000)]
    lab = spark.createDataFrame([*labels, *labels[:9], (None, 1), (7, None), (99_999, 1)], "doc_id long, toxic int")
    docs = make_docs(rows + extra)
    out = toxicity.scored(docs, lab).collect()
    assert len(out) == len(rows) + len(extra)
    got = {r["doc_id"]: r for r in out}
    held = [(got[i]["predicted"], y) for i, y in labels if got[i]["held_out"]]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
    assert np.mean([got[20_000 + k]["predicted"] for k in range(20)]) >= 0.8
    assert np.mean([got[10_000 + k]["predicted"] for k in range(20)]) <= 0.1
    assert got[None]["predicted"] == 1 and got[None]["held_out"] is False
    assert got[30_000]["score"] == got[30_001]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    # the fit reads the same rows in any layout
    again = {r["doc_id"]: r["score"] for r in toxicity.scored(docs.repartition(7), lab).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-6 for i, r in got.items())


def test_without_labels_or_rows(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.scored(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, toxic int")
    assert all(r["predicted"] == 1 for r in toxicity.scored(docs, one).collect())
    assert toxicity.scored(docs.limit(0), one).count() == 0


def test_the_sample_is_bounded(spark, make_docs):
    rows, labels, _ = corpus(80)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.train(make_docs(rows), lab, max_train=30).rows <= 30


def test_repeated_ids_beyond_the_sample(spark, make_docs):
    rows, labels, _ = corpus(60)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    more = [(i, t + f" again {k}") for i, t in rows for k in range(4)]
    docs = make_docs(rows + rows + more)
    one = toxicity.train(docs, lab, max_train=40)
    two = toxicity.train(docs.repartition(11), lab, max_train=40)
    assert one.rows == two.rows == 40
    assert np.array_equal(one.bucket, two.bucket) and one.bias == two.bias


def plain_parts(word):
    """Buckets of a word: the marked word, and each stretch of 3 to 5 of its letters."""
    marked = "<" + word.strip(".,;:!?\"'()[]{}|#*%&$~<>") + ">"
    parts = [marked] + [marked[a : a + n] for n in (3, 4, 5) for a in range(len(marked)) if a + n <= len(marked)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % 32768 for p in parts]


def plain_bag(text):
    """Share of each bucket: every word of the text weighs the same, and so does every part of a word."""
    bag, got = {}, (text or "").lower().split()
    for w in got:
        parts = plain_parts(w)
        for p in parts:
            bag[p] = bag.get(p, 0.0) + 1 / len(parts) / len(got)
    return bag


TEXTS = [None, "", " \n", "Kind words, kindly said.", "a", "!!! ...", "ÉTÉ été \U0001f600 x", "vile (vile) VILE!", "long " * 30_000 + "end", "same", "same"]


def test_bags_and_scores_equal_a_plain_restatement(spark, make_docs):
    for text, packed in zip(TEXTS, toxicity._bag(pd.Series(TEXTS, dtype=object)), strict=True):
        at, weight, top = toxicity.unpacked(packed)
        got = dict(zip(at.tolist(), (weight * float(top)).tolist(), strict=True))
        want = plain_bag(text)
        assert got.keys() == want.keys() and all(got[b] == pytest.approx(want[b], rel=2e-3, abs=1e-7) for b in want)
    rng = np.random.default_rng(5)
    model = toxicity.Model(rng.normal(0, 3, toxicity.BUCKETS), -0.4, 1)
    docs = make_docs(list(enumerate(TEXTS))).withColumn("y", F.lit(1)).withColumn("toxic_score", F.lit("x"))
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", toxicity.score(F.col("text"), model, spark).alias("p")).collect()}
    for i, text in enumerate(TEXTS):
        z = -0.4 + sum(share * model.bucket[b] for b, share in plain_bag(text).items())
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


def test_the_fit_equals_adam_by_its_formula():
    """Embeddings and softmax fitted once more, text by text and in double precision."""
    rows, labels, _ = corpus(12, seed=9)
    texts, y = [" ".join(t.split()[:25]) for _, t in rows], np.array([v for _, v in labels])
    model = toxicity.fit(list(toxicity._bag(pd.Series(texts))), y, batch=5)
    bags = [plain_bag(t) for t in texts]
    used = sorted(set().union(*bags))
    place = {b: k for k, b in enumerate(used)}
    rng, epochs, steps = np.random.default_rng(7), 320 // 3, 0
    e = rng.normal(0, 0.1, (32768, 8))[used]
    u = rng.normal(0, 0.3, (8, 2))
    share = (y.sum() + 0.5) / (len(y) + 1)
    c = np.array([0, math.log(share / (1 - share))])
    param = [e, u, c]
    one, two = [np.zeros_like(p) for p in param], [np.zeros_like(p) for p in param]
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for first in range(0, len(y), 5):
            pick = order[first : first + 5]
            grad = [1e-4 * param[0], np.zeros_like(u), np.zeros_like(c)]
            for i in pick:
                h = sum(30 * s * param[0][place[b]] for b, s in bags[i].items())
                z = h @ param[1] + param[2]
                q = np.exp(z - z.max())
                q = q / q.sum() - (np.arange(2) == y[i])
                back = param[1] @ q / len(pick)
                for b, s in bags[i].items():
                    grad[0][place[b]] += 30 * s * back
                grad[1] += np.outer(h, q) / len(pick)
                grad[2] += q / len(pick)
            steps += 1
            for k in range(3):
                one[k] = 0.9 * one[k] + 0.1 * grad[k]
                two[k] = 0.999 * two[k] + 0.001 * grad[k] ** 2
                param[k] = param[k] - 0.05 * (1 - epoch / epochs) * (one[k] / (1 - 0.9**steps)) / (np.sqrt(two[k] / (1 - 0.999**steps)) + 1e-8)
    assert steps == 3 * epochs
    for bag, toxic in zip(bags, y, strict=True):
        h = sum(30 * s * param[0][place[b]] for b, s in bag.items())
        z = h @ param[1] + param[2]
        mine = model.bias + sum(s * model.bucket[b] for b, s in bag.items())
        assert 1 / (1 + math.exp(-mine)) == pytest.approx(1 / (1 + math.exp(z[0] - z[1])), abs=0.02)
        assert (mine > 0) == bool(toxic)


def test_the_sample_is_bounded_by_bytes(spark, make_docs):
    rows, labels, _ = corpus(60)
    rows += [(1000 + i, " ".join(f"w{i}x{j}" for j in range(5000))) for i in range(6)]  # long texts: large bags
    lab = spark.createDataFrame(labels + [(1000 + i, i % 2) for i in range(6)], "doc_id long, toxic int")
    docs = make_docs(rows)
    size = {i: len(b) for (i, t), b in zip(rows, toxicity._bag(pd.Series([t for _, t in rows])), strict=True)}
    learn = [i for i in size if zlib.crc32(str(i).encode()) % 5 != 0]
    order = [r["id"] for r in spark.createDataFrame([(i,) for i in learn], "id long").orderBy(F.xxhash64("id"), "id").collect()]
    for share in (0.0, 0.3, 0.7, 1.0):
        bound = int(share * sum(size[i] for i in learn))
        want = sum(np.cumsum([size[i] for i in order]) <= bound)
        one = toxicity.train(docs, lab, max_bytes=bound)
        two = toxicity.train(docs.repartition(9), lab, max_bytes=bound)
        assert one.rows == two.rows == want
        assert np.array_equal(one.bucket, two.bucket)
