from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallybayes.llm import ngram_lm


def tokens(text):
    lower = {i: i + 32 for i in range(65, 91)}
    return [*(text or "").translate(lower).encode().split(), "</s>"]


def part(i):
    r = zlib.crc32(str(i).encode() if i is not None else b"") % 5
    return {1: "scored", 0: "deleted"}.get(r, "counted")


def model(rows, weights):
    """The model by its formula, from plain counters."""
    uni, bi, ctx = Counter(), Counter(), Counter()
    for i, t in rows:
        if part(i) != "scored":
            k = tokens(t)
            uni.update(k)
            ctx.update(["<s>", *k[:-1]])
            bi.update(zip(["<s>", *k[:-1]], k, strict=True))
    n, v = sum(uni.values()), len(uni)
    out = []
    for _, t in rows:
        k, score, base = tokens(t), 0.0, 0.0
        for a, w in zip(["<s>", *k[:-1]], k, strict=True):
            l2, l1, l0 = weights[0 if not ctx[a] else 1 + int(math.log2(ctx[a]))]
            score += math.log10(l2 * bi[a, w] / max(ctx[a], 1) + l1 * uni[w] / max(n, 1) + l0 / (v + 1))
            base += math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1)))
        out.append((len(k), sum(uni[w] > 0 for w in k), n, base, score))
    return out


def corpus():
    rng = random.Random(3)
    words = ["The", "the", "a", "cat", "Dog", "sat", "É", "on", "mat"] + [f"r{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(words[: rng.choice([5, 49])]) for _ in range(rng.randrange(30)))) for i in range(120)]
    return rows + [(200, None), (201, ""), (202, "the " * 30_000), (3, rows[3][1]), (3, rows[3][1]), (None, "no id here"), (2**53 + 1, "The cat"), (2**63 - 1, "a")]


@pytest.mark.parametrize(("fan", "parts", "levels"), [(256, 3, 1), (3, 14, 3)])
def test_scores_equal_the_formula(spark, make_docs, monkeypatch, fan, parts, levels):
    weights, merges = [], []
    merge = ngram_lm._ask_on
    monkeypatch.setattr(ngram_lm, "FAN", fan)
    monkeypatch.setattr(ngram_lm, "_ask_on", lambda *a: merges.append(a) or merge(*a))
    real = ngram_lm.learn
    monkeypatch.setattr(ngram_lm, "learn", lambda *a: weights.append(real(*a)) or weights[0])
    monkeypatch.setattr(ngram_lm, "PER_BUCKET", 50)
    rows = corpus()
    docs = make_docs(rows).withColumn("batch", F.lit(1)).withColumn("vocab", F.lit("x"))
    got = ngram_lm.score(docs.repartition(parts)).collect()
    w = weights[0]
    assert len(merges) == 2 * (levels - 1)  # words and bigrams
    assert np.allclose(w.sum(1), 1) and (w[1:] > 0).all() and w[0, 0] == 0
    want = model(rows, w)
    out = sorted(((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"], r["held_out"]) for r in got))
    exp = sorted((str(i), *m, part(i) == "scored") for (i, _), m in zip(rows, want, strict=True))
    for a, b in zip(out, exp, strict=True):
        assert a[:4] == b[:4] and a[6] == b[6]
        assert a[4] == pytest.approx(b[4], rel=1e-9) and a[5] == pytest.approx(b[5], rel=1e-9)


def test_sums_and_answers_of_a_level():
    """Questions of many askers with a key that all have: added up, dealt on, and answered in their own order."""
    rng = np.random.default_rng(4)
    hot = np.uint64(2**63 + 5)
    asked, total = [], {}
    for asker in range(40):
        keys = np.unique(np.append(rng.integers(0, 2**64, 30, dtype=np.uint64) >> np.uint64(55) << np.uint64(55), hot))
        main, held = rng.integers(0, 300, len(keys)), rng.integers(0, 300, len(keys))
        for k, a, b in zip(keys.tolist(), main.tolist(), held.tolist(), strict=True):
            x, y = total.get(k, (0, 0))
            total[k] = x + a, y + b
        asked.append(ngram_lm._deal(asker, keys, main, held, 3, 1))
    asked = pd.concat(asked, ignore_index=True)
    assert set(asked["bucket"]) == set(range(8)) and set(asked["parent"]) == {0}
    finer, answers = 6, []
    for bucket, own in asked.groupby("bucket"):
        (row,) = ngram_lm._merge(own).to_dict("records")
        on = ngram_lm._deal(0, np.frombuffer(row["keys"], "<u8"), ngram_lm.unpack(row["main"]), ngram_lm.unpack(row["held"]), finer, 1)
        assert (on["bucket"] // 8 == bucket).all()
        told = pd.concat([ngram_lm._answer(2)(r) for _, r in on.groupby("bucket")])
        told = told[told["batch"] >= 0].rename(columns={"bucket": "fine"}).sample(frac=1, random_state=1)
        out = ngram_lm._pass_on(2)(own, told)
        answers += zip(own["keys"], out["main"], out["every"], strict=True)
    for keys, main, every in answers:
        k = np.frombuffer(keys, "<u8").tolist()
        assert ngram_lm.unpack(main).tolist() == [total[x][0] for x in k]
        assert ngram_lm.unpack(every).tolist() == [sum(total[x]) for x in k]


def test_em_raises_the_held_out_likelihood():
    rng = np.random.default_rng(1)
    cells = pd.DataFrame({"b": rng.integers(0, 4, 300), "x2": rng.integers(0, 30, 300), "x1": rng.integers(0, 60, 300), "n": rng.integers(1, 50, 300)})

    def loss(w):
        p2 = np.where((cells.x2 > 0) & (cells.b > 0), 2.0 ** (-(cells.x2 - 1) / ngram_lm.GRID), 0)
        p1 = np.where(cells.x1 > 0, 2.0 ** (-(cells.x1 - 1) / ngram_lm.GRID), 0)
        m = w[cells.b]
        return -(cells.n * np.log(m[:, 0] * p2 + m[:, 1] * p1 + m[:, 2] * 1e-6)).sum()

    steps = [loss(ngram_lm.learn(cells, 1e-6, rounds=r)) for r in (1, 3, 10, 100)]
    assert all(b <= a + 1e-3 * abs(a) for a, b in zip(steps, steps[1:], strict=False)) and steps[-1] < steps[0]


def test_nothing_to_learn_from(spark, make_docs):
    ids = [i for i in range(40) if part(i) == "scored"]
    got = ngram_lm.score(make_docs([(i, "a b") for i in ids])).collect()
    assert [(r["train_tokens"], r["n_known"], r["score"], r["base_score"]) for r in got] == [(0, 0, 0.0, 0.0)] * len(ids)
    assert ngram_lm.score(make_docs([(1, "x")]).limit(0)).count() == 0
