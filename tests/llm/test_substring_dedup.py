from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallybayes.llm import substring_dedup


def brute(rows, size):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, 2**63), 2**63 - 1 if i is None else i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        drop = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < (2**63 - 1 if i is None else i):
                drop[k : k + size] = [True] * size
        kept = b" ".join(x for x, d in zip(w, drop, strict=True) if not d).decode()
        out.append((str(i), len(w), sum(drop), kept))
    return sorted(out)


def run(docs, seed):
    out, r = substring_dedup.dedup(docs, seed=seed)
    got = out.select("doc_id", F.col(f"{r}.n_words").alias("a"), F.col(f"{r}.n_removed").alias("b"), F.col(f"{r}.kept").alias("c"))
    return sorted((str(x["doc_id"]), x["a"], x["b"], x["c"]) for x in got.collect())


def test_random_documents_equal_brute_force(spark, make_docs):
    rng = random.Random(7)
    for seed, letters in ((1, "ab"), (2, "abc"), (3, "ab"), (5, "abcdefgh")):
        rows = []
        passages = [[rng.choice(letters) for _ in range(rng.randrange(4 * seed))] for _ in range(6)]
        for i in range(60):
            w = []
            for _ in range(rng.randrange(5)):
                w += rng.choice(passages) if rng.random() < 0.7 else [rng.choice(letters + "xyz") for _ in range(rng.randrange(9))]
            rows.append((rng.randrange(40), rng.choice([" ", "\n", " \t"]).join(w)))
        rows += [(3, None), (None, rows[0][1]), (None, rows[1][1]), (-5, rows[2][1]), (9, ""), (9, "  \x0b ")]
        assert run(make_docs(rows), seed) == brute(rows, 2 * seed), (seed, letters)


def test_long_and_unicode_texts(spark, make_docs):
    rng = random.Random(8)
    body = [rng.choice(["é", "中中", "x", "yy", "\u00a0z", "q\u2003r"]) + str(rng.randrange(5000)) for _ in range(30_000)]
    rows = [(1, " ".join(body)), (2, " ".join(body[5000:9000] + ["new"] + body[9000:9049] + ["end"])), (3, "one " * 5000), (4, "one " * 60)]
    assert run(make_docs(rows), 25) == brute(rows, 50)


def test_clashing_columns_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "a b c d"), (2, "a b c d"), (2, "a b c d")]).withColumn("sub_id", F.lit(9)).withColumn("id", F.lit(8))
    out, r = substring_dedup.dedup(docs, seed=2)
    assert out.columns == [*docs.columns, r]
    assert sorted((x["doc_id"], x[r]["kept"], x["sub_id"], x["id"]) for x in out.collect()) == [(1, "a b c d", 9, 8), (2, "", 9, 8), (2, "", 9, 8)]
    assert substring_dedup.dedup(docs.limit(0))[0].count() == 0


def test_texts_without_an_id_stay_apart_when_short_hashes_collide(spark, make_docs):
    many = spark.range(400_000).select(F.concat(F.lit("a b c d e f "), F.col("id").cast("string")).alias("text"))
    pairs = many.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t")).filter(F.size("t") > 1)
    one, other = pairs.orderBy("h").first()["t"][:2]
    # the second is longer, with the passage of document 1 elsewhere
    rows = [(1, "x y z " + one), (None, one), (None, other), (None, "p q r s t u v w x y z a b c d e f"), (2, "a b c d e f")]
    assert run(make_docs(rows), 2) == brute(rows, 4)


def test_many_equal_rows_keep_one_set_of_spans(spark, make_docs):
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words[:20]))] + [(None, " ".join(words))] * 3000 + [(7, " ".join(words[5:]))] * 3000
    docs = make_docs(rows)
    spans = substring_dedup.repeats(docs, 2).collect()
    assert len(spans) == 2 and all(len({x["loc"] for x in r["spans"]}) == len(r["spans"]) <= 30 for r in spans)
    assert run(docs, 2) == brute(rows, 4)
