from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from tallybayes.llm import simhash
from tallybayes.llm._util import Stage


def brute_fingerprint(text, words=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    if not w:
        return 0
    runs = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [b" ".join(w)]
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def clusters(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints(spark):
    for t in (None, "", " \n", "a", "A b", "a B c", "É Á z ß", "x y z " * 40_000):
        assert simhash.fingerprint(t) % 2**64 == brute_fingerprint(t), (t or "")[:20]
    # the engine's own XXH64 has the same seed
    assert spark.sql("select xxhash64('a b c') as h").first()["h"] == xxhash.xxh64(b"a b c", seed=42).intdigest() - (
        2**64 if xxhash.xxh64(b"a b c", seed=42).intdigest() >= 2**63 else 0
    )


def test_bk_tree_equals_brute_force():
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for b in base for _ in range(12)})
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        for r in (0, 1, 2, 5):
            assert sorted(tree.near(v, r)) == [i for i, x in enumerate(values) if (x ^ v).bit_count() <= r]


def test_links_with_shards_cut_into_parts(spark):
    rng = random.Random(2)
    values = set()
    for _ in range(6):  # clusters that chain, and share whole blocks of bits
        v = rng.getrandbits(64)
        for _ in range(30):
            v ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                v ^= 1 << rng.randrange(22)
            values.add(v)
    values |= {rng.getrandbits(64) for _ in range(50)}
    signed = [v - 2**64 if v >= 2**63 else v for v in sorted(values)]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    for shard in (4, 4096):
        got = simhash.links(df, 2, Stage(spark, "test"), shard=shard).collect()
        root = {v: v for v in signed}

        def find(v, root=root):
            while root[v] != v:
                v = root[v]
            return v

        for a, b in got:
            root[find(a)] = find(b)
        want = clusters(signed, 2)
        pairs = {(find(signed[i]), w) for i, w in enumerate(want)}
        assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


def test_components_of_documents(spark, make_docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    rows = []
    for k in range(25):
        w = [word() for _ in range(60)]
        rows.append((100 - k, " ".join(w)))
        rows.append((200 + k, " ".join(w).upper()))
        if k % 2:
            w[rng.randrange(60)] = word()
            rows.append((300 + k, " ".join(w)))
    rows += [(5, None), (6, ""), (7, "only two"), (7, "only two"), (None, "only two"), (None, "no id"), (None, "no id")]
    docs = make_docs(rows).withColumn("kept_id", F.lit(1)).withColumn("tie", F.lit("x"))
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    want = clusters(fps, 2)
    least = {}
    for (i, _), c in zip(rows, want, strict=True):
        least[c] = min(x for x in (least.get(c), i) if x is not None) if (least.get(c), i) != (None, None) else None
    expected = sorted((str(i), f"{f:016x}", str(least[c])) for (i, _), f, c in zip(rows, fps, want, strict=True))
    assert sorted((str(r["doc_id"]), f"{r['fp'] % 2**64:016x}", str(r["component_id"])) for r in out) == expected

    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == len(set(want))
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(v for v in least.values() if v is not None)
    assert [r["text"] for r in got if r["doc_id"] is None] == ["no id"]


def test_empty_table(spark, make_docs):
    empty = make_docs([(1, "x")]).limit(0)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.dedup(empty).count() == 0
