from __future__ import annotations

import hashlib
import os
import re
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tallybayes.llm import bpe, queries, simhash
from tallybayes.llm.oracle import ORACLE_SQL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(corpus_pipeline.__file__)), "tools"))
from oracle_check import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck(SF).execute(ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_every_query_is_registered():
    import __spark_entry__ as E

    own = [q for q in E.queries() if q.startswith("op") or q == "pipeline"]
    assert sorted(int(q[2:].split("_")[0]) for q in own if q != "pipeline") == list(range(1, 14)) and "pipeline" in own


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def cut_by_hand(texts):
    """Texts by id without the words of 50-word windows that start in a document with a smaller id."""
    first, out = {}, {}
    for i in sorted(texts):
        w = words(texts[i])
        for a in range(len(w) - 49):
            first.setdefault(tuple(w[a : a + 50]), i)
    for i, t in texts.items():
        w = words(t)
        gone = {k for a in range(len(w) - 49) if first[tuple(w[a : a + 50])] < i for k in range(a, a + 50)}
        out[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
    return out


def targets_by_hand(sizes):
    """Each source's share of 150 % of all words by weights 3, 1, 2, at most twice its own; the excess dealt anew."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, left = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in target]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(step(spark, docs, SF).collect(), docs.schema)
        kept[name] = {(r["doc_id"], r["text"]): r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before = {k[0] for k in kept["toxicity"]}
    after = {k[0]: k[1] for k in kept["simhash near-dedup"]}
    prints = {i: simhash.fingerprint(t) for i, t in kept["toxicity"]}
    # the kept ones are far apart, and each dropped one is tied to a smaller kept one by links
    ids = sorted(after)
    for a in ids:
        assert all(((prints[a] ^ prints[b]) % 2**64).bit_count() > 2 for b in ids if b < a)
    assert set(after) <= before and len(after) < len(before)
    cut = {k[0]: (k[1], r["n_chars"]) for k, r in kept["substring dedup"].items()}
    want = cut_by_hand(after)
    assert {i: t for i, (t, _) in cut.items()} == want and any(want[i] != after[i] for i in want)
    assert all(n == len(t) for i, (t, n) in cut.items() if want[i] != after[i])
    # the mix takes whole documents, twice at most, and each source's words come near its target
    source = {k[0]: r["source"] for k, r in kept["substring dedup"].items()}
    size = {i: len(words(t)) for i, t in want.items()}
    copies = Counter(r["doc_id"] for r in docs.collect())
    assert copies.keys() <= want.keys() and max(copies.values()) <= 2
    assert all(r["text"] == want[r["doc_id"]] and r["source"] == source[r["doc_id"]] for r in docs.collect())
    total, taken = Counter(), Counter()
    for i, n in size.items():
        total[source[i]] += n
        taken[source[i]] += n * copies[i]
    for s, target in targets_by_hand(total).items():
        assert abs(taken[s] - target) <= max(n for i, n in size.items() if source[i] == s)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(out) == docs.count()
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], r["text"])
    for r in out:
        ids = ref.encode_ordinary(texts[r["doc_id"]])
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(bytes(r["ids"])).hexdigest()


def test_edge_rows_pass_every_stage(spark, make_docs):
    rows = [(None, None), (None, "x"), (1, None), (1, None), (2, ""), (3, "word " * 3000), (3, "word " * 3000), (4, "a\nb")]
    for docs in (make_docs(rows), make_docs(rows).limit(0)):
        schema = docs.schema
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, docs, SF)
            assert out.columns == schema.names
            docs = spark.createDataFrame(out.collect(), schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert out.count() > 0
