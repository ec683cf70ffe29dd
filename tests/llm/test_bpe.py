from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallybayes.llm import bpe
from tallybayes.llm._util import prepare

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def texts():
    rng = random.Random(5)
    wild = [chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x500), rng.randrange(0x4E00, 0x9000), rng.randrange(0x1F300, 0x1F600)])) for _ in range(200)]
    wild += list(" \n\t ethaon's")
    out = ["", " ", "\n\n ", "a", "x" * 3000, "中" * 500, "the" * 900, "a  b   c    ", "don't you'll", "<|endoftext|>", "\x00\x7f"]
    out += ["".join(rng.choice("etaoinsh") for _ in range(4000)), "ab " * 50_000, " " * 70_000 + "x", "é" * 70_000]
    return out + ["".join(rng.choice(wild) for _ in range(rng.randrange(80))) for _ in range(300)]


def test_ids_equal_the_reference_library(ranks, reference):
    coder, back = bpe.Encoder(ranks, PATTERN), bpe.Decoder(ranks, block=7)
    for t in texts():
        ids = np.frombuffer(coder.encode(t), "<u4")
        assert ids.tolist() == reference(t), t[:60]
        assert back.text(ids) == t


def test_full_tables_change_nothing(ranks, reference):
    coder = bpe.Encoder(ranks, PATTERN, max_pieces=3)
    coder.machine.max_states = 5
    for t in texts()[:120]:
        assert np.frombuffer(coder.encode(t), "<u4").tolist() == reference(t), t[:60]


def test_words_met_before_are_not_matched_again(ranks, reference):
    coder, read = bpe.Encoder(ranks, PATTERN), []
    words = ["" if i % 17 == 0 else f"wörd{i % 40}," + "\n" * (i % 13 == 0) for i in range(400)]
    first, then = " ".join(words), " ".join(words[::-1])
    assert np.frombuffer(coder.encode(first), "<u4").tolist() == reference(first)
    own = coder.findall
    coder.findall = lambda t: read.append(len(t)) or own(t)
    assert np.frombuffer(coder.encode(then), "<u4").tolist() == reference(then)
    assert sum(read) < len(then) / 2  # the words that go with white space before them


def test_no_way_on_goes_back(ranks, reference):
    # longest tokens first: most of these pieces need shorter ones after all
    rng = random.Random(3)
    machine = bpe.Transducer(ranks)
    tokens = [t.decode() for t in rng.sample(sorted(ranks), 3000) if t.isalpha() and t.isascii()]
    for _ in range(500):
        piece = "".join(rng.choice(tokens)[: rng.randrange(1, 9)] for _ in range(5))
        assert machine.encode(piece.encode()) == reference(piece), piece


def test_streaming_decoder_equals_python_at_every_cut():
    rng = random.Random(9)
    parts = [b"a", "é".encode(), "中".encode(), "😀".encode(), b"\xff", b"\xe4", b"\xf0\x9f", b"\xed\xa0\x80", b"\xc0\x80", b"\xf4\x90"]
    for _ in range(400):
        data = b"".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        cut = rng.randrange(len(data) + 1)
        m = bpe.Utf8Decoder()
        assert m.feed(data[:cut]) + m.feed(data[cut:]) + m.finish() == data.decode("utf-8", "replace")


def test_columns(spark, reference, make_docs):
    prepare(spark)
    docs = make_docs([(1, None), (2, ""), (2, ""), (3, "Hello wörld " * 3000), (None, "x")])
    code = docs.select("doc_id", "text", bpe.encode(F.col("text"), PATH, PATTERN).alias("c"))
    rows = code.select("*", bpe.decode(F.col("c.ids"), PATH, PATTERN).alias("back"), bpe.unpack(F.col("c.ids")).alias("list")).collect()
    assert len(rows) == 5
    for r in rows:
        ids = reference(r["text"] or "")
        assert (r["c"]["n_tokens"], r["list"], r["back"]) == (len(ids), ids, r["text"] or "")
    assert code.limit(0).count() == 0


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Transducer({b"a": 0})
