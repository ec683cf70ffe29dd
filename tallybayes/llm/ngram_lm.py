"""LM scoring: deleted interpolation of bigram, unigram and uniform estimates.

    P(w | v) = l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1)

b is the bucket of the context's frequency c(v): 0, 1, 2-3, 4-7 and so on. The
weights of each bucket are learned by expectation-maximisation: counts come
from one part of the training documents, the weights maximise the likelihood
of the counts of the other part, which was left out ("deleted"). Scores then use
the counts of all training documents.

How it runs. Documents are read once, into batches of about ``BATCH`` bytes:
the distinct words of a batch as 64-bit hashes, its tokens as indexes into
them. A batch asks for the counts of what it holds: it deals its sorted keys to
buckets of the hash range, a bucket adds up what is reported and answers each
asker in the order of its question. Words make one such round, bigrams another.
After that a batch knows every count its tokens need and works alone.

A bucket hears at most about ``FAN`` askers. Where there are more batches,
``FAN`` of them are added up bucket by bucket to one asker of the next level,
which deals its keys to finer buckets, and so on up to one top; answers come
back down the same way. So a frequent word reaches a bucket at most ``FAN``
times, a question holds thousands of keys at every level, and no group grows
with the input: 100 TB are four levels. Tasks are as many as their bytes ask
for. Nothing is broadcast but the weights, and the driver sees totals and a
histogram with a bounded number of cells.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.llm._util import Stage, Words, mix64, prepare

BATCH = 4 << 20
PER_BUCKET = 1 << 20  # keys, summed over askers
FAN = 256  # askers that a bucket hears
TASK_KEYS = 4 << 20  # keys of a task's buckets: some 40 MB
TASK_BATCHES = 4
END, BEGIN = np.uint64(1), np.uint64(2)  # hashes of the end token and of the context before the first
SCORED, COUNTED, DELETED = 0, 1, 2  # held out; counts; weights
GRID = 4  # cells of the histogram for each doubling of an estimate
QUESTION = "batch long, parent long, bucket long, keys binary, main binary, held binary"
MERGED = "batch long, keys binary, main binary, held binary"
ANSWER = "batch long, bucket long, kind int, main binary, every binary, n_main long, n_all long, v_main long, v_all long"


def part_of(doc_id) -> int:
    """Part of a document: crc32 of its id as text, modulo 5; 1 is held out, 0 gives weights. A null id has remainder 0."""
    r = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5
    return SCORED if r == 1 else DELETED if r == 0 else COUNTED


def pack(counts: np.ndarray) -> bytes:
    """Counts as a byte each; those of 255 and more again at the end, in eight."""
    big = counts >= 255
    return len(counts).to_bytes(8, "little") + np.where(big, 255, counts).astype(np.uint8).tobytes() + counts[big].astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    out = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8", -1, 8 + n) if len(data) > 8 + n else 0
    return out


def _planes(index: np.ndarray) -> bytes:
    """Indexes as their low 16 bits, then the next 8, then (where there are so many words) the rest."""
    parts = [(index & 0xFFFF).astype("<u2").tobytes(), ((index >> 16) & 0xFF).astype(np.uint8).tobytes()]
    if len(index) and int(index.max()) >> 24:
        parts.append((index >> 24).astype(np.uint8).tobytes())
    return b"".join(parts)


def _index(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, "<u2", n).astype(np.int32)
    out |= np.frombuffer(data, np.uint8, n, 2 * n).astype(np.int32) << 16
    if len(data) > 3 * n:
        out |= np.frombuffer(data, np.uint8, n, 3 * n).astype(np.int32) << 24
    return out


def _batch_row(ids: list, texts: list[bytes]) -> dict:
    w = Words([t.lower() for t in texts])
    hashes, n = w.hashes(), np.diff(w.offset)
    tokens = np.insert(hashes, w.offset[1:], END)  # one end after each text
    vocab, index = np.unique(np.concatenate([tokens, [END, BEGIN]]), return_inverse=True)
    return {
        "ids": [None if i is None else str(i) for i in ids],
        "parts": bytes(part_of(i) for i in ids),
        "sizes": (n + 1).astype("<i4").tobytes(),
        "vocab": vocab.astype("<u8").tobytes(),
        "tokens": _planes(index[:-2]),
        "n": len(tokens),
    }


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ids, texts, size = [], [], 0
    for rows in batches:
        for i, t in zip(rows["doc_id"].tolist(), rows["text"].tolist(), strict=True):
            ids.append(None if i is None else int(i))
            texts.append(b"" if t is None else t.encode("utf-8", "surrogatepass"))
            size += len(texts[-1])
            if size >= BATCH:
                yield pd.DataFrame([_batch_row(ids, texts)])
                ids, texts, size = [], [], 0
    if ids:
        yield pd.DataFrame([_batch_row(ids, texts)])


@dataclass
class Batch:
    """A batch as arrays: per token its word, its context, its document, and the part of that."""

    vocab: np.ndarray
    word: np.ndarray
    context: np.ndarray
    doc: np.ndarray
    part: np.ndarray

    @classmethod
    def of(cls, row) -> Batch:
        vocab, word = np.frombuffer(row["vocab"], "<u8"), _index(row["tokens"], int(row["n"]))
        sizes = np.frombuffer(row["sizes"], "<i4")
        parts = np.frombuffer(row["parts"], np.uint8)
        context = np.empty_like(word)
        context[1:] = word[:-1]
        context[np.cumsum(sizes, dtype=np.int64) - sizes] = np.searchsorted(vocab, BEGIN)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        return cls(vocab, word, context, doc, parts[doc])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, counted, deleted): the distinct words; of the begin mark, the documents."""
        n = len(self.vocab)
        begin, end = np.searchsorted(self.vocab, BEGIN), np.searchsorted(self.vocab, END)
        out = []
        for p in (COUNTED, DELETED):
            c = np.bincount(self.word[self.part == p], minlength=n)
            c[begin] = c[end]
            out.append(c)
        return self.vocab, *out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, counted, deleted, index): the distinct bigrams, and each token's."""
        key = mix64(self.vocab[self.context] * np.uint64(0x9E3779B97F4A7C15) + mix64(self.vocab[self.word]), 5)
        keys, index = np.unique(key, return_inverse=True)
        out = [np.bincount(index[self.part == p], minlength=len(keys)) for p in (COUNTED, DELETED)]
        return keys, *out, index


def parent_of(asker: int, groups: int) -> int:
    """The asker of the next level that speaks for this one."""
    return int(mix64(np.array([asker], np.uint64), 11)[0]) % groups


def _deal(asker: int, keys: np.ndarray, main: np.ndarray, held: np.ndarray, bits: int, groups: int) -> pd.DataFrame:
    """Sorted keys and their counts as questions: a row for each bucket (the first ``bits`` bits) that has some."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    spans = list(zip(first, [*first[1:], len(keys)], strict=True))
    return pd.DataFrame(
        {
            "batch": asker,
            "parent": parent_of(asker, groups),
            "bucket": bucket[first],
            "keys": [keys[a:z].astype("<u8").tobytes() for a, z in spans],
            "main": [pack(main[a:z]) for a, z in spans],
            "held": [pack(held[a:z]) for a, z in spans],
        }
    )


def _ask(kind: int, bits: int, groups: int):
    """Batches to questions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.to_dict("records"):
                b = Batch.of(row)
                yield _deal(row["batch"], *(b.words() if kind == 1 else b.pairs())[:3], bits, groups)

    return run


def _ask_on(bits: int, groups: int):
    """Sums of a level to questions of the next one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.to_dict("records"):
                keys = np.frombuffer(row["keys"], "<u8")
                yield _deal(row["batch"], keys, unpack(row["main"]), unpack(row["held"]), bits, groups)

    return run


def _union(questions) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(distinct keys, each asked key's place among them, where one question ends and the next begins)."""
    keys = [np.frombuffer(k, "<u8") for k in questions]
    known, index = np.unique(np.concatenate(keys), return_inverse=True)
    return known, index, np.cumsum([len(k) for k in keys])[:-1].tolist()


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """All questions of a parent in a bucket to their sum."""
    known, index, _ = _union(rows["keys"])
    sums = [np.bincount(index, np.concatenate([unpack(x) for x in rows[c]]), len(known)).astype(np.int64) for c in ("main", "held")]
    return pd.DataFrame(
        {"batch": [int(rows["parent"].iloc[0])], "keys": [known.astype("<u8").tobytes()], "main": [pack(sums[0])], "held": [pack(sums[1])]}
    )


def _pass_on(kind: int):
    """The questions of a parent in a bucket, and what the parent was told, to answers in the order of each question."""

    def run(asked: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        _, index, cuts = _union(asked["keys"])
        told = told.sort_values("fine")
        out = {"batch": asked["batch"].to_numpy(), "bucket": asked["bucket"].to_numpy(), "kind": kind}
        for c in ("main", "every"):
            counts = np.concatenate([unpack(x) for x in told[c]])
            out[c] = [pack(x) for x in np.split(counts[index], cuts)]
        return pd.DataFrame({**out, "n_main": 0, "n_all": 0, "v_main": 0, "v_all": 0})

    return run


def _answer(kind: int):
    """All questions of a bucket at the top to their answers, and a row of the bucket's totals (batch null)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        known, index, cuts = _union(rows["keys"])
        totals = []
        for c in ("main", "held"):
            each = np.concatenate([unpack(x) for x in rows[c]])
            totals.append(np.bincount(index, each, len(known)).astype(np.int64))
        main, held = totals
        out = pd.DataFrame(
            {
                "batch": rows["batch"].to_numpy(),
                "bucket": rows["bucket"].to_numpy(),
                "kind": kind,
                "main": [pack(x) for x in np.split(main[index], cuts)],
                "every": [pack(x) for x in np.split((main + held)[index], cuts)],
                "n_main": 0, "n_all": 0, "v_main": 0, "v_all": 0,
            }
        )
        word = known != BEGIN
        both = main + held
        out.loc[len(out)] = [
            -1, rows["bucket"].iloc[0], kind, b"", b"",
            int(main[word].sum()), int(both[word].sum()), int((main[word] > 0).sum()), int((both[word] > 0).sum()),
        ]
        return out

    return run


@dataclass
class Totals:
    n_main: int = 0
    n_all: int = 0
    v_main: int = 0
    v_all: int = 0


def _answers(rows: pd.DataFrame, kind: int) -> np.ndarray:
    """The counts that a batch was told, in the order of its keys."""
    own = rows[rows["kind"] == kind].sort_values("bucket")
    return np.concatenate([unpack(x) for x in own["counts"]])


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0, then one for each doubling."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


def _cell(p: np.ndarray) -> np.ndarray:
    """Histogram cell of an estimate: 0 for none, else 1 + its halvings in steps of 1 / GRID."""
    return np.where(p > 0, 1 + np.round(-np.log2(np.maximum(p, 1e-300)) * GRID), 0).astype(np.int64)


def _ids(texts) -> list:
    return [None if i is None else int(i) for i in texts]


def _histogram(t: Totals):
    """A batch and its answers to (bucket, cell of the bigram estimate, cell of the unigram estimate, tokens)."""

    def run(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        b = Batch.of(batch.iloc[0])
        main, pair = _answers(answers, 1), _answers(answers, 2)
        *_, index = b.pairs()
        use = b.part == DELETED
        v, w, vw = main[b.context[use]], main[b.word[use]], pair[index[use]]
        cells = np.stack([bucket_of(v), _cell(vw / np.maximum(v, 1)), _cell(w / max(t.n_main, 1))], axis=1)
        got, n = np.unique(cells, axis=0, return_counts=True)
        return pd.DataFrame({"b": got[:, 0], "x2": got[:, 1], "x1": got[:, 2], "n": n}).astype("int64")

    return run


def learn(cells: pd.DataFrame, uniform: float, rounds: int = 100) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) for each bucket, by expectation-maximisation.

    Starts from equal weights. One token's worth is added to every weight, so
    that none becomes zero; a bucket without held-out tokens gets the weights
    learned from all of them. Contexts that were never seen have no bigram
    estimate: their share of it goes to the others.
    """
    top = max(64, int(cells["b"].max()) + 1 if len(cells) else 1)

    def em(c: pd.DataFrame, seen: bool) -> np.ndarray:
        n = c["n"].to_numpy(np.float64)
        p = np.stack(
            [
                np.where(c["x2"] > 0, 2.0 ** (-(c["x2"] - 1) / GRID), 0) * seen,
                np.where(c["x1"] > 0, 2.0 ** (-(c["x1"] - 1) / GRID), 0),
                np.full(len(c), uniform),
            ],
            axis=1,
        )
        live = np.array([float(seen), 1, 1])
        w = live / live.sum()
        for _ in range(rounds):
            share = p * w
            total = (n[:, None] * share / np.maximum(share.sum(1, keepdims=True), 1e-300)).sum(0) + live
            w = total / total.sum()
        return w

    pooled = em(cells[cells["b"] > 0], True)
    out = np.tile(pooled, (top, 1))
    out[0] = em(cells[cells["b"] == 0], False)
    for b in sorted(set(cells["b"]) - {0}):
        out[b] = em(cells[cells["b"] == b], True)
    return out


def _scores(t: Totals, weights: np.ndarray):
    """A batch and its answers to a row for each document."""

    def run(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = batch.iloc[0]
        b = Batch.of(row)
        every, pair = _answers(answers, 1), _answers(answers, 2)
        *_, index = b.pairs()
        v, w = every[b.context], every[b.word]
        mix = weights[bucket_of(v)]
        p = mix[:, 0] * pair[index] / np.maximum(v, 1) + mix[:, 1] * w / max(t.n_all, 1) + mix[:, 2] / (t.v_all + 1)
        base = np.log10((w + 0.5) / (t.n_all + 0.5 * (t.v_all + 1)))
        n = len(row["ids"])
        add = lambda x: np.bincount(b.doc, x, n)
        sizes = np.frombuffer(row["sizes"], "<i4")
        return pd.DataFrame(
            {
                "doc_id": pd.array(_ids(row["ids"]), dtype="Int64"),
                "held_out": np.frombuffer(row["parts"], np.uint8) == SCORED,
                "n_tokens": sizes.astype(np.int64),
                "n_known": add(w > 0).astype(np.int64),
                "train_tokens": t.n_all,
                "base_score": add(base),
                "score": add(np.log10(p)),
            }
        )

    return run


def _tasks(spark, size: int, each: int) -> int:
    """Tasks for ``size`` things of which one task takes about ``each``; not fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def _round(stage: Stage, rows: DataFrame, kind: int) -> tuple[DataFrame, DataFrame]:
    """Every batch's answers (of words, kind 1, or bigrams, kind 2), and the rows of totals."""
    spark = rows.sparkSession
    size = F.octet_length("vocab") / 8 if kind == 1 else F.col("n")
    askers, keys = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0)).cast("long")).first()
    below, source, bits = [], None, 3  # below: questions of each level that were added up, and their buckets' bits
    while True:
        groups = max(1, -(-askers // FAN))
        bits = max(bits, (keys // groups // PER_BUCKET).bit_length())  # finer from level to level: buckets nest
        tasks = _tasks(spark, keys, TASK_KEYS)
        if source is None:
            asked = rows.mapInPandas(_ask(kind, bits, groups), QUESTION)
        else:
            asked = source.mapInPandas(_ask_on(bits, groups), QUESTION)
        if groups == 1:
            break
        asked = stage.table(asked)
        below.append((asked, bits, tasks))
        near = asked.repartition(tasks, "parent", "bucket")
        source = stage.table(near.groupBy("parent", "bucket").applyInPandas(_merge, MERGED))
        askers, keys = groups, source.agg(F.sum(F.octet_length("keys") / 8).cast("long")).first()[0]
    top = stage.table(asked.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(_answer(kind), ANSWER))
    answers, fine = top, bits
    for asked, bits, tasks in reversed(below):
        told = answers.filter("batch >= 0").select(
            F.col("batch").alias("parent"),
            F.shiftright("bucket", fine - bits).alias("bucket"),
            F.col("bucket").alias("fine"),
            "main",
            "every",
        )
        pair = [x.repartition(tasks, "parent", "bucket").groupBy("parent", "bucket") for x in (asked, told)]
        answers = stage.table(pair[0].cogroup(pair[1]).applyInPandas(_pass_on(kind), ANSWER))
        fine = bits
    return answers, top.filter("batch < 0")


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each row of ``docs``.

    Null and empty texts are one end token. Repeated rows each count and are
    each scored. A null id trains (remainder 0). Without training documents N
    and V are 0, all estimates but the uniform one are 0, and every score is 0.
    An empty table gives an empty result. Words and bigrams are told apart by
    64-bit hashes. Scores add up in token order in double precision.
    """
    spark = docs.sparkSession
    prepare(spark)
    stage = Stage(spark, "ngram-lm")
    schema = "ids array<string>, parts binary, sizes binary, vocab binary, tokens binary, n long"
    # ids as text: a long column with nulls would reach pandas as floating point
    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")
    rows = texts.mapInPandas(_batches, schema)
    rows = stage.table(rows.withColumn("batch", F.monotonically_increasing_id()))  # fixed once written

    words, totals = _round(stage, rows, 1)
    total = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_main", "n_all", "v_main", "v_all")])
    t = Totals(**total.first().asDict())
    pairs, _ = _round(stage, rows, 2)
    answers = words.unionByName(pairs).filter("batch >= 0")
    tasks = _tasks(spark, rows.count(), TASK_BATCHES)

    def told(counts: str):  # each pass moves the one column that it needs
        own = answers.select("batch", "bucket", "kind", F.col(counts).alias("counts"))
        return rows.repartition(tasks, "batch").groupBy("batch").cogroup(own.repartition(tasks, "batch").groupBy("batch"))

    both = told("main")
    cells = both.applyInPandas(_histogram(t), "b long, x2 long, x1 long, n long")
    cells = stage.table(cells.groupBy("b", "x2", "x1").agg(F.sum("n").alias("n"))).orderBy("b", "x2", "x1").toPandas()
    weights = learn(cells, 1.0 / (t.v_main + 1))
    if not t.n_all:  # nothing was learned: the uniform estimate alone
        weights[:] = 0, 0, 1
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return told("every").applyInPandas(_scores(t, weights), out)
