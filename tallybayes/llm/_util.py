"""Helpers shared by the operators: staged tables, names, word arrays."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.operators.owner import delete_folder, note_folder

# ASCII white space: the separators of [^\x20\x09-\x0D]+
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MAX_ARROW_ROWS, MAX_ARROW_BYTES = 250, 16 << 20
NO_ID = 2**63 - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.

    Where the session names none, a local master may fall back to a
    ``checkpoints`` folder beside its warehouse; off local mode that is refused.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """While a staged table is written, its shuffle files go as soon as it is whole."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make a session ready for the Python side of an operator.

    Executors get this package through Spark (once per application), and
    texts, which may be very long, go to Python at most 250 or 16 MiB at a time.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        with tempfile.NamedTemporaryFile(prefix=f"{package.name}-", suffix=".zip", delete=False) as f:
            with zipfile.ZipFile(f, "w") as z:
                for p in sorted(package.rglob("*.py")):
                    z.write(p, p.relative_to(package.parent).as_posix())
        sc.addPyFile(f.name)
        _SHIPPED.add(sc.applicationId)
    if int(spark.conf.get(ARROW_ROWS)) > MAX_ARROW_ROWS or int(spark.conf.get(ARROW_ROWS)) <= 0:
        spark.conf.set(ARROW_ROWS, str(MAX_ARROW_ROWS))
    spark.conf.set(ARROW_BYTES, str(MAX_ARROW_BYTES))


class Stage:
    """Tables written to the shared folder: they outlive lost executors and cut lineage.

    ``drop`` removes a table that no later plan reads. What a returned lazy
    DataFrame still reads stays until its owner is released: an open ``Scope``, or
    the result of a registered query.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        note_folder(self.base)
        self.paths: dict[int, str] = {}
        self.tables: list[DataFrame] = []  # alive, so that their ids stay theirs

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{len(self.paths)}"
        with _shuffle_cleanup(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.tables.append(out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete_folder(self.spark, self.paths[id(t)])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have (whatever its extra columns are called)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(c):
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def n_words(text):
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# -- word arrays -----------------------------------------------------------------
_WS = np.zeros(256, bool)
_WS[[32, 9, 10, 11, 12, 13]] = True
_U64 = np.uint64
_MUL = _U64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240613)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = _U64(0xD1B54A32D192ED03)
_POW = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    """_BASE ** 0..n-1 modulo 2**64; grown when a longer word comes."""
    global _POW
    if len(_POW) < n:
        p = np.full(max(n, 64), _BASE, np.uint64)
        p[0] = 1
        _POW = np.multiply.accumulate(p)
    return _POW


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """The splitmix64 finaliser on an array of 64-bit values."""
    x = x + _U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end byte of each word of a byte array."""
    word = np.empty(len(buf) + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(_WS[buf], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words: a polynomial of random byte values, then mixed with the length."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    flat = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    value = _BYTE[buf[~_WS[buf]]] * _powers(int(length.max()))[flat]
    sums = np.add.reduceat(value, np.cumsum(length) - length)
    return mix64(sums ^ (length.astype(np.uint64) * _MUL))


def text_chunks(texts, max_bytes: int = 1 << 22):
    """Yield (first, bytes list) runs of about ``max_bytes`` (one longer text may stand alone)."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = b"" if t is None else t.encode("utf-8", "surrogatepass")
        if held and size + len(b) > max_bytes:
            yield first, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield first, held


class Words:
    """The words of a run of texts as arrays: byte spans, hashes, and each text's first word."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts)
        self.buf = np.frombuffer(self.data, np.uint8)
        self.start, self.end = word_spans(self.buf)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.offset = np.searchsorted(self.start, bounds)  # words of text i: offset[i] to offset[i + 1]
        self.offset[-1] = len(self.start)

    def hashes(self) -> np.ndarray:
        return word_hashes(self.buf, self.start, self.end)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offset) - 1), np.diff(self.offset))
