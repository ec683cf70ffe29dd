"""Byte-level BPE: encoding by a transducer of compatible tokens, decoding by a UTF-8 state machine.

Encoding. A token sequence is the BPE encoding of its bytes exactly when every
adjacent pair of tokens is: the merges leave both tokens of the pair as they
are. So the merges compile into a nondeterministic transducer whose states are
(last token written, trie node of the token being read); for every prefix of a
text one path alone ends at a token boundary. ``Transducer`` follows the longest
token first and goes back where no token may follow; a place found dead is not
tried again, so each place is read once for each token that ends there. The
moves (may this token follow that one?) are worked out when first needed.

A text is split at plain spaces that follow a non-space, where no match of the
pattern can cross, so a word met before needs neither the pattern nor the
transducer. The table of moves is flushed when it is full; of the words and
pieces already encoded the older go, but for those met again. So memory
is bounded for any text. Neither changes a result.

Decoding. ``Utf8Decoder`` takes the bytes of a token at a time and gives the
characters that are complete; its state is the bytes still expected and the
range allowed for the next one. Malformed bytes become U+FFFD as Python's
``errors="replace"`` has it.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

MAX_STATES = 200_000
MAX_PIECES = 500_000
NEVER = 1 << 60
CUT = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: base64 token and rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class Transducer:
    """Transducer from bytes to BPE ids, its moves made when needed."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"{len(missing)} single bytes have no rank")
        self.ranks, self.max_states = ranks, max_states
        self.text = {r: t for t, r in ranks.items()}
        # trie: node 0 is the root; child[(node << 8) | byte], token[node] or -1
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        for t, r in ranks.items():
            node = 0
            for b in t:
                key = (node << 8) | b
                node = self.child.get(key) or self._node(key)
            self.token[node] = r
        # of each token: its bytes' number, and the longest token that it starts with (-1: none)
        self.size = {r: len(t) for t, r in ranks.items()}
        self.shorter = {r: next((ranks[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in ranks), -1) for t, r in ranks.items()}
        self.edge: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}

    def _node(self, key: int) -> int:
        self.child[key] = len(self.token)
        self.token.append(-1)
        return len(self.token) - 1

    def _edges(self, t: int) -> tuple | None:
        """How the merges make a token: its first and its last part over time, each with the rank that absorbs it.

        None for a token that the merges don't make of its own bytes: it is written for a whole piece only.
        """
        if t in self.edge:
            return self.edge[t]
        ranks, text = self.ranks, self.text[t]
        parts = [text[i : i + 1] for i in range(len(text))]
        left, right = [], []
        while len(parts) > 1:
            options = [ranks.get(parts[i] + parts[i + 1], NEVER) for i in range(len(parts) - 1)]
            low = min(options)
            if low == NEVER:
                break
            i = options.index(low)
            if i == 0:
                left.append((parts[0], low))
            if i == len(parts) - 2:
                right.append((parts[-1], low))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        whole = len(parts) == 1 and ranks[parts[0]] == t
        self.edge[t] = ([*left, (text, NEVER)], [*right, (text, NEVER)]) if whole else None
        return self.edge[t]

    def _pair(self, a: int, b: int) -> bool:
        """May ``b`` follow ``a``: do the merges of both together leave them as they are?

        They do unless, at some time, the last part of ``a`` and the first part
        of ``b`` merge before either is absorbed by a merge of its own; of equal
        ranks the leftmost goes first.
        """
        if (after := self._edges(b)) is None:
            return False
        if a < 0:
            return True
        if len(self.pairs) > 5 * self.max_states:
            self.pairs.clear()
        ends, starts, i, j, ok = self.edge[a][1], after[0], 0, 0, True
        while True:
            (x, till_x), (y, till_y) = ends[i], starts[j]
            across = self.ranks.get(x + y, NEVER)
            if across < till_x and across <= till_y and across != NEVER:
                ok = False
                break
            if till_x == till_y == NEVER:
                break
            if till_x <= till_y:
                i += 1
            else:
                j += 1
        self.pairs[(a << 32) | b] = ok
        return ok

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token as a whole is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        child, token, known, size, shorter = self.child.get, self.token, self.pairs.get, self.size, self.shorter
        out: list[int] = []
        dead: set[int] = set()  # places from which no path reaches the end
        at, last, n = 0, -1, len(piece)
        while at < n:
            node, t, i = 0, -1, at
            while i < n and (node := child((node << 8) | piece[i])):
                if token[node] >= 0:
                    t = token[node]
                i += 1
            while True:  # the longest token that may follow, else back to a shorter one before it
                if t < 0:
                    dead.add(at)
                    t = out.pop()
                    at -= size[t]
                    last = out[-1] if out else -1
                elif at + size[t] not in dead:
                    ok = known((last << 32) | t)
                    if ok or (ok is None and self._pair(last, t)):
                        break
                t = shorter[t]
            out.append(t)
            at += size[t]
            last = t
        return out


def blocks(text: str, size: int = CUT) -> Iterator[str]:
    """The text in runs that can be split into pieces one by one.

    A run ends before a plain space that follows a non-space: no match of the
    pattern has both, so matches are the same as over the whole text.
    """
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class Encoder:
    """Texts to ids: words, then pattern pieces, then the transducer, each word and piece once while it is held."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = MAX_PIECES):
        self.machine = Transducer(ranks)
        self.findall = regex.compile(pattern).findall
        self.max_pieces = max_pieces
        # words by themselves, as they are after a plain space; pieces
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_words, self.old_pieces = self.words, self.pieces

    def _make_room(self) -> None:
        """Where the room is taken, what is held turns old and what was old is given up."""
        if len(self.words) + len(self.pieces) > self.max_pieces:
            self.old_words, self.old_pieces = self.words, self.pieces
            self.words, self.pieces = {}, {}

    def _piece(self, piece: str, hold: bool) -> bytes:
        """The ids of a piece that ``pieces`` lacks."""
        if (ids := self.old_pieces.get(piece)) is None:
            found = self.machine.encode(piece.encode("utf-8", "surrogatepass"))
            ids = struct.pack(f"<{len(found)}I", *found)
        if hold and len(piece) <= 64:
            self.pieces[piece] = ids
        return ids

    def _chunk(self, chunk: str, hold: bool = True) -> bytes:
        """The ids of text that no match crosses the ends of; ``hold`` is false where they are held as a word."""
        pieces = self.findall(chunk)
        if len(pieces) == 1:
            return self.pieces.get(pieces[0]) or self._piece(pieces[0], hold)
        get = self.pieces.get
        return b"".join([get(p) or self._piece(p, True) for p in pieces])

    def _word(self, word: str) -> bytes:
        """The ids of a word that ``words`` lacks, with the plain space before it."""
        short = len(word) <= 64
        if (ids := self.old_words.get(word)) is None:
            ids = self._chunk(" " + word, hold=not short)
        if short:
            self.words[word] = ids
        return ids

    def _run(self, run: str) -> bytes:
        """The ids of a run, word by word; what does not end in a non-space goes with the word after it."""
        words = run.split(" ")
        ids = list(map(self.words.get, words))
        ids[0] = None if words[0] else b""  # no space before it
        i, last = -1, len(words) - 1
        for _ in range(ids.count(None)):
            try:
                i = ids.index(None, i + 1)
            except ValueError:  # those that went with a word before them
                break
            j = i
            while j < last and (not words[j] or words[j][-1].isspace()):
                j += 1
            if 0 < i == j and words[i] and not words[i][-1].isspace():
                ids[i] = self._word(words[i])
            else:
                ids[i] = self._chunk((" " if i else "") + " ".join(words[i : j + 1]))
                ids[i + 1 : j + 1] = [b""] * (j - i)
        return b"".join(ids)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; null is the empty text."""
        out = []
        for run in blocks(text or ""):
            self._make_room()
            out.append(self._run(run))
        return b"".join(out)


class Utf8Decoder:
    """Incremental UTF-8: state is (bytes still expected, range of the next one, bytes held back)."""

    def __init__(self):
        self.need, self.low, self.high, self.held = 0, 0x80, 0xBF, b""

    def _lead(self, b: int) -> tuple[int, int, int] | None:
        """Bytes that follow a lead byte, and the range of the first of them."""
        if 0xC2 <= b <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= b <= 0xEF:
            return 2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
        if 0xF0 <= b <= 0xF4:
            return 3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
        return None

    def feed(self, data: bytes) -> str:
        """Characters that ``data`` completes."""
        if not self.need:  # the usual case: whole characters, no byte held back
            try:
                return data.decode("utf-8")
            except UnicodeDecodeError:
                pass
        out: list[str] = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.held += bytes([b])
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(self.held.decode("utf-8"))
                        self.held = b""
                    continue
                out.append("�")
                self.need, self.held, self.low, self.high = 0, b"", 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif lead := self._lead(b):
                self.need, self.low, self.high = lead
                self.held = bytes([b])
            else:
                out.append("�")
        return "".join(out)

    def finish(self) -> str:
        """What remains at the end: U+FFFD for an unfinished character."""
        left, self.need, self.held, self.low, self.high = bool(self.need), 0, b"", 0x80, 0xBF
        return "�" if left else ""


class Decoder:
    """Ids to bytes or text, a block of tokens at a time."""

    def __init__(self, ranks: dict[bytes, int], block: int = 4096):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.block = block

    def chunks(self, ids: np.ndarray) -> Iterator[bytes]:
        for i in range(0, len(ids), self.block):
            yield b"".join(map(self.tokens.__getitem__, ids[i : i + self.block].tolist()))

    def text(self, ids: Iterable[int]) -> str:
        """The text of the ids, decoded as a stream."""
        machine = Utf8Decoder()
        return "".join([machine.feed(c) for c in self.chunks(np.asarray(ids, "<u4"))] + [machine.finish()])


_CACHE: dict[tuple, tuple[Encoder, Decoder]] = {}


def _codec(vocabulary: str, pattern: str) -> tuple[Encoder, Decoder]:
    """The worker's own codec; made once, as the vocabulary is a file of every machine."""
    key = (vocabulary, pattern)
    if key not in _CACHE:
        _CACHE.clear()
        ranks = read_ranks(vocabulary)
        _CACHE[key] = Encoder(ranks, pattern), Decoder(ranks)
    return _CACHE[key]


ENCODED = StructType([StructField("n_tokens", IntegerType()), StructField("ids", BinaryType())])


def encode(text: Column, vocabulary: str, pattern: str) -> Column:
    """Struct (n_tokens, ids) of a text column; ids are packed little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a rank file present on every machine. Null
    and empty texts have no ids. Texts of any length are encoded whole.
    """

    @F.pandas_udf(ENCODED)
    def run(texts: pd.Series) -> pd.DataFrame:
        coder, _ = _codec(vocabulary, pattern)
        ids = [coder.encode(t) for t in texts]
        return pd.DataFrame({"n_tokens": [len(i) // 4 for i in ids], "ids": ids})

    return run(text)


def decode(ids: Column, vocabulary: str, pattern: str) -> Column:
    """Text of packed ids (null: empty), by the streaming decoder."""

    @F.pandas_udf(StringType())
    def run(packed: pd.Series) -> pd.Series:
        _, coder = _codec(vocabulary, pattern)
        return pd.Series([coder.text(np.frombuffer(p or b"", "<u4")) for p in packed], dtype=object)

    return run(ids)


def unpack(ids: Column) -> Column:
    """Packed ids as an array of integers."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def run(packed: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(p or b"", "<u4").astype(np.int32) for p in packed], dtype=object)

    return run(ids)
