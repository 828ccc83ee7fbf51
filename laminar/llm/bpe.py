"""Byte-level BPE: a bounded-lookahead streaming encoder and an incremental decoder.

Encoding a piece (a pre-token) left to right keeps, for every prefix, the last token of
the prefix's encoding. A token sequence is the encoding of its bytes exactly if every two
neighbours are the encoding of their own bytes, so the last token of a prefix is the one
whose start prefix ends in a compatible token; without it the rest is the encoding of
the shorter prefix. Hence the encodings of all prefixes form a tree. Whatever follows,
the final path runs through one of the last L prefixes, L being the longest token in
bytes: the merge list's sufficient lookahead. Tokens below the point where the paths of
these L prefixes meet are stable: they are emitted and forgotten. Memory is bounded by
the lookahead, not by the piece. The tokens that end at each byte come from an automaton
over the vocabulary.

Whether two neighbours stay apart is read off the merge list: as ranks go up, the last token
of the left one and the first token of the right one grow step by step, and the two meet as
a pair only if that pair's merge comes before the next step of either.

Ids leave in blocks; the decoder maps them to bytes and runs a UTF-8 state machine over
block limits, so that neither the ids nor the decoded text of a long text are held whole
(``round_trip``). ``encode`` and ``decode`` give and take arrays of ids.

Scale: no shuffle. The model file (a few MB, its size is fixed) is read once by the
driver and broadcast; workers keep a bounded cache of recent pieces, each with the bytes of
its ids and the bytes that its ids stand for.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm.common import small_batches, workers_import_package

# Fixed value: how byte-level models cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_PIECES = 120_000  # pieces of the younger and of the older half of the cache
CACHE_PAIRS = 300_000
CACHE_BYTES = 64  # longer pieces are not worth keeping
BLOCK = 8_192  # pieces, or ids of a long piece, handed on at a time
NEVER = float("inf")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 bytes
    stand for themselves, the others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Model:
    """Tables of a byte-level BPE model and the two transducers."""

    def __init__(self, text: str):
        import regex

        spec = json.loads(text)
        letter = byte_letters()
        to_bytes = lambda token: bytes(letter[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.id_of = {to_bytes(t): i for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.lookahead = max(map(len, self.id_of))
        self.window = 2 * self.lookahead
        self.tokens = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for data, i in self.id_of.items():
            self.tokens.add_word(data.decode("latin-1"), (i, len(data)))
        self.tokens.make_automaton()
        self.made_of, self.in_order = self._splits()
        self.find = regex.compile(PIECES).finditer
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
            if self.special
            else lambda s: [s]
        )
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})

    def _splits(self) -> tuple[dict[int, tuple[int, int, int]], bool]:
        """(token -> rank and parts of its merge, whether the merge list is in order: each
        token made by one merge, after its parts)."""
        made_of: dict[int, tuple[int, int, int]] = {}
        in_order = True
        for (a, b), (rank, token) in self.merges.items():
            in_order &= token not in made_of
            made_of[token] = (rank, a, b)
        for rank, a, b in made_of.values():
            in_order &= all(p not in made_of or made_of[p][0] < rank for p in (a, b))
        return made_of, in_order

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """How the last (side 1) or first (side 0) token within a token grows: each with the
        rank at which it is merged into the next."""
        known = self.edges[side].get(token)
        if known is None:
            known, ends = [], NEVER
            while True:
                known.append((token, ends))
                made = self.made_of.get(token)
                if made is None:
                    break
                ends, token = made[0], made[2 if side else 1]
            known.reverse()
            self.edges[side][known[-1][0]] = known
        return known

    def merged(self, data: bytes) -> list[int]:
        """Encoding of a short piece: the merge of lowest rank first, wherever it occurs."""
        ids = [self.byte_id[b] for b in data]
        get = self.merges.get
        while len(ids) > 1:
            best = None
            for pair in zip(ids, ids[1:]):
                m = get(pair)
                if m is not None and (best is None or m < best):
                    best, at = m, pair
            if best is None:
                break
            out, i, n = [], 0, len(ids)
            while i < n:
                if i + 1 < n and ids[i] == at[0] and ids[i + 1] == at[1]:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def alone(self, token: int) -> bool:
        """Whether a token is the encoding of its own bytes."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self.merged(self.bytes_of[token]) == [token]
        return known

    def apart(self, a: int, b: int) -> bool:
        """Whether b may follow a, both alone: no merge ever crosses their border."""
        if not self.in_order:
            return self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        get = self.merges.get
        left, right = iter(self.edge(a, 1)), iter(self.edge(b, 0))
        (x, x_ends), (y, y_ends) = next(left), next(right)
        while True:
            crossing = get((x, y))
            # of equal ranks the leftmost goes first
            if crossing is not None and crossing[0] < x_ends and crossing[0] <= y_ends:
                return False
            if x_ends == NEVER and y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                x, x_ends = next(left)
            else:
                y, y_ends = next(right)

    def compatible(self, a: int | None, b: int) -> bool:
        """Whether b may follow a (None: whether b may come first)."""
        if a is None:
            return self.alone(b)
        key = a << 32 | b
        known = self.fits.get(key)
        if known is None:
            known = self.alone(b) and self.apart(a, b)
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            self.fits[key] = known
        return known

    def stream(self, data: bytes) -> Iterator[int]:
        """Encoding of a piece of any length, emitting tokens once they are stable."""
        base, done = 0, 0
        last: dict[int, int | None] = {0: None}
        start = {0: 0}
        fits, compatible = self.fits.get, self.compatible
        for at_end, (token, size) in self.tokens.iter(data.decode("latin-1")):
            end = at_end + 1
            if end == done:  # the last token of this prefix is known
                continue
            if done - base >= 2 * self.window and (done - base) % self.lookahead == 0:
                first = max(base + 1, done - self.lookahead + 1)
                meet = self._meeting([p for p in range(first, done + 1) if p in last], start)
                yield from self._path(base, meet, last, start)
                base = meet
                last = {p: t for p, t in last.items() if p >= base}
                start = {p: s for p, s in start.items() if p >= base}
            at = end - size
            if at not in last or at < base:
                continue
            before = last[at]
            known = None if before is None else fits(before << 32 | token)
            if known or known is None and compatible(before, token):
                last[end], start[end] = token, at
                done = end
        yield from self._path(base, len(data), last, start)

    def stream_short(self, data: bytes) -> array:
        """The transducer on a piece no longer than the window, where nothing is stable before
        the end: the last token of every prefix, then the path from the end."""
        last, start = [0] * (len(data) + 1), [0] * (len(data) + 1)
        fits, compatible, done = self.fits, self.compatible, 0
        for end, (token, size) in self.tokens.iter(data.decode("latin-1")):
            if end < done:  # the last token of the prefix data[:end + 1] is known
                continue
            at = end + 1 - size
            if at:
                before = last[at]
                key = before << 32 | token
                if not (fits[key] if key in fits else compatible(before, token)):
                    continue
            elif not compatible(None, token):
                continue
            done = end + 1
            last[done], start[done] = token, at
        path = array("I")
        while done:
            path.append(last[done])
            done = start[done]
        path.reverse()
        return path

    @staticmethod
    def _path(base: int, at: int, last: dict, start: dict) -> list[int]:
        path = []
        while at > base:
            path.append(last[at])
            at = start[at]
        path.reverse()
        return path

    @staticmethod
    def _meeting(ends: list[int], start: dict[int, int]) -> int:
        """The latest prefix that lies on the paths of all the given ones."""
        heap = [-p for p in ends]
        heapq.heapify(heap)
        while True:
            top = -heapq.heappop(heap)
            while heap and -heap[0] == top:
                heapq.heappop(heap)
            if not heap:
                return top
            heapq.heappush(heap, -start[top])

    def _kept(self, piece: str, data: bytes) -> tuple[bytes, bytes]:
        """(bytes of the ids, bytes they stand for) of a short piece, from the cache or anew."""
        known = self.old.get(piece)
        if known is None:
            ids = self.stream_short(data)
            known = (_little_endian(ids), b"".join([self.bytes_of[i] for i in ids]))
        if len(self.young) >= CACHE_PIECES:
            self.old, self.young = self.young, {}
        self.young[piece] = known
        return known

    def blocks(self, text: str) -> Iterator[tuple[bytes, bytes]]:
        """The ids of a text as little-endian 32-bit integers and the bytes they stand for,
        block by block."""
        for part in self.split(text) if self.special else [text]:
            if part in self.special:
                i = self.special[part]
                yield _little_endian(array("I", [i])), self.bytes_of[i]
                continue
            ids: list[bytes] = []
            said: list[bytes] = []
            for found in self.find(part):
                piece = found.group()
                known = self.young.get(piece)
                if known is None:
                    data = piece.encode()
                    if len(data) > CACHE_BYTES:
                        yield b"".join(ids), b"".join(said)
                        ids, said = [], []
                        stream = self.stream(data)
                        while some := array("I", islice(stream, BLOCK)):
                            yield _little_endian(some), b"".join([self.bytes_of[i] for i in some])
                        continue
                    known = self._kept(piece, data)
                ids.append(known[0])
                said.append(known[1])
                if len(ids) >= BLOCK:
                    yield b"".join(ids), b"".join(said)
                    ids, said = [], []
            yield b"".join(ids), b"".join(said)

    def encode(self, text: str) -> list[int]:
        ids = array("I")
        for block, _ in self.blocks(text):
            ids.frombytes(block)
        if sys.byteorder != "little":
            ids.byteswap()
        return ids.tolist()

    def decoder(self) -> tuple[Callable[[array], str], Callable[[], str]]:
        """(feed, end): text of a block of ids as far as its characters are whole, and what
        is left at the end. Unknown ids are passed over; bytes that are no UTF-8 become
        U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        get = self.bytes_of.get

        def feed(ids) -> str:
            return machine.decode(b"".join([get(i, b"") for i in ids]))

        return feed, lambda: machine.decode(b"", True)

    def decode(self, ids) -> str:
        feed, end = self.decoder()
        return feed(ids) + end()

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids, sha256 of the decoded text) in constant memory."""
        count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for ids, data in self.blocks(text):
            count += len(ids) // 4
            ids_hash.update(ids)
            text_hash.update(machine.decode(data).encode())
        text_hash.update(machine.decode(b"", True).encode())
        return count, ids_hash.hexdigest(), text_hash.hexdigest()


def _little_endian(block: array) -> bytes:
    if sys.byteorder != "little":
        block = array("I", block)
        block.byteswap()
    return block.tobytes()


_LOADED: dict[int, Model] = {}


def _model(shared) -> Model:
    """The worker's copy of a broadcast model, kept as long as the worker lives."""
    key = hash(shared.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Model(shared.value)
    return _LOADED[key]


def load(spark: SparkSession, path: str):
    """Broadcast of a tokenizers JSON file (byte-level BPE)."""
    workers_import_package()
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(text: Column, model) -> Column:
    """array<int> of ids; null counts as empty."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        m = _model(model)
        return pd.Series([m.encode(t) if t else [] for t in texts])

    return ids(text)


def decode(ids: Column, model) -> Column:
    """Text of an array of ids; null counts as empty."""

    @F.pandas_udf("string")
    def text(arrays: pd.Series) -> pd.Series:
        m = _model(model)
        return pd.Series([m.decode(a) if a is not None else "" for a in arrays])

    return text(ids)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (text, anything else) with a struct column ``bpe``: n_tokens, ids_sha256
    (ids as little-endian unsigned 32-bit integers), decoded_sha256.

    Null texts count as empty: no tokens, the hashes of nothing. Repeated rows are alike; an
    empty table gives an empty result; other columns stay as they are.
    """
    if "bpe" in docs.columns:
        raise ValueError("rename the column bpe first")
    model = load(docs.sparkSession, path)
    small_batches(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        m = _model(model)
        rows = [m.round_trip(t or "") for t in texts]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn("bpe", digests(docs["text"]))
