"""Byte-level BPE: a minimal perfect hash for pre-tokens in the vocabulary, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array

import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from . import common

# Unicode's White_Space, and letters and numbers below U+0250. Python's own classes differ from them.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACE_LOW = "\\t-\\r \\x85\\xa0"
LETTER_LOW = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBER_LOW = "0-9²³¹¼-¾"


def _pattern(space: str, letter: str, number: str) -> str:
    """The public pre-token pattern with its classes spelt out."""
    classes = {r"\s": space, r"\p{L}": letter, r"\p{N}": number}
    spelt = lambda part: "".join(classes.get(x, x) for x in re.findall(r"\\p\{\w\}|\\?.", part))

    def one(m: re.Match) -> str:
        return spelt(m[0]) if m[0].startswith("[") else f"[^{space}]" if m[0] == r"\S" else f"[{classes[m[0]]}]"

    return re.sub(r"\[[^]]*\]|\\p\{\w\}|\\[sS]", one, public_tokenizers.PATTERN)


_ANY = regex.compile(_pattern(SPACE, r"\p{L}", r"\p{N}"))
_LOW = re.compile(_pattern(SPACE_LOW, LETTER_LOW, NUMBER_LOW))
_HIGH = re.compile("[^\x00-ɏ]")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text; texts below U+0250 take a faster matcher with the same classes."""
    return (_ANY if _HIGH.search(text) else _LOW).findall(text)


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a tiktoken vocabulary file by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * (1 + max(int(b) for _, b in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """A minimal perfect hash of distinct byte strings: hash and displace, buckets of four, largest first.

    ``slot`` gives each key its own place in 0..n-1; other strings get some place, so the caller compares the key there.
    """

    def __init__(self, keys: list[bytes], shift: array | None = None):
        """``shift``: the displacements of an earlier build over the same keys."""
        n = self.n = len(keys)
        self.m = max(1, n // 4)
        if shift is not None:
            self.shift = shift
            return
        buckets: list[list[int]] = [[] for _ in range(self.m)]
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for h in hashes:
            buckets[h % self.m].append(h)
        self.shift, taken = array("q", [0]) * self.m, bytearray(n)
        free = 0
        for b in sorted(range(self.m), key=lambda b: -len(buckets[b])):
            if not buckets[b]:
                break
            if len(buckets[b]) == 1:  # any free place: stored itself, negative
                while taken[free]:
                    free += 1
                taken[free], self.shift[b] = 1, -free - 1
                continue
            d = 1
            while True:
                places = {self._place(h, d) for h in buckets[b]}
                if len(places) == len(buckets[b]) and not any(taken[p] for p in places):
                    break
                d += 1
            for p in places:
                taken[p] = 1
            self.shift[b] = d

    def _place(self, h: int, d: int) -> int:
        return ((h ^ (d * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 >> 20 & 0xFFFFFFFFFFFF) % self.n

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.m]
        return -d - 1 if d < 0 else self._place(h, d)


class Encoder:
    """Encodes as the ranks say: in each pre-token the adjacent pair of lowest rank merges first, leftmost on ties."""

    def __init__(self, tokens: list[bytes], shift: array | None = None):
        self.tokens = tokens
        known = [i for i, t in enumerate(tokens) if t]
        self.ranks = {tokens[i]: i for i in known}
        self.hash = PerfectHash([tokens[i] for i in known], shift)
        self.at: list[int] = [0] * len(known)
        for i in known:
            self.at[self.hash.slot(tokens[i])] = i

    def lookup(self, piece: bytes) -> int:
        """The rank of a whole pre-token, or -1."""
        rank = self.at[self.hash.slot(piece)]
        return rank if self.tokens[rank] == piece else -1

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that isn't in the vocabulary."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))  # of the part that begins here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := ranks.get(piece[before[i] : stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def piece_ids(self, piece: bytes) -> list[int]:
        rank = self.lookup(piece)
        return [rank] if rank >= 0 else self.merge(piece)


class PieceCache(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers, in two generations of at most ``limit`` entries."""

    def __init__(self, ids, limit: int = 150_000):
        self.ids, self.limit, self.old = ids, limit, {}

    def __missing__(self, piece: str) -> bytes:
        got = self.old.get(piece)
        if got is None:
            got = array("I", self.ids(piece.encode())).tobytes()
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = got
        return got

    def forget(self) -> None:
        self.old = {}
        self.clear()


def encode_text(cache: PieceCache, text: str) -> bytes:
    return b"".join(map(cache.__getitem__, pre_tokens(text)))


def decode_ids(tokens: list[bytes], ids: bytes) -> bytes:
    return b"".join(map(tokens.__getitem__, memoryview(ids).cast("I")))


_ENCODERS: dict[str, tuple[list[bytes], PieceCache]] = {}


def _encoder(path: str, shift: array) -> tuple[list[bytes], PieceCache]:
    """Set up once in each Python worker."""
    if path not in _ENCODERS:
        tokens = load_ranks(path)
        _ENCODERS[path] = tokens, PieceCache(Encoder(tokens, shift).piece_ids)
    return _ENCODERS[path]


def encode(docs: DataFrame, vocabulary: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, with ``keep_ids``) of each row of ``docs`` (doc_id, text).

    Whole texts are split into pre-tokens, each encoded on its own by the ranks of the tiktoken file ``vocabulary``,
    without special tokens, then decoded again. The hash is built once on the driver; each node has the file. A null text is empty: no ids and the digests of no bytes. Repeated rows,
    null ids and other columns don't matter; an empty table gives no rows. No shuffle; memory is one slice of texts.
    """

    shift = PerfectHash([t for t in load_ranks(vocabulary) if t]).shift

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, cache = _encoder(vocabulary, shift)
        ids = [encode_text(cache, t or "") for t in batch.column("text").to_pylist()]
        columns = [
            batch.column("doc_id"),
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(decode_ids(tokens, x)).hexdigest() for x in ids], pa.string()),
        ]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            columns.append(pa.array([memoryview(x).cast("I").tolist() for x in ids], pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>" if keep_ids else "")

    def forget() -> None:  # the worker lives on
        if vocabulary in _ENCODERS:
            _ENCODERS[vocabulary][1].forget()

    return common.map_text(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), run, schema, after=forget)
