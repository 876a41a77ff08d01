"""Cost-balanced packing of token sequences."""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from . import bpe, common
from .common import Scratch

#: Tokens a sequence holds.
CAPACITY = 2048
#: Tokens that are packed at once in a task; bounds its memory.
WINDOW = 1 << 20
#: Pre-tokens in a generation of the cache of a worker.
CACHED = 100_000
#: Closes each document.
END_ID = 1
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
SCHEMA = ", ".join(f"{c} long" for c in COLUMNS)

Piece = tuple[int | None, int, int, int, bytes]  # doc_id, start, length, doc_tokens, ids


def cost(length: int, capacity: int = CAPACITY) -> float:
    """Linear cost of the layers plus quadratic cost of attention, in the linear cost of one token."""
    return length + length * length / capacity


def split(piece: Piece, at: int) -> tuple[Piece, Piece]:
    doc, start, length, total, ids = piece
    return (doc, start, at, total, ids[: 4 * at]), (doc, start + at, length - at, total, ids[4 * at :])


class _Open:
    """Open sequences: the one of least cost with at least some room, exactly; a heap by cost for each room."""

    def __init__(self, n: int, capacity: int):
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
        self.heaps[capacity] = [(0.0, i) for i in range(n)]
        self.least = np.full(capacity + 1, np.inf)
        if n:
            self.least[capacity] = 0.0

    def take(self, room: int) -> tuple[float, int, int] | None:
        """(cost, sequence, its room)."""
        at = room + int(self.least[room:].argmin())
        if not self.heaps[at]:
            return None
        spent, i = heapq.heappop(self.heaps[at])
        self.least[at] = self.heaps[at][0][0] if self.heaps[at] else np.inf
        return spent, i, at

    def put(self, spent: float, i: int, room: int) -> None:
        if room:
            heapq.heappush(self.heaps[room], (spent, i))
            self.least[room] = self.heaps[room][0][0]


def pack_window(pieces: list[Piece], capacity: int = CAPACITY) -> tuple[list[list[Piece]], list[Piece]]:
    """(full sequences, rest): as many sequences as the tokens fill, and pieces of fewer tokens than one holds.

    Pieces over the capacity give whole sequences first. The others, longest first, go to the sequence of least cost
    that has room for them; a piece that no sequence has room for is cut to fill the one of least cost, and its end goes
    on. What is left when all are full are the ends of the shortest pieces.
    """
    done, queue = [], []
    for p in pieces:
        while p[2] >= capacity:
            head, p = split(p, capacity)
            done.append([head])
        if p[2]:
            queue.append(p)
    n = sum(p[2] for p in queue) // capacity
    sequences: list[list[Piece]] = [[] for _ in range(n)]
    opened, rest = _Open(n, capacity), []
    queue.sort(key=lambda p: -p[2])
    for p in queue:
        while p is not None:
            if found := opened.take(p[2]):
                part, p = p, None
            elif found := opened.take(1):
                part, p = split(p, found[2])
            else:
                rest.append(p)
                break
            spent, i, room = found
            sequences[i].append(part)
            opened.put(spent + cost(part[2], capacity), i, room - part[2])
    return done + sequences, rest


def last_sequences(rest: list[Piece]) -> list[list[Piece]]:
    """Under one sequence of tokens as sequences whose lengths are powers of two, which aren't padded."""
    left, out, queue = sum(p[2] for p in rest), [], rest[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        sequence = []
        while size:
            p = queue.pop()
            if p[2] > size:
                p, end = split(p, size)
                queue.append(end)
            sequence.append(p)
            size -= p[2]
        out.append(sequence)
    return out


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next one from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return {b: b for b in printed} | {b: 0x100 + i for i, b in enumerate(others)}


_TOKENIZERS: dict[str, tuple[Tokenizer, bpe.PieceCache, list[str]]] = {}


def _tokenizer(path: str) -> tuple[Tokenizer, bpe.PieceCache, list[str]]:
    """Once in each Python worker: the tokenizer, the ids of single pre-tokens by its model, and its special tokens.

    The cache is for plain byte-level BPE; another tokenizer encodes whole texts.
    """
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        t = Tokenizer.from_file(path)
        split = t.pre_tokenizer
        plain = isinstance(split, ByteLevel) and not split.add_prefix_space and split.use_regex and t.normalizer is None
        model, letters = t.model, _byte_letters()
        by_piece = lambda raw: [x.id for x in model.tokenize(raw.decode("latin-1").translate(letters))]
        _TOKENIZERS[path] = t, bpe.PieceCache(by_piece if plain else None, CACHED), [x.content for x in t.get_added_tokens_decoder().values()]
    return _TOKENIZERS[path]


def token_ids(path: str, text: str) -> bytes:
    """Ids by the tokenizer as little-endian unsigned 32-bit integers, without added special tokens.

    A byte-level tokenizer encodes each pre-token on its own, so its model is asked once for each and ids are looked up
    from then on; a text that has the string of a special token goes through the tokenizer whole.
    """
    tokenizer, cache, special = _tokenizer(path)
    if cache.ids is None or any(x in text for x in special):
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    return bpe.encode_text(cache, text)


def _rows(sequences: list[list[Piece]], first_id: int | None, keep_ids: bool) -> pa.RecordBatch:
    """Pieces by sequence, numbered from ``first_id``; without it they are in none yet and carry their ids."""
    out = []
    for n, sequence in enumerate(sequences):
        offset = 0
        for doc, start, length, total, ids in sequence:
            out.append((doc, start, length, zlib.crc32(ids), total, None if first_id is None else first_id + n, offset, ids))
            offset += length
    columns = list(zip(*out, strict=True)) or [()] * 8
    arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
    carried = columns[7] if keep_ids or first_id is None else [None] * len(out)
    return pa.RecordBatch.from_arrays([*arrays, pa.array(carried, pa.binary())], [*COLUMNS, "raw"])


def _packed(pieces: Iterator[Piece], turn: int, last: bool, keep_ids: bool, capacity: int) -> Iterator[pa.RecordBatch]:
    """One task's rows: full sequences window by window, and at its end what fills none (on the last turn short sequences).

    A sequence's id holds the turn, the partition and its number there, so a task that runs again gives the same rows.
    """
    held: list[Piece] = []
    tokens, done = 0, turn << 56 | TaskContext.get().partitionId() << 32
    for piece in pieces:
        held.append(piece)
        tokens += piece[2]
        if tokens >= WINDOW:
            full, held = pack_window(held, capacity)
            tokens = sum(p[2] for p in held)
            yield _rows(full, done, keep_ids)
            done += len(full)
    full, held = pack_window(held, capacity)
    if last:
        full += last_sequences(held)
    yield _rows(full, done, keep_ids)
    if not last:
        yield _rows([held], None, keep_ids)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of the documents of ``docs`` (doc_id, text) in sequences of at most ``capacity`` tokens.

    Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids with ``keep_ids``. A document
    is the ids of its text and END_ID; a null or empty text is END_ID alone. Each id lies in exactly one piece. Repeated
    rows and null ids are packed like others; other columns don't matter; an empty table gives no rows.

    Each task packs the documents that it reads, about WINDOW tokens at a time. What fills no sequence in the end, less
    than one for each task, is gathered into tasks of about WINDOW tokens and packed again, until one task is left (a
    five-hundredth of the tasks each turn). So all sequences are full, however the input is split, but those of the very
    last tokens, eleven at most, whose lengths are powers of two. No text is shuffled but these ends, and no task holds
    more than a window and one document.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = array("I", [END_ID]).tobytes()

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for part in common.slices(batch, "text", 512 << 10):
                    for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                        ids = token_ids(tokenizer, text or "") + end
                        yield doc, 0, len(ids) // 4, len(ids) // 4, ids

        yield from _packed(pieces(), 0, False, keep_ids, capacity)
        if tokenizer in _TOKENIZERS:  # the worker lives on
            _TOKENIZERS[tokenizer][1].forget()
        common.release()

    def again(turn: int, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces = (p for b in batches for p in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "raw")), strict=True))
            yield from _packed(pieces, turn, last, keep_ids, capacity)

        return run

    common.bounded_batches(docs)
    scratch, schema = Scratch(docs.sparkSession, "packing"), SCHEMA + ", raw binary"
    rows = scratch.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, schema), "turn0")
    out, turn, parts = rows.where("sequence_id IS NOT NULL"), 0, 0
    while True:
        rest = rows.where("sequence_id IS NULL")
        tokens = rest.agg(F.sum("length")).first()[0] or 0
        if not tokens:
            break
        turn, parts = turn + 1, min(-(-tokens // WINDOW), max(1, parts // 2) if turn else tokens)
        order = ["doc_id", "start", "ids_crc32"]
        dealt = rest.repartition(1) if parts == 1 else rest.repartition(parts, *order)
        rows = scratch.table(dealt.sortWithinPartitions(*order).mapInArrow(again(turn, parts == 1), schema), f"turn{turn}")
        out = out.unionByName(rows.where("sequence_id IS NOT NULL"))
    if not keep_ids:
        return out.drop("raw")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.frombuffer(x.as_buffer(), "<u4").astype(np.int64) for x in b.column("raw")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in COLUMNS), pa.array(ids, pa.list_(pa.int64()))], [*COLUMNS, "ids"])

    return out.mapInArrow(unpack, SCHEMA + ", ids array<long>")
