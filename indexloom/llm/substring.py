"""Repeated passages: seeds from winnowed anchors, extension to maximal repeats, removal from all but the first document."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import U64, Scratch, mix

#: Words of a window, and of an anchor. A window holds WINDOW - ANCHOR + 1 anchors, of which the least hash is its seed.
WINDOW, ANCHOR = 50, 12


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


#: Odd multipliers of the rolling hashes: one for anchors, two that together name segments and windows.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class Rolling:
    """Hashes of any run of an array of words: a polynomial modulo 2**64, mixed."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        self.sums = np.r_[U64(0), np.cumsum(mix(words ^ U64(base)) * _powers(base, n)[:n], dtype=U64)]
        self.down = _powers(_inverse(base), n)

    def __call__(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[starts + lengths] - self.sums[starts]) * self.down[starts] + np.asarray(lengths, np.int64).astype(U64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` items, by doubling."""
    size = 1
    out = x
    while 2 * size <= width:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - size :]) if width > size else out


class Segments:
    """The segments of one slice of documents.

    A segment is a longest run of consecutive windows of a document that have the same seed. Equal windows have equal
    seeds wherever they stand, so a window's equals all lie in segments that have its seed.
    """

    def __init__(self, batch: pa.RecordBatch, window: int, anchor: int):
        data, offsets = common.text_bytes(batch.column("text"))
        starts, lengths, doc_of = common.word_spans(data, offsets)
        words = common.hash_spans(data, starts, lengths)
        self.n_docs = batch.num_rows
        bounds = common.doc_starts(doc_of, self.n_docs)
        self.n_words = np.diff(bounds)
        empty = np.zeros(0, np.int64)
        self.doc, self.first, self.count, self.seed = empty, empty, empty, empty.view(U64)
        n = len(words)
        self.hashes = [Rolling(words, b) for b in BASES[1:]]
        self.window = window
        if n < window:
            return
        grams = Rolling(words, BASES[0])(np.arange(n - anchor + 1), anchor)
        seeds = sliding_min(grams, window - anchor + 1)  # by the word at which the window begins
        whole = doc_of[: n - window + 1] == doc_of[window - 1 :]
        at = np.flatnonzero(whole)
        if not len(at):
            return
        seeds, doc = seeds[at], doc_of[at]
        new = np.r_[True, (seeds[1:] != seeds[:-1]) | (at[1:] != at[:-1] + 1)]
        begin = np.flatnonzero(new)
        self.start = at[begin]  # in the words of the slice
        self.count = np.diff(np.r_[begin, len(at)])
        self.doc, self.seed = doc[begin], seeds[begin]
        self.first = self.start - bounds[self.doc]  # in the words of the document
        self.base = bounds

    def names(self, starts: np.ndarray, lengths: np.ndarray | int) -> list[np.ndarray]:
        return [h(starts, lengths).view(np.int64) for h in self.hashes]


def _segments(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Segments(batch, window, anchor)
        ids = batch.column("doc_id").take(pa.array(s.doc))
        names = s.names(s.start, s.count + window - 1) if len(s.doc) else [s.first, s.first]
        return pa.RecordBatch.from_arrays([ids, pa.array(s.seed.view(np.int64)), *map(pa.array, names), pa.array(s.first), pa.array(s.count)], ["doc_id", "seed", "s1", "s2", "first", "windows"])

    return common.map_text(docs, run, "doc_id long, seed long, s1 long, s2 long, first long, windows long", 1 << 20)


def _windows(docs: DataFrame, owners: np.ndarray, window: int, anchor: int) -> DataFrame:
    """The windows of the segments whose (s1, owner) is in the filter ``owners``; ``first`` is a window's first word."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Segments(batch, window, anchor)
        if len(s.doc):
            s1, _ = s.names(s.start, s.count + window - 1)
            hit = common.passes(owners, s1 ^ batch.column("slot").to_numpy(zero_copy_only=False)[s.doc])
            start, count, doc = s.start[hit], s.count[hit], s.doc[hit]
            doc = np.repeat(doc, count)
            start = np.repeat(start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            names, first = s.names(start, window), start - s.base[doc]
        else:
            doc, names, first = s.doc, [s.first, s.first], s.first
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), *map(pa.array, names), pa.array(first)], ["doc_id", "w1", "w2", "first"])

    return common.map_text(docs.withColumn("slot", F.xxhash64("doc_id")), run, "doc_id long, w1 long, w2 long, first long", 1 << 20)


def repeats(spark: SparkSession, docs: DataFrame, scratch: Scratch, window: int, anchor: int) -> DataFrame:
    """(doc_id, first, words): runs of words of a document that windows cover which also start in a smaller doc_id.

    Seeds join: only segments whose seed lies in two documents go on. A segment extends its seed both ways; of equal
    segments all but the smallest doc_id's are repeats as a whole. Only the smallest one's windows are left to compare,
    where its seed has another segment too: they are named by their words and matched one by one, which finds where
    repeats end. Segments are a twentieth of the words, so no row is made for each window of a copy, and counts are
    aggregated before the shuffle: no pair of documents is ever formed.
    """
    segments = scratch.table(_segments(docs, window, anchor).where("doc_id is not null"), "segments")
    seeds = segments.groupBy("seed").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x <> y").select("seed")
    seeds = scratch.table(seeds, "seeds")
    maybe = common.may_be_in(spark, common.bloom_bits(seeds, F.xxhash64("seed"), common.filter_size(seeds.count())), F.xxhash64("seed"))
    shared = scratch.table(segments.where(maybe).join(seeds, "seed", "left_semi"), "shared")
    scratch.drop("segments", "seeds")
    kinds = scratch.table(shared.groupBy("seed", "s1", "s2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")), "kinds")
    owned = scratch.table(kinds.where("owner <> last").select("s1", "s2", "owner"), "owned")
    whole = shared.join(owned, ["s1", "s2"]).where("doc_id > owner").select("doc_id", "first", (F.col("windows") + window - 1).alias("words"))
    whole = scratch.table(whole, "whole")
    scratch.drop("shared", "owned")
    several = scratch.table(kinds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed"), "several")
    open_ = scratch.table(kinds.join(several, "seed", "left_semi").select(F.col("s1").bitwiseXOR(F.xxhash64("owner")).alias("slot")), "open")
    scratch.drop("kinds", "several")
    bits = common.bloom_bits(open_, F.col("slot"), common.filter_size(open_.count()))
    scratch.drop("open")
    windows = scratch.table(_windows(docs, bits, window, anchor).where("doc_id is not null"), "windows")
    first = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x <> y").select("w1", "w2", "x")
    single = windows.join(scratch.table(first, "first"), ["w1", "w2"]).where("doc_id > x").select("doc_id", "first", F.lit(window).cast("long").alias("words"))
    found = scratch.table(whole.union(single), "repeats")
    scratch.drop("whole", "windows", "first")
    return found


def _kept(words: list[bytes], first: np.ndarray, length: np.ndarray) -> tuple[int, bytes]:
    """(words removed, the others joined by one space)."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(first + length, len(words)), -1)
    gone = np.cumsum(edge[:-1]) > 0
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _finish(rows: DataFrame, keep_text: bool, cut: bool) -> DataFrame:
    """Counts, digest and (if asked for) text; bytes.split() splits at exactly the contract's white space. With ``cut`` rows have their runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole, "text", 1 << 20):
                n, removed, digests, texts = [], [], [], []
                runs = batch.column("runs") if cut else None
                for i, text in enumerate(batch.column("text").to_pylist()):
                    words = (text or "").encode().split()
                    gone, kept = 0, None
                    if cut and runs[i].is_valid:
                        pairs = runs[i].values
                        gone, kept = _kept(words, pairs.field("first").to_numpy(), pairs.field("words").to_numpy())
                    if kept is None:
                        kept = b" ".join(words)
                    n.append(len(words))
                    removed.append(gone)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept.decode() if gone else text)
                columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if keep_text:
                    columns.append(pa.array(texts, pa.string()))
                    names.append("kept_text")
                    for name in batch.schema.names:
                        if name not in ("doc_id", "text", "runs"):
                            columns.append(batch.column(name))
                            names.append(name)
                yield pa.RecordBatch.from_arrays(columns, names)
        common.release()

    common.bounded_batches(rows)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if keep_text:
        schema += ", kept_text string" + "".join(f", `{n}` {t}" for n, t in rows.dtypes if n not in ("doc_id", "text", "runs"))
    return rows.mapInArrow(run, schema)


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256.

    A word goes if a run of ``window`` words that covers it also starts in a document with a smaller doc_id; runs are
    judged on the input. kept_sha256 is of the kept words joined by one space. With ``keep_text`` also kept_text (the
    text unchanged where nothing goes, else the kept words joined by one space) and the columns of ``carry``.

    Null and empty texts have no words; texts below ``window`` words lose none. Rows that share a doc_id are one document:
    repeats among them stay, and what goes from one goes from the same place in the others. A null doc_id neither gives
    nor loses words. An empty table gives no rows. Words are compared by 64-bit hashes, runs by 128 bits. What the result
    reads beside ``docs`` is one table of runs; all others are deleted.

    Texts without a repeat are finished where they are read; only the others are shuffled, by doc_id, to meet their runs.
    """
    scratch = Scratch(spark, "substring")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = repeats(spark, slim, scratch, window, anchor)
    runs = scratch.only(found.groupBy("doc_id").agg(F.collect_list(F.struct("first", "words")).alias("runs")))
    bits = common.bloom_bits(runs, F.xxhash64("doc_id"), common.filter_size(runs.count()))
    hit = common.may_be_in(spark, bits, F.xxhash64("doc_id"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    return _finish(rows.where(~hit), keep_text, False).unionByName(_finish(rows.where(hit).join(runs, "doc_id", "left"), keep_text, True))
