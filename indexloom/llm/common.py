"""Shared pieces of the training-data operators: scratch tables, Arrow batches, word hashes, components."""

from __future__ import annotations

import ctypes
import hashlib
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
MASK64 = (1 << 64) - 1

# ---------------------------------------------------------------- scratch tables


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local master may leave it unset (tests), and has a local one then."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[\d*, ]+\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/indexloom-shared"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/indexloom/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Written tables that cut lineage. ``drop`` removes those that no later plan reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def table(self, df: DataFrame, step: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{step}")
        df.write.parquet(path)
        self.paths[step] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *steps: str) -> None:
        for step in list(steps):
            remove_path(self.spark, self.paths.pop(step))

    def only(self, df: DataFrame) -> DataFrame:
        """``df`` as a table, all other tables dropped: what an operator returns."""
        kept = self.table(df, "only")
        self.drop(*(step for step in list(self.paths) if step != "only"))
        return kept


# ---------------------------------------------------------------- documents

#: Bytes of an Arrow batch on its way to Python (or one longer row), where the session has Spark's default. The executor keeps what batches took outside its heap, so large ones add up.
BATCH_BYTES = 1 << 20
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bounded_batches(df: DataFrame) -> None:
    """Has the session send smaller Arrow batches, unless it was told a size; the setting stays, as plans are lazy."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_CONF, None) == _BATCH_DEFAULT:
        conf.set(_BATCH_CONF, f"{BATCH_BYTES}b")


def with_crc_fold(df: DataFrame, id_col: str, mod: int) -> DataFrame:
    """``fold``: crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return df.withColumn("fold", F.crc32(text.cast("binary")) % mod)


def release() -> None:
    """Gives freed memory back at the end of a task; Python workers live on, and what they keep adds up over stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def map_text(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, max_bytes: int = 1 << 20, text_col: str = "text", after: Callable[[], None] = lambda: None) -> DataFrame:
    """``fn`` over slices of Arrow batches that hold about ``max_bytes`` of ``text_col`` (or one longer text); ``after`` at a task's end."""

    bounded_batches(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col, max_bytes):
                yield fn(piece)
        after()
        release()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text_col: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and n + 1 offsets into them. A null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


# ---------------------------------------------------------------- words and hashes

#: White space of the contracts: space and \t \n \v \f \r. All are single bytes in UTF-8.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply); works in place on a copy."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, length, document) of every run of bytes that aren't white space; texts don't run into each other."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (np.r_[True, ~solid[:-1]] | edge[:-1]))
    ends = np.flatnonzero(solid & (np.r_[~solid[1:], True] | edge[1:])) + 1
    return starts, ends - starts, np.searchsorted(offsets, starts, side="right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span, eight bytes at a time; spans over 256 bytes go through BLAKE2b."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), buffer=padded, strides=(1,))
    h = mix(lengths.astype(U64) + U64((seed * 2 + 1) * 0x9E3779B97F4A7C15 & MASK64))
    todo, at = np.arange(len(starts)), 0
    while len(todo) and at < 256:
        left = lengths[todo] - at
        v = eight[starts[todo] + at]
        part = left < 8
        v[part] &= (U64(1) << (left[part].astype(U64) * U64(8))) - U64(1)
        h[todo] = mix((h[todo] ^ v) * U64(0xD6E8FEB86659FD93))
        at += 8
        todo = todo[left > 8]
    for i in todo[lengths[todo] > 256]:
        raw = data[starts[i] : starts[i] + lengths[i]].tobytes()
        h[i] = U64(int.from_bytes(hashlib.blake2b(raw, digest_size=8, salt=seed.to_bytes(2, "little")).digest(), "little"))
    return h


def doc_starts(doc_of: np.ndarray, n_docs: int) -> np.ndarray:
    """n + 1 offsets of the documents in an array of items sorted by document."""
    return np.searchsorted(doc_of, np.arange(n_docs + 1))


def shingles(words: np.ndarray, doc_of: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each document and their document, sorted by document and hash.

    A document with 1 to k - 1 words has its whole sequence as its one shingle.
    """
    bounds = doc_starts(doc_of, n_docs)
    counts = np.diff(bounds)
    odd = [U64((0x9E3779B97F4A7C15 * (2 * i + 1) | 1) & MASK64) for i in range(k)]
    n = max(0, len(words) - k + 1)
    full = np.zeros(n, U64)
    for i in range(k):
        full += mix(words[i : i + n] ^ odd[i])
    same = doc_of[:n] == doc_of[k - 1 :] if n else np.zeros(0, bool)
    h, d = mix(full[same] ^ U64(k)), doc_of[:n][same]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        s = np.zeros(len(short), U64)
        for i in range(k - 1):
            has = counts[short] > i
            s[has] += mix(words[bounds[short[has]] + i] ^ odd[i])
        h, d = np.r_[h, mix(s ^ counts[short].astype(U64))], np.r_[d, short]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]
        h, d = h[new], d[new]
    return h, d


# ---------------------------------------------------------------- filters of bounded size


def bloom_bits(rows: DataFrame, slot: Column, log2_bits: int) -> np.ndarray:
    """A one-hash Bloom filter of ``slot`` (a hash of the key, as a long) as 2**log2_bits bits.

    A member always passes; a full filter passes everything. It only saves shuffling, results don't depend on it.
    """
    words = rows.select(slot.alias("h")).selectExpr(f"shiftright(h & {(1 << log2_bits) - 1}L, 6) AS w", "shiftleft(1L, CAST(h & 63 AS INT)) AS b")
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bits = np.zeros(1 << (log2_bits - 6), np.int64)
    bits[found["w"].to_numpy(np.int64)] = found["b"].to_numpy(np.int64)
    return bits


def filter_size(n: int) -> int:
    """log2_bits for ``n`` members: eight bits each, 128 KB to 32 MB in all. Beyond 2**28 / 8 members more and more others pass."""
    return max(20, min(28, (8 * n).bit_length()))


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (int64) are in the filter."""
    slot = hashes & (len(bits) * 64 - 1)
    return ((bits[slot >> 6] >> (slot & 63)) & 1).astype(bool)


def may_be_in(spark: SparkSession, bits: np.ndarray, slot: Column) -> Column:
    """:func:`passes` inside the JVM: the filter is the value of a scalar subquery."""
    table = pa.table({"bits": pa.array([bits], pa.list_(pa.int64()))})
    words = spark.createDataFrame(table).scalar()
    word = F.get(words, F.shiftright(slot.bitwiseAND(F.lit(len(bits) * 64 - 1)), 6).cast("int"))
    return F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1


#: Ids of a list that is broadcast; 16 bytes each.
FEW_IDS = 1 << 20


def without_ids(spark: SparkSession, rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` isn't in ``gone`` (one column, doc_id; distinct, a written table), null keys included.

    A list of at most FEW_IDS is broadcast. Beyond that a filter passes on rows that surely stay where they are read,
    and only the others are shuffled to meet the list.
    """
    n = gone.count()
    gone = gone.select(F.col("doc_id").alias(key))
    if n <= FEW_IDS:
        return rows.join(F.broadcast(gone), key, "left_anti").select(rows.columns)
    slot = F.xxhash64(F.col(key).cast("long"))
    hit = may_be_in(spark, bloom_bits(gone, F.xxhash64(key), filter_size(n)), slot)
    return rows.where(~hit).unionByName(rows.where(hit).join(gone, key, "left_anti").select(rows.columns))


def drop_rows(spark: SparkSession, docs: DataFrame, decide: Callable[[DataFrame], DataFrame], nulls_last: bool, name: str) -> DataFrame:
    """The rows of ``docs`` that ``decide`` keeps: it gets (doc_id, text) and returns rows with doc_id and kept.

    Where ids are null or repeat, rows are decided one by one under ids of their own, in the order of doc_id (nulls
    first or last) and text; so no row goes for another row's text, and of equal rows one stays.
    """
    scratch = Scratch(spark, name)
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").take(1):
        gone = scratch.table(decide(docs.select("doc_id", "text")).where("NOT kept").select(F.col("doc_id").cast(docs.schema["doc_id"].dataType)), "gone")
        return without_ids(spark, docs, gone, "doc_id")
    own = "row_id"
    while own in docs.columns:
        own += "_"
    order = [F.col("doc_id").asc_nulls_last() if nulls_last else F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    numbered = scratch.table(docs.repartitionByRange(*order).sortWithinPartitions(*order, "text").withColumn(own, F.monotonically_increasing_id()), "numbered")
    gone = scratch.table(decide(numbered.select(F.col(own).alias("doc_id"), "text")).where("NOT kept").select("doc_id"), "gone")
    return without_ids(spark, numbered, gone, own).select(docs.columns)


# ---------------------------------------------------------------- connected components


def components(spark: SparkSession, edges: DataFrame, keep: Scratch, name: str) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for every node that has an edge, as table
    ``name`` of ``keep``.

    Contraction by rounds: each component hooks onto its smallest neighbour, chains of hooks are followed to their
    end, edges are renamed and those inside a component go, until none is left (a star takes two rounds at most, a chain
    one). Each step is cut by a written table; nothing is collected. A null node links with nothing.
    """
    scratch = Scratch(spark, f"{name}-cc")
    edges = edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = scratch.table(edges, "e0")
    labels = None
    step = 0
    while edges.take(1):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        hook, hop = scratch.table(hook, f"h{step}.0"), 0
        while True:
            up = hook.select(F.col("node").alias("to"), F.col("to").alias("up"))
            far = hook.join(up, "to").select("node", F.col("up").alias("to"), (F.col("up") != F.col("to")).alias("moved"))
            far = scratch.table(far, f"h{step}.{hop + 1}")
            scratch.drop(f"h{step}.{hop}")
            hook, hop = far.select("node", "to"), hop + 1
            if not far.where("moved").take(1):
                break
        if labels is None:
            new = hook.select("node", F.col("to").alias("component"))
        else:
            new = labels.join(hook.select(F.col("node").alias("component"), "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        new = scratch.table(new, f"l{step}")
        renamed = (
            edges.join(hook.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(hook.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct()
        )
        left = scratch.table(renamed, f"e{step + 1}")
        scratch.drop(f"h{step}.{hop}", f"e{step}", *([f"l{step - 1}"] if step else []))
        labels, edges, step = new, left, step + 1
    kept = keep.table(labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component")), name)
    scratch.drop(*scratch.paths)
    return kept
