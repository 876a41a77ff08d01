"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import U64, Scratch, mix

#: Slots of a signature, of which four make a band: at a similarity of 0.8 a pair misses all 32 bands once in 20 million.
SLOTS, ROWS = 128, 4
#: Elements whose permutations are held at once.
CHUNK = 1 << 16
#: A pair is read in full if its signatures agree this far below the similarity it is looked at for (over five deviations).
SLACK = 0.2
#: Members and shingles of a chunk of a hub's group or of a bucket; chunks meet two by two, so a task holds two of them.
CHUNK_MEMBERS, CHUNK_SHINGLES = 2048, 1 << 19


def superminhash(elements: np.ndarray, doc_of: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures (n_docs, slots) of the documents' distinct elements; inf where a document has none.

    Each element deals the ranks 0..slots-1 to the slots by its own permutation and adds a fraction; a slot keeps the
    least sum. Rank by rank for all elements at once: after rank j all later sums exceed j + 1, so a document stops as
    soon as each of its slots holds something, and only unfinished documents hold permutations at all.
    """
    out = np.full((n_docs, slots), np.inf)
    bounds = common.doc_starts(doc_of, n_docs)
    lo = 0
    while lo < n_docs:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + CHUNK, side="right")) - 1)
        _deal(elements[bounds[lo] : bounds[hi]], doc_of[bounds[lo] : bounds[hi]] - lo, out[lo:hi], slots)
        lo = hi
    return out


def _draw(elements: np.ndarray, j: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """A fraction and a place in j..slots-1 for each element at rank j."""
    x = mix(elements + U64((j + 1) * 0x9E3779B97F4A7C15 & common.MASK64))
    place = ((x & U64(0xFFFFFFFF)) * U64(slots - j) >> U64(32)).astype(np.int64) + j
    return (x >> U64(32)).astype(np.float64) * 2.0**-32, place


def _deal(elements: np.ndarray, doc_of: np.ndarray, out: np.ndarray, slots: int) -> None:
    flat = out.reshape(-1)
    r, place = _draw(elements, 0, slots)
    np.minimum.at(flat, doc_of * slots + place, r)
    todo = np.isinf(out).any(axis=1)
    keep = todo[doc_of]
    elements, doc_of, place = elements[keep], doc_of[keep], place[keep]
    perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(elements), 1))
    rows = np.arange(len(elements))
    perm[rows, place] = 0
    for j in range(1, slots):
        if not len(elements):
            break
        r, place = _draw(elements, j, slots)
        slot = perm[rows, place].astype(np.int64)
        perm[rows, place] = perm[rows, j]
        np.minimum.at(flat, doc_of * slots + slot, r + j)
        todo[todo] = np.isinf(out[todo]).any(axis=1)
        keep = todo[doc_of]
        if keep.mean() < 0.7:
            elements, doc_of, perm = elements[keep], doc_of[keep], perm[keep]
            rows = np.arange(len(elements))


def bands(signatures: np.ndarray) -> np.ndarray:
    """(n_docs, slots / ROWS) int64: four slots of 16 bits each, which are both the band's key and the signature."""
    bits = (mix(np.ascontiguousarray(signatures).view(U64)) >> U64(48)).astype("<u2")
    return bits.reshape(len(signatures), -1, ROWS).copy().view("<i8").reshape(len(signatures), -1)


def doc_shingles(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each row, and the rows, sorted; A-Z lower-cased."""
    data, offsets = common.text_bytes(batch.column("text"))
    data = common.LOWER[data]
    starts, lengths, doc_of = common.word_spans(data, offsets)
    return common.shingles(common.hash_spans(data, starts, lengths), doc_of, batch.num_rows, k)


def set_names(h: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two order-free sums over the hashes of each set, which with its size name it."""
    sums = []
    for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        total = np.r_[U64(0), np.cumsum(mix(h ^ U64(salt)), dtype=U64)]
        sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return sums


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, two order-free sums that name the set, and the bands (null for an empty set)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, d = doc_shingles(batch, k)
        n = batch.num_rows
        bounds = common.doc_starts(d, n)
        sums = set_names(h, bounds)
        counts = np.diff(bounds)
        keys = bands(superminhash(h, d, n))
        width = keys.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(counts > 0, width, 0))], pa.int32()), pa.array(keys[counts > 0].reshape(-1)), mask=pa.array(counts == 0))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums[0]), pa.array(sums[1]), lists], ["doc_id", "n_shingles", "s1", "s2", "bands"])

    return common.map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>", 1 << 20)


def _lanes(column) -> np.ndarray:
    return np.stack([np.asarray(x) for x in column]).view("<u2") if len(column) else np.zeros((0, SLOTS), "<u2")


def _agreeing(pairs: DataFrame, reps: DataFrame, percent: float) -> DataFrame:
    """Of pairs (a, b), those whose set sizes allow the similarity and whose signatures come near it."""
    least = int((percent / 100 - SLACK) * SLOTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.asarray(b.column(c).flatten()).view("<u2").reshape(b.num_rows, -1) for c in ("ba", "bb"))
            near = (x == y).sum(axis=1) >= least
            if near.any():
                yield b.select(["a", "b"]).filter(pa.array(near))

    of = lambda c: reps.select(F.col("c").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("bands").alias(f"b{c}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return joined.select("a", "b", "ba", "bb").mapInArrow(run, "a long, b long")


def _compared(pairs: DataFrame, sets: DataFrame, percent: float, near: float) -> DataFrame:
    """(a, b, linked) of pairs whose full sets have 100 * intersection >= near * union; linked: >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at_least = np.zeros((2, b.num_rows), bool)
            for i, (x, y) in enumerate(zip(b.column("sa"), b.column("sb"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")  # merges two sorted runs
                shared = int((both[1:] == both[:-1]).sum())
                at_least[:, i] = [100 * shared >= p * (len(both) - shared) for p in (near, percent)]
            rows = pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(at_least[1])], ["a", "b", "linked"])
            yield rows.filter(pa.array(at_least[0]))

    of = lambda c: sets.select(F.col("c").alias(c), F.col("shingles").alias(f"s{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, linked boolean")


def _chunked(rows: DataFrame, key: str, scratch: Scratch, step: str, keep: str = "true") -> DataFrame:
    """``rows`` (with n_shingles) in chunk pairs (key, i, j) for keys for which ``keep`` (an aggregate) holds.

    A chunk has about CHUNK_MEMBERS members and CHUNK_SHINGLES shingles at most, or one larger set.
    """
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK_MEMBERS, F.sum("n_shingles") / CHUNK_SHINGLES)).cast("int")
    sizes = rows.groupBy(key).agg(parts.alias("chunks"), F.expr(keep).alias("keep")).where("keep").drop("keep")
    dealt = rows.join(scratch.table(sizes, f"{step}-sizes"), key).withColumn("chunk", F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).drop("chunks", "other", "n_shingles")


def _forest(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """Links (a, b) of chunk pairs between their probes and other members, as forests over components.

    Rows are (key, i, j, chunk, c, comp, probe, shingles). A pair is looked at unless both are probes or members of one
    component by then. Intersections are exact: one probe is counted against all members at a time, no pair leaves the
    task, and a link comes out only where it joins two components.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        apart = rows["i"].iloc[0] != rows["j"].iloc[0]
        rows = rows.sort_values("c")
        ids, probe, chunk = rows["c"].to_numpy(), rows["probe"].to_numpy(bool), rows["chunk"].to_numpy()
        comp = np.unique(rows["comp"].to_numpy(), return_inverse=True)[1]
        sets = [np.frombuffer(x, np.int64) for x in rows["shingles"]]
        sizes = np.array([len(x) for x in sets])
        cuts = np.cumsum(sizes) - sizes
        _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        mark = np.zeros(len(count), bool)
        out = []
        for s in np.flatnonzero(probe).tolist():
            if (comp == comp[s]).all():
                continue
            own = place[cuts[s] : cuts[s] + sizes[s]]
            mark[own] = True
            shared = np.add.reduceat(mark[place], cuts, dtype=np.int64)
            mark[own] = False
            yes = (100 * shared >= percent * (sizes + sizes[s] - shared)) & (comp != comp[s])
            if apart:
                yes &= chunk != chunk[s]
            for t in np.flatnonzero(yes).tolist():
                if comp[t] != comp[s]:
                    out.append((ids[s], ids[t]))
                    comp[comp == comp[t]] = comp[s]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy(key, "i", "j").applyInPandas(run, "a long, b long")


def _far_members(rows: DataFrame, percent: int) -> DataFrame:
    """Members (bucket, c, comp, far) of a pair with a member far from its hub whose signatures come near the similarity.

    Rows are (bucket, band, i, j, chunk, c, comp, far, bands). A pair is taken in the first band that it shares, if its
    components differ. Pairs stay in the task.
    """
    least = int((percent / 100 - SLACK) * SLOTS)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        apart, band = rows["i"].iloc[0] != rows["j"].iloc[0], int(rows["band"].iloc[0])
        comp, far, chunk = rows["comp"].to_numpy(), rows["far"].to_numpy(bool), rows["chunk"].to_numpy()
        lanes = np.stack([np.asarray(x) for x in rows["bands"]]).view("<u2")
        keys = lanes.view("<i8")
        hit = np.zeros(len(rows), bool)
        for s in np.flatnonzero(far).tolist():
            ok = (comp != comp[s]) & ~(keys[:, :band] == keys[s, :band]).any(axis=1)
            if apart:
                ok &= chunk != chunk[s]
            at = np.flatnonzero(ok)
            at = at[(lanes[at] == lanes[s]).sum(axis=1) >= least]
            if len(at):
                hit[at] = hit[s] = True
        return rows.loc[hit, ["bucket", "c", "comp", "far"]]

    return rows.groupBy("bucket", "i", "j").applyInPandas(run, "bucket long, c long, comp long, far boolean")


class _Sets:
    """The full shingle sets of classes, written as they are first asked for: (c, shingles), sorted 64-bit hashes."""

    def __init__(self, docs: DataFrame, reps: DataFrame, k: int, repeated: bool, scratch: Scratch):
        self.docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("slot", F.xxhash64("doc_id"))
        self.reps, self.k, self.repeated, self.scratch = reps, k, repeated, scratch
        self.parts: list[DataFrame] = []

    def with_(self, ids: DataFrame) -> DataFrame:
        """All sets so far and those of ``ids`` (c, distinct); texts are read again only for new ones."""
        for part in self.parts:
            ids = ids.join(part.select("c"), "c", "left_anti")
        step = f"sets{len(self.parts)}"
        new = self.scratch.table(ids.join(self.reps.select("c", "rep", "n_shingles", "s1", "s2"), "c"), f"{step}-of")
        n = new.count()
        if n or not self.parts:
            rows = self._read(common.bloom_bits(new, F.xxhash64("rep"), common.filter_size(n)))
            if self.repeated:  # a doc_id may have several texts, and a text several rows
                key = ["rep", "n_shingles", "s1", "s2"]
                rows = rows.withColumnRenamed("doc_id", "rep").join(new, key).select("c", "shingles").dropDuplicates(["c"])
            else:
                rows = rows.join(new.select(F.col("rep").alias("doc_id"), "c"), "doc_id").select("c", "shingles")
            self.parts.append(self.scratch.table(rows, step))
        out = self.parts[0]
        for part in self.parts[1:]:
            out = out.unionByName(part)
        return out

    def _read(self, bits: np.ndarray) -> DataFrame:
        k = self.k

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            batch = batch.filter(pa.array(common.passes(bits, batch.column("slot").to_numpy(zero_copy_only=False))))
            h, d = doc_shingles(batch, k)
            bounds = common.doc_starts(d, batch.num_rows)
            signed = h.view(np.int64).copy()
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                signed[a:b].sort()
            raw = [signed[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), *map(pa.array, set_names(h, bounds)), pa.array(raw, pa.binary())], ["doc_id", "n_shingles", "s1", "s2", "shingles"])

        return common.map_text(self.docs, run, "doc_id long, n_shingles long, s1 long, s2 long, shingles binary", 1 << 20)


def _with_components(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with comp, the component of c by ``labels``; a class without links is its own."""
    return rows.join(labels.select(F.col("node").alias("c"), "component"), "c", "left").withColumn("comp", F.coalesce("component", "c")).drop("component")


def _hubs_by_score(members: DataFrame) -> DataFrame:
    """(bucket, hub, score): a bucket's hub is the member that meets most others over all its buckets, the least on ties.

    One order over all members, so near copies, which share many buckets, share a hub, and it is the one in their middle.
    """
    score = members.groupBy("c").agg(F.sum("n").alias("score"))
    best = members.join(score, "c").groupBy("bucket").agg(F.max(F.struct("score", (-F.col("c")).alias("less"))).alias("h"))
    return best.select("bucket", (-F.col("h.less")).alias("hub"), "h.score")


def _links(spark: SparkSession, docs: DataFrame, reps: DataFrame, k: int, percent: int, repeated: bool, scratch: Scratch) -> DataFrame:
    """(node, component) of the classes that link with another, by class, as a table of ``scratch``."""
    near = 100 - 2 * (100 - percent)
    rows = reps.select("c", F.posexplode("bands").alias("band", "key")).select("c", F.col("band").cast("byte").alias("band"), F.xxhash64("band", "key").alias("bucket"))
    shared = scratch.table(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    members = scratch.table(rows.join(shared, "bucket").select("bucket", "band", "c", "n"), "members")
    scratch.drop("shared")
    sets = _Sets(docs, reps, k, repeated, scratch)

    # Each class and the best of its buckets' hubs.
    first = scratch.table(_hubs_by_score(members), "first")
    pairs = members.join(first, "bucket").where("c <> hub").groupBy("c").agg(F.max(F.struct("score", (-F.col("hub")).alias("less"))).alias("h")).select((-F.col("h.less")).alias("a"), F.col("c").alias("b"))
    both = lambda pairs: pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
    agreeing = scratch.table(_agreeing(pairs, reps, percent), "agreeing0")
    linked = scratch.table(_compared(agreeing, sets.with_(both(agreeing)), percent, percent).select("a", "b"), "linked")
    labels = common.components(spark, linked, scratch, "labels0")

    # Buckets that still have several components, and their hubs.
    members = scratch.table(_with_components(members, labels), "placed")
    several = scratch.table(members.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bucket"), "several")
    members = scratch.table(members.join(several, "bucket").select("bucket", "band", "c", "comp", "n"), "open")
    scratch.drop("members", "placed", "agreeing0", "linked", "several")
    joined = scratch.table(members.join(first.select("bucket", "hub"), "bucket").where("c <> hub"), "joined")
    agreeing = scratch.table(_agreeing(joined.select(F.col("hub").alias("a"), F.col("c").alias("b")).distinct(), reps, near), "agreeing")
    have = sets.with_(both(agreeing))
    kinds = scratch.table(_compared(agreeing, have, percent, near), "kinds")

    # Members near the hub: of two that can link, one isn't linked with it.
    size = reps.select("c", "n_shingles")
    group = _with_components(kinds.select(F.col("a").alias("hub"), F.col("b").alias("c"), "linked"), labels)
    group = group.join(labels.select(F.col("node").alias("hub"), "component"), "hub", "left").withColumn("home", F.coalesce("component", "hub"))
    group = group.select("hub", "c", "home", F.when(F.col("linked"), F.col("home")).otherwise(F.col("comp")).alias("comp")).withColumn("probe", F.col("comp") != F.col("home"))
    group = _chunked(group.join(size, "c"), "hub", scratch, "group", "count(*) > 1 AND bool_or(probe)").join(have, "c")
    within = scratch.table(_forest(group, "hub", percent), "within")

    # Members far from the hub: by signature, then on the sets of those that agree with another.
    kind = kinds.select(F.col("a").alias("hub"), F.col("b").alias("c"), "linked")
    left = joined.where("n > 2").join(kind, ["hub", "c"], "left").where("linked IS NULL OR NOT linked").select("bucket", "band", "c", "comp", F.col("linked").isNull().alias("far"))
    left = scratch.table(left, "left")
    mixed = left.groupBy("bucket").agg(F.count_if("far").alias("far_members"), F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y AND far_members > 0").select("bucket")
    left = left.join(scratch.table(mixed, "mixed"), "bucket")
    far = scratch.table(_far_members(_chunked(left.join(size, "c"), "bucket", scratch, "far").join(reps.select("c", "bands"), "c"), percent).distinct(), "far")
    apart = _chunked(far.withColumnRenamed("far", "probe").join(size, "c"), "bucket", scratch, "apart").join(sets.with_(far.select("c").distinct()), "c")
    apart = scratch.table(_forest(apart, "bucket", percent), "apart")
    links = kinds.where("linked").select("a", "b").unionByName(within).unionByName(apart)

    # The components of the first links, joined by the others.
    place = lambda c, to: labels.select(F.col("node").alias(c), F.col("component").alias(to))
    over = links.join(place("a", "x"), "a", "left").join(place("b", "y"), "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    more = common.components(spark, over, scratch, "more")
    nodes = labels.select(F.col("node"), "component").unionByName(more.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("component")))
    moved = more.select(F.col("node").alias("component"), F.col("component").alias("to"))
    return scratch.table(nodes.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")


def near_dedup(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others are ignored): doc_id, n_shingles, component_id, kept.

    A document's set is its distinct k-word shingles (with fewer words its whole sequence as one; without words none,
    and it links with nothing). Documents link when 100 * intersection >= percent * union, confirmed on the full sets.
    component_id is the smallest doc_id reachable; rows of the document that has it are kept. Rows that share a doc_id
    are one node, whatever their texts: what one of them reaches all reach. A row without doc_id takes the component of
    an equal set under an id, and isn't kept; else it links with nothing, has no component and is kept. An empty table
    gives no rows.

    Equal sets are one class, so exact copies never make pairs. Classes meet in band buckets. First each is compared, on
    the full sets, with the best connected of its buckets' hubs; that joins nearly all that belongs together, so pairs
    that are left over are those between different components of a bucket. For these each bucket's members are compared
    with one hub. As Jaccard distance is a metric, of the other pairs only these can link: two members near the hub
    (similarity 1 - 2 * (1 - t) at least, for the threshold t) of which one isn't linked with it, which are intersected
    exactly in tasks that hold the hub's group in chunks; and pairs with a member that isn't near the hub, which are
    compared by signature in the bucket, in chunks too, and on full sets where those agree. So each pair of a bucket is
    compared, ruled out or inside a component. No group is paired up in rows. What the result reads is one table; all
    others are deleted.
    """
    scratch = Scratch(spark, "minhash")
    drawn = scratch.table(sketch(docs, k), "sketch")
    known = drawn.where("doc_id is not null")
    repeats = scratch.table(known.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeats")
    repeated = bool(repeats.take(1))
    classes = known.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    # Written, so that the join has two plain shuffles and a hot class is split. A class goes by its smallest doc_id unless ids repeat.
    classes = scratch.table(classes.withColumn("c", F.monotonically_increasing_id() if repeated else F.col("rep")), "classes")
    nodes = drawn.join(classes, ["n_shingles", "s1", "s2"], "left")
    nodes = scratch.table(nodes.withColumn("bands", F.when(F.col("doc_id") == F.col("rep"), F.col("bands"))), "nodes")
    scratch.drop("sketch", "classes")
    reps = nodes.where("bands is not null").select("c", "rep", "n_shingles", "s1", "s2", "bands")
    if repeated:
        reps = scratch.table(reps.dropDuplicates(["c"]), "reps")
    labels = _links(spark, docs, reps, k, percent, repeated, scratch)
    rows = nodes.select("doc_id", "n_shingles", "c")
    if repeated:  # the classes of one doc_id are one node, and go by the smallest doc_id of all
        own = scratch.table(rows.where("c is not null").join(repeats, "doc_id").groupBy("doc_id").agg(F.min("c").alias("own")), "own")
        rows = rows.join(own, "doc_id", "left").withColumn("c", F.coalesce("c", "own"))
        joined = rows.where("c <> own").select(F.col("c").alias("a"), F.col("own").alias("b")).unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = common.components(spark, joined, scratch, "joined")
        named = _with_components(reps.select("c", "rep"), labels)
        least = scratch.table(named.groupBy("comp").agg(F.min("rep").alias("component")), "least")
        labels = named.join(least, "comp").select(F.col("c").alias("node"), "component")
    labels = labels.select(F.col("node").alias("c"), "component")
    component = F.coalesce("component", "c" if not repeated else "doc_id", "doc_id")
    out = rows.join(labels, "c", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
    return scratch.only(out)
