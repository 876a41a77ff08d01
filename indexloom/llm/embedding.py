"""Near-duplicate vectors: a pigeonhole join over subspaces of rotated vectors, verified exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import Scratch

#: Dimensions of a block: enough that few pairs are within a block's share by chance.
BLOCK = 16
#: Rows of a chunk of a cell. Chunks of a larger cell meet two by two, so a task holds at most two.
CELL = 1 << 15
#: Vectors that one coordinate is enough to part; each further coordinate is taken for sixteen times as many.
ONE_AXIS = 1 << 14
#: Rounding allowance of ranges and single-precision distances, which only pick candidates.
EPSILON = 1e-4
#: Entries of a distance matrix that a task holds at once.
STRIP = 4 << 20


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same in each process."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks(dim: int, size: int = BLOCK) -> list[slice]:
    return [slice(a, min(dim, a + size)) for a in range(0, dim, size)]


def _valid(v: pa.Array, kind: str) -> list[bytes | None]:
    """The components as bytes of each non-empty, finite, non-zero vector; None for others."""
    out: list[bytes | None] = []
    for x in v:
        a = None
        if x.is_valid and len(x.values) and not x.values.null_count:
            a = x.values.to_numpy(zero_copy_only=False).astype(kind) + 0.0  # -0.0 becomes 0.0
            norm = float(np.square(a, dtype=np.float64).sum()) if np.isfinite(a).all() else 0.0
            if not 0 < norm < math.inf:
                a = None
        out.append(None if a is None else a.astype(kind).tobytes())
    return out


def _unit(raw, kind: str) -> np.ndarray:
    a = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    return a / np.sqrt(np.einsum("ij,ij->i", a, a))[:, None]


def _spread(classes: DataFrame, axes: int, budget: float, kind: str) -> DataFrame:
    """A row for each block and cell that a vector lies in (home) or may reach from a lower cell, with its coordinates there.

    Two vectors within ``budget`` (squared) have a block of b dimensions within budget * b / dim. A cell is a box over
    the first ``axes`` coordinates of a block; it meets the vectors of lower cells no farther than that.
    """

    def run(batches):
        for batch in batches:
            raws = batch.column("raw").to_pylist()
            by_dim: dict[int, list[int]] = {}
            for i, r in enumerate(raws):
                by_dim.setdefault(len(r) // np.dtype(kind).itemsize, []).append(i)
            for dim, rows in by_dim.items():
                y = _unit([raws[i] for i in rows], kind) @ rotation(dim)
                pick, block, cells, homes, coords = [], [], [], [], []
                for b, part in enumerate(blocks(dim)):
                    size = part.stop - part.start
                    radius = math.sqrt(budget * size / dim) * (1 + EPSILON) + EPSILON
                    width = 1.5 * radius
                    z = y[:, part][:, : min(axes, size)] / width
                    base = np.floor(z).astype(np.int64)
                    reach = radius / width
                    near = [(np.arange(len(rows)), base.copy(), np.zeros(len(rows)))]
                    for axis in range(z.shape[1]):
                        grown = []
                        for who, cell, gone in near:
                            at = z[who, axis]
                            for step in (-1, 0, 1):
                                c = base[who, axis] + step
                                gap = np.maximum(0, np.maximum(c - at, at - c - 1))
                                keep = gone + gap**2 <= reach**2
                                moved = cell[keep].copy()
                                moved[:, axis] = c[keep]
                                grown.append((who[keep], moved, (gone + gap**2)[keep]))
                        near = grown
                    for who, cell, _ in near:
                        step = cell - base[who]
                        lead = np.zeros(len(who), np.int64)
                        for axis in range(step.shape[1]):
                            lead = np.where(lead == 0, step[:, axis], lead)
                        keep = lead >= 0  # home, or a lexicographically higher cell
                        pick.append(np.asarray(rows)[who[keep]])
                        block.append(np.full(keep.sum(), b))
                        cells.append(_cell_names(dim, b, cell[keep]))
                        homes.append(lead[keep] == 0)
                        raw = np.ascontiguousarray(y[:, part][who[keep]].astype("<f4")).tobytes()
                        coords += [raw[k : k + 4 * size] for k in range(0, len(raw), 4 * size)]
                take = np.concatenate(pick)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells)), pa.array(np.concatenate(block), pa.int32()), pa.array(np.concatenate(homes)), batch.column("c").take(pa.array(take)), pa.array(coords, pa.binary())],
                    ["cell", "block", "home", "c", "coords"],
                )

    return classes.select("c", "raw").mapInArrow(run, "cell long, block int, home boolean, c long, coords binary")


def _cell_names(dim: int, block: int, cell: np.ndarray) -> np.ndarray:
    """A 64-bit hash of dimension, block and box. Boxes that share one are searched together, which costs time alone."""
    h = np.full(len(cell), dim * 1_000_003 + block, np.int64).view(np.uint64)
    for axis in range(cell.shape[1]):
        h = common.mix(h + cell[:, axis].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return common.mix(h).view(np.int64)


def _near_strips(part: np.ndarray, home: np.ndarray, chunk: np.ndarray | None, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of rows within ``share`` in single precision, strip by strip: i is at home and j is away or comes before it.

    Rows that are away come first. With ``chunk`` only pairs of two chunks.
    """
    n = len(part)
    square = np.einsum("ij,ij->i", part, part)
    order = np.where(home, np.arange(n), -1)
    lo, step = n - int(home.sum()), max(1, STRIP // max(1, n))
    while lo < n:
        hi = min(n, lo + step)
        near = square[lo:hi, None] + square[None, :hi] - 2 * part[lo:hi] @ part[:hi].T <= share + EPSILON
        near &= order[None, :hi] < order[lo:hi, None]
        if chunk is not None:
            near &= chunk[None, :hi] != chunk[lo:hi, None]
        i, j = np.nonzero(near)
        yield i + lo, j
        lo = hi


def _involved(rows: pd.DataFrame, cosine: float, dims: dict[int, int]) -> pd.DataFrame:
    """The rows (cell, block, c, home) of a task that have another within their block's share."""
    out = []
    for (block, width), g in rows.groupby(["block", rows["coords"].str.len()], sort=False):
        g = g.sort_values("home", kind="stable")
        apart = g["i"].iloc[0] != g["j"].iloc[0]
        part = np.frombuffer(b"".join(g["coords"]), "<f4").reshape(len(g), -1)
        # Blocks of one place and size have the largest share in the lowest dimension; cells of two dimensions rarely meet.
        share = max((2 - 2 * cosine) * (p.stop - p.start) / dim for dim in dims for k, p in enumerate(blocks(dim)) if k == block and 4 * (p.stop - p.start) == width)
        hit = np.zeros(len(g), bool)
        for i, j in _near_strips(part, g["home"].to_numpy(bool), g["chunk"].to_numpy() if apart else None, share):
            hit[i] = hit[j] = True
        out.append(g.loc[hit, ["cell", "block", "home", "c"]])
    return pd.concat(out)


def _match(rows: pd.DataFrame, cosine: float, kind: str) -> pd.DataFrame:
    """Links of one task of a cell that this block is the first to have: vec_id, links counted with copies, forest edge.

    A pair is taken from its home, or from the later of two homes in the order of (vec_id, vector). A task of two chunks
    has only the pairs between them.
    """
    found = []
    for (block, width), g in rows.groupby(["block", rows["raw"].str.len()], sort=False):
        apart = g["i"].iloc[0] != g["j"].iloc[0]
        g = g.sort_values(["home", "vec_id", "raw"])  # probes first
        unit = _unit(g["raw"], kind)
        ids, weight, home, chunk = (g[c].to_numpy() for c in ("vec_id", "n", "home", "chunk"))
        n, dim = unit.shape
        y = unit @ rotation(dim)
        parts = blocks(dim)
        share = [(2 - 2 * cosine) * (p.stop - p.start) / dim * (1 + 1e-9) + 1e-12 for p in parts]
        counts, root = np.zeros(n, np.int64), np.arange(n)

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in _near_strips(y[:, parts[block]].astype(np.float32), home.astype(bool), chunk if apart else None, share[block]):
            for k in range(0, len(i), 1 << 16):
                a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                linked = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
                a, b = a[linked], b[linked]
                for q in range(block + 1):  # within its share here, and not in an earlier block
                    e = y[a, parts[q]] - y[b, parts[q]]
                    within = np.einsum("ij,ij->i", e, e) <= share[q]
                    keep = within if q == block else ~within
                    a, b = a[keep], b[keep]
                np.add.at(counts, a, weight[b])
                np.add.at(counts, b, weight[a])
                while (root != root[root]).any():
                    root = root[root]
                new = root[a] != root[b]  # a dense group is joined by its first few
                for u, v in zip(a[new].tolist(), b[new].tolist(), strict=True):
                    u, v = find(u), find(v)
                    root[max(u, v)] = min(u, v)
        some = np.flatnonzero(counts)
        found.append(pd.DataFrame({"vec_id": ids[some], "links": counts[some], "to": ids[np.array([find(x) for x in some.tolist()], np.int64)]}))
    return pd.concat(found)


def _dealt(rows: DataFrame, scratch: Scratch, step: str) -> DataFrame:
    """``rows`` of cells that some vector is at home in, in chunk pairs (cell, i, j) of at most twice CELL rows."""
    sizes = rows.groupBy("cell").agg(F.max("home").alias("any"), F.count(F.lit(1)).alias("rows")).where("any AND rows > 1")
    sizes = scratch.table(sizes.select("cell", F.ceil(F.col("rows") / CELL).cast("int").alias("chunks")), step)
    dealt = rows.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).drop("chunks", "other")


def near_dedup(spark: SparkSession, vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding; others are ignored): vec_id, n_links, component_id, kept.

    Vectors link when their cosine in double precision is ``cosine`` or more; n_links counts the other vectors linked
    directly, component_id is the smallest vec_id reachable, and the vector that has it is kept. Null, empty, zero or
    non-finite vectors and those with a null component link with nothing, nor do vectors of unequal dimensions. Each row
    counts as a vector, but rows that share a vec_id are one node of the components; a null vec_id links with nothing,
    has no component and is kept. An empty table gives no rows.

    Equal vectors are one class that counts its copies. Classes are rotated and split into blocks of BLOCK dimensions;
    a pair within the squared distance 2 - 2 * cosine has a block within its share, and each block is joined by range
    over grid cells. A cell of many rows is cut into chunks that meet two by two. First only ids and a block's coordinates
    go to the cells, where block distances are computed in strips; rows that have another within the share, few but for
    real links, go to their cell again as whole vectors, and what passes there is verified in double precision. A link is
    counted in the first block that has it, so no pair leaves a task: only counts and a spanning forest of each cell do.
    What the result reads is one table; all others are deleted.
    """
    scratch = Scratch(spark, "embedding")

    kind = "f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "f8"

    def bytes_of(batches):
        for batch in batches:
            known = batch.column("vec_id").is_valid().to_pylist()
            raw = [r if k else None for r, k in zip(_valid(batch.column("embedding"), kind), known, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary())], ["vec_id", "raw"])

    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(bytes_of, "vec_id long, raw binary")
    read = scratch.table(read.withColumn("key", F.sha2("raw", 256)), "read")
    groups = read.where("raw is not null").groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n"), F.min("raw").alias("raw"))
    classes = scratch.table(groups.withColumn("c", F.monotonically_increasing_id()), "classes")
    dims = {r[0] // np.dtype(kind).itemsize: 0 for r in classes.select(F.octet_length("raw")).distinct().limit(1 << 16).collect()}
    n = classes.count()
    axes = 1 + max(0, math.ceil(math.log(max(1, n / ONE_AXIS), 16)))
    rows = scratch.table(_spread(classes, axes, 2 - 2 * cosine, kind), "rows")
    dealt = _dealt(rows, scratch, "sizes").groupBy("cell", "i", "j")
    near = dealt.applyInPandas(lambda rows: _involved(rows, cosine, dims), "cell long, block int, home boolean, c long")
    near = scratch.table(near.distinct(), "near")
    scratch.drop("rows", "sizes")
    whole = _dealt(near, scratch, "near-sizes").join(classes.select("c", "vec_id", "n", "raw"), "c")
    found = scratch.table(whole.groupBy("cell", "i", "j").applyInPandas(lambda rows: _match(rows, cosine, kind), "vec_id long, links long, to long"), "found")
    labels = common.components(spark, found.select(F.col("vec_id").alias("a"), F.col("to").alias("b")), scratch, "labels")
    links = scratch.table(found.groupBy("vec_id").agg(F.sum("links").alias("links")), "links")
    graph = classes.join(links, "vec_id", "left").join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component"))
    graph = scratch.table(graph, "graph")
    component = F.coalesce("component", "vec_id")
    return scratch.only(read.join(graph, "key", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")))
