"""Text quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import Scratch

#: Labelled rows that are learned from at most, by the hash of doc_id.
MAX_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
#: Bins of a feature, of a feature in a pair, pairs, rounds over all features and over all pairs.
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS = 64, 16, 10, 150, 60
RATE, RIDGE, LEAF_ROWS = 0.1, 1.0, 8
#: A text is predicted good from this score.
CUT = 0.3

FEATURES = (
    "log_words", "mean_word_bytes", "long_words", "single_letters", "distinct_words", "top_word", "repeated_next", "repeated_lines",
    "log_line_words", "upper", "digits", "symbols", "marks", "stops", "commas", "non_ascii", "symbol_ends", "mark_ends", "capital_starts", "longest_word",
)

_CLASS = np.zeros((256, 8), bool)  # upper, lower, digit, symbol, mark, stop, comma, non-ASCII
_CLASS[65:91, 0] = _CLASS[97:123, 1] = _CLASS[48:58, 2] = True
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"], 3] = True
_CLASS[[ord("!"), ord("?")], 4] = _CLASS[[ord("."), ord(";"), ord(":")], 5] = _CLASS[ord(","), 6] = True
_CLASS[128:, 7] = True


def text_features(column: pa.Array) -> np.ndarray:
    """(texts, FEATURES): shares of bytes, words and lines of each whole text; an empty text is all zeros."""
    n = len(column)
    data, offsets = common.text_bytes(column)
    starts, lengths, doc = common.word_spans(data, offsets)
    bounds = common.doc_starts(doc, n)
    words = np.diff(bounds)
    some = np.maximum(words, 1)
    of_doc = lambda x: np.bincount(doc, weights=x, minlength=n)
    size = np.maximum(np.diff(offsets), 1)
    shares = []
    for k in range(8):
        total = np.r_[0, np.cumsum(_CLASS[:, k][data])]
        shares.append(total[offsets[1:]] - total[offsets[:-1]])
    upper, lower, digit, symbol, mark, stop, comma, high = shares
    h = common.hash_spans(data, starts, lengths)
    order = np.lexsort((h, doc))
    hs, ds = h[order], doc[order]
    new = np.r_[True, (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])] if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    run = np.diff(np.r_[at, len(h)])
    top = np.zeros(n)
    np.maximum.at(top, ds[at], run)
    same = np.r_[False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])] if len(h) else np.zeros(0, bool)
    lines, again = _lines(data, offsets, n)
    last = data[starts + lengths - 1] if len(starts) else np.zeros(0, np.uint8)
    head = data[starts] if len(starts) else np.zeros(0, np.uint8)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, lengths)
    columns = [
        np.log1p(words), of_doc(lengths) / some, of_doc(lengths > 20) / some, of_doc(lengths == 1) / some, np.bincount(ds[at], minlength=n) / some, top / some, of_doc(same) / some, again / np.maximum(lines, 1),
        np.log1p(words / np.maximum(lines, 1)), upper / np.maximum(upper + lower, 1), digit / size, symbol / size, mark / size, stop / some, comma / some, high / size,
        of_doc(_CLASS[last, 3]) / some, of_doc(_CLASS[last, 4]) / some, of_doc(_CLASS[head, 0]) / some, np.log1p(longest),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _lines(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-empty lines of each text, and those that repeat an earlier line."""
    solid = data != 10
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if not len(data):
        return np.zeros(n), np.zeros(n)
    starts = np.flatnonzero(solid & (np.r_[True, ~solid[:-1]] | edge[:-1]))
    ends = np.flatnonzero(solid & (np.r_[~solid[1:], True] | edge[1:])) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    h = common.hash_spans(data, starts, ends - starts)
    order = np.lexsort((h, doc))
    h, d = h[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])] if len(h) else np.zeros(0, bool)
    return np.bincount(doc, minlength=n), np.bincount(d[~new], minlength=n)


@dataclass
class Model:
    """An intercept, bin edges and a table of additions per feature, and for each pair its coarser edges and table."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Bin look-ups and additions only."""
        out = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        for i, j, a, b, table in self.pairs:
            out += table[np.searchsorted(a, x[:, i], side="right"), np.searchsorted(b, x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between the quantiles; values that many rows share get a bin of their own."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="inverted_cdf").astype(np.float32))


def _tree(g: np.ndarray, h: np.ndarray, c: np.ndarray, depth: int = 2) -> np.ndarray:
    """The step of each bin by a tree of ``depth`` levels over the bins' gradient, curvature and row counts."""
    out = np.empty(len(g))

    def grow(lo: int, hi: int, left: int) -> None:
        sg, sh, sc = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi]), np.cumsum(c[lo:hi])
        G, H, C = sg[-1], sh[-1], sc[-1]
        if left and hi - lo > 1:
            gain = sg[:-1] ** 2 / (sh[:-1] + RIDGE) + (G - sg[:-1]) ** 2 / (H - sh[:-1] + RIDGE) - G**2 / (H + RIDGE)
            gain[(sc[:-1] < LEAF_ROWS) | (C - sc[:-1] < LEAF_ROWS)] = -1
            k = int(gain.argmax())
            if gain[k] > 1e-9:
                grow(lo, lo + k + 1, left - 1)
                grow(lo + k + 1, hi, left - 1)
                return
        out[lo:hi] = G / (H + RIDGE)

    grow(0, len(g), depth)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, steps) of the best tree that cuts both axes of a pair table once."""
    cut = lambda x: np.cumsum(np.cumsum(x, axis=0), axis=1)
    G, H, C = cut(g), cut(h), cut(c)
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)

    def four(S):
        a, right, below, all_ = S[:-1, :-1], S[:-1, -1:], S[-1:, :-1], S[-1, -1]
        return a, right - a, below - a, all_ - right - below + a

    gs, hs, cs = four(G), four(H), four(C)
    gain = sum(x**2 / (y + RIDGE) for x, y in zip(gs, hs, strict=True)) - G[-1, -1] ** 2 / (H[-1, -1] + RIDGE)
    gain = np.where(np.minimum.reduce(cs) < 1, -1, gain)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[i, j] <= 1e-9:
        return 0.0, np.zeros_like(g)
    steps = np.empty_like(g)
    v = [x[i, j] / (y[i, j] + RIDGE) for x, y in zip(gs, hs, strict=True)]
    steps[: i + 1, : j + 1], steps[: i + 1, j + 1 :], steps[i + 1 :, : j + 1], steps[i + 1 :, j + 1 :] = v
    return float(gain[i, j]), steps


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: in each round every feature in turn adds a shallow tree over its bins, then the chosen pairs do."""
    if not len(y):
        return Model(0.0, [], [])
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(rate / (1 - rate))), [_edges(x[:, j], BINS) for j in range(x.shape[1])], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]
    logit = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for b, t, c in zip(bins, model.tables, counts, strict=True):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), c)
            t += step
            logit += step[b]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cbins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def table(i: int, j: int, w: np.ndarray | None) -> np.ndarray:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(cbins[i] * shape[1] + cbins[j], w, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(((_quadrants(table(i, j, g), table(i, j, h), table(i, j, None))[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    chosen = [(i, j, np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for gain, i, j in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in chosen:
            g, h = slopes()
            step = RATE * _quadrants(table(i, j, g), table(i, j, h), table(i, j, None))[1]
            t += step
            logit += step[cbins[i], cbins[j]]
    model.pairs = [(i, j, coarse[i], coarse[j], t) for i, j, t in chosen]
    return model


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs`` (doc_id, text; others are ignored).

    Features of whole texts are computed in one pass and written; the model is trained on those of at most MAX_ROWS
    labelled documents outside the held-out fold (``labels``: doc_id, quality), then added up bin by bin for all rows.
    Null and empty texts have features of zeros and are scored like others. Labels that are null or other than 0 and 1
    are left out; a document with several labels counts with each; without labels each score is 0.5. A null doc_id
    counts as the empty text for the fold and has no label. Repeated rows score alike; an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = text_features(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float32()))], ["doc_id", "x"])

    scratch = Scratch(spark, "quality")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = common.with_crc_fold(common.map_text(slim, run, "doc_id long, x array<float>"), "doc_id", FOLDS)
    rows = scratch.table(rows, "features")
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality IN (0, 1)")
    known = rows.where(f"fold <> {HELD_OUT}").join(truth, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(MAX_ROWS)
    known = known.select("x", "quality").toPandas()
    x = np.stack(known["x"].to_numpy()) if len(known) else np.zeros((0, len(FEATURES)), np.float32)
    model = train(x, known["quality"].to_numpy(np.float64))

    def score(batches):
        for b in batches:
            s = model.score(np.asarray(b.column("x").flatten()).reshape(b.num_rows, -1))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.select("doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "x").mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
