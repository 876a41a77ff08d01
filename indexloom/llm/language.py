"""Language of code-switched text by a linear-chain conditional random field over words."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import U64, mix

#: Training documents per language, pieces taken from each and words of a piece: the bound of the training sample.
SAMPLE_DOCS, PIECES, PIECE_WORDS = 600, 3, 24
#: Documents of folds other than this one, of FOLDS, may be learned from.
FOLDS, HELD_OUT = 4, 2
#: Bytes of text that are labelled at once.
SLICE = 512 << 10
#: Words of a block of the chain. All blocks of a slice run word by word beside each other, so a long text is many short chains.
BLOCK = 512
#: Hashed features.
TABLE = 1 << 16
UNKNOWN = "und"
_LATIN = re.compile("[A-Za-z]")
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    """Weights by feature and language, transitions between the languages of neighbouring words, and those of a first word."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_LATIN.search(text) or _LETTER.search(text))


def features(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, word) pairs sorted by word: affixes of one to three bytes, inner trigrams and the word itself."""
    n = len(starts)
    word = np.arange(n)
    parts, owner = [common.hash_spans(data, starts, lengths, 9)], [word]
    for k in (1, 2, 3):
        size = np.minimum(lengths, k)
        parts += [common.hash_spans(data, starts, size, k), common.hash_spans(data, starts + lengths - size, size, 3 + k)]
        owner += [word, word]
    grams = np.maximum(lengths - 2, 0)
    who = np.repeat(word, grams)
    at = np.arange(len(who)) - np.repeat(np.cumsum(grams) - grams, grams) + starts[who]
    three = data[at].astype(U64) | data[at + 1].astype(U64) << U64(8) | data[at + 2].astype(U64) << U64(16) if len(who) else np.zeros(0, U64)
    parts.append(mix(three + U64(1 << 40)))
    owner.append(who)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(parts) % U64(TABLE)).astype(np.int64)[order], owner[order]


def emissions(model: Model, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Scores (words, labels), each distinct word scored once."""
    if not len(starts):
        return np.zeros((0, len(model.labels)), np.float32)
    _, first, back = np.unique(common.hash_spans(data, starts, lengths), return_index=True, return_inverse=True)
    out = np.empty((len(first), len(model.labels)), np.float32)
    for lo in range(0, len(first), 1 << 15):  # feature lists of so many words are held at once
        part = first[lo : lo + (1 << 15)]
        f, owner = features(data, starts[part], lengths[part])
        out[lo : lo + len(part)] = np.add.reduceat(model.weights[f], np.searchsorted(owner, np.arange(len(part))), axis=0)
    return out[back]


def _sum_to_one(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def _transfer(local: np.ndarray, at: np.ndarray, length: np.ndarray, before: np.ndarray, step: np.ndarray) -> np.ndarray:
    """For each block the matrix that takes a message over it, up to scale; ``before`` is the move into its first word."""
    order = np.argsort(-length, kind="stable")
    at, length = at[order], length[order]
    out = before[order] * local[at][:, None, :]
    for t in range(1, int(length[0])):
        k = int(np.searchsorted(-length, -t, side="left"))
        m = (out[:k] @ step) * local[at[:k] + t][:, None, :]
        out[:k] = m / m.sum(axis=(1, 2), keepdims=True)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back]


def forward_backward(scores: np.ndarray, bounds: np.ndarray, moves: np.ndarray, start: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(local factors, forward messages, backward messages) at each word, each message up to scale.

    Documents are cut into blocks, and all blocks advance together. What enters a block from either side is found first,
    from the transfer matrices of the blocks of long documents, so the cuts change nothing.
    """
    n, n_labels = scores.shape
    local = np.exp(scores - scores.max(axis=1, keepdims=True)) if n else scores
    step, first_step = np.exp(moves).astype(local.dtype), np.exp(start).astype(local.dtype)
    sizes = np.diff(bounds)
    parts = -(-sizes // block)
    doc = np.repeat(np.arange(len(sizes)), parts)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    at, length = bounds[:-1][doc] + rank * block, np.minimum(block, sizes[doc] - rank * block)
    into = np.tile(first_step, (len(doc), 1))
    behind = np.ones((len(doc), n_labels), local.dtype)
    cut = np.flatnonzero(parts[doc] > 1)
    if len(cut):
        begins = (rank[cut] == 0)[:, None, None]
        over = np.empty((len(doc), n_labels, n_labels), local.dtype)
        over[cut] = _transfer(local, at[cut], length[cut], np.where(begins, np.eye(n_labels, dtype=local.dtype), step), step)
        by_rank = [cut[rank[cut] == r] for r in range(int(rank.max()) + 1)]
        end = into.copy()  # the forward message at the last word of each block
        for here in by_rank:
            if len(here) and rank[here[0]]:
                into[here] = end[here - 1] @ step
            enters = into[here] if len(here) and not rank[here[0]] else end[here - 1]
            end[here] = _sum_to_one(np.einsum("bi,bij->bj", enters, over[here]))
        for here in by_rank[::-1]:
            here = here[rank[here] < parts[doc[here]] - 1]
            behind[here] = _sum_to_one(np.einsum("bij,bj->bi", over[here + 1], behind[here + 1]))
    order = np.argsort(-length, kind="stable")
    at, length, into, behind = at[order], length[order], into[order], behind[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")  # blocks longer than t
    alpha, beta = np.empty_like(local), np.empty_like(local)
    a = into
    for t in range(longest):
        k = active[t]
        a = _sum_to_one(local[at[:k] + t] * (a if t == 0 else a[:k] @ step))
        alpha[at[:k] + t] = a
    b = behind[:0]
    for t in range(longest - 1, -1, -1):
        k = active[t]
        new = behind[:k].copy()
        if len(b):
            new[: len(b)] = _sum_to_one((local[at[: len(b)] + t + 1] * b) @ step.T)
        b = new
        beta[at[:k] + t] = b
    return local, alpha, beta


def marginals(scores: np.ndarray, bounds: np.ndarray, moves: np.ndarray, start: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Posterior of each label at each word by forward-backward."""
    _, alpha, beta = forward_backward(scores, bounds, moves, start, block)
    return _sum_to_one(alpha * beta) if len(scores) else alpha


def gradients(scores: np.ndarray, truth: np.ndarray, bounds: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the log-likelihood of ``truth``, by scores, moves and start: what is there less what is expected.

    A pair of neighbours is expected by the forward message of one, the move, and the factor and backward message of the other.
    """
    local, alpha, beta = forward_backward(scores, bounds, moves, start)
    by_score = -_sum_to_one(alpha * beta)
    by_score[np.arange(len(truth)), truth] += 1
    left = np.setdiff1d(np.arange(len(truth) - 1), bounds[1:-1] - 1)
    pair = alpha[left][:, :, None] * np.exp(moves)[None] * (local * beta)[left + 1][:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    by_move = -pair.sum(axis=0)
    np.add.at(by_move, (truth[left], truth[left + 1]), 1)
    return by_score, by_move, by_score[bounds[:-1]].sum(axis=0)


def train(pieces: list[tuple[str, list[bytes]]], epochs: int = 4, batch: int = 64, rate: float = 0.3, seed: int = 11) -> Model:
    """A model by stochastic ascent of the conditional likelihood (AdaGrad).

    Each training sequence strings one to four pieces of random languages together, so transitions learn how long text
    stays in a language.
    """
    labels = sorted({x for x, _ in pieces})
    n_labels = len(labels)
    model = Model(labels, np.zeros((TABLE, n_labels), np.float32), np.zeros((n_labels, n_labels)), np.zeros(n_labels))
    if n_labels < 2:
        return model
    rng = np.random.default_rng(seed)
    of = {x: [w for y, w in pieces if y == x] for x in labels}
    flat = [w for _, ws in pieces for w in ws]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    joined = b" ".join(vocabulary)
    starts, lengths, _ = common.word_spans(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]))
    f, owner = features(np.frombuffer(joined, np.uint8), starts, lengths)
    cuts = np.searchsorted(owner, np.arange(len(vocabulary) + 1))
    known = {x: [np.array([vocabulary[w] for w in ws]) for ws in of[x]] for x in labels}
    square_w, square_m, square_s = np.full_like(model.weights, 1e-2), np.full_like(model.moves, 1e-2), np.full_like(model.start, 1e-2)
    for _ in range(epochs * max(1, len(pieces) // (2 * batch))):
        words, truth, bounds = [], [], [0]
        for _ in range(batch):
            for _ in range(rng.integers(1, 5)):
                y = int(rng.integers(n_labels))
                w = known[labels[y]][rng.integers(len(known[labels[y]]))]
                words.append(w)
                truth.append(np.full(len(w), y))
            bounds.append(sum(map(len, words)))
        words, truth, bounds = np.concatenate(words), np.concatenate(truth), np.array(bounds)
        sizes = cuts[words + 1] - cuts[words]
        who = np.repeat(np.arange(len(words)), sizes)
        feats = f[np.arange(len(who)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + cuts[words][who]]
        scores = np.add.reduceat(model.weights[feats], np.cumsum(sizes) - sizes, axis=0).astype(np.float64)
        grad, gm, gs = gradients(scores, truth, bounds, model.moves, model.start)
        g = np.zeros_like(model.weights)
        np.add.at(g, feats, grad[who].astype(np.float32))
        for value, gradient, square in ((model.weights, g / batch, square_w), (model.moves, gm / batch, square_m), (model.start, gs / batch, square_s)):
            square += gradient * gradient
            value += rate * gradient / np.sqrt(square)
    return model


def sample_pieces(docs: DataFrame) -> list[tuple[str, list[bytes]]]:
    """Pieces of the training documents: of each language SAMPLE_DOCS documents, chosen by the hash of doc_id."""
    labelled = common.with_crc_fold(docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")), "doc_id", FOLDS).where(f"fold <> {HELD_OUT} AND lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    spot = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.lit(3)), F.lit(1_000_000))
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1_000_000, int(1_000_000 * SAMPLE_DOCS / n) + 1)))])
    chosen = labelled.where(spot < F.element_at(share, F.col("lang"))).select("doc_id", "lang", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, words = [], []
        for doc, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text")), strict=True):
            w = common.LOWER[np.frombuffer(text.encode(), np.uint8)].tobytes().split()
            rng = np.random.default_rng(abs(doc or 0))
            for _ in range(min(PIECES, len(w) // PIECE_WORDS + 1) if w else 0):
                a = int(rng.integers(max(1, len(w) - PIECE_WORDS + 1)))
                langs.append(lang)
                words.append(b" ".join(w[a : a + PIECE_WORDS]))
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary())], ["lang", "words"])

    rows = common.map_text(chosen, run, "lang string, words binary").toPandas()
    return sorted((x, bytes(w).split()) for x, w in zip(rows["lang"], rows["words"], strict=True))


def label_texts(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each whole text; the score is the language's mean posterior over the words that have letters."""
    n = len(texts)
    if not model.labels:
        return [UNKNOWN] * n, np.zeros(n)
    data, offsets = common.text_bytes(texts)
    data = common.LOWER[data]
    starts, lengths, doc_of = common.word_spans(data, offsets)
    letter = (data >= 97) & (data <= 122) | (data >= 128)
    within = np.r_[0, np.cumsum(letter)]
    lettered = within[starts + lengths] > within[starts]
    post = marginals(emissions(model, data, starts, lengths), common.doc_starts(doc_of, n), model.moves, model.start)
    total = np.zeros((n, len(model.labels)))
    np.add.at(total, doc_of[lettered], post[lettered])
    count = np.bincount(doc_of[lettered], minlength=n)
    known = np.array([has_letter(t) for t in texts.to_pylist()], bool)
    best = total.argmax(axis=1)
    score = np.where(known & (count > 0), total.max(axis=1) / np.maximum(count, 1), 0.0)
    return [model.labels[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.clip(score, 0, 1)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, score = label_texts(model, batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return common.map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double", SLICE)


def keep_identified(docs: DataFrame, min_score: float) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``min_score``, all columns, ``lang`` set to that language.

    Trained on ``docs`` as in :func:`identify`; without a column ``lang`` there is nothing to learn from, and every row
    goes. Null texts and texts without a letter go, repeated rows are decided alike. No shuffle.
    """
    if "lang" not in docs.columns:
        return docs.limit(0)
    model = train(sample_pieces(docs))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, score = label_texts(model, batch.column("text"))
        batch = batch.set_column(batch.schema.get_field_index("lang"), "lang", pa.array(langs, pa.string()))
        return batch.filter(pa.array((score >= min_score) & (np.array(langs) != UNKNOWN)))

    typed = docs.withColumn("lang", F.col("lang").cast("string"))
    return common.map_text(typed, run, typed.schema, SLICE)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of ``docs`` (doc_id, text, lang; others are ignored).

    The field is trained on a bounded sample of the documents that may be learned from and sees only text after that.
    Null texts and texts without a letter are ``und`` with score 0, as is everything if no row has a lang to learn from;
    with one language every other text gets it with score 1. A null doc_id counts as the empty text for the fold.
    Repeated rows are predicted alike; an empty table gives no rows. No shuffle but of the counts by language.
    """
    out = predict(docs, train(sample_pieces(docs)))
    return common.with_crc_fold(out, "doc_id", FOLDS).select("doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "lang_pred", "score")
