"""From raw documents to packed training sequences: language, exact, near and substring deduplication, packing.

Each stage takes (spark, docs, sf_dir), works on all of docs and returns a DataFrame; all but the last return the
columns of docs. STAGES lists them in order; ``run`` writes each result as Parquet and reads it for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.llm import language, minhash, packing, substring
from indexloom.llm.common import Scratch, drop_rows
from indexloom.llm.exact_dedup import exact_dedup

#: Documents whose language is less sure go: mean posterior over their words.
MIN_LANGUAGE_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null texts too) or of no sure language go; ``lang`` is the language found."""
    return language.keep_identified(docs, MIN_LANGUAGE_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows whose texts are equal after lower-casing A-Z, the one with the largest doc_id stays (null counts as least).

    Rows are decided by their own text: where ids repeat, other texts under an id stay, and of equal rows one does. A
    null text counts as empty. An empty table gives no rows.
    """
    return drop_rows(spark, docs, lambda rows: exact_dedup(spark, rows, digests=False), nulls_last=False, name="stage-exact")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by five-word shingles at a similarity of 0.8, the one with the smallest doc_id stays (null counts as largest).

    Rows are decided by their own text, as in :func:`drop_exact_copies`. Null texts and texts without words link with
    nothing and stay. An empty table gives no rows.
    """
    return drop_rows(spark, docs, lambda rows: minhash.near_dedup(spark, rows, k=5, percent=80), nulls_last=True, name="stage-near")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 50 words that a smaller doc_id has go from the text; documents that lose every word go.

    Null and empty texts stay as they are. Rows without doc_id lose nothing; rows that share one are one document. Columns
    beside doc_id and text pass through, n_chars is counted anew where words went. An empty table gives no rows.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    safe = {c: f"carry_{i}" for i, c in enumerate(rest)}
    renamed = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(s) for c, s in safe.items()])
    cut = substring.substring_dedup(spark, renamed, keep_text=True, carry=tuple(safe.values())).where("n_removed = 0 OR n_removed < n_words")
    text = F.col("kept_text")
    columns = {"doc_id": F.col("doc_id"), "text": text} | {c: F.col(s) for c, s in safe.items()}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(columns["n_chars"])
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens; a null text is its end token alone, repeated rows are packed each."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: SQL can't express the language model or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.table(docs, name)
            if i:
                scratch.drop(STAGES[i - 1][0])
    return docs
