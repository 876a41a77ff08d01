"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import Scratch

#: Characters of the normalised text that the second key covers.
PREFIX = 64


def exact_dedup(spark: SparkSession, docs: DataFrame, digests: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; a null text is empty, and empty texts are equal.
    Of a group the largest doc_id stays. Lengths that occur once are groups of one without another look; so are
    (length, prefix) pairs that occur once; only the rest is grouped by the full digest. With ``digests`` False only
    texts that survive the first two steps are normalised and hashed in full, and text_sha256 is null for the others.

    Rows that share a doc_id and a text count each in group_size and are all ``kept`` if that id stays. A null doc_id
    never stays in a group that has another id; alone its keep_id is null and it is kept. An empty table gives no rows.

    All in the JVM, and only keys are shuffled. Groups are counted by partial aggregation, and the join that brings the
    counts back is a plain equi-join, whose large partitions adaptive execution splits; no group is gathered in one task.
    What the result reads is one table; all others are deleted.
    """
    scratch = Scratch(spark, "exact")
    text = F.coalesce(F.col("text"), F.lit(""))
    lower = lambda c: F.translate(c, ascii_uppercase, ascii_lowercase)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).alias("n_bytes"), F.xxhash64(lower(F.substring(text, 1, PREFIX))).alias("prefix"), text.alias("text"))
    key = F.xxhash64("n_bytes", "prefix")
    digest = F.sha2(lower(F.col("text")).cast("binary"), 256)
    if digests:
        keyed = scratch.table(keyed.select("doc_id", "n_bytes", "prefix", digest.alias("digest")), "keys")
    short = scratch.table(keyed.select("n_bytes", "prefix"), "short") if not digests else keyed
    lengths = short.groupBy("n_bytes").count().where("count > 1").select("n_bytes")
    prefixes = short.join(scratch.table(lengths, "lengths"), "n_bytes", "left_semi").groupBy("n_bytes", "prefix").count().where("count > 1").select(key.alias("k2"))
    prefixes = scratch.table(prefixes, "prefixes")
    hit = common.may_be_in(spark, common.bloom_bits(prefixes, F.col("k2"), common.filter_size(prefixes.count())), key)
    rows = scratch.table(keyed.select("doc_id", F.col("digest") if digests else F.when(hit, digest).alias("digest"), hit.alias("again")), "rows")
    groups = rows.where("again").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    return scratch.only(
        rows.join(scratch.table(groups, "groups"), "digest", "left").select(
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.when(F.col("group_size").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )
