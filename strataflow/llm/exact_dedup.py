"""Exact duplicates with frequent digests split off (DataFrame functions only).

A Misra-Gries sketch over the digests names those that may be frequent. Their true counts are then
taken, and the verified winners, a bounded number of rows, are broadcast: copies of a frequent
text are settled where they are read. All other digests are counted in an ordinary shuffle, combined before
it, and the counts of those that repeat are joined back. No task needs the rows of a group together,
so a group of any size, named by the sketch or not, can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import frequent, one_of_each, saved, texts

#: Counters of the sketch: a digest with more than about 1/TRACKED of all rows is never missed.
TRACKED = 16_384
#: At most so many winners are broadcast (a row is about 100 bytes).
MOST_WINNERS = 4_096
#: Rarer digests are not worth a broadcast row.
LEAST_COPIES = 64


def digest(text: Column) -> Column:
    """SHA-256, lower-case hex, of the text with each run of white space as one space."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.sha2(plain.cast("binary"), 256)


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tracked: int = TRACKED,
    most_winners: int = MOST_WINNERS,
    least_copies: int = LEAST_COPIES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white-space runs became one space; a NULL text is an empty
    one. The smallest id of a group stays. A NULL id is larger than any other: a group with
    NULL ids only has keep_id NULL and stays. Repeated rows of one id count as rows of the group and
    stand or fall together. An empty table gives no rows. Other columns of ``docs`` play no part.
    """
    picked = texts(docs, id_column, text_column)
    digests = saved(
        picked.select("doc_id", F.unhex(digest(F.col("text"))).alias("digest")), "digests"
    )
    hashes = digests.select(F.xxhash64("digest").alias("h"))
    candidates = frequent(hashes, "h", tracked, most_winners, least_copies)
    # The sketch counts hashes; these are the true counts of its few candidates.
    winners = (
        digests.withColumn("h", F.xxhash64("digest"))
        .join(F.broadcast(candidates), "h", "left_semi")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") >= least_copies)
    )
    winners = saved(winners, "winners")
    copied = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners), "digest", "left_anti")
    repeated = (
        rest.groupBy("digest")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    alone = F.col("group_size").isNull()
    others = rest.join(repeated, "digest", "left").select(
        "digest",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
    )
    return copied.select(others.columns).unionAll(others).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of ``exact_groups``, all columns as they are.

    It is of the smallest id; of rows that share it, or of a group without ids, one stays.
    """
    groups = exact_groups(docs, id_column, text_column).where("group_size > 1")
    keys = groups.groupBy("doc_id", F.col("text_sha256").alias("text_key"), "kept").count()
    return one_of_each(
        docs,
        F.col(id_column).cast("long"),
        digest(F.col(text_column)),
        keys.where("not kept or count > 1"),
    )
