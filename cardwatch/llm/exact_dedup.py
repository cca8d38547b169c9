"""Exact deduplication by skew-safe combining (DataFrame operations only).

Texts are equal when they are identical after every run of ASCII white space
becomes one space.  Three combining steps, each grouped by the whole
normalised text beside its digest, so that no digest is ever trusted alone:

1. *local*: the partial aggregate of step 2 merges copies inside each input
   partition before anything is shuffled;
2. *salted*: copies merge per (digest, text, salt), the salt coming from the
   row's id, so that a text holding a third of all rows meets in ``salts``
   tasks and not in one;
3. *global*: the salt winners of a text (at most ``salts`` rows) are combined
   to the smallest id and the group's size.

The verdict returns to the rows along the same (digest, salt) pairs, narrow
rows only.  Equal texts have equal digests, so a digest with one text needs
no text in that join; digests shared by different texts (found in step 3, by
comparing texts) are joined on the text as well.

Defined cases: NULL text is the empty text; a NULL id never wins against an
id (a group of NULL ids keeps NULL); rows repeating the winning id are all
marked as kept; an empty table gives an empty result; further columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import SPACE_CLASS, text_of, written


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(text_of(text), f"[{SPACE_CLASS}]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32,
                     digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``,
    ``kept``, ``digest``."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt"),
        normalised(text_col).alias("norm"),
    ).withColumn("digest", digest(F.col("norm")))

    winners = rows.groupBy("digest", "norm", "salt").agg(F.min("doc_id").alias("first_id"),
                                                         F.count(F.lit(1)).alias("n"))
    same_digest = Window.partitionBy("digest")
    same_text = Window.partitionBy("digest", "norm")
    verdicts = (winners
                .withColumn("clash", F.min("norm").over(same_digest) != F.max("norm").over(same_digest))
                .withColumn("keep_id", F.min("first_id").over(same_text))
                .withColumn("group_size", F.sum("n").over(same_text))
                .select("digest", "salt", "keep_id", "group_size", F.when(F.col("clash"), F.col("norm")).alias("norm")))
    verdicts = written(verdicts, "exact-verdicts")

    keys = rows.select("doc_id", "salt", "digest")
    out = keys.join(verdicts.where(F.col("norm").isNull()).drop("norm"), ["digest", "salt"])
    clashing = verdicts.where(F.col("norm").isNotNull())
    if not clashing.isEmpty():
        out = out.unionByName(rows.join(clashing, ["digest", "salt", "norm"]).drop("norm"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "digest")


def op10_exact_dedup(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept",
                                         F.lower(F.hex("digest")).alias("text_sha256"))
