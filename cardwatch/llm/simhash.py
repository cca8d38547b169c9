"""SimHash near-duplicates by Golay-code fuzzy hashing.

*Fingerprint*: A-Z are lower-cased, words are cut at ASCII white space, every
run of ``shingle`` words (repeats included) is hashed with XXH64 (seed 42);
a bit of the fingerprint is set when it is set in more than half of them.

*Candidates*: the 64 bits fall into segments of 22, 21 and 21 bits.  Two
fingerprints at most two bits apart have, by the pigeonhole principle, a
segment without an error; the errors of the next segment (cyclically) are at
most two, so its Golay decoding shares a codeword index.  Each fingerprint
therefore gets, per segment, the keys (exact segment, one to six codeword
indices of the next segment): about 16 keys of 36 bits.

*Verify*: fingerprints that meet under a key are joined and kept when at most
``max_bits`` of their bits differ.  A key under which more than ``HOT_KEY``
distinct fingerprints meet would cost quadratic work; its fingerprints are
linked through midpoints instead: two words are at most two bits apart exactly
when a word lies within one bit of both, so every word links the fingerprints
within one bit of it to the smallest of them.  That costs 65 rows a
fingerprint, loses no link of its component and emits no pairs.

All work is on distinct fingerprints, so thousands of exact copies cost one.

Defined cases: NULL and empty texts (no word) have fingerprint 0, linked like
any other; fewer words than a shingle make one shingle of all words; NULL ids
never name a component that has another id; an empty table gives an empty
result; repeated ids share the component of their fingerprint; further
columns are ignored, and clashing names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cardwatch.llm.common import all_but, fresh, quoted, python_workers, written
from cardwatch.llm.components import components
from cardwatch.llm.golay import nearby_indices

SHINGLE, MAX_BITS = 3, 2
SEED = 42
#: (lowest bit, bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Distinct fingerprints under one key beyond which midpoints replace pairs.
HOT_KEY = 64
_CHUNK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, as an unsigned integer."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z change, only ASCII space cuts
    if not words:
        return 0
    line = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends - 1)[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(stops), _CHUNK):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at:at + _CHUNK], stops[at:at + _CHUNK])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def fingerprint_column(text: str | Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""
    @F.pandas_udf(LongType())
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], dtype=np.uint64).view(np.int64))

    return simhash(F.col(text) if isinstance(text, str) else text)


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        fps = batch["fp"].to_numpy(dtype=np.int64)
        bits = fps.view(np.uint64)
        parts = [((bits >> np.uint64(low)) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]
        for i, exact in enumerate(parts):
            row, index = nearby_indices(parts[(i + 1) % len(parts)])
            yield pd.DataFrame({"key": (exact[row] << 14) | (index.astype(np.int64) << 2) | i, "fp": fps[row]})


def fuzzy_keys(fps: DataFrame) -> DataFrame:
    """(key, fp) for distinct fingerprints ``fp``."""
    return fps.select("fp").mapInPandas(_keys, "key long, fp long")


def _close(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """Edges (a, b) whose components are those of all links at up to
    ``max_bits`` differing bits between the distinct fingerprints ``fp``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys find links of at most two bits")
    keys = fuzzy_keys(fps)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    met = written(keys.join(shared, "key"), "simhash-met")

    few = met.where(F.col("n") <= hot_key)
    pairs = (few.select("key", F.col("fp").alias("a"))
             .join(few.select("key", F.col("fp").alias("b")), "key")
             .where((F.col("a") < F.col("b")) & _close("a", "b", max_bits)).select("a", "b"))

    hot = met.where(F.col("n") > hot_key).select("fp").distinct()
    if max_bits == 2:
        # x ^ y has at most two bits: both lie within one bit of a midpoint.
        flips = [0, *[1 << i if i < 63 else -(1 << 63) for i in range(64)]]
        around = hot.select("fp", F.explode(F.array(*[F.lit(x).cast("long") for x in flips])).alias("flip")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    elif max_bits == 1:
        # one bit apart: equal after one of the 64 bits is cleared in both
        masks = [~(1 << i) if i < 63 else (1 << 63) - 1 for i in range(64)]
        around = hot.select("fp", F.posexplode(F.array(*[F.lit(x).cast("long") for x in masks])).alias("bit", "mask")).select(
            "fp", F.xxhash64("bit", F.col("fp").bitwiseAND(F.col("mask"))).alias("mid"))
    else:
        return pairs
    hubs = around.groupBy("mid").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where(F.col("a") != F.col("z"))
    stars = around.join(hubs, "mid").where(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars.where(_close("a", "b", max_bits)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """One row per input row: ``doc_id``, ``fp`` (signed long),
    ``component_id``, the smallest id reachable through links, and ``root``,
    the component's smallest fingerprint (which names it where no row of it
    has an id)."""
    python_workers(docs.sparkSession)
    marked = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(text_col, shingle).alias("fp")),
                     "simhash")
    # copies combine inside each partition before the shuffle
    first = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    linked = components(near_links(first, max_bits, hot_key), "a", "b").withColumnRenamed("node", "fp")
    members = first.join(linked, "fp")
    named = (members.join(members.groupBy("root").agg(F.min("first_id").alias("named")), "root")
             .select("fp", "root", "named"))
    classes = first.join(named, "fp", "left").select("fp", F.coalesce("named", "first_id").alias("component_id"),
                                                     F.coalesce("root", "fp").alias("root"))
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, one of each component: the row with its smallest id.
    Of rows that repeat that id one stays; a component without any id keeps
    one row.  Columns are those of ``docs``.

    An id that stands in one row settles that row by itself.  Only rows with
    a repeated id or none need their fingerprint again to be told apart."""
    verdicts = written(near_duplicates(docs, id_col, text_col, shingle, max_bits), "simhash-verdicts")
    key, fp, root = fresh(docs, "_stay_id"), fresh(docs, "_stay_fp"), fresh(docs, "_stay_root")
    ids = written(verdicts.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("stays")), "simhash-ids")
    alone = ids.where("rows = 1 AND stays").select(F.col("doc_id").alias(key))
    # as many ids as documents that stay: never broadcast, so that the plan is one at every size
    settled = docs.join(alone.hint("merge"), docs[id_col] == F.col(key), "left_semi")
    unclear = ids.where("rows > 1 OR doc_id IS NULL").select(F.col("doc_id").alias(key))
    if unclear.isEmpty():
        return settled
    again = docs.join(unclear.hint("merge"), docs[id_col].eqNullSafe(F.col(key)), "left_semi")
    again = written(again.withColumn(fp, fingerprint_column(quoted(text_col), shingle)), "simhash-unclear")
    stay = (verdicts.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias(key), F.col("fp").alias(f"{fp}_"), F.col("root").alias(root)).distinct())
    again = again.join(stay, again[id_col].eqNullSafe(F.col(key)) & (F.col(fp) == F.col(f"{fp}_")))
    return settled.unionByName(again.dropDuplicates([id_col, root]).select(all_but(again, key, fp, f"{fp}_", root)))


def op6_simhash(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id")
