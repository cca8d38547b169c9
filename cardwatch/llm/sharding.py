"""Sharding through fixed virtual slots.

A record's slot is a hash of its key modulo a fixed number of slots and never
changes.  A stored, versioned map says which shard each slot belongs to;
rebalancing and growing edit the map, never the hash:

* version 1 deals the slots out in equal runs;
* the bytes and rows of every slot are aggregated (``n_slots`` rows, a fixed
  bound, whatever the corpus) and :func:`rebalanced` moves single slots from
  the heaviest to the lightest shard until no move helps;
* :func:`grown` moves slots into one new shard only.

Editing works on the slot table alone; no record is read for it.

Defined cases: NULL text has size 1 (no bytes plus one); NULL ids hash like
any value; rows repeating an id share its slot; an empty table keeps the
first map; an existing column of an output name is replaced.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import fresh, new_folder, unsigned_crc32, utf8_bytes, written

N_SLOTS = 4096
ROWS_PER_BUCKET = 50_000


def slot_of(key: str, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n_slots)).cast("int")


def record_size(text: str) -> Column:
    return utf8_bytes(text) + F.lit(1).cast("long")


class SlotMaps:
    """Versioned slot maps in one parquet table (version, slot, shard).

    A version is appended as a single file in a single commit, so readers see
    all of it or nothing."""

    SCHEMA = "version int, slot int, shard int"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, version: int, shards: Sequence[int]) -> None:
        rows = self.spark.createDataFrame([(version, s, shard) for s, shard in enumerate(shards)], self.SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def latest_version(self) -> int:
        return self.all().agg(F.max("version")).first()[0]

    def read(self, version: int) -> DataFrame:
        return self.all().where(F.col("version") == version).select("slot", "shard")


def initial_map(n_slots: int, n_shards: int) -> list[int]:
    return [s * n_shards // n_slots for s in range(n_slots)]


def slot_loads(docs: DataFrame, slot: str, size: str, n_slots: int) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot: an aggregate of ``n_slots`` rows."""
    nbytes, nrows = [0] * n_slots, [0] * n_slots
    for r in docs.groupBy(slot).agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("n")).collect():
        nbytes[r[0]], nrows[r[0]] = r[1], r[2]
    return nbytes, nrows


def rebalanced(shards: Sequence[int], loads: Sequence[int], n_shards: int, only_into: int | None = None) -> list[int]:
    """Move single slots from the heaviest shard to the lightest (or only into
    ``only_into``) while a move lowers the heavier of the two."""
    shards = list(shards)
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    total = [0] * n_shards
    for slot, shard in enumerate(shards):
        if loads[slot]:
            held[shard].append((loads[slot], slot))
            total[shard] += loads[slot]
    for h in held:
        h.sort()
    while True:
        high = max((s for s in range(n_shards) if s != only_into), key=lambda s: (total[s], -s))
        low = only_into if only_into is not None else min(range(n_shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        own = held[high]
        at = bisect_left(own, (gap // 2, -1))
        options = [own[i] for i in (at - 1, at) if 0 <= i < len(own) and own[i][0] < gap]
        if not options:
            return shards
        load, slot = min(options, key=lambda x: (abs(2 * x[0] - gap), x))
        own.remove((load, slot))
        insort(held[low], (load, slot))
        total[high] -= load
        total[low] += load
        shards[slot] = low


def grown(shards: Sequence[int], loads: Sequence[int], n_shards: int) -> list[int]:
    """One more shard: it alone receives slots."""
    return rebalanced(shards, loads, n_shards + 1, only_into=n_shards)


def with_shards(docs: DataFrame, slot_map: DataFrame, slot: str, out: str = "shard") -> DataFrame:
    """Add the shard of every row; the map has ``n_slots`` rows, so it is broadcast."""
    key = fresh(docs, "_map_slot")
    docs = docs.drop(out)
    m = F.broadcast(slot_map.select(F.col("slot").alias(key), F.col("shard").alias(out)))
    return docs.join(m, docs[slot] == m[key]).drop(key)


def balanced_map(docs: DataFrame, slot: str, size: str, n_shards: int, n_slots: int,
                 path: str) -> tuple[DataFrame, list[int]]:
    """Store version 1 and, from the measured loads, version 2; returns the
    current map and the rows of each slot."""
    maps = SlotMaps(docs.sparkSession, path)
    first = initial_map(n_slots, n_shards)
    maps.append(1, first)
    nbytes, nrows = slot_loads(docs, slot, size, n_slots)
    maps.append(2, rebalanced(first, nbytes, n_shards))
    return maps.read(maps.latest_version()), nrows


def shard_positions(rows: DataFrame, nrows: Sequence[int], order: Sequence[str],
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each shard, without sorting a whole shard.

    Every virtual slot is cut into hash buckets of about ``rows_per_bucket``
    rows; a row's position is the rows of the buckets before it in its shard
    plus its rank in its own bucket."""
    cuts = max(1, -(-max(nrows, default=0) // rows_per_bucket))
    rows = rows.withColumn("_cut", F.pmod(F.xxhash64(*order, F.lit("cut")), F.lit(cuts)).cast("int"))
    bucket = ["shard", "virtual_slot", "_cut"]
    sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*bucket).orderBy(*order)
    return (rows.join(starts, bucket)
            .withColumn("slot", F.col("_start") + F.row_number().over(within) - 1)
            .drop("_cut", "_start"))


def shard_records(docs: DataFrame, n_shards: int = 8, n_slots: int = N_SLOTS, id_col: str = "doc_id",
                  text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``,
    ``virtual_slot``, ``shard`` and ``slot`` (position in the shard)."""
    rows = written(docs.select(F.col(id_col).alias("doc_id"), record_size(text_col).alias("size"),
                               unsigned_crc32(text_col).alias("text_crc32"),
                               slot_of(id_col, n_slots).alias("virtual_slot")), "shard-records")
    path = path or new_folder(docs.sparkSession, "slot-maps")
    slot_map, nrows = balanced_map(rows, "virtual_slot", "size", n_shards, n_slots, path)
    return shard_positions(with_shards(rows, slot_map, "virtual_slot"), nrows, ["doc_id", "size", "text_crc32"])


def shard_documents(docs: DataFrame, n_shards: int = 8, n_slots: int = N_SLOTS, id_col: str = "doc_id",
                    text_col: str = "text", path: str | None = None) -> DataFrame:
    """The documents themselves with ``virtual_slot`` and ``shard``: one pass
    for the slot loads, one for the rows; no text is shuffled."""
    path = path or new_folder(docs.sparkSession, "slot-maps")
    sized = docs.select(slot_of(id_col, n_slots).alias("virtual_slot"), record_size(text_col).alias("size"))
    slot_map, _ = balanced_map(sized, "virtual_slot", "size", n_shards, n_slots, path)
    return with_shards(docs.withColumn("virtual_slot", slot_of(id_col, n_slots)), slot_map, "virtual_slot")


def op1_sharding(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query: shards of near equal bytes."""
    return shard_records(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                                      F.col("slot").cast("long").alias("slot"),
                                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
