import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwatch.llm import sharding as S
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, rows_of, sf  # noqa: F401


def check_positions(rows):
    by = defaultdict(list)
    for shard, slot in rows:
        by[shard].append(slot)
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


def test_edges(edge_docs, clashing_docs):
    for docs in (edge_docs, clashing_docs):
        got = S.op1_sharding(docs)
        want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in EDGE_ROWS),
                      key=lambda r: tuple((x is None, str(x)) for x in r))
        assert rows_of(got, "doc_id", "size", "text_crc32") == want
        assert got.where("shard NOT BETWEEN 0 AND 7 OR law <> 'bytes' OR grown_shard IS NOT NULL").count() == 0
        check_positions(rows_of(got, "shard", "slot"))


def test_empty_table(no_docs):
    assert S.op1_sharding(no_docs).count() == 0
    assert S.shard_documents(no_docs).count() == 0


def test_sizes_are_near_equal_and_positions_gapless(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = S.shard_records(docs).collect()
    total = defaultdict(int)
    for r in out:
        total[r.shard] += r.size
    assert max(total.values()) - min(total.values()) <= max(r.size for r in out)
    check_positions([(r.shard, r.slot) for r in out])


def test_positions_do_not_depend_on_the_bucket_width(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = docs.select("doc_id", S.record_size("text").alias("size"), S.slot_of("doc_id", 16).alias("virtual_slot"),
                       (S.slot_of("doc_id", 16) % 4).alias("shard"))
    for width in (3, 50_000):
        got = S.shard_positions(rows, S.slot_loads(rows, "virtual_slot", "size", 16)[1], ["doc_id"], width)
        check_positions(rows_of(got, "shard", "slot"))


def test_maps_are_versioned_and_edited(spark, scratch):
    maps = S.SlotMaps(spark, f"{scratch}/maps")
    first = S.initial_map(64, 4)
    maps.append(1, first)
    loads = [(i * 37) % 101 for i in range(64)]
    maps.append(2, S.rebalanced(first, loads, 4))
    assert maps.latest_version() == 2
    assert [r[1] for r in rows_of(maps.read(1).select(F.format_string("%03d", "slot"), "shard"))] == first


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=8, max_size=200), st.integers(2, 8))
def test_rebalancing_and_growing(loads, n):
    first = S.initial_map(len(loads), n)
    moved = S.rebalanced(first, loads, n)

    def totals(shards, k):
        return [sum(x for x, s in zip(loads, shards) if s == i) for i in range(k)]

    assert max(totals(moved, n)) <= max(totals(first, n))
    assert max(totals(moved, n)) - min(totals(moved, n)) <= max(loads)
    more = S.grown(moved, loads, n)
    assert all(b == a or b == n for a, b in zip(moved, more))  # the new shard alone receives
    assert max(totals(more, n + 1)) <= max(totals(moved, n))


def test_documents_keep_their_columns(edge_docs, clashing_docs):
    assert S.shard_documents(edge_docs).columns == [*edge_docs.columns, "virtual_slot", "shard"]
    out = S.shard_documents(clashing_docs)
    assert out.count() == len(EDGE_ROWS) and out.where("shard NOT BETWEEN 0 AND 7").count() == 0
