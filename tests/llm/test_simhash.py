import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwatch.llm import golay
from cardwatch.llm import simhash as M
from cardwatch.llm.components import components
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, rows_of, sf  # noqa: F401


def plain_fingerprint(text):
    """The contract, bit by bit."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(fps):
    """Smallest id of the component of each (id, fingerprint), by all pairs."""
    least = list(range(len(fps)))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    ids = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return [ids.get(find(i)) for i in range(len(fps))]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aAbBÉé \t\n\x0b\x1c\x85 İz", max_size=60))
def test_fingerprint_equals_the_plain_one(text):
    assert M.fingerprint(text) == plain_fingerprint(text)


def test_sparks_own_hash_agrees(spark):
    h = spark.sql("SELECT xxhash64('one two three') AS h").first().h
    assert h % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


def test_golay_code_is_perfect_and_near_words_share_an_index():
    words = np.arange(1 << 23, dtype=np.int64)[:: 997]
    index = golay.decode(words)
    codewords = np.array([c for c in range(1 << 23) if golay._remainder(c) == 0][:: 7])
    assert (golay.decode(codewords) == codewords >> 11).all() and len(set((codewords >> 11).tolist())) == len(codewords)
    assert ((index >= 0) & (index < 4096)).all()
    rng = random.Random(3)
    for _ in range(300):
        x = rng.getrandbits(23)
        y = x
        for _ in range(2):
            y ^= 1 << rng.randrange(23)
        (_, a), (_, b) = golay.nearby_indices(np.array([x])), golay.nearby_indices(np.array([y]))
        assert set(a.tolist()) & set(b.tolist()) and 1 <= len(a) <= 6


def _fingerprints(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n // 8):
        centre = rng.getrandbits(64)
        for _ in range(8):
            x = centre
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return list(dict.fromkeys(out))


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_all_links_are_found_by_pairs_and_by_midpoints(spark):
    fps = _fingerprints(400, 5)
    table = spark.createDataFrame([(_signed(x),) for x in fps], "fp long")
    want = sorted(r for r in zip(map(_signed, fps), map(str, [
        _signed(fps[k]) for k in reachable(list(enumerate(fps)))])))
    for max_bits in (2, 1, 0):
        linked = sum((fps[i] ^ fps[j]).bit_count() <= max_bits for i in range(len(fps)) for j in range(i))
        sets = []
        for hot in (0, 3, 10_000):  # midpoints only, a mixture, pairs only
            edges = M.near_links(table, max_bits, hot)
            bad = edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > max_bits).count()
            assert bad == 0
            sets.append(rows_of(components(edges, "a", "b")))
        if max_bits:
            assert sets[0] == sets[1] == sets[2] and linked
    assert want


def test_components_equal_brute_force(spark):
    fps = _fingerprints(320, 9)
    rows = [(i * 3 + 1, _signed(x)) for i, x in enumerate(fps)]
    table = spark.createDataFrame(rows, "id long, fp long")
    got = {r.node: r.root for r in components(M.near_links(table), "a", "b").collect()}
    by_root = {}
    for fp, want in zip(fps, reachable(list(enumerate(fps)))):
        by_root.setdefault(want, set()).add(got.get(_signed(fp), _signed(fp)))
    assert all(len(v) == 1 for v in by_root.values())
    assert len({next(iter(v)) for v in by_root.values()}) == len(by_root)


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_edges_equal_brute_force(edge_docs, clashing_docs):
    fps = [(d, plain_fingerprint(t) if len(t or "") < 1000 else M.fingerprint(t)) for d, t, *_ in EDGE_ROWS]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(fps, reachable(fps))),
                  key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows_of(M.op6_simhash(edge_docs)) == want
    assert rows_of(M.op6_simhash(clashing_docs)) == want


def test_whole_table_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [(r.doc_id, M.fingerprint(r.text)) for r in rows]
    want = sorted((d, f"{f:016x}", c) for (d, f), c in zip(fps, reachable(fps)))
    assert sorted(map(tuple, M.op6_simhash(docs).collect())) == want


def test_filter_keeps_one_of_each_component(edge_docs, clashing_docs, no_docs):
    for docs in (edge_docs, clashing_docs):
        kept = M.drop_near_duplicates(docs)
        assert kept.columns == docs.columns
        ids = [r.doc_id for r in kept.collect()]
        classes = {(r.component_id, r.root) for r in M.near_duplicates(docs).collect()}
        assert sorted(map(str, ids)) == sorted(str(c) for c, _ in classes)
    assert M.drop_near_duplicates(no_docs).count() == 0 and M.op6_simhash(no_docs).count() == 0
