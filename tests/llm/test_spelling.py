import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwatch.llm import spelling as M
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, rows_of, sf  # noqa: F401


def plain_words(rows):
    n = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{low}".encode())
            if h % 97 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1:]
            n[low] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def variants(word):
    """What one deletion leaves, with its place."""
    return [(i, word[:i] + word[i + 1:]) for i in range(len(word))]


def brute(n):
    """By deletions: replaced words lose the same place, longer ones any."""
    by_place, near = {}, {w: set() for w in n}
    for w in n:
        if len(w) > 1000:
            continue
        for at in set(variants(w)):
            by_place.setdefault(at, []).append(w)
        for _, rest in variants(w):
            if rest in n:
                near[w].add(rest)
                near[rest].add(w)
    for group in by_place.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_the_table_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute(plain_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert want and rows_of(M.op13_spelling(docs), *COLUMNS) == want
    words = M.count_words(docs)
    assert rows_of(M.spelling_forms(words, groups=5, shard_words=1), *COLUMNS) == want


def test_edges_equal_brute_force(edge_docs, clashing_docs, no_docs):
    want = brute(plain_words([r[:2] for r in EDGE_ROWS]))
    assert rows_of(M.op13_spelling(edge_docs), *COLUMNS) == want
    assert rows_of(M.op13_spelling(clashing_docs), *COLUMNS) == want
    assert M.op13_spelling(no_docs).count() == 0


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abcmÿ", min_size=1, max_size=7), max_size=40))
def test_trie_finds_all_words_one_edit_away(words):
    trie = M.Trie(0, 4)
    for w in words:
        trie.add(w, 1)
    found = [(w, x) for w in words for x, _ in trie.near(w)]
    assert len(found) == len({frozenset(p) for p in found})  # each pair from one side
    assert {*found, *[(x, w) for w, x in found]} == {(w, x) for w in words for x in words if plain_distance(x, w) == 1}


def test_chains_ties_and_long_words(spark):
    rows = [("abcde", 3), ("abcdef", 6), ("abcdefg", 12), ("abcdefgh", 24), ("tiede", 10), ("tiedf", 10), ("tiedg", 5),
            ("x" * 5000, 3), ("x" * 5001, 7), ("alone", 9)]
    out = {r.word: r for r in M.spelling_forms(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert [out[w].root for w in ("abcde", "abcdef", "abcdefg", "abcdefgh")] == ["abcdefgh"] * 4
    assert out["tiedg"].form == "tiede" and out["tiede"].form is None and out["tiede"].n_near == 2
    assert out["x" * 5000].form == "x" * 5001 and out["alone"].n_near == 0


def test_a_third_of_all_words_near_one(spark):
    rows = [("qwert" + chr(97 + i % 26) + chr(97 + i // 26), 3) for i in range(300)] + [("qwertaa" + "b", 10_000)]
    n = dict(rows)
    docs = spark.createDataFrame(rows, "word string, n long")
    assert rows_of(M.spelling_forms(docs, shard_words=4), *COLUMNS) == brute(n)


def test_counts_stay_in_the_jvm(edge_docs):
    plan = M.count_words(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert edge_docs.select(F.lit(1)).count() == len(EDGE_ROWS)


def test_sql_oracle(spark, sf):
    from oracle_compare import compare
    for name, result in compare(spark, sf, ["op13_spelling"]).items():
        assert result[0] == "ok", (name, result)
