import hashlib
import re
from collections import defaultdict
from functools import cmp_to_key

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwatch.llm import mixing as X
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, rows_of, sf  # noqa: F401

LEVELS = ("domain", "lang", "source")
WEIGHTS = {"domain": {"a": 3, "b": 1, "z": 0}, "lang": {"en": 2}, "source": {"s2": 5}}


def brute_budgets(leaves, mix):
    """Fill each node's children round by round, whole tokens, top down."""
    def weight(level, name):
        return mix.weights.get(level, {}).get(name, mix.default_weight)

    def cap(path):
        return sum(n * mix.max_epochs for leaf, n in leaves.items() if leaf[:len(path)] == path
                   and all(weight(lv, x) > 0 for lv, x in zip(LEVELS, leaf)))

    budgets = {(): min(sum(leaves.values()) * mix.share_num // mix.share_den, cap(()))}
    for depth, level in enumerate(LEVELS):
        below = {}
        for path, b in budgets.items():
            names = {leaf[depth] for leaf in leaves if leaf[:depth] == path}
            open_, rest = {n: weight(level, n) for n in names}, b
            while True:  # the child that fills first, as long as the budget still fills it
                full = [n for n, w in open_.items() if w == 0 or cap(path + (n,)) * sum(open_.values()) <= rest * w]
                if not full:
                    break
                def first(x, y):
                    a, c = cap(path + (x,)) * max(open_[y], 1), cap(path + (y,)) * max(open_[x], 1)
                    return (a > c) - (a < c) or (x > y) - (x < y)
                n = min(full, key=cmp_to_key(first))
                below[path + (n,)] = cap(path + (n,)) if open_[n] else 0
                rest -= below[path + (n,)]
                del open_[n]
            for n, w in open_.items():
                below[path + (n,)] = w * rest // sum(open_.values())
        budgets = below
    return budgets


def brute_plan(rows, mix):
    """rows: (doc_id, leaf, text) -> (chosen (doc_id, epoch), planned and
    selected tokens per leaf)."""
    members = defaultdict(list)
    for d, leaf, t in rows:
        members[leaf].append((d, t or "", len(re.findall(r"[^ \t-\r]+", t or ""))))
    tokens = {leaf: sum(n for *_, n in own) for leaf, own in members.items()}
    planned = {leaf: b for leaf, b in brute_budgets(tokens, mix).items() if tokens[leaf]}
    cap = {leaf: tokens[leaf] * mix.max_epochs if all(mix.weights.get(lv, {}).get(x, mix.default_weight) > 0 for lv, x in zip(LEVELS, leaf))
           else 0 for leaf in planned}

    def choose(leaf, budget):
        epochs, rest = divmod(budget, tokens[leaf])

        def key(d, t):
            ident = f"{'' if d is None else d}:{hashlib.md5(t.encode()).hexdigest()}"
            return int(hashlib.md5(f"{mix.seed}:{epochs + 1}:{ident}".encode()).hexdigest()[:15], 16)
        out, spent = [(d, e) for d, *_ in members[leaf] for e in range(1, epochs + 1)], epochs * tokens[leaf]
        if rest:
            for k in sorted({key(d, t) for d, t, _ in members[leaf]}):
                own = [(d, n) for d, t, n in members[leaf] if key(d, t) == k]
                rest -= sum(n for _, n in own)
                if rest < 0:
                    break
                spent += sum(n for _, n in own)
                out += [(d, epochs + 1) for d, _ in own]
        return out, spent

    chosen = {leaf: choose(leaf, b) for leaf, b in planned.items()}
    unspent = {leaf: b - chosen[leaf][1] for leaf, b in planned.items()}
    for depth in (2, 1, 0):  # siblings first, then the ancestors
        for node in {leaf[:depth] for leaf in planned}:
            below = [leaf for leaf in planned if leaf[:depth] == node]
            pool = sum(unspent.pop(leaf) for leaf in below)
            room = {leaf: cap[leaf] - chosen[leaf][1] for leaf in below}
            taker = min(below, key=lambda leaf: (room[leaf] < pool, tokens[leaf] / len(members[leaf]) if room[leaf] >= pool else 0,
                                                 -room[leaf], leaf))
            unspent |= dict.fromkeys(below, 0)
            had = chosen[taker][1]
            if min(had + pool, cap[taker]) > had:
                chosen[taker] = choose(taker, min(had + pool, cap[taker]))
            unspent[taker] = had + pool - chosen[taker][1]
    return (sorted((x for out, _ in chosen.values() for x in out), key=str), planned,
            {leaf: spent for leaf, (_, spent) in chosen.items()})


def brute_mix(rows, mix):
    return brute_plan(rows, mix)[0]


def _leaf(*values):
    return tuple(X.NULL_NODE if v is None else v for v in values)


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from("abcz"), st.sampled_from(["en", "de"]), st.sampled_from(["s1", "s2", "s3"])),
                       st.integers(0, 500), min_size=1, max_size=12), st.integers(1, 9))
def test_budgets_equal_brute_force(spark, leaves, share):
    mix = X.Mixture(weights=WEIGHTS, share_num=share, share_den=5)
    table = spark.createDataFrame([(*k, n, 1) for k, n in leaves.items()],
                                  "domain string, lang string, source string, tokens long, docs long")
    got = {(r.domain, r.lang, r.source): r.budget for r in X.leaf_budgets(table, mix).collect()}
    assert got == brute_budgets(leaves, mix)


def test_shortages_go_to_siblings_before_ancestors(spark):
    # a/en is short by far: a/de takes what it leaves before b sees any of it
    leaves = {("a", "en", "s"): 10, ("a", "de", "s"): 1000, ("b", "en", "s"): 1000}
    mix = X.Mixture(share_num=1, share_den=2, max_epochs=1)
    table = spark.createDataFrame([(*k, n, 1) for k, n in leaves.items()],
                                  "domain string, lang string, source string, tokens long, docs long")
    got = {(r.domain, r.lang): r.budget for r in X.leaf_budgets(table, mix).collect()}
    assert got == {("a", "en"): 10, ("a", "de"): 492, ("b", "en"): 502}


def test_selection_equals_brute_force_in_any_bucket_width(spark):
    rows = [(i if i % 17 else None, f"w {'x ' * (i * 7 % 30)}", "en" if i % 3 else None, f"s{i % 2}") for i in range(400)]
    rows += rows[:9]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    tree = [F.lit("d"), F.col("lang"), F.col("source")]
    for share, width in ((3, 1), (3, 4096), (9, 16), (1, 64)):
        mix = X.Mixture(weights={"lang": {"en": 2}}, share_num=share, share_den=5, rows_per_bucket=width)
        want = brute_mix([(d, _leaf("d", lang, s), t) for d, t, lang, s in rows], mix)
        got = X.mix_documents(docs, tree, mix)
        assert sorted(((r.doc_id, r.epoch) for r in got.collect()), key=str) == want


def test_edges(edge_docs, clashing_docs, no_docs):
    tree = X.corpus_tree()
    want = brute_mix([(d, _leaf("d" + str(int(s[3:]) % 4) if re.search("[0-9]$", s or "") else "other", lang, s),
                       t) for d, t, lang, s, _ in EDGE_ROWS], X.MIXTURE)
    for docs in (edge_docs, clashing_docs):
        out = X.mix_documents(docs, tree, X.MIXTURE)
        assert sorted(((r.doc_id, r.epoch) for r in out.collect()), key=str) == want
    assert [c for c in out.columns if c != "epoch"] == [c for c in clashing_docs.columns if c != "epoch"]
    assert X.op4_mixing(no_docs).count() == 0


def test_no_python_in_the_plan(edge_docs):
    plan = X.op4_mixing(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def leaf_rows(docs):
    nodes = [X.node_of(c) for c in X.corpus_tree()]
    return docs.select(X.identity(F.col("doc_id"), "text").alias("ident"), X.token_count("text").alias("tokens"),
                       *[c.alias(lv) for c, lv in zip(nodes, LEVELS)])


def test_budget_is_spent(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    total = docs.agg(F.sum(X.token_count("text"))).first()[0]
    out = X.op4_mixing(docs)
    spent, longest = out.agg(F.sum("tokens"), F.max("tokens")).first()
    assert 0 <= total * 3 // 5 - spent <= longest
    assert rows_of(out.select(F.max("epoch"))) <= [(2,)]
    plan = X.leaf_plan(leaf_rows(docs), X.MIXTURE).collect()
    assert sum(r.selected for r in plan) == spent
    for r in plan:  # no leaf misses more than a document; one leaf a node may hold what its siblings left
        assert r.planned - r.selected < longest


def test_a_long_first_document_leaves_its_budget_to_siblings(spark):
    rows = [(0, "x " * 1000, "en", "s1")] + [(i, "x " * 10, "en", "s1") for i in range(1, 5)]
    rows += [(i, "x " * 10, "en", "s2") for i in range(5, 195)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mix = X.Mixture(share_num=3, share_den=5, max_epochs=1)
    tree = [F.lit("d"), F.col("lang"), F.col("source")]
    out = X.mix_documents(docs, tree, mix)
    spent = out.agg(F.sum(X.token_count("text"))).first()[0]
    assert 2940 * 3 // 5 - 10 < spent <= 2940 * 3 // 5


def test_a_third_of_the_ids_missing(spark):
    rows = [(i if i % 3 else None, f"word{i} " * 4, "en", f"s{i % 2}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    tree = [F.lit("d"), F.col("lang"), F.col("source")]
    out = X.mix_documents(docs, tree, X.Mixture(max_epochs=1))
    assert out.agg(F.sum(X.token_count("text"))).first()[0] == 600 * 4 * 3 // 5
