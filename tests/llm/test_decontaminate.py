import random
from collections import Counter

from pyspark.sql import functions as F

from cardwatch.llm import decontaminate as D
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, rows_of, sf  # noqa: F401

ITEMS = "item_id long, text string"


def build(items):
    df = Counter(t for _, x in items for t in set(D.words_of(x)))
    lengths = [len(D.words_of(x)) for _, x in items if D.words_of(x)]
    return D.ItemIndex.build(items, df, len(lengths), sum(lengths) / max(len(lengths), 1)), df, lengths


def plain_scores(items, df, lengths, terms):
    """Share of each item's BM25 total that the terms cover, item by item."""
    from math import log
    out = {}
    for i, text in items:
        tf = Counter(D.words_of(text))
        if not tf:
            continue
        norm = D.K1 * (1 - D.B + D.B * sum(tf.values()) / (sum(lengths) / len(lengths)))
        w = {t: log(1 + (len(lengths) - df[t] + 0.5) / (df[t] + 0.5)) * n * (D.K1 + 1) / (n + norm) for t, n in tf.items()}
        out[i] = sum(w[t] for t in w if t in terms) / sum(w.values())
    return out


def _corpus(seed, n_items=150):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(12)]
    words = common * 10 + [f"w{i}" for i in range(400)]
    return rng, words, [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(4, 40)))) for i in range(n_items)]


def test_search_equals_exhaustive_scoring(monkeypatch):
    for seed, common, block in ((1, 0.4, 32), (2, 0.0, 4), (3, 0.25, 1)):
        monkeypatch.setattr(D, "COMMON", common)
        monkeypatch.setattr(D, "BLOCK", block)
        rng, words, items = _corpus(seed)
        index, df, lengths = build(items)
        for _ in range(60):
            passage = set(rng.choice(words) for _ in range(30)) | set(D.words_of(rng.choice(items)[1])[: rng.randrange(20)])
            for threshold in (0.3, 0.5, 0.8):
                threshold = max(threshold, common + 0.05)
                got = {index.ids[k]: round(s, 9) for k, s in index.search(passage, threshold).items()}
                want = {i: round(s, 9) for i, s in plain_scores(items, df, lengths, passage).items() if s >= threshold - 1e-9}
                assert got == want


def brute(docs, items):
    """Pairs whose question and answer shingles lie in the document, all against all."""
    out = []
    for d, text, *_ in docs:
        words = D.words_of(text)
        for i, item in items:
            parts = [p for p in map(D.shingles, D.question_answer(item)) if p]
            said = {n: set(zip(*[words[k:] for k in range(n)])) for n in {len(next(iter(p))) for p in parts}}
            shares = [len(p & said[len(next(iter(p)))]) / len(p) for p in parts]
            if shares and min(shares) >= D.OVERLAP:
                out.append((d, i))
    return sorted(out, key=str)


def _planted(seed=7):
    rng, words, items = _corpus(seed, 60)
    items = [(i, t + ". " + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) + ".") for i, t in items]
    docs = []
    for d in range(120):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 300)))]
        for _ in range(rng.randrange(3)):
            t = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 6])):  # some copies are damaged
                t[rng.randrange(len(t))] = "changed"
            parts.insert(rng.randrange(len(parts) + 1), " ".join(t).upper() if rng.random() < 0.3 else "\n".join(t))
        docs.append((d, " ".join(parts)))
    return docs, items


def test_pairs_equal_brute_force(spark):
    docs, items = _planted()
    want = brute(docs, items)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    assert len(want) > 40
    for block in (D.MAX_BLOCK_ITEMS, 7):
        out = D.contaminated(d, b, block_items=block)
        assert sorted(((r.doc_id, r.item_id) for r in out.collect()), key=str) == want
        dirty = {p[0] for p in want}
        kept = D.drop_contaminated(d, b, block_items=block)
        assert {r.doc_id for r in kept.collect()} == {x[0] for x in docs} - dirty
    # scores do not depend on the blocks
    a, c = (rows_of(D.contaminated(d, b, block_items=n).select("doc_id", "item_id", F.round("score", 9)))
            for n in (D.MAX_BLOCK_ITEMS, 7))
    assert a == c


def test_whole_table_equals_brute_force(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = D.op7_decontaminate(docs, items).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == want and want


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    items = [(1, "The quick brown fox jumps over the lazy dog. It ran home."), (1, "two words"), (None, "one"), (2, None),
             (3, ""), (4, " .. "), (5, "lorem ipsum dolor sit amet consectetur lorem ipsum dolor sit. amet consectetur lorem"),
             (5, "unheard of")]
    b = spark.createDataFrame(items, ITEMS)
    want = brute(EDGE_ROWS, items)
    for docs in (edge_docs, clashing_docs):
        got = D.op7_decontaminate(docs, b.withColumn("term", F.lit(1)).withColumn("words", F.lit("x")))
        assert sorted(((r.doc_id, r.item_id) for r in got.collect()), key=str) == want
        kept = D.drop_contaminated(docs, b)
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == {None, 4, 5, 8, 9}
    empty = spark.createDataFrame([], ITEMS)
    assert D.op7_decontaminate(no_docs, b).count() == 0 and D.op7_decontaminate(edge_docs, empty).count() == 0
    assert D.drop_contaminated(edge_docs, empty).count() == len(EDGE_ROWS)
    assert D.op7_decontaminate(edge_docs, b.where("text IS NULL")).count() == 0


def brute_whole(docs, items):
    """Pairs by question and answer or by the whole item's shingles, all against all."""
    out = set(brute(docs, items))
    for d, text, *_ in docs:
        for i, item in items:
            whole, words = D.shingles(D.words_of(item)), D.words_of(text)
            if whole and len(whole & set(zip(*[words[k:] for k in range(len(next(iter(whole))))]))) / len(whole) >= D.OVERLAP:
                out.add((d, i))
    return sorted(out, key=str)


def test_one_changed_word_in_the_last_sentence_hides_no_item(spark):
    rng, words, items = _corpus(11, 25)
    items = [(i, t + ". " + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) + ".") for i, t in items]
    docs = []
    for _, text in items:
        n = len(D.words_of(text.split(". ")[1]))
        for k in range(n):
            t = text.split()
            t[len(t) - n + k] = "changed"
            docs.append((len(docs), " ".join([rng.choice(words) for _ in range(50)] + t + ["after"])))
    want = brute_whole(docs, items)
    assert len(want) > len(brute(docs, items)) + 20
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    assert sorted(((r.doc_id, r.item_id) for r in D.op7_decontaminate(d, b).collect()), key=str) == want
    for block in (D.MAX_BLOCK_ITEMS, 7):
        kept = D.drop_contaminated(d, b, block_items=block, whole_items=True)
        assert {r.doc_id for r in kept.collect()} == {x[0] for x in docs} - {p[0] for p in want}


def test_exhaustive_look_up_needs_no_score():
    # the words that every item has weigh next to nothing: the document has 84% of the item, but no score of 0.5
    said = " ".join("abcdefghijklmnopqrstuvwxyz" * 2)
    items = [(i, f"{said}. only{i} rare{i} words{i} here{i} today{i}") for i in range(30)]
    index, df, lengths = build(items)
    docs = [(0, "so " + said + " and no more")]
    assert max(plain_scores(items, df, lengths, set(D.words_of(docs[0][1]))).values()) < D.THRESHOLD
    assert D.matches(docs[0][1], index, whole_items=True) == []
    index.look_up(D.OVERLAP)  # exhaustive
    got = D.matches(docs[0][1], index, whole_items=True)
    assert [(0, m[0]) for m in sorted(got)] == sorted(brute_whole(docs, items)) and got
    scores = plain_scores(items, df, lengths, set(D.words_of(docs[0][1])))
    assert all(abs(m[1] - scores[m[0]]) < 1e-9 for m in got)


def test_scattered_items_are_found(spark):
    # sentences and parts further apart than a passage; short parts; one edit in the answer
    items = [(1, ". ".join(" ".join(f"{s}{k}" for k in range(24)) for s in ("first", "second", "third"))),
             (2, "Who wrote the long book about whales and men at sea? A clerk of the customs house of New York did, long ago now."),
             (3, "Two words. Three more words."), (4, "Which one? The quick brown fox jumps over the lazy dog.")]
    gap = " ".join(f"filler{i}" for i in range(500))
    docs = [(i, f" {gap} ".join(s for s in text.replace("?", ".").split(". "))) for i, text in items]
    docs += [(12, docs[1][1].replace("ago now", "ago then")), (14, docs[3][1].replace("one", "two")), (15, gap)]
    docs.append((11, " ".join(f"{w} {gap}" for w in items[0][1].split())))
    want = brute_whole(docs, items)
    assert {(1, 1), (2, 2), (3, 3), (4, 4), (12, 2)} <= set(want) and not {p[0] for p in want} & {11, 15}
    index, _, _ = build(items)
    assert len({(d, m[0]) for d, t in docs for m in D.matches(t, index)}) < len(want)  # no passage reaches the threshold
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    assert sorted(((r.doc_id, r.item_id) for r in D.op7_decontaminate(d, b).collect()), key=str) == want
    kept = D.drop_contaminated(d, b, whole_items=True)
    assert {r.doc_id for r in kept.collect()} == {x[0] for x in docs} - {p[0] for p in want}


def test_the_result_comes_from_the_search(spark, sf, monkeypatch):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(c, "text").collect()]
                   for n, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    index, _, _ = build(items)
    want = {(d, i) for d, i in brute_whole(docs, items)}
    got = {(d, m[0]) for d, t in docs for m in D.matches(t, index, whole_items=True)}
    assert got <= want and len(got) >= 0.9 * len(want) > 0
    monkeypatch.setattr(D.ItemIndex, "search", lambda *_: {})
    assert not any(D.matches(t, index, whole_items=True) for _, t in docs)


def test_repeated_items_are_one_index_entry(spark):
    items = [(1, "The quick brown fox jumps over the lazy dog. It ran home.")] * 500 + [(2, "unheard of")]
    index = next(D.item_indexes(spark.createDataFrame(items, ITEMS)))
    assert sorted(zip(index.ids, index.copies)) == [(1, 500), (2, 1)]
    docs = spark.createDataFrame([(7, "so the quick brown fox jumps over the lazy dog it ran home")], "doc_id long, text string")
    assert D.contaminated(docs, spark.createDataFrame(items, ITEMS)).count() == 500
