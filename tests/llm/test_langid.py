import numpy as np
from pyspark.sql import functions as F

from cardwatch.llm import langid as L
from cardwatch.llm.common import held_out
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, sf  # noqa: F401


def plain_counts(text):
    """Hashed 1- to 3-grams, one at a time with Python integers."""
    mask, mix = (1 << 32) - 1, [int(m) for m in L._MIX]
    points = [p if p >= 0xC0 or 97 <= p <= 122 else 32 for p in map(ord, f" {text} ".lower())]
    out = np.zeros(L.DIMS, dtype=int)
    for i in range(len(points)):
        h = None
        for order in range(3):
            if i + order >= len(points):
                break
            h = points[i] * mix[0] & mask if order == 0 else ((h ^ (points[i + order] + order)) * mix[order]) & mask
            out[((h ^ (h >> 15)) * mix[0] & mask) >> (32 - L.DIMS_BITS)] += 1
    return out


def test_gram_counts_equal_the_plain_ones(monkeypatch):
    for text in ("", "a", "Hello, World! Ünïcödé \U0001f600 12", "x" * 300 + "yz" * 40):
        want = plain_counts(text)
        assert (L.gram_counts(text) == want).all()
        for chunk in (1, 2, 7, 64):  # pieces of a long text count every gram once
            monkeypatch.setattr(L, "_CHUNK", chunk)
            assert (L.gram_counts(text) == want).all()
        monkeypatch.undo()


def test_letters():
    assert not any(map(L.has_letter, (None, "", " 12 _ ² \U0001f600 ½ ٣")))
    assert all(map(L.has_letter, ("a", "1é", "字", "ª")))


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = L.op9_langid(docs)
    assert out.count() == docs.count()
    seen = out.where("held_out").join(docs.where("lang IS NOT NULL"), "doc_id").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in seen) >= 0.95 * len(seen)
    known = {r.lang for r in docs.select("lang").distinct().collect()} | {"und"}
    assert {r.lang_pred for r in out.collect()} <= known
    assert out.where("score IS NULL OR score NOT BETWEEN 0 AND 1").count() == 0


def test_held_out_languages_teach_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    other = docs.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, L.op9_langid(x).collect())) for x in (docs, other))
    assert a == b


def test_frequencies_cover_every_row_and_the_sample_is_bounded(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    df = np.zeros(L.DIMS)
    texts = [r.text for r in docs.collect()]
    for t in texts:
        df += plain_counts(t) > 0 if len(t) < 2000 else L.gram_counts(t) > 0
    assert np.allclose(L.inverse_frequencies(docs.repartition(7)), np.log((1 + len(texts)) / (1 + df)) + 1)
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("en").alias("lang"))
    assert L._sample(many, 1000).count() == 1000


def test_rows_sharing_an_id_are_sampled_one_by_one(spark):
    words = {"en": "the house and this water with that", "de": "das haus und dieses wasser mit jenem"}
    for shared in (7, 8):
        docs = spark.range(6000).select(F.lit(shared).cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, words["en"]).otherwise(
            words["de"]).alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
        assert {r.lang: r["count"] for r in L._sample(docs, 1000).groupBy("lang").count().collect()} == {"en": 1000, "de": 1000}
    model = L.fit(docs, 50)
    assert [model.predict(t)[0] for t in words.values()] == ["en", "de"]


def test_ftrl_is_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(2)
    rows = [(np.array([k, 10 + int(rng.integers(50))]), np.array([0.9, 0.4]), k) for k in (0, 1, 2) * 60]
    coef, bias = L.train_ftrl(rows, 3)
    assert all((x @ coef[at] + bias).argmax() == k for at, x, k in rows)
    assert (coef != 0).sum() < 0.02 * coef.size
    logits, labels = rng.normal(size=(4000, 3)) * 6, None
    p = L._softmax(logits / 3.0)
    labels = np.array([rng.choice(3, p=q) for q in p])
    assert 2.4 < L.best_temperature(logits, labels) < 3.7


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    for docs in (edge_docs, clashing_docs):
        got = {(r.doc_id, r.lang_pred, r.score) for r in L.op9_langid(docs).collect()}
        assert L.op9_langid(docs).count() == len(EDGE_ROWS)
        assert {d for d, p, s in got if p == "und" and s == 0.0} == {4, 5, None, 9}
        assert {p for d, p, s in got if d == 6} <= {"en", "de", "fr", "la"}
    assert L.op9_langid(no_docs).count() == 0


def test_without_languages_or_with_one(spark):
    docs = spark.createDataFrame([(i, f"word {i}", None) for i in range(30)], "doc_id long, text string, lang string")
    assert {tuple(r)[2:] for r in L.op9_langid(docs).collect()} == {("und", 0.0)}
    one = docs.withColumn("lang", F.lit("en"))
    assert {r.lang_pred for r in L.op9_langid(one).collect()} == {"en"}
