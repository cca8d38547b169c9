import numpy as np
from pyspark.sql import functions as F

from cardwatch.llm import quality as Q
from cardwatch.llm.common import held_out
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, sf  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"


def plain_scores(x, y, points, pooled=0.1, diagonal=0.05, temperature=5.0):
    """The same discriminant with explicit inverses and determinants."""
    both = sum(np.cov(x[y == k].T, bias=True) * (y == k).sum() for k in (0, 1)) / len(y)
    logs = []
    for k in (0, 1):
        share = pooled + (1 - pooled) * x.shape[1] / ((y == k).sum() + x.shape[1])
        c = (1 - share) * np.cov(x[y == k].T, bias=True) + share * both
        c = (1 - diagonal) * c + diagonal * np.diag(np.diag(c)) + 1e-3 * np.eye(x.shape[1])
        d = points - x[y == k].mean(axis=0)
        logs.append((-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.linalg.slogdet(c)[1]) / temperature
                    + np.log((y == k).mean()))
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def test_scores_equal_explicit_inverses(spark):
    rng = np.random.default_rng(4)
    y = (rng.random(400) < 0.7).astype(int)
    x = rng.normal(size=(400, len(Q.STATISTICS))) * (1 + y[:, None]) + 0.8 * y[:, None]
    table = spark.createDataFrame([(r.tolist(), int(k)) for r, k in zip(x, y)], "stats array<double>, label int")
    model = Q.fit(table.repartition(5))
    assert np.allclose(model.scores(x[:50]), plain_scores(x, y, x[:50]), atol=1e-8)


def test_held_out_accuracy(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    out = Q.op2_quality(docs, labels)
    assert out.count() == docs.count()
    seen = out.where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in seen) >= 0.9 * len(seen)
    assert out.where("(score >= 0.3) <> (predicted = 1) OR score NOT BETWEEN 0 AND 1 OR score IS NULL").count() == 0


def test_held_out_labels_teach_nothing(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    flipped = labels.select("doc_id", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"), "toxic")
    a, b = (sorted(map(tuple, Q.op2_quality(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, 1, 0), (10, 0, 0), (-11, 0, 1), (6, 0, 0), (7, None, 0),
                                    (None, 1, 1), (999, 0, 0), (6, 0, 0)], LABELS)
    first = None
    for docs in (edge_docs, clashing_docs):
        out = Q.op2_quality(docs, labels)
        assert out.columns == ["doc_id", "held_out", "score", "predicted"]
        assert out.count() == len(EDGE_ROWS)
        assert out.where("score IS NULL OR score NOT BETWEEN 0 AND 1").count() == 0
        scores = sorted((str(r.doc_id), round(r.score, 9)) for r in out.collect())
        first = first or scores
        assert scores == first
        assert Q.keep_quality(docs, labels).columns == docs.columns
    assert Q.op2_quality(no_docs, labels).count() == 0 and Q.keep_quality(no_docs, labels).count() == 0


def test_without_labels_or_with_one_class(spark, edge_docs):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in Q.op2_quality(edge_docs, none).collect()} == {0.5}
    assert Q.keep_quality(edge_docs, none).count() == len(EDGE_ROWS)
    for k in (0, 1):
        one = spark.createDataFrame([(1, k, 0), (2, k, 0), (3, k, 0)], LABELS)
        assert {r.score for r in Q.op2_quality(edge_docs, one).collect()} == {float(k)}


def test_equal_texts_score_equally(edge_docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (10, 0, 0), (-11, 0, 1), (6, 0, 0)], LABELS)
    out = {}
    for r in edge_docs.join(Q.op2_quality(edge_docs, labels), "doc_id").collect():
        out.setdefault(r.text or "", set()).add(r.score)
    assert all(len(s) == 1 for s in out.values())
