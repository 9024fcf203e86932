"""Learnt scores: held-out accuracy, what teaches nothing, and the cases at the edge."""

import numpy as np
import pytest

from eventloom.llm import catalog, pairwise_quality, toxicity

SF = "/root/testdata/sf0.1"


def held_out_rows(spark, name, label):
    rows = catalog.QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out")
    out = rows.select("score", "predicted", label).toPandas()
    return out["score"].to_numpy(), out["predicted"].to_numpy(), out[label].to_numpy()


def area(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"))
    n = (labels == 1).sum()
    return (order[labels == 1].sum() - n * (n - 1) / 2) / n / (len(labels) - n)


def test_quality_on_documents_whose_labels_were_not_seen(spark):
    scores, predicted, labels = held_out_rows(spark, "op2_pairwise_quality", "quality")
    assert len(labels) > 1000 and area(scores, labels) > 0.99
    assert (predicted == labels).mean() > 0.98 and ((scores >= 0.5) == predicted).all()


def test_toxicity_on_documents_whose_labels_were_not_seen(spark):
    scores, predicted, labels = held_out_rows(spark, "op3_counterfactual_toxicity", "toxic")
    # About one in ten of the toxic documents here is junk that holds no toxic word any more.
    assert area(scores, labels) > 0.94
    assert predicted[labels == 0].mean() < 0.01 and predicted[labels == 1].mean() > 0.85


def test_preferences_rank_on_the_feature_that_matters():
    rng = np.random.default_rng(1)
    x = rng.random((400, len(pairwise_quality.FEATURES)))
    labels = (x[:, 3] > 0.25).astype(int)
    ranking = pairwise_quality.fit(x, labels)
    p = ranking.probability(x)
    assert ((p >= 0.5) == labels).mean() > 0.97
    assert abs((p < 0.5).mean() - (labels == 0).mean()) < 0.01  # the threshold is the quantile at that share
    better, worse = pairwise_quality.preferences(labels, rng)
    assert (labels[better] == 1).all() and (labels[worse] == 0).all()


def test_swaps_take_the_blame_off_groups():
    """A group's name that stands beside abuse in training must not make neutral mentions toxic."""
    insult, talk = ["idiots", "scum"], ["weather", "market", "music", "people"]
    texts = [{"muslims", insult[k % 2], talk[k % 4]} for k in range(60)] + [{talk[k % 4], talk[(k + 1) % 4]} for k in range(200)]
    texts += [{"christians", talk[k % 4]} for k in range(20)] + [{"muslims", "abuse"} for _ in range(60)]
    toxic = np.array([1] * 60 + [0] * 220 + [1] * 60, float)
    plain, fair = (toxicity.fit(texts, toxic, swap_penalty=p) for p in (0.0, toxicity.SWAP_PENALTY))
    neutral = "muslims talk about music"
    assert plain.probability(neutral) > 0.5 > fair.probability(neutral)
    assert fair.probability("muslims are scum") > 0.7 and fair.probability("christians are scum") > 0.7
    gap = {name: abs(m.weights["muslims"] - m.weights["christians"]) for name, m in (("plain", plain), ("fair", fair))}
    assert gap["fair"] < 0.2 * gap["plain"]


@pytest.mark.parametrize("score", [pairwise_quality.quality_scores, toxicity.toxicity_scores])
def test_edges(spark, score):
    label = "quality" if score is pairwise_quality.quality_scores else "toxic"
    docs = spark.createDataFrame([(None, "a b"), (1, None), (2, ""), (3, "x " * 50000), (3, "x " * 50000), (4, "y")], "doc_id long, text string")
    docs = docs.selectExpr("*", "'a' AS Score", "2 AS predicted")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    rows = score(docs, none).collect()
    assert len(rows) == 6 and {r.score for r in rows} == {0.5} and rows[0].held_out is False
    one_kind = spark.createDataFrame([(1, 1), (2, 0), (None, 0), (3, None), (4, 0), (4, 1)], f"doc_id long, {label} int")
    assert {r.predicted for r in score(docs, one_kind).collect()} == {1}  # ids 2, 3 and 4 are held out
    assert score(docs.limit(0), one_kind).count() == 0
    assert [c.lower() for c in score(docs, none).columns].count("score") == 1


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(k, "good words here" if k % 2 else "!!! ### !!!") for k in range(60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a, b = (pairwise_quality.quality_scores(docs, x).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b and {(r.doc_id % 2, r.predicted) for r in a} == {(0, 0), (1, 1)}
