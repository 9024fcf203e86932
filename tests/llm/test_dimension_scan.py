"""Nearest neighbours against brute force."""

import numpy as np

from eventloom.llm import catalog, dimension_scan


def test_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.stack(rows["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    place = {v: k for k, v in enumerate(rows["vec_id"])}
    got = catalog.QUERIES["op7_dimension_scan"](spark, sf).toPandas()
    hits = total = 0
    for query, mine in got.groupby("query_id"):
        mine = mine.sort_values("rank")
        scores = x @ x[place[query]]
        np.testing.assert_allclose(mine["score"], [scores[place[v]] for v in mine["vec_id"]], atol=1e-12)
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5] and query not in set(mine["vec_id"])
        order = [v for v in rows["vec_id"].to_numpy()[np.lexsort((rows["vec_id"], -scores))] if v != query][:5]
        hits, total = hits + len({*order} & {*mine["vec_id"]}), total + 5
    assert total == 5 * (rows["vec_id"] % 50 == 0).sum()
    assert hits / total >= 0.9


def test_ties_nulls_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [1.0, 0.0, 0.0, 0.0]) for k in range(0, 300)]  # one vector that many ids share
    rows += [(300 + k, rng.standard_normal(4).tolist()) for k in range(40)]
    rows += [(k, [1.0, 0.0, 0.0, 0.0]) for k in range(0, 300, 7)]  # repeated rows
    rows += [(400, None), (401, []), (402, [0.0] * 4), (403, [1.0, None, 0.0, 0.0]), (404, [float("nan"), 1.0, 0.0, 0.0]),
             (405, [float("inf"), 1.0, 0.0, 0.0]), (406, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "0 AS rank", "'s' AS score")
    got = {}
    for r in dimension_scan.neighbours(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {0, 50, 100, 150, 200, 250, 300}
    for query in (0, 50, 250):
        assert [v for v, _ in got[query]] == [v for v in range(6) if v != query][:5]
        assert all(abs(s - 1) < 1e-12 for _, s in got[query])
    assert dimension_scan.neighbours(df.limit(0), df).count() == 0
    assert dimension_scan.neighbours(df, df.limit(0)).count() == 0
    few = df.filter("vec_id in (1, 2, 300)").distinct()
    assert dimension_scan.neighbours(few, few).count() == 6


def test_scan_keeps_the_nearest_of_clustered_vectors():
    rng = np.random.default_rng(3)
    middle = rng.standard_normal((20, 96))
    x = dimension_scan.unit(middle[rng.integers(0, 20, 3000)] + 0.4 * rng.standard_normal((3000, 96)))
    q = dimension_scan.unit(middle[rng.integers(0, 20, 100)] + 0.4 * rng.standard_normal((100, 96)))
    turn = dimension_scan.rotation(96)
    np.testing.assert_allclose(turn @ turn.T, np.eye(96), atol=1e-9)
    found = dict(dimension_scan.scan((x @ turn).astype(np.float32), (q @ turn).astype(np.float32), 5))
    hits = sum(len({*np.argsort(-(x @ q[i]))[:5]} & {*found[i]}) for i in range(100))
    assert hits / 500 > 0.95
