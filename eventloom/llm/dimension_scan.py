"""Nearest neighbours by cosine from inverted lists, scanned a block of dimensions at a time.

Vectors are scaled to unit length and turned by a random rotation, so that any few of their dimensions are a
fair sample of the distance. Lists come from k-means over a bounded sample; every vector is put into the list
of its nearest centre and every query is sent to its nearest lists. Within a list the distances are added up
over blocks of columns; after each block a hypothesis test drops the candidates whose distance so far makes it
unlikely that they beat the query's best. Scores of the survivors are computed anew from the original vectors.

Equal vectors are one candidate with its smallest ids, so a vector that a third of all rows share costs one
comparison. Large lists are dealt out in parts, for vectors and for queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import stage

K = 5
# Rows that the centres are learnt from, and lists at most.
SAMPLE_ROWS = 20_000
MAX_LISTS = 1024
# Share of the lists that a query visits. Vectors without any clusters need about half for 0.9 of the
# neighbours; clustered ones far less.
PROBED = 0.65
BLOCK = 16
# The more, the fewer neighbours are dropped by mistake.
EPSILON = 2.1
PART_ROWS = 8192
_TILE = 64
_SLACK = 1e-5
SEED = 5
FOUND = "query long, rep long, ids array<long>, score double"


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    c = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        nearest = (sample @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, nearest, sample)
        filled = np.linalg.norm(sums, axis=1) > 0
        c[filled] = sums[filled] / np.linalg.norm(sums[filled], axis=1, keepdims=True)
    return c


def scan(x: np.ndarray, q: np.ndarray, k: int, block: int = BLOCK, epsilon: float = EPSILON) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the rows of ``x`` that may be among its ``k`` nearest; both are rotated unit vectors."""
    n, d = x.shape
    for first in range(0, len(q), _TILE):
        own = q[first:first + _TILE]
        t = min(block, d)
        partial = np.maximum((x[:, :t] ** 2).sum(1) + (own[:, :t] ** 2).sum(1)[:, None] - 2 * own[:, :t] @ x[:, :t].T, 0)
        # The distances of the most promising bound the k-th best from above.
        few = min(n, 2 * k)
        promising = np.argpartition(partial, few - 1, axis=1)[:, :few]
        whole = ((x[promising] - own[:, None, :]) ** 2).sum(2)
        best = np.sort(whole, axis=1)[:, min(k, n) - 1] + _SLACK
        rows, cols = np.nonzero(partial * (d / t) <= ((1 + epsilon / np.sqrt(t)) ** 2 * best)[:, None])
        so_far = partial[rows, cols]
        while t < d:
            upto = min(t + block, d)
            so_far = so_far + ((x[cols, t:upto] - own[rows, t:upto]) ** 2).sum(1)
            t = upto
            factor = (1 + epsilon / np.sqrt(t)) ** 2 if t < d else 1.0
            alive = so_far * (d / t) <= factor * best[rows]
            rows, cols, so_far = rows[alive], cols[alive], so_far[alive]
        ends = np.searchsorted(rows, np.arange(len(own) + 1))
        for i in range(len(own)):
            mine, dist = cols[ends[i]:ends[i + 1]], so_far[ends[i]:ends[i + 1]]
            if len(mine) > k:
                mine = mine[dist <= np.partition(dist, k - 1)[k - 1] + _SLACK]
            yield first + i, mine


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(rep, ids, vector): each distinct vector once, with its ``keep`` smallest ids; the smallest stands for it."""
    own = Window.partitionBy("vector").orderBy("id")
    return (rows.withColumn("place", F.dense_rank().over(own)).filter(F.col("place") <= keep).groupBy("vector")
            .agg(F.array_sort(F.collect_set("id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "ids", "vector"))


def neighbours(rows: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K,
               probed: float = PROBED, sample_rows: int = SAMPLE_ROWS, max_lists: int = MAX_LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for each row of ``queries``.

    Score is the cosine in double precision; equal scores are ranked by the smaller id. Rows without an id and
    unusable vectors take no part, nor do vectors of another length than most. An id stands for one vector:
    repeated rows count once, and a query never finds its own id. Fewer than ``k`` other rows give fewer
    neighbours, an empty table none. Other columns are ignored.
    """
    spark = rows.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector")).filter(
            F.col("id").isNotNull() & usable(F.col("vector")))

    most = clean(rows).groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = most["d"]
    table = stage(distinct_vectors(clean(rows).filter(F.size("vector") == d), k + 1), "vectors")
    asked = clean(queries).filter(F.size("vector") == d)
    asked_once = asked.groupBy("vector").agg(F.min("id").alias("query"))

    turn = rotation(d)
    sample = table.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("vector").toPandas()
    learnt = unit(_matrix(sample["vector"])) @ turn
    lists = max(1, min(int(table.count() ** 0.5), max_lists, len(learnt)))
    middle = centres(learnt, lists)
    visits = max(1, round(probed * lists + 0.5)) if lists > 1 else 1
    visits = min(visits, lists)

    @F.pandas_udf("array<int>")
    def near(vectors: pd.Series, wanted: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        order = np.argsort(-(unit(_matrix(vectors)) @ turn @ middle.T), axis=1, kind="stable")
        return pd.Series([row[:n].astype(np.int32) for row, n in zip(order, wanted, strict=True)])

    indexed = stage(table.withColumn("list", near("vector", F.lit(1))[0]), "lists")
    sent = stage(asked_once.withColumn("list", F.explode(near("vector", F.lit(visits)))), "probes")

    def parts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("list").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias(name))

    # At most max_lists rows.
    sizes = F.broadcast(parts(indexed, "row_parts").join(parts(sent, "query_parts"), "list"))

    def dealt(df: DataFrame, id_: str, own: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return df.join(sizes, "list").withColumn(own, F.pmod(F.xxhash64(id_), F.col(own)).cast("int")).withColumn(other, every)

    def scanned(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            left = left.sort_values("rep", ignore_index=True)
            x, q = unit(_matrix(left["vector"])), unit(_matrix(right["vector"]))
            reps, ids, asks = left["rep"].to_numpy(), left["ids"].to_list(), right["query"].to_numpy()
            for i, cols in scan(np.ascontiguousarray((x @ turn).astype(np.float32)), (q @ turn).astype(np.float32), k + 1):
                score = x[cols] @ q[i]
                for j in np.lexsort((reps[cols], -score))[:k + 1]:
                    out.append((asks[i], reps[cols[j]], ids[cols[j]], score[j]))
        return pd.DataFrame(out, columns=["query", "rep", "ids", "score"])

    group = ["list", "row_parts", "query_parts"]
    found = (dealt(indexed, "rep", "row_parts", "query_parts").groupBy(*group)
             .cogroup(dealt(sent, "query", "query_parts", "row_parts").groupBy(*group)).applyInPandas(scanned, FOUND))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    top = (found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).groupBy("query")
           .agg(F.collect_list(F.transform("ids", lambda x: F.struct((-F.col("score")).alias("s"), x.alias("v")))).alias("lists"))
           .select("query", F.array_sort(F.flatten("lists")).alias("found")))
    members = asked.distinct().join(asked_once, "vector").select(F.col("id").alias("query_id"), "query")
    others = F.slice(F.filter("found", lambda f: f["v"] != F.col("query_id")), 1, k)
    return (members.join(top, "query").select("query_id", F.posexplode(others).alias("at", "f"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.v").alias("vec_id"), (-F.col("f.s")).alias("score")))
