"""Exact top-k by MaxScore over integer vectors.

A dimension is a term; the components of a shard's vectors in it are its postings. For one query, a term's bound is the most it
can add to a score in the shard. Terms are sorted by bound; the low ones whose bounds add up to less than a score the k best
already pass are non-essential. The essential postings are traversed for all vectors; only vectors whose partial
score plus the remaining bounds can still compete are probed in the other terms, some terms at a time. Shards' top lists are merged.

Queries and vectors are dealt in blocks; a group is one block of each, so its memory is bounded and no task sees a whole table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagegrain.llm.common import ship, table, written

ship(__name__)

TOP = 5
EVERY = 50
SCALE = 256
VECTORS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 512
#: Terms probed between two prunings.
PROBE = 8


def integers(embedding: Column) -> Column:
    """floor(256 * x) of each component as long."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(embedding: Column) -> Column:
    """No null and no non-finite component; an empty vector has score 0 with all others."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def search(query: np.ndarray, own: int, postings: np.ndarray, high: np.ndarray, low: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(id, score) of the k best vectors of one shard. ``postings`` has a row per term; ``high`` and ``low`` are its extremes."""
    n = postings.shape[1]
    bound = np.maximum(query * high, query * low)
    order = np.argsort(-bound, kind="stable")
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)  # most that the terms from here on can add
    # a score that k vectors reach: the ones with the highest component in the best term
    column = postings[order[0]] * query[order[0]]
    some = np.argpartition(-column, min(2 * k, n - 1))[:2 * k + 1]
    some = some[ids[some] != own]
    seeds = np.sort(query @ postings[:, some])[::-1]
    reach = seeds[k - 1] if len(seeds) >= k else None
    # essential: without these terms no score reaches it
    essential = len(order) if reach is None else max(1, int(np.argmax(rest < reach)) if (rest < reach).any() else len(order))
    score = query[order[:essential]] @ postings[order[:essential]]
    alive = np.flatnonzero(ids != own)
    score, at = score[alive], essential
    while True:
        if len(score) > k and at < len(order):
            # the k best so far lose at most what the terms left can take away
            least = np.minimum(query * high, query * low)[order[at:]].sum()
            reach = max(reach if reach is not None else -np.inf, np.partition(score, len(score) - k)[len(score) - k] + least)
            keep = score + rest[at] >= reach
            alive, score = alive[keep], score[keep]
        if at == len(order):
            break
        step = order[at:at + PROBE]
        score = score + query[step] @ postings[np.ix_(step, alive)]
        at += len(step)
    top = best(score, ids[alive], k)
    return [(int(ids[alive[i]]), int(score[i])) for i in top]


def block_search(k: int):
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = max(1, max(map(len, queries["vector"])), max(map(len, vectors["vector"])))
        ids = vectors["vec_id"].to_numpy(np.int64)
        rows, asked = matrix(vectors["vector"], width), matrix(queries["vector"], width)
        most = float(np.abs(rows).max(initial=0)) * float(np.abs(asked).max(initial=0)) * width
        kind = np.float64 if most < 2**53 else np.int64  # floating products of such integers are exact, and fast
        postings = np.ascontiguousarray(rows.T).astype(kind)
        high, low = postings.max(axis=1), postings.min(axis=1)
        out = [(q, *hit) for q, v in zip(queries["vec_id"].tolist(), asked.astype(kind)) for hit in search(v, q, postings, high, low, ids, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best other vectors of every query.

    ``vectors`` has ``vec_id`` and ``embedding``. Rows without id and unusable vectors take no part. A shorter vector counts as padded with zeros.
    An id that occurs in several rows asks once, with its smallest vector; such rows are candidates one by one, but
    never of their own id.
    """
    sound = written(vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
                    .select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("vector")), "vectors")
    asked = sound.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sizes = sound.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    nv, nq = max(1, math.ceil(sizes["n"] / VECTORS_PER_BLOCK)), max(1, math.ceil(sizes["q"] / QUERIES_PER_BLOCK))

    def dealt(rows: DataFrame, own: str, n: int, other: str, others: int, *more: str) -> DataFrame:
        return (rows.withColumn(own, F.pmod(F.xxhash64("vec_id", *more), F.lit(n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    q = dealt(asked, "qb", nq, "vb", nv)
    v = dealt(sound, "vb", nv, "qb", nq, "vector")
    found = (q.groupBy("vb", "qb").cogroup(v.groupBy("vb", "qb"))
             .applyInPandas(block_search(k), "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # k rows per query and block of vectors
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 5
"""
