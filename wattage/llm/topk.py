"""Exact top-k inner products by tiled matrix products.

Vectors are dealt into shards of candidates and tiles of queries of bounded size. Each
(tile, shard) pair is one group: a task multiplies the two blocks, keeps the best k per
query and block, and the lists of a query are merged in a tree: a level merges the lists
of ``FAN`` neighbouring shards into one, so no task holds more than ``FAN`` lists of a query
however many shards there are. No pair of vectors ever becomes a row.

Vectors that are null or hold a null or non-finite component take no part, nor do rows
with a null id. Rows are told apart by themselves: of rows that share an id each is a
query and a candidate of its own (also for one another), unless ``quantised`` is asked for
one row per id, the smallest vector in array order. Vectors of different length are not
compared. Ties go to the smaller id. An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

SHARD_ROWS = 8_192
TILE_ROWS = 2_048
# Queries multiplied at once inside a task: 512 * 8,192 doubles are 32 MB.
STRIP = 512
#: Lists merged into one at a level of the tree.
FAN = 16
LISTS = "query long, query_id long, shard int, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", one_per_id: bool = True) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as long, for the vectors that take part.

    With ``one_per_id`` rows that share an id count once, by the smallest vector. Components beyond the range of a long are held at its ends.
    """
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    edge = float(1 << 62)
    whole = F.transform(x, lambda c: F.floor(F.least(F.greatest(c * float(scale), F.lit(-edge)), F.lit(edge))).cast("long"))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(finite)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")) if one_per_id else rows


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while every partial sum is below 2**53, else in Python integers."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    most = int(max(abs(int(q.min())), abs(int(q.max())))) * int(max(abs(int(c.min())), abs(int(c.max())))) * q.shape[1]
    if most < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return q @ c.T
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one list, by score descending then id ascending."""
    if len(ids) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= limit)  # all ties of the k-th score
    else:
        keep = np.arange(len(ids))
    return keep[np.lexsort((ids[keep], -scores[keep].astype(object) if len(keep) and scores[keep].min() == -(1 << 63) else -scores[keep]))][:k]


def top_k(vectors: DataFrame, is_query: Column, k: int, shard_rows: int = SHARD_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """The ``k`` best candidates of every query row: query_id, rank (from 1), vec_id, score.

    ``vectors`` is (vec_id, v) as made by ``quantised``; ``is_query`` a condition on it;
    every row but the query's own is a candidate.
    """
    # Numbered once and stored: the number tells rows apart that share an id.
    rows = vectors.select("vec_id", "v", F.coalesce(is_query, F.lit(False)).alias("asks"), F.size("v").alias("dims"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    shards, tiles = max(1, -(-sizes["n"] // shard_rows)), max(1, -(-sizes["q"] // tile_rows))
    deal = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("row", "vec_id", "v", "dims", deal(shards, 1).alias("shard"), all_of(tiles).alias("tile"))
    queries = rows.filter("asks").select(
        F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("dims").alias("q_dims"),
        all_of(shards).alias("q_shard"), deal(tiles, 2).alias("q_tile"),
    )

    def multiply(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ("query", "query_id", "shard", "vec_id", "score")
        if not len(left) or not len(right):
            return pd.DataFrame({n: [] for n in names}).astype("int64")
        q, c = np.stack(left["q"].to_numpy()), np.stack(right["v"].to_numpy())
        asking, q_ids, c_rows, c_ids = left["query"].to_numpy(), left["query_id"].to_numpy(), right["row"].to_numpy(), right["vec_id"].to_numpy()
        out: list[tuple[np.ndarray, ...]] = []
        for lo in range(0, len(q), STRIP):
            scores = _scores(q[lo : lo + STRIP], c)
            for i, row in enumerate(scores):
                others = c_rows != asking[lo + i]
                ids, row = (c_ids, row) if others.all() else (c_ids[others], row[others])
                at = _best(ids, row, k)
                fixed = [np.full(len(at), x) for x in (asking[lo + i], q_ids[lo + i], key[1])]
                out.append((*fixed, ids[at], row[at]))
        return pd.DataFrame({n: np.concatenate(x) for n, x in zip(names, zip(*out))})

    partial = queries.groupBy("q_dims", "q_shard", "q_tile").cogroup(candidates.groupBy("dims", "shard", "tile")).applyInPandas(multiply, LISTS)
    # sort_array descending puts the smaller id first.
    entry = F.struct("score", (-F.col("vec_id")).alias("order"), "vec_id")
    best = F.slice(F.sort_array(F.collect_list(entry), asc=False), 1, k).alias("best")
    lists = partial
    while shards > FAN:
        shards = -(-shards // FAN)
        merged = lists.groupBy("query", "query_id", F.expr(f"shard div {FAN}").cast("int").alias("shard")).agg(best)
        lists = merged.select("query", "query_id", "shard", F.explode("best").alias("b")).select("query", "query_id", "shard", "b.vec_id", "b.score")
    listed = lists.groupBy("query", "query_id").agg(best).select("query_id", F.posexplode("best").alias("at", "b"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
