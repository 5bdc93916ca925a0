"""Exact nearest neighbours of a stated query set, and exact similarity joins of vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from quern.operators.sampling import lot
from quern.shared import cut

#: Vectors of a block.
BLOCK = 2048


def _blocks(df: DataFrame, id_name: str, vec: str, prefix: str) -> DataFrame:
    """One row a block of vectors: ids and their components, flat."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), BLOCK):
                part = b.iloc[i : i + BLOCK]
                yield pd.DataFrame({f"{prefix}_ids": [part["id"].to_numpy()], f"{prefix}_flat": [np.concatenate([np.asarray(v, np.float64) for v in part["vec"]])]})

    rows = df.select(F.col(id_name).cast("long").alias("id"), F.col(vec).alias("vec")).where("id is not null and vec is not null")
    return rows.mapInPandas(pack, f"{prefix}_ids array<long>, {prefix}_flat array<double>")


def nearest(queries: DataFrame, data: DataFrame, id_name: str, vec: str, k: int, metric: str = "dot") -> DataFrame:
    """(query, neighbour, score, rank): the k best of `data` for each of `queries`, exact.

    Query blocks meet data blocks; each pair of blocks gives k rows a query, and the best of them are ranked.  dot:
    the greatest inner product first; euclidean: the least distance first.  Ties go to the lesser id.  A query that is
    in the data finds itself.  Vectors need one length; null ids and vectors are left out.
    """
    sign = 1.0 if metric == "dot" else -1.0

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for qi, qf, di, dflat in zip(b["q_ids"], b["q_flat"], b["d_ids"], b["d_flat"]):
                q, d = np.asarray(qf).reshape(len(qi), -1), np.asarray(dflat).reshape(len(di), -1)
                s = q @ d.T
                if metric != "dot":
                    s = -np.sqrt(np.maximum((q**2).sum(1)[:, None] + (d**2).sum(1)[None] - 2 * s, 0.0))
                di = np.asarray(di)
                order = np.argsort(di, kind="stable")
                s, di = s[:, order], di[order]
                n = min(k, s.shape[1])
                top = np.argsort(-s, axis=1, kind="stable")[:, :n]
                yield pd.DataFrame({"query": np.repeat(np.asarray(qi), n), "neighbour": di[top].ravel(), "score": sign * np.take_along_axis(s, top, 1).ravel()})

    pairs = _blocks(queries, id_name, vec, "q").crossJoin(_blocks(data, id_name, vec, "d"))
    found = pairs.mapInPandas(best, "query long, neighbour long, score double")
    order = F.desc("score") if metric == "dot" else F.asc("score")
    return found.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(order, "neighbour"))).where(F.col("rank") <= k)


def similar_vectors(df: DataFrame, id_name: str, vec: str, threshold: float) -> DataFrame:
    """(i, j, score), both directions and (i, i): all pairs of unit vectors with an inner product of `threshold` or
    more, exact.

    Vectors are cut into blocks by hash, each pair of blocks is one matrix product of one task, and no vector is
    compared twice: a block goes to the pairs it belongs to, by the numbers of both.  Only what passes leaves the task.
    """
    rows = df.select(F.col(id_name).cast("long").alias("id"), F.col(vec).alias("vec")).where("id is not null and vec is not null")
    parts = max(1, math.ceil(rows.count() / BLOCK))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    blocks = cut(rows.groupBy(part.alias("part")).agg(F.collect_list("id").alias("ids"), F.collect_list("vec").alias("vecs")), "blocks")
    x = blocks.select(F.col("part").alias("a"), F.explode(F.sequence("part", F.lit(parts - 1))).alias("b"), F.col("ids").alias("xi"), F.col("vecs").alias("x"))
    y = blocks.select(F.col("part").alias("b"), F.explode(F.sequence(F.lit(0), "part")).alias("a"), F.col("ids").alias("yi"), F.col("vecs").alias("y"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for one, xi, x, yi, y in zip(b["a"] == b["b"], b["xi"], b["x"], b["yi"], b["y"]):
                xi, yi = np.asarray(xi), np.asarray(yi)
                s = np.array([*x], dtype=np.float64) @ np.array([*y], dtype=np.float64).T
                r, c = np.nonzero(s >= threshold)
                yield pd.DataFrame({"i": xi[r], "j": yi[c], "score": s[r, c]})
                if not one:
                    yield pd.DataFrame({"i": yi[c], "j": xi[r], "score": s[r, c]})

    return x.join(y, ["a", "b"]).mapInPandas(meet, "i long, j long, score double")


def similarity_bins(queries: DataFrame, data: DataFrame, id_name: str, vec: str, bins: int, low: float, high: float) -> DataFrame:
    """(bin, count) of the inner products of every query with every other vector, counted inside the pairs of blocks:
    no pair leaves its task.  Products outside go into the first and the last bin."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(bins, np.int64)
        for b in batches:
            for qi, qf, di, dflat in zip(b["q_ids"], b["q_flat"], b["d_ids"], b["d_flat"]):
                s = np.asarray(qf).reshape(len(qi), -1) @ np.asarray(dflat).reshape(len(di), -1).T
                s = s[np.asarray(qi)[:, None] != np.asarray(di)[None]]
                out += np.bincount(np.clip(np.floor((s - low) / (high - low) * bins).astype(np.int64), 0, bins - 1), minlength=bins)
        yield pd.DataFrame({"bin": np.flatnonzero(out).astype(np.int32), "n": out[out > 0]})

    found = _blocks(queries, id_name, vec, "q").crossJoin(_blocks(data, id_name, vec, "d")).mapInPandas(count, "bin int, n long")
    return found.groupBy("bin").agg(F.sum("n").alias("count"))


def calibration(df: DataFrame, id_name: str, vec: str, most: int = 300, bins: int = 100, low: float = -1.0, high: float = 1.0, seed: int = 42) -> DataFrame:
    """(bin, count) of the similarities of all pairs among at most `most` records, the first by lot."""
    some = df.select(id_name, vec).orderBy(lot(id_name, seed), id_name).limit(most)
    return similarity_bins(some, some, id_name, vec, bins, low, high).select("bin", (F.col("count") / 2).cast("long").alias("count"))
