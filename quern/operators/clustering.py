"""Clusters of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.neighbours import nearest
from quern.shared import cut

#: Points that the density clustering takes; it holds a tree of all points in one task.  Beyond, use `kmeans`.
MOST_POINTS = 50_000


def _core_distances(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty(len(x))
    sq = (x**2).sum(1)
    for a in range(0, len(x), 1024):
        d = np.sqrt(np.maximum(sq[a : a + 1024, None] + sq[None] - 2 * x[a : a + 1024] @ x.T, 0.0))
        out[a : a + 1024] = np.partition(d, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
    return out


def _spanning_tree(x: np.ndarray, core: np.ndarray) -> np.ndarray:
    """(weight, a, b) of the least spanning tree under mutual reachability, by Prim's rule."""
    n = len(x)
    inside, best, parent = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, np.int64)
    edges, at = np.empty((n - 1, 3)), 0
    for e in range(n - 1):
        inside[at] = True
        d = np.maximum(np.maximum(np.sqrt(np.maximum(((x - x[at]) ** 2).sum(1), 0.0)), core), core[at])
        closer = ~inside & (d < best)
        best[closer], parent[closer] = d[closer], at
        nxt = int(np.where(inside, np.inf, best).argmin())
        edges[e] = best[nxt], parent[nxt], nxt
        at = nxt
    return edges[np.argsort(edges[:, 0], kind="stable")]


def density_labels(x: np.ndarray, min_cluster: int = 10, min_samples: int = 5) -> np.ndarray:
    """Labels by hierarchical density: -1 for noise, clusters from 0 by their first point.

    The tree of mergers is condensed to splits in which both sides have `min_cluster` points; of a cluster and its
    descendants the more stable choice stays.  The whole is no cluster.
    """
    n = len(x)
    if n < max(2, min_cluster):
        return np.full(n, -1)
    tree = _spanning_tree(x, _core_distances(x, min_samples))
    # single linkage: node n + e merges two nodes at tree[e, 0]
    top, size = np.arange(2 * n - 1), np.ones(2 * n - 1, np.int64)
    kids, height = np.zeros((n - 1, 2), np.int64), tree[:, 0]

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for e, (_, a, b) in enumerate(tree):
        ra, rb = find(int(a)), find(int(b))
        kids[e] = ra, rb
        top[ra] = top[rb] = n + e
        size[n + e] = size[ra] + size[rb]

    def points(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            v = todo.pop()
            if v < n:
                out.append(v)
            else:
                todo += kids[v - n].tolist()
        return out

    # condense from the root: clusters with their birth, children, and the points that fall out
    birth, children, stability, members = [0.0], [[]], [0.0], [[]]
    todo = [(2 * n - 2, 0)]
    while todo:
        node, c = todo.pop()
        if node < n:
            continue
        a, b = kids[node - n]
        lam = 1.0 / height[node - n] if height[node - n] > 0 else np.inf
        big = [v for v in (a, b) if size[v] >= min_cluster]
        gain = lambda m: 0.0 if np.isinf(lam) and np.isinf(birth[c]) else m * (lam - birth[c])
        if len(big) == 2:
            stability[c] += gain(size[a] + size[b])
            for v in (a, b):
                birth.append(lam)
                children.append([])
                stability.append(0.0)
                members.append([])
                children[c].append(len(birth) - 1)
                todo.append((v, len(birth) - 1))
            continue
        for v in (a, b):
            if size[v] >= min_cluster:
                todo.append((v, c))
            else:
                p = points(v)
                stability[c] += gain(len(p))
                members[c] += p
    chosen = set()
    value = stability[:]
    for c in range(len(birth) - 1, 0, -1):
        below = sum(value[k] for k in children[c])
        if children[c] and below > stability[c]:
            value[c] = below
        else:
            chosen.add(c)
            drop = children[c][:]
            while drop:
                k = drop.pop()
                chosen.discard(k)
                drop += children[k]

    def everything(c: int) -> list[int]:
        return members[c] + [p for k in children[c] for p in everything(k)]

    groups = sorted((sorted(everything(c)) for c in chosen), key=lambda g: g[0])
    labels = np.full(n, -1)
    for i, g in enumerate(groups):
        labels[g] = i
    return labels


def density_clusters(df: DataFrame, id_name: str, vec: str, min_cluster: int = 10, min_samples: int = 5) -> DataFrame:
    """(id, cluster_id) by `density_labels`; more than MOST_POINTS points are an error, as one task holds them."""
    rows = df.select(F.col(id_name).cast("long").alias("id"), F.col(vec).alias("vec")).where("id is not null and vec is not null")
    if rows.limit(MOST_POINTS + 1).count() > MOST_POINTS:
        raise ValueError(f"density clustering takes at most {MOST_POINTS} points; use kmeans")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        labels = density_labels(np.array([np.asarray(v, np.float64) for v in part["vec"]]), min_cluster, min_samples)
        return pd.DataFrame({"id": part["id"], "cluster_id": labels.astype(np.int32)})

    return rows.withColumn("one", F.lit("")).groupBy("one").applyInPandas(run, "id long, cluster_id int").withColumnRenamed("id", id_name)


def with_noise_assigned(labels: DataFrame, df: DataFrame, id_name: str, vec: str, label: str = "cluster_id") -> DataFrame:
    """Labels with each noise point (-1) given that of its nearest clustered point; all noise stays one group -1."""
    rows = df.select(id_name, vec).join(labels.select(id_name, label), id_name)
    noise, known = rows.where(F.col(label) == -1), rows.where(F.col(label) != -1)
    near = nearest(noise, known, id_name, vec, 1, "euclidean").select(F.col("query").alias(id_name), F.col("neighbour").alias("__n"))
    named = near.join(known.select(F.col(id_name).alias("__n"), F.col(label).alias("__label")), "__n").select(id_name, "__label")
    return labels.join(named, id_name, "left").withColumn(label, F.coalesce("__label", F.col(label))).select(*labels.columns)


#: Rows, at most, from which the first centres are drawn.
FIRST = 10_000


def _first_centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k different rows, each drawn by its squared distance to the nearest one before."""
    chosen = [x[int(rng.integers(len(x)))]]
    near = ((x - chosen[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = near.sum()
        at = int(rng.choice(len(x), p=near / total)) if total > 0 else int(rng.integers(len(x)))
        chosen.append(x[at])
        near = np.minimum(near, ((x - x[at]) ** 2).sum(1))
    return np.array(chosen)


def _nearest_centres(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = np.maximum((x**2).sum(1)[:, None] + (centres**2).sum(1)[None] - 2 * x @ centres.T, 0.0)
    return d.argmin(1), d.min(1)


def _silhouette(x: np.ndarray, own: np.ndarray, sums: np.ndarray, squares: np.ndarray, n: np.ndarray) -> float:
    """The sum of the rows' silhouettes by mean squared distances to the rows of each cluster."""
    there = np.flatnonzero(n > 0)
    means = sums[there] / n[there, None]
    d = (x**2).sum(1)[:, None] - 2 * x @ means.T + (squares[there] / n[there])[None]  # mean over the whole cluster
    at = np.searchsorted(there, own)
    rows = np.arange(len(x))
    m = n[own]
    a = np.where(m > 1, d[rows, at] * m / np.maximum(m - 1, 1), 0.0)  # without the row itself
    d[rows, at] = np.inf
    b = d.min(1)
    return float(np.where(m > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-12), 0.0).sum())


def kmeans(df: DataFrame, id_name: str, vec: str, least: int = 3, most: int = 30, starts: int = 10, turns: int = 50, seed: int = 42) -> DataFrame:
    """(id, cluster_id) for the number of clusters with the greatest mean silhouette; the least of equals.

    Every number from `least` to `most` is tried from `starts` first centres, and the start with the least squared
    distances stands for it.  All models take their turns together: one pass over the vectors adds up the sums of every
    cluster of every model inside the tasks, so a sweep costs as many passes as the slowest model has turns, and only
    centres come to the driver, at most sum(k) * starts rows.  The silhouette is by squared Euclidean distances, which
    sums of clusters give without comparing pairs.  Too few rows for `least` + 1 clusters are one cluster.
    """
    rows = df.select(F.col(id_name).cast("long").alias("id"), F.transform(vec, lambda x: x.cast("double")).alias("vec")).where("id is not null and vec is not null")
    rows = cut(rows, "vectors")
    n = rows.count()
    sizes = range(least, min(most + 1, n))
    if not len(sizes):
        return df.select(id_name, F.lit(0).alias("cluster_id"))
    some = np.array([np.asarray(r["vec"]) for r in rows.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(FIRST).collect()])
    rng = np.random.default_rng(seed)
    centres = {(k, s): _first_centres(some, k, rng) for k in sizes for s in range(starts)}
    context = df.sparkSession.sparkContext

    def sums(models: dict, silhouettes: dict | None = None) -> dict:
        """model -> (sums, squares, counts, inertia) of its clusters, or its summed silhouette."""
        sent = context.broadcast((models, silhouettes))

        def add(batches):
            given, known = sent.value
            out: dict = {}
            for b in batches:
                if not len(b):
                    continue
                x = np.array([np.asarray(v) for v in b["vec"]])
                for m, c in given.items():
                    own, d = _nearest_centres(x, c)
                    if known is not None:
                        out[m] = out.get(m, 0.0) + _silhouette(x, own, *known[m][:3])
                        continue
                    total = (own[None] == np.arange(len(c))[:, None]).astype(float) @ x
                    got = [total, np.bincount(own, (x**2).sum(1), len(c)), np.bincount(own, minlength=len(c)).astype(float), d.sum()]
                    out[m] = [p + q for p, q in zip(out[m], got)] if m in out else got
            flat = [[float(v)] if known is not None else np.concatenate([np.ravel(p) for p in v]) for v in out.values()]
            yield pd.DataFrame({"k": [m[0] for m in out], "s": [m[1] for m in out], "v": pd.Series(flat, dtype=object)}).astype({"k": "int32", "s": "int32"})

        def whole(batches):
            out: dict = {}
            for b in batches:
                for k, s, v in zip(b["k"], b["s"], b["v"]):
                    out[k, s] = out[k, s] + v if (k, s) in out else np.asarray(v)
            yield pd.DataFrame({"k": [m[0] for m in out], "s": [m[1] for m in out], "v": pd.Series([*out.values()], dtype=object)}).astype({"k": "int32", "s": "int32"})

        found: dict = {}
        schema = "k int, s int, v array<double>"
        for r in rows.mapInPandas(add, schema).repartition("k", "s").mapInPandas(whole, schema).collect():
            v = np.asarray(r["v"])
            k, dim = r["k"], some.shape[1]
            found[k, r["s"]] = float(v[0]) if silhouettes is not None else (v[: k * dim].reshape(k, dim), v[k * dim : k * dim + k], v[k * dim + k : k * dim + 2 * k], float(v[-1]))
        return found

    moving = dict(centres)
    for _ in range(turns):
        for m, (total, _, count, _) in sums(moving).items():
            new = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], moving[m])
            if np.abs(new - moving[m]).max() < 1e-4:
                del moving[m]
            centres[m] = new
        moving = {m: centres[m] for m in moving}
        if not moving:
            break
    final = sums(centres)
    best = {k: min((m for m in final if m[0] == k), key=lambda m: (final[m][3], m[1])) for k in sizes}
    told = sums({m: centres[m] for m in best.values()}, {m: final[m] for m in best.values()})
    winner = centres[max(best.values(), key=lambda m: (round(told[m] / n, 12), -m[0]))]
    chosen = context.broadcast(winner)

    def label(batches):
        for b in batches:
            x = np.array([np.asarray(v) for v in b["vec"]]).reshape(len(b), -1)
            yield pd.DataFrame({"id": b["id"], "cluster_id": (_nearest_centres(x, chosen.value)[0] if len(b) else np.zeros(0)).astype(np.int32)})

    return rows.mapInPandas(label, "id long, cluster_id int").withColumnRenamed("id", id_name)


def plane(df: DataFrame, id_name: str, vec: str) -> DataFrame:
    """(id, x, y): the two principal components, for drawing any number of points."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.select(id_name, array_to_vector(F.transform(vec, lambda x: x.cast("double"))).alias("features"))
    xy = vector_to_array("p")
    return PCA(k=2, inputCol="features", outputCol="p").fit(rows).transform(rows).select(id_name, xy[0].alias("x"), xy[1].alias("y"))


#: Points that the neighbour embedding takes; it holds the distances of all pairs in one task.
MOST_DRAWN = 5_000


def neighbour_coordinates(x: np.ndarray, perplexity: float = 30.0, turns: int = 500, seed: int = 42) -> np.ndarray:
    """Two coordinates of each row by t-distributed stochastic neighbour embedding (van der Maaten and Hinton, 2008).

    Widths are found by bisection so that each row's neighbours have the perplexity (of at most n - 1); descent with
    momentum and gains from principal components, with exaggeration in the first fifth of the turns.
    """
    n = len(x)
    if n < 3:
        return np.zeros((n, 2))
    d = np.maximum((x**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * x @ x.T, 0.0)
    goal = np.log(min(perplexity, (n - 1) / 1.5))
    low, high, beta = np.zeros(n), np.full(n, np.inf), np.ones(n)
    for _ in range(60):
        p = np.exp(-(d - np.sort(d, axis=1)[:, 1:2]) * beta[:, None])
        np.fill_diagonal(p, 0.0)
        total = np.maximum(p.sum(1), 1e-300)
        p /= total[:, None]
        entropy = -(p * np.log(np.maximum(p, 1e-300))).sum(1)
        flat = entropy > goal
        low, high = np.where(flat, beta, low), np.where(flat, high, beta)
        beta = np.where(np.isinf(high), beta * 2, (low + high) / 2)
    p = np.maximum((p + p.T) / (2 * n), 1e-12)
    centred = x - x.mean(0)
    axes = np.linalg.svd(centred, full_matrices=False)[2][:2]
    rng = np.random.default_rng(seed)
    y = centred @ axes.T
    y = np.pad(y, ((0, 0), (0, 2 - y.shape[1])))
    y = y / (y[:, 0].std() + 1e-12) * 1e-4 + rng.normal(size=(n, 2)) * 1e-6
    step, gains, rate = np.zeros_like(y), np.ones_like(y), max(n / 48.0, 50.0)
    for turn in range(turns):
        near = 1 / (1 + np.maximum((y**2).sum(1)[:, None] + (y**2).sum(1)[None] - 2 * y @ y.T, 0.0))
        np.fill_diagonal(near, 0.0)
        pull = (p * (12.0 if turn < turns // 5 else 1.0) - near / near.sum()) * near
        gradient = 4 * (pull.sum(1)[:, None] * y - pull @ y)
        gains = np.maximum(np.where(np.sign(gradient) == np.sign(step), gains * 0.8, gains + 0.2), 0.01)
        step = (0.5 if turn < turns // 5 else 0.8) * step - rate * gains * gradient
        y = y + step
        y -= y.mean(0)
    return y


def neighbour_map(df: DataFrame, id_name: str, vec: str, perplexity: float = 30.0, seed: int = 42) -> DataFrame:
    """(id, x, y) by `neighbour_coordinates`, for drawing; more than MOST_DRAWN points are an error: use `plane`."""
    rows = df.select(F.col(id_name).cast("long").alias("id"), F.col(vec).alias("vec")).where("id is not null and vec is not null")
    if rows.limit(MOST_DRAWN + 1).count() > MOST_DRAWN:
        raise ValueError(f"the neighbour embedding takes at most {MOST_DRAWN} points; use plane")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        xy = neighbour_coordinates(np.array([np.asarray(v, np.float64) for v in part["vec"]]), perplexity, seed=seed)
        return pd.DataFrame({"id": part["id"], "x": xy[:, 0], "y": xy[:, 1]})

    return rows.withColumn("one", F.lit("")).groupBy("one").applyInPandas(run, "id long, x double, y double").withColumnRenamed("id", id_name)
