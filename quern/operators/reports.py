"""Counts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F


def tag_counts(df: DataFrame, tags: str, order: str, most: int | None = None) -> DataFrame:
    """(tag, count, first_seen): by count, then first appearance (record, then place); the first `most` where given."""
    long = df.select(F.col(order).alias("o"), F.posexplode(tags).alias("at", "tag")).where("tag is not null")
    out = long.groupBy("tag").agg(F.count(F.lit(1)).alias("count"), F.min(F.struct("o", "at")).alias("first"))
    out = out.orderBy(F.desc("count"), "first")
    out = out.limit(most) if most else out
    return out.select("tag", "count", F.col("first.o").alias("first_seen"))


def split_counts(train: DataFrame, evaluation: DataFrame, by: str) -> DataFrame:
    """(value, train, eval): records of both splits by the value of a column, null as 'unknown'."""
    rows = train.select(by).withColumn("split", F.lit("train")).unionByName(evaluation.select(by).withColumn("split", F.lit("eval")))
    value = F.coalesce(F.col(by).cast("string"), F.lit("unknown")).alias("value")
    return rows.groupBy(value).agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "eval").alias("eval"))


def split_report(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """One row: totals of both splits, of mirrors and failed rephrasings, and the number of clusters."""
    a = train.agg(F.count_if(~F.coalesce("is_eval_mirror", F.lit(False))).alias("train_items"), F.count_if(F.coalesce("is_eval_mirror", F.lit(False))).alias("eval_mirrors"))
    b = evaluation.agg(F.count(F.lit(1)).alias("eval_items"), F.count_if(F.coalesce("rephrase_failed", F.lit(False))).alias("rephrase_failures"))
    c = train.select("cluster_id").union(evaluation.select("cluster_id")).agg(F.countDistinct("cluster_id").alias("clusters_found"))
    return a.crossJoin(b).crossJoin(c).select((F.col("train_items") + F.col("eval_items")).alias("total_items"), "train_items", "eval_items", "eval_mirrors", "rephrase_failures", "clusters_found")


def split_distributions(train: DataFrame, evaluation: DataFrame, fields: tuple[str, ...] = ("cluster_id", "difficulty", "category")) -> DataFrame:
    """(field, value, train, eval): `split_counts` of each field, the nested part of the split report."""
    parts = [split_counts(train, evaluation, c).select(F.lit(c).alias("field"), "value", "train", "eval") for c in fields]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def cluster_stats(labels: DataFrame, label: str = "cluster_id") -> DataFrame:
    """One row: the number of noise points (-1) and of clusters without noise."""
    return labels.agg(F.count_if(F.col(label) == -1).alias("noise_points"), F.countDistinct(F.when(F.col(label) != -1, F.col(label))).alias("clusters"))


def cleaning_report(marked: DataFrame, stage: str, stages: list[str]) -> DataFrame:
    """(step, remaining, discarded): records left after each stage, from the column that names where each went out."""
    n = marked.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col(stage) == s).alias(f"s{i}") for i, s in enumerate(stages)])
    rows, gone = [F.struct(F.lit(0).alias("step_no"), F.lit("input").alias("step"), F.col("all").alias("remaining"), F.lit(0).cast("long").alias("discarded"))], F.lit(0).cast("long")
    for i, s in enumerate(stages):
        gone = gone + F.col(f"s{i}")
        rows.append(F.struct(F.lit(i + 1).alias("step_no"), F.lit(s).alias("step"), (F.col("all") - gone).alias("remaining"), F.col(f"s{i}").alias("discarded")))
    return n.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def usage(calls: DataFrame, prices: list[tuple[str, float, float]], default: tuple[float, float] = (0.25, 1.5)) -> DataFrame:
    """(model, calls, prompt_tokens, completion_tokens, cost): sums by model; a price per million tokens applies where
    its key is contained in the model's name, the first that fits."""
    sums = calls.groupBy("model").agg(F.count(F.lit(1)).alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"))
    into, out = F.lit(float(default[0])), F.lit(float(default[1]))
    for key, a, b in reversed(prices):
        fits = F.contains(F.coalesce("model", F.lit("")), F.lit(key))
        into, out = F.when(fits, F.lit(float(a))).otherwise(into), F.when(fits, F.lit(float(b))).otherwise(out)
    return sums.withColumn("cost", (F.col("prompt_tokens") * into + F.col("completion_tokens") * out) / 1e6)


def histogram(values: DataFrame, column: str, bins: int, low: float, high: float) -> DataFrame:
    """(bin, count) of equal bins; values outside go into the first and the last."""
    at = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col(column) - low) / (high - low) * bins)))
    return values.where(F.col(column).isNotNull()).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def colours(df: DataFrame, label: str) -> DataFrame:
    """(label, number): the different labels in order, numbered from 0, for a legend."""
    distinct = df.select(label).distinct().where(F.col(label).isNotNull())
    return distinct.select(label, (F.dense_rank().over(W.orderBy(label)) - 1).alias("number"))  # one row a label


def scatter(points: DataFrame, records: DataFrame, order: str, field: str) -> DataFrame:
    """(order, x, y, value, number): the points of a chart with the value of a field ('unknown' for null) and its colour
    number in the legend."""
    named = points.join(records.select(order, F.coalesce(F.col(field).cast("string"), F.lit("unknown")).alias("value")), order)
    legend = colours(named, "value")
    return named.join(legend, "value").select(order, "x", "y", "value", "number")


def latest_tags(tags: Column, merged: dict[str, str]) -> Column:
    """An array of tags with each replaced by its entry in the map, one hop, repeats kept."""
    if not merged:
        return tags
    pairs = F.create_map(*[F.lit(x) for kv in merged.items() for x in kv])
    return F.transform(tags, lambda t: F.coalesce(pairs[t], t))
