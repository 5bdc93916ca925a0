"""Samples and the train/evaluation split, in a fixed order by hash instead of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F


def lot(order: str, seed: int = 42) -> Column:
    """A record's place in the shuffled order: the MD5 of seed and id, the same in any engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(order).cast("string")))


def percentage(df: DataFrame, order: str, percent: int, seed: int = 42) -> DataFrame:
    """At least one record and percent of 100 of them, rounded down, without replacement.

    The cut comes from a count of the lots' first two bytes, so that only the records of one in 65536 lots are
    ordered; ties go by id.
    """
    n = df.count()
    if n == 0:
        return df
    want = max(1, n * percent // 100)
    ticket = df.withColumn("__lot", lot(order, seed)).withColumn("__head", F.substring("__lot", 1, 4))
    seen = 0
    for head, count in sorted((r["__head"], r["count"]) for r in ticket.groupBy("__head").count().collect()):  # at most 65536 rows
        if seen + count >= want:
            break
        seen += count
    edge = ticket.where(F.col("__head") == head).orderBy("__lot", order).limit(want - seen)
    return ticket.where(F.col("__head") < head).union(edge).select(*df.columns)


def allocations(sizes: DataFrame, fraction: float = 0.12, least: int = 2) -> DataFrame:
    """(cluster_id, size, allocated): records each cluster gives to the evaluation split.

    The budget is the fraction of all, one at least; a cluster gives its part of it, `least` at least and its size at
    most; where that passes the budget, each part is scaled down, again to `least` at least.
    """
    total = F.sum("size").over(W.partitionBy())
    out = sizes.select("cluster_id", F.col("size").cast("long").alias("size")).withColumn("__total", total)  # one row a cluster
    budget = F.greatest(F.lit(1), F.floor(F.col("__total") * F.lit(fraction))).cast("long")
    out = out.withColumn("__budget", budget)
    out = out.withColumn("__a", F.least("size", F.greatest(F.lit(least).cast("long"), F.floor(F.col("__budget") * F.col("size") / F.col("__total")))))
    out = out.withColumn("__sum", F.sum("__a").over(W.partitionBy()))
    scaled = F.greatest(F.lit(least).cast("long"), F.floor(F.col("__a") * F.col("__budget") / F.col("__sum")))
    return out.select("cluster_id", "size", F.when(F.col("__sum") > F.col("__budget"), scaled).otherwise(F.col("__a")).alias("allocated"))


def stratified(df: DataFrame, order: str, stratum: str, cluster: str = "cluster_id", fraction: float = 0.12, least: int = 2, seed: int = 42) -> DataFrame:
    """The records of the evaluation split.

    Each cluster gives its allocation by the shares of the strata in it, one at least of each, trimmed or filled up in
    the order of lots; a cluster not larger than its allocation gives all.
    """
    sizes = df.groupBy(F.col(cluster).alias("cluster_id")).agg(F.count(F.lit(1)).alias("size"))
    plan = allocations(sizes, fraction, least)
    strata = df.groupBy(F.col(cluster).alias("cluster_id"), F.coalesce(F.col(stratum), F.lit("unknown")).alias("__stratum")).agg(F.count(F.lit(1)).alias("__n")).join(plan, "cluster_id")
    strata = strata.withColumn("__quota", F.greatest(F.lit(1).cast("long"), F.floor(F.col("allocated") * F.col("__n") / F.col("size")))).drop("__n")
    names = df.columns
    rows = df.withColumns({"__c": F.col(cluster), "__stratum": F.coalesce(F.col(stratum), F.lit("unknown")), "__lot": lot(order, seed)})
    rows = rows.join(strata.withColumnRenamed("cluster_id", "__c"), ["__c", "__stratum"])
    rows = rows.withColumn("__in", F.row_number().over(W.partitionBy("__c", "__stratum").orderBy("__lot", order)))
    # those within their stratum's quota come first, then the rest, each by lot
    rows = rows.withColumn("__rank", F.row_number().over(W.partitionBy("__c").orderBy((F.col("__in") > F.col("__quota")).cast("int"), "__lot", order)))
    return rows.where(F.col("__rank") <= F.col("allocated")).select(*names)


def split(df: DataFrame, order: str, stratum: str, **settings) -> tuple[DataFrame, DataFrame]:
    """(train, evaluation): the rest and the sample."""
    evaluation = stratified(df, order, stratum, **settings)
    return df.join(evaluation.select(order), order, "left_anti"), evaluation


def mirror(evaluation: DataFrame, rephrased: DataFrame, order: str) -> DataFrame:
    """Evaluation records with their rephrased question and answer beside the original ones."""
    return evaluation.join(rephrased.select(order, F.col("question").alias("rephrased_question"), F.col("answer").alias("rephrased_answer")), order)


def final_train(train: DataFrame, mirrored: DataFrame) -> DataFrame:
    """Train records and the evaluation mirrors in their original form, with `is_eval_mirror`."""
    kept = mirrored.drop("rephrased_question", "rephrased_answer").withColumn("is_eval_mirror", F.lit(True))
    return train.withColumn("is_eval_mirror", F.lit(False)).unionByName(kept, allowMissingColumns=True)
