"""Tags that mean the same, merged by the similarity of their embeddings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.dedup import survivors_of
from quern.operators.neighbours import similar_vectors
from quern.providers import embedded
from quern.shared import cut


def merged_into(df: DataFrame, order: str, tags: str, threshold: float = 0.85, embed: Callable | None = None) -> DataFrame:
    """(tag, merged): each tag that another one stands for, one hop.

    Tags are taken in the order of their first appearance.  A tag that none before has taken is compared with the later
    ones that none has taken: of two similar tags the more frequent stands for the other, the tie keeps the earlier.  A
    tag that loses at its own turn goes on, and the last one it loses to stands for it.  Whether a tag is taken before
    its turn depends on earlier tags only, so joins decide it in rounds; nothing is collected.
    """
    long = df.select(F.col(order).alias("o"), F.posexplode(tags).alias("at", "tag")).where("tag is not null")
    found = cut(long.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("o", "at")).alias("first")).withColumn("id", F.xxhash64("tag")), "tags")
    vectors = embedded(found.select("id", "tag"), "tag", embed).select("id", "vec")
    near = similar_vectors(vectors, "id", "vec", threshold).select("i", "j")
    side = lambda s: found.select(F.col("id").alias(s), F.col("tag").alias(f"t{s}"), F.col("n").alias(f"n{s}"), F.col("first").alias(f"f{s}"))
    pairs = near.join(side("i"), "i").join(side("j"), "j").where("fi < fj")
    pairs = cut(pairs.withColumn("wins", F.col("ni") >= F.col("nj")), "pairs")
    acting = cut(survivors_of(pairs.select(F.explode(F.array("i", "j")).alias("node")), pairs.where("wins").select(F.col("i").alias("first"), F.col("j").alias("then"))), "acting")
    own = cut(pairs.join(acting.withColumnRenamed("node", "i"), "i", "left_semi"), "own")
    taken = own.where("wins").groupBy("j").agg(F.min_by("ti", "fi").alias("merged"), F.min("fi").alias("by"), F.first("tj").alias("tag"))
    taken = cut(taken, "taken")
    # a tag that loses at its turn, to those that none before its turn has taken
    lost = own.where("not wins").join(taken.select("j", "by"), "j", "left").where("by is null or by > fi")
    lost = lost.groupBy("i").agg(F.max_by("tj", "fj").alias("merged"), F.first("ti").alias("tag"))
    gone = taken.join(acting.withColumnRenamed("node", "j"), "j", "left_anti")
    return gone.select("tag", "merged").union(lost.select("tag", "merged"))


def merged(df: DataFrame, order: str, tags: str, mapping: DataFrame) -> DataFrame:
    """`df` with each tag replaced by the one that stands for it, repeats and order kept; null arrays stay null.

    Only rows with a tag to replace take part in the join.
    """
    names = df.columns
    long = df.select(F.col(order).alias("__o"), F.posexplode(tags).alias("__at", "__tag"))
    hits = long.join(mapping.select(F.col("tag").alias("__tag"), F.col("merged").alias("__merged")), "__tag")
    changed = hits.groupBy("__o").agg(F.map_from_entries(F.collect_list(F.struct("__at", "__merged"))).alias("__by"))
    out = df.join(changed, F.col(order) == F.col("__o"), "left")
    new = F.transform(tags, lambda t, i: F.coalesce(F.element_at(F.col("__by"), i), t))
    return out.withColumn(tags, F.when(F.col("__by").isNotNull(), new).otherwise(F.col(tags))).select(*names)
