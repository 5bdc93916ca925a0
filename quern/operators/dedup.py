"""Exact, fuzzy and semantic duplicates with survivors that follow the order of the records.

Greedy rules run through the records in order: a record that is still there compares itself with its partners, the
loser goes, and a record that loses goes on comparing.  Whether a record starts depends only on earlier records, so
`greedy` decides it in rounds of joins: as many as the longest chain of decisions, without collecting any group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from quern.functions import native
from quern.functions.similarity import indel_similarity
from quern.functions.text import normalized
from quern.shared import cut, forget


def exact(df: DataFrame, order: str, text: str, normalize: bool = True) -> DataFrame:
    """With `duplicate_of`: the first record in order with the same text, null for that record itself.

    The least order of each text is summed up before the shuffle and joined back by the text, so that a text of a third
    of all rows is split like any skewed join.  A null text is a text of its own.
    """
    keyed = df.withColumn("__key", normalized(F.col(text)) if normalize else F.col(text))
    first = keyed.groupBy("__key").agg(F.min(order).alias("__first"))
    same = F.col("x.__key").eqNullSafe(F.col("y.__key"))
    out = keyed.alias("x").join(first.alias("y"), same).select(*[F.col(f"x.{c}") for c in df.columns], F.col("y.__first").alias("__first"))
    return out.withColumn("duplicate_of", F.when(F.col("__first") != F.col(order), F.col("__first"))).drop("__first")


def survivors_of(nodes: DataFrame, before: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """(node): the nodes not blocked that no surviving node stands before.  before: (first, then), acyclic."""
    before = cut(before.select("first", "then").distinct(), "before")
    out = blocked.select(F.col("node"), F.lit(False).alias("alive")).distinct() if blocked is not None else None
    # nodes that no other stands before are decided at once
    state = nodes.select("node").distinct()
    state = state.join(out, "node", "left") if out is not None else state.withColumn("alive", F.lit(None).cast("boolean"))
    state = cut(state, "state")
    while True:
        told = before.join(state.select(F.col("node").alias("first"), F.col("alive").alias("first_alive")), "first")
        votes = told.groupBy(F.col("then").alias("node")).agg(F.bool_or(F.coalesce("first_alive", F.lit(False))).alias("loses"), F.bool_or(F.col("first_alive").isNull()).alias("open"))
        decided = F.when(F.col("alive").isNotNull(), F.col("alive")).when(F.coalesce("loses", F.lit(False)), False).when(~F.coalesce("open", F.lit(False)), True)
        old, state = state, cut(state.join(votes, "node", "left").select("node", decided.alias("alive")), "state")
        forget(old)
        if state.where("alive is null").isEmpty():
            forget(before)
            return state.where("alive").select("node")


def greedy(edges: DataFrame, weights: DataFrame, keep: str = "heavier") -> DataFrame:
    """(node): the records that a greedy run removes.

    edges: (i, j), the pairs in which i compares itself with j; for a symmetric relation, i < j.  weights: (node,
    weight).  keep `heavier`: the greater weight stays, the tie keeps i; `first`: i stays.
    """
    w = weights.select("node", "weight")
    e = edges.select("i", "j").distinct().join(w.select(F.col("node").alias("i"), F.col("weight").alias("wi")), "i").join(w.select(F.col("node").alias("j"), F.col("weight").alias("wj")), "j")
    wins = F.lit(True) if keep == "first" else F.col("wi") >= F.col("wj")
    e = cut(e.withColumn("wins", wins), "edges")
    nodes = e.select(F.explode(F.array("i", "j")).alias("node")).distinct()
    # a record starts unless an earlier one that started beats it
    starts = cut(survivors_of(nodes, e.where("wins and i < j").select(F.col("i").alias("first"), F.col("j").alias("then"))), "starts")
    acting = e.join(starts.select(F.col("node").alias("i")), "i")
    acting = cut(acting, "acting")
    beaten = acting.where("wins").groupBy(F.col("j").alias("node")).agg(F.min("i").alias("by"))
    lost = nodes.join(starts, "node", "left_anti")
    if keep == "first":
        return lost.union(beaten.select("node")).distinct()
    # a record that started loses to a heavier partner that is still there at its turn: one that no record before
    # its turn has beaten and, if it is an earlier record, that did not lose at its own turn
    heavier = acting.where("not wins").join(beaten.withColumnsRenamed({"node": "j", "by": "__by"}), "j", "left")
    heavier = heavier.where("__by is null or __by > i")
    ahead = heavier.where("j > i").select(F.col("i").alias("node")).distinct()
    earlier = heavier.where("j < i").join(starts.select(F.col("node").alias("j")), "j", "left_semi")
    kept_at_turn = survivors_of(starts, earlier.select(F.col("j").alias("first"), F.col("i").alias("then")), ahead)
    lost_at_turn = starts.join(kept_at_turn, "node", "left_anti")
    return lost.union(beaten.select("node")).union(lost_at_turn).distinct()


#: Texts and characters of a block at most, texts of a block at least, and the blocks that texts are cut into where both
#: bounds leave it open; texts of a block that are compared in one call.
BLOCK, BLOCK_CHARS, LEAST, BLOCKS, SLICE = 32768, 1 << 22, 1024, 24, 1024


def similar_strings(df: DataFrame, order: str, text: str, threshold: float) -> DataFrame:
    """(i, j, ratio), i < j: all pairs of different texts whose Indel similarity is at least `threshold`.

    Lossless candidate search.  The lengths of similar texts differ by the factor (2 - threshold) / threshold at most,
    so texts meet by length class and, where the threshold allows it, by script: a text of mostly ASCII characters is
    not similar to one of mostly others.  Such cells are cut into blocks by hash, each pair of blocks is one row of one
    task, and no pair of texts is compared twice.  Inside a pair of blocks (`native`), counts of characters bound the
    common subsequence of two texts, and what is left is compared exactly.

    Cost still grows with the square of a cell.  Null and empty texts have no partner; a threshold of 0 or less is an
    error.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be greater than 0")
    t = threshold
    spark = df.sparkSession
    rows = df.select(F.col(order).cast("long").alias("id"), F.col(text).alias("text")).where("text <> ''").withColumn("n", F.length("text"))
    factor = (2 - t) / t
    size = F.floor(F.log("n") / F.lit(math.log(factor)) + 1e-9).cast("int") if factor > 1.0001 else F.col("n")
    other = F.length(F.regexp_replace("text", r"[\x00-\x7f]", "")) / F.col("n")
    apart = (t - 0.2) / factor > 1.2 - t  # texts of under a fifth and over four fifths of other characters can't meet
    script = F.when(other < 0.2, 0).when(other > 0.8, 2).otherwise(1) if apart else F.lit(1)
    placed = cut(rows.select("id", "text", "n", size.alias("size"), script.cast("int").alias("script")), "placed")

    # the cells, one row a length class and script, their blocks, and which of them meet
    cells = {(r["size"], r["script"]): r for r in placed.groupBy("size", "script").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("chars")).collect()}
    block = min(BLOCK, max(LEAST, sum(r["rows"] for r in cells.values()) // BLOCKS))
    parts = {c: max(-(-r["rows"] // block), -(-r["chars"] // BLOCK_CHARS)) for c, r in cells.items()}
    starts, n = {}, 0
    for c in sorted(parts):
        starts[c], n = n, n + parts[c]
    meets = []
    for (a, s), n in parts.items():
        for cell in [(a, z) for z in range(s + 1)] + [(a - 1, z) for z in range(3)]:  # of one length class, each two cells once
            if abs(s - cell[1]) <= 1 and cell in parts:
                x, y = starts[a, s], starts[cell]
                meets += [(x + p, y + q) for p in range(n) for q in range(p if x == y else 0, parts[cell])]
    numbered = spark.createDataFrame([(*c, parts[c], starts[c]) for c in sorted(parts)], "size int, script int, parts int, start int")
    tasks = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(meets)], "task int, a int, b int")
    own = F.col("start") + F.pmod(F.xxhash64("id"), "parts").cast("int")
    blocks = cut(placed.join(F.broadcast(numbered), ["size", "script"]).groupBy(own.alias("block")).agg(F.collect_list("id").alias("ids"), F.collect_list("text").alias("texts")), "blocks")
    count = max(1, min(len(meets), 2000))
    x = blocks.join(F.broadcast(tasks), F.col("block") == F.col("a")).select("task", (F.col("a") == F.col("b")).alias("same"), F.col("ids").alias("xi"), F.col("texts").alias("xt")).repartition(count, "task")
    y = blocks.join(F.broadcast(tasks), F.col("block") == F.col("b")).where("a <> b").select("task", F.col("ids").alias("yi"), F.col("texts").alias("yt")).repartition(count, "task")
    at = x.join(y, "task", "left").withColumns({"yi": F.coalesce("yi", "xi"), "yt": F.coalesce("yt", "xt")}).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("xi") - 1, F.lit(SLICE))))
    cut_out = lambda c: F.slice(c, F.col("at") + 1, F.lit(SLICE))
    found = F.call_udf(native.register(spark), cut_out("xt"), "yt", F.lit(float(t)), F.when(F.col("same"), F.col("at")).otherwise(-1), cut_out("xi"), "yi")
    return at.select(F.inline(found))


def fuzzy(df: DataFrame, order: str, text: str, weight: str, threshold: float = 0.85, keep: str = "heavier") -> DataFrame:
    """With `removed`: whether the greedy run over similar texts removes the record.

    Equal texts have the same partners and each other, so a record with a copy before it that is no lighter always goes
    and decides nothing: either that copy beats it, or what beat the copy does.  Only the others, the `leads`, are
    compared: one a text where the first stays, else as many as its weights rise in order.
    """
    ranks = df.select(F.col(order).alias("id"), F.col(text).alias("text"), (F.lit(0) if keep == "first" else F.coalesce(F.length(weight), F.lit(0))).alias("weight"))
    rising = W.partitionBy("text").orderBy("id")
    first = ranks.where("text is not null and id is not null").groupBy("text", "weight").agg(F.min("id").alias("id"))
    above = first.select("id", "text", "weight", F.first("id").over(rising).alias("first"), F.max("weight").over(rising.rowsBetween(W.unboundedPreceding, -1)).alias("most"))
    leads = cut(above.where("most is null or weight > most").drop("most"), "leads")
    pairs = similar_strings(leads.where("id = first"), "id", "text", threshold).select("i", "j")
    across = pairs.join(leads.select(F.col("first").alias("i"), F.col("id").alias("a")), "i").join(leads.select(F.col("first").alias("j"), F.col("id").alias("b")), "j")
    x, y = leads.alias("x"), leads.alias("y")
    within = x.join(y, F.expr("x.first = y.first and x.id < y.id")).select(F.col("x.id").alias("i"), F.col("y.id").alias("j"))
    edges = across.select(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).union(within)
    gone = greedy(edges, leads.select(F.col("id").alias("node"), "weight"), keep)
    stay = leads.select("id").join(gone.select(F.col("node").alias("id")), "id", "left_anti")
    out = df.join(stay.select(F.col("id").alias(order), F.lit(True).alias("__stays")), order, "left")
    return out.withColumn("removed", F.col(text).isNotNull() & F.col(order).isNotNull() & F.col("__stays").isNull()).select(*df.columns, "removed")


def ranked_edges(similar: DataFrame, most: int = 20) -> DataFrame:
    """(i, j): each record's partners among its `most` best, itself included, without the best one.

    similar: (i, j, score) with both directions and (i, i).  Order: score descending, then j; the first is taken for
    the record itself and skipped, so among equal vectors a record may miss a partner.
    """
    w = W.partitionBy("i").orderBy(F.desc("score"), "j")
    return similar.withColumn("rank", F.row_number().over(w)).where((F.col("rank") > 1) & (F.col("rank") <= most) & (F.col("i") != F.col("j"))).select("i", "j")


def in_loop(df: DataFrame, group: str, order: str, text: str, threshold: float = 0.8, initial: str | None = None) -> DataFrame:
    """With `repeats`: whether an earlier kept record of the same group is more similar than `threshold`.

    Records whose column `initial` is true are a group's first batch, which is kept whole.  Groups are the questions of one chunk, which the generation bounds; a record is kept unless a kept one stands
    before it, which `survivors_of` decides without collecting a group.
    """
    first = F.coalesce(F.col(initial), F.lit(False)) if initial else F.lit(False)
    rows = df.select(F.col(group).alias("g"), F.col(order).alias("id"), F.col(text).alias("text"), first.alias("initial"))
    x, y = rows.alias("x"), rows.alias("y")
    fits = F.expr(f"2 * least(length(x.text), length(y.text)) > {threshold} * (length(x.text) + length(y.text))")
    pairs = x.join(y, F.expr("x.g = y.g and x.id < y.id and not y.initial") & fits).select(F.col("x.id").alias("first"), F.col("y.id").alias("then"), indel_similarity("x.text", "y.text").alias("ratio")).where(F.col("ratio") > threshold)
    kept = survivors_of(rows.select(F.col("id").alias("node")), pairs)
    return df.join(kept.select(F.col("node").alias(order), F.lit(False).alias("repeats")), order, "left").select(*df.columns, F.coalesce("repeats", F.lit(True)).alias("repeats"))
