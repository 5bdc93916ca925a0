"""Mixing sources to target weights (problem 9), by hash-threshold histograms.

Every document has a hash in [0, 2**60).  Sizes are summed by source and hash bucket; for each source the threshold
lies in the bucket where the sum passes its budget, and only that bucket is summed again by finer buckets, until it
holds one document at most.  Documents below the threshold come once more than the others; nothing is sorted.
Thresholds are nested: a larger budget keeps every document of a smaller one.

A source takes its budget as whole passes over its documents and one partial pass.  The total is the largest at which
every source that has tokens can give its share within max_repeats, or `total` where given, if it is not larger.
Sources without tokens can't give their share; it is spread over the others in proportion, and the report shows it.

Defined results: documents of other or null sources are left out; null and empty texts have size 0 and come as often
as their hash says; documents of one id have one hash and come together, so a source may miss its budget by their
size; without any usable source the mix is empty; a source listed twice is an error; null or negative shares count
as 0, repeats below 1 as 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.tokens import FOLDER, VOCABULARY, counted
from quern.shared import cut

#: Bits of the hash, and of it in a level of buckets.
BITS, LEVEL = 60, 10
#: Sources that a mix may have; targets and histograms of one level fit on the driver below it.
MOST_SOURCES = 1000


@dataclass
class Plan:
    """What one source gives: whole passes, and the hash below which documents come once more."""

    source: str
    share: float
    repeats: int
    available: int
    budget: float = 0.0
    passes: int = 0
    threshold: int = 0


class Mix:
    """A mix of `documents` after `targets` (source, target_share, max_repeats)."""

    def __init__(self, documents: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", total: float | None = None, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> None:
        self.key, self.source = key, source
        rows = targets.select("source", "target_share", "max_repeats").where("source is not null").limit(MOST_SOURCES + 1).collect()
        if len(rows) > MOST_SOURCES or len({r["source"] for r in rows}) < len(rows):
            raise ValueError(f"targets need different sources, at most {MOST_SOURCES}")
        spark = documents.sparkSession
        names = spark.createDataFrame([(r["source"],) for r in rows], "source string")
        used = documents.select(key, source, text).join(F.broadcast(names.withColumnRenamed("source", source)), source, "left_semi")
        self.sizes = cut(counted(used, [key, source], text, folder, vocabulary).withColumn("hash", F.shiftrightunsigned(F.xxhash64(F.lit(9), F.col(key)), 64 - BITS)), "sizes")
        have = {r[0]: r[1] or 0 for r in self.sizes.groupBy(source).agg(F.sum("n_tokens")).collect()}
        self.plans = [Plan(r["source"], max(0.0, r["target_share"] or 0.0), max(0, r["max_repeats"] or 0), have.get(r["source"], 0)) for r in rows]
        able = [p for p in self.plans if p.share > 0 and p.available > 0 and p.repeats > 0]
        weight = sum(p.share for p in able)
        most = min((p.repeats * p.available * weight / p.share for p in able), default=0.0)
        self.total = most if total is None else min(float(total), most)
        for p in able:
            p.budget = self.total * p.share / weight
            p.passes = min(p.repeats, int(p.budget / p.available + 1e-9))
        self._thresholds([p for p in able if p.passes < p.repeats and p.budget - p.passes * p.available >= 1])

    def _thresholds(self, plans: list[Plan]) -> None:
        """Sets the thresholds, one histogram of the boundary buckets a level."""
        left = {p.source: p.budget - p.passes * p.available for p in plans}
        prefix = dict.fromkeys(left, 0)  # of the boundary bucket
        for level in range(BITS // LEVEL):
            if not left:
                return
            shift = BITS - LEVEL * (level + 1)
            bucket = F.shiftright("hash", shift)
            # at most MOST_SOURCES rows, whatever the size of the corpus
            at = self.sizes.sparkSession.createDataFrame([*prefix.items()], "__source string, __prefix long")
            inside = self.sizes.join(F.broadcast(at), (F.col(self.source) == F.col("__source")) & (F.shiftright("hash", shift + LEVEL) == F.col("__prefix")))
            sums: dict[str, list] = {}
            for r in inside.groupBy(self.source, bucket.alias("bucket")).agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("rows")).collect():
                sums.setdefault(r[0], []).append((r["bucket"], r["n"], r["rows"]))
            for p in plans:
                if p.source not in left:
                    continue
                for b, n, rows in sorted(sums.get(p.source, [])):
                    if n <= left[p.source]:
                        left[p.source] -= n
                        p.threshold = (b + 1) << shift
                        continue
                    p.threshold = b << shift
                    prefix[p.source] = b
                    if rows == 1 or shift == 0:
                        if left[p.source] * 2 > n:  # the nearer side of the budget
                            p.threshold = (b + 1) << shift
                        del left[p.source], prefix[p.source]
                    break
                else:
                    del left[p.source], prefix[p.source]

    def documents(self) -> DataFrame:
        """(key, source, n_tokens, copies): every document that is taken, and how often."""
        # at most MOST_SOURCES rows
        plan = self.sizes.sparkSession.createDataFrame([(p.source, p.passes, p.threshold) for p in self.plans], "__source string, __passes int, __threshold long")
        taken = self.sizes.join(F.broadcast(plan), F.col(self.source) == F.col("__source"))
        copies = (F.col("__passes") + (F.col("hash") < F.col("__threshold")).cast("int")).alias("copies")
        return taken.select(self.key, self.source, "n_tokens", copies).where("copies > 0")

    def shares(self) -> DataFrame:
        """(source, target_share, available_tokens, taken_tokens, actual_share, most_copies) of every target."""
        taken = self.documents().groupBy(self.source).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("taken"), F.max("copies").alias("most"))
        got = {r[0]: (r["taken"], r["most"]) for r in taken.collect()}
        whole = sum(t for t, _ in got.values())
        rows = [(p.source, p.share, p.available, int(got.get(p.source, (0, 0))[0]), got.get(p.source, (0, 0))[0] / whole if whole else 0.0, int(got.get(p.source, (0, 0))[1])) for p in self.plans]
        return self.sizes.sparkSession.createDataFrame(rows, "source string, target_share double, available_tokens long, taken_tokens long, actual_share double, most_copies int")
