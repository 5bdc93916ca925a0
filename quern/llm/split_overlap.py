"""Records of evaluation splits that occur, exactly or almost, in the training split (problem 2).

Suffixes of both splits are brought into one order in Spark's partitions, and runs of suffixes of both splits with a
common prefix name the pairs.  A record is put into the array in one canonical order of its different words (by hash,
between a first and a last sign), so that no pair depends on the order in which its words are written:

- Two records of which every union of u words has c in common differ in u - c words, and each of those interrupts the
  sequence of the common words at one place, so at least 2c - u + 1 suffixes of one begin with the same two words as
  suffixes of the other.  A word share of `threshold` (0.5 or more) leaves at least one; see `shared_at_least`.
- As that many are shared, the suffixes with the most frequent beginnings are left out: two records that reach the
  threshold still meet at one of the others (`starts`).  Nothing is sampled and no pair is lost.

Suffixes are shuffled and sorted by their beginning (Spark's sort-merge join), and AQE splits runs that are hot.  Where
two suffixes meet, the words before and after them and the parity sketches of their records refuse the pair unless
their word sets can reach the threshold; the exact word share decides.  Equal texts are one class and are expanded at
the end.  For pairs found, a suffix array over both texts as written gives the longest common prefixes of neighbours of
both splits; the shared spans are merged into `coverage` (`covered`).

Defined results: nulls count as empty; a text without words overlaps with none; repeated rows are listed each; empty
tables give empty results; a threshold below 0.5 is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.lookalike import _WORDS, folded
from quern.llm.near_duplicates import _mix, parity, word_hash
from quern.shared import cut

#: Hash buckets in which words are counted; any order of beginnings that both sides share is lossless.
BUCKETS = 1 << 16
#: Bits of the map of the beginnings of one split, by which the other split's are refused before they are shuffled.
BITS = 1 << 24
#: Words of a shared span, at least.
SPAN = 3
_FIRST, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def sequence(text: str) -> np.ndarray:
    """The hashes of the text's words in order."""
    return np.fromiter((word_hash(w) for w in _WORDS.findall(folded(text))), dtype=np.uint64).view(np.int64)


@lru_cache(maxsize=1 << 16)
def shared_at_least(n: int, threshold: float) -> int:
    """How many beginnings of two words a record of n different words shares at least with any other at the threshold.

    Of u words in the union c = ceil(threshold * u) are common; c + 1 pairs of neighbours, the signs included, are
    interrupted at u - c places at most; u is n at least and n / threshold at most.
    """
    return min(2 * math.ceil(threshold * u - 1e-9) - u + 1 for u in range(n, int(n / threshold + 1e-9) + 1))


def starts(words: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): the beginnings of two words of the suffixes in canonical order that are needed, and their places.

    words: the different words of a record, sorted.
    """
    u = words.view(np.uint64)
    left, right = np.concatenate([[_FIRST], u]), np.concatenate([u, [_LAST]])
    keys = _mix(left * np.uint64(0xD6E8FEB86659FD93) + right)
    c = counts[(u % np.uint64(BUCKETS)).astype(np.int64)].astype(np.float64)
    often = np.concatenate([[c.max()], c]) * np.concatenate([c, [c.max()]])
    few = np.lexsort((keys, often))[: len(u) + 2 - shared_at_least(len(u), threshold)]
    return keys[few].view(np.int64), few


def suffix_array(x: np.ndarray) -> np.ndarray:
    """The places of the suffixes of a sequence in lexicographic order, by doubling."""
    rank = np.unique(x, return_inverse=True)[1].astype(np.int64)
    k, n = 1, len(x)
    while True:
        after = np.full(n, -1, np.int64)
        after[: n - k] = rank[k:] if k < n else rank[:0]
        order = np.lexsort((after, rank))
        new = np.concatenate([[False], (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])]).cumsum()
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        k *= 2


def common_prefixes(x: np.ndarray, order: np.ndarray) -> list[int]:
    """The length of the longest common prefix of each suffix in order with the one before it."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    word, at, where = x.tolist(), order.tolist(), place.tolist()
    out, h = [0] * len(word), 0
    for i in range(len(word)):
        if where[i] == 0:
            h = 0
            continue
        j = at[where[i] - 1]
        while i + h < len(word) and j + h < len(word) and word[i + h] == word[j + h]:
            h += 1
        out[where[i]] = h
        h = max(0, h - 1)
    return out


def covered(a: np.ndarray, b: np.ndarray, span: int = SPAN) -> int:
    """How many words of a stand in spans of `span` words or more that b holds too."""
    if len(a) < span or len(b) < span:
        return 0
    # a sign of its own between both texts and one at the end, so that no prefix runs over
    _, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.concatenate([ids[: len(a)], [-2], ids[len(a) :], [-1]])
    order = suffix_array(x)
    prefixes = common_prefixes(x, order)
    longest = [0] * len(a)
    for steps in (range(len(x)), range(len(x) - 1, -1, -1)):  # from the nearest suffix of b before, then after
        best = 0
        for k in steps:
            if steps.step == 1:
                best = min(best, prefixes[k])
            at = int(order[k])
            if at > len(a):
                best = len(x)
            elif at < len(a):
                longest[at] = max(longest[at], best)
            if steps.step == -1:
                best = min(best, prefixes[k])
    words = end = 0
    for i, n in enumerate(longest):
        if n >= span:
            words += i + n - max(end, i)
            end = max(end, i + n)
    return words


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(bucket, n): in how many texts the words of a bucket are."""
    n = np.zeros(BUCKETS, np.int64)
    for b in batches:
        if len(b):
            n += np.bincount((np.concatenate(b["words"].tolist()).view(np.uint64) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(n)
    yield pd.DataFrame({"bucket": at.astype(np.int32), "n": n[at]})


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, kind, class, n, p, q, words, written); the words, sorted, and the text as written only with the first row
    of each class in a partition."""
    seen: set[tuple[int, bool]] = set()
    for b in batches:
        rows = []
        for i, kind, text in zip(b["id"], b["kind"], b["text"]):
            s = sequence(text)
            if not len(s):
                continue
            c = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
            if (c, kind < 0) in seen:
                rows.append((i, kind, c, 0, 0, 0, None, None))
                continue
            seen.add((c, kind < 0))
            u = np.unique(s.view(np.uint64)).view(np.int64)
            rows.append((i, kind, c, len(u), *parity(u), u, s))
        yield pd.DataFrame(rows, columns=["id", "kind", "class", "n", "p", "q", "words", "written"])


def _suffixes(batches: Iterator[pd.DataFrame], counts: np.ndarray, threshold: float, bits: np.ndarray | None) -> Iterator[pd.DataFrame]:
    """One row for each suffix that is needed, with its place and the size and sketch of its record; with `bits`, only
    those whose beginning may be in the map."""
    for b in batches:
        found = [starts(x, counts, threshold) for x in b["words"]]
        empty = np.zeros(0, np.int64)
        keys, at = np.concatenate([empty, *[k for k, _ in found]]), np.concatenate([empty, *[a for _, a in found]]).astype(np.int32)
        owner = np.repeat(np.arange(len(b)), [len(k) for k, _ in found])
        if bits is not None:
            h = (keys.view(np.uint64) >> np.uint64(20)) % np.uint64(BITS)
            ok = np.flatnonzero(bits[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63)) & np.uint64(1))
            keys, at, owner = keys[ok], at[ok], owner[ok]
        yield pd.DataFrame({"key": keys, "at": at} | {c: b[c].to_numpy()[owner] for c in ("class", "n", "p", "q")})


def _map_of(keys: DataFrame) -> np.ndarray:
    """A map of BITS bits of the keys: BITS / 64 rows at most come to the driver."""
    h = F.expr(f"cast(pmod(shiftrightunsigned(key, 20), {BITS}) as int)")
    rows = keys.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, h & 63)")).alias("bits")).toPandas()
    out = np.zeros(BITS // 64, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def overlaps(evaluation: DataFrame, training: DataFrame, eval_key: str, train_key: str, eval_pairs: list[list[str]], train_pair: list[str], threshold: float = 0.8, coverage: bool = True) -> DataFrame:
    """(eval_key, train_key, kind, share, coverage) of all overlapping records.

    `eval_pairs` lists the columns of each version of an evaluation item; kind is the version's number.  coverage is
    the number of words of the evaluation text in spans of SPAN words or more that both texts share; null where it is
    not asked for.
    """
    if threshold < 0.5:
        raise ValueError("the threshold must be 0.5 or more")
    text = lambda columns: F.concat_ws("\n", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    versions = F.array(*[F.struct(F.lit(k).alias("kind"), text(cols).alias("text")) for k, cols in enumerate(eval_pairs)])
    left = evaluation.select(F.col(eval_key).cast("long").alias("id"), F.explode(versions).alias("v")).select("id", "v.kind", "v.text")
    right = training.select(F.col(train_key).cast("long").alias("id"), F.lit(-1).alias("kind"), text(train_pair).alias("text"))
    both = left.union(right).where("id is not null")
    table = cut(both.mapInPandas(_texts, "id long, kind int, class long, n int, p long, q long, words array<long>, written array<long>"), "sequences")
    texts = table.where("words is not null")
    counts = np.zeros(BUCKETS, np.int64)
    for r in texts.select("words").mapInPandas(_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS
        counts[r["bucket"]] = r["n"]
    context = evaluation.sparkSession.sparkContext
    sent = context.broadcast(counts)
    schema = "key long, at int, class long, n int, p long, q long"
    rows = lambda side: texts.where(side).select("class", "n", "p", "q", "words")
    x = cut(rows("kind >= 0").mapInPandas(lambda it: _suffixes(it, sent.value, threshold, None), schema), "suffixes")
    bits = context.broadcast(_map_of(x))
    y = rows("kind < 0").mapInPandas(lambda it: _suffixes(it, sent.value, threshold, bits.value), schema)
    x, y = x.alias("x"), y.alias("y")
    differ = F.expr("bit_count(x.p ^ y.p) + bit_count(x.q ^ y.q)")
    most = (F.col("x.n") + F.col("y.n")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    # words that only one set has: as many as the parts before and after the common beginning differ in size, at least
    apart = F.abs(F.col("x.at") - F.col("y.at")) + F.abs(F.col("x.n") - F.col("x.at") - F.col("y.n") + F.col("y.at"))
    met = x.join(y, F.col("x.key") == F.col("y.key")).where((apart <= most) & (differ <= most))
    pairs = cut(met.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct(), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = cut(texts.select("class", "words", "written").join(ends, "class", "left_semi").groupBy("class").agg(F.first("words").alias("words"), F.first("written").alias("written")), "sets")
    common = F.size(F.array_intersect("wa", "wb"))
    share = common / (F.size("wa") + F.size("wb") - common)
    checked = (
        pairs.join(sets.select(F.col("class").alias("a"), F.col("words").alias("wa"), F.col("written").alias("ta")), "a")
        .join(sets.select(F.col("class").alias("b"), F.col("words").alias("wb"), F.col("written").alias("tb")), "b")
        .select("a", "b", "ta", "tb", share.alias("share")).where(F.col("share") >= threshold)
    )
    checked = checked.mapInPandas(_spans, "a long, b long, share double, coverage int") if coverage else checked.select("a", "b", "share", F.lit(None).cast("int").alias("coverage"))
    checked = cut(checked, "checked")
    members = table.select("id", "kind", "class").distinct()
    return (
        checked.join(members.where("kind >= 0").select(F.col("class").alias("a"), F.col("id").alias(eval_key), "kind"), "a")
        .join(members.where("kind < 0").select(F.col("class").alias("b"), F.col("id").alias(train_key)), "b")
        .select(eval_key, train_key, "kind", "share", "coverage")
    )


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b[["a", "b", "share"]].assign(coverage=np.array([covered(np.asarray(x), np.asarray(y)) for x, y in zip(b["ta"], b["tb"])], np.int32))


def report(found: DataFrame, evaluation: DataFrame, training: DataFrame, eval_key: str, train_key: str, source: str) -> DataFrame:
    """(split, source, items, overlapping, covered_words): by split and source, all records, those with an overlap, and
    the sum of the greatest coverage of each of those."""

    def side(df: DataFrame, key: str, name: str) -> DataFrame:
        hit = found.groupBy(key).agg(F.max("coverage").alias("__covered"))
        sums = df.select(key, source).join(hit, key, "left").groupBy(source)
        return sums.agg(F.count(F.lit(1)).alias("items"), F.count("__covered").alias("overlapping"), F.coalesce(F.sum("__covered"), F.lit(0)).alias("covered_words")).select(F.lit(name).alias("split"), source, "items", "overlapping", "covered_words")

    return side(evaluation, eval_key, "evaluation").union(side(training, train_key, "training"))
