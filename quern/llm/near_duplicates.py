"""Near-duplicate records with small edits (problem 4), by min-max hashing.

Each record becomes the set of its words (see `lookalike.words`).  Under every permutation both the least and the
greatest hash are kept, so that PERMUTATIONS hash passes give 2 * PERMUTATIONS signature values; BANDS bands of ROWS
values each name buckets.  Sets that meet in a bucket are candidates; the exact word share decides.

Copies (equal word sets) are one class: only classes meet in buckets, so a class of a third of all rows costs one
row per input partition.  `similar_classes` gives pairs of classes, `membership` the rows of each, `pairs` expands
both, `groups` gives connected groups.

Chance that a pair of word share j is missed: (1 - j**ROWS)**BANDS, that is 0.02 at 0.7, 0.001 at 0.75 and 8e-6 at
0.8 with the defaults.  Between bucket and exact check stands a lossless test: the parity of the words' hashes in
SKETCH bits differs in at most as many bits as the sets differ in words.

Defined results: a null text counts as empty; records with fewer than `least_words` different words have no class
and are left out of pairs, and are groups of their own in `groups`; rows repeated under one id count once; an empty
table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.lookalike import words
from quern.operators.components import connected_components
from quern.shared import cut

ROWS, BANDS = 8, 64
PERMUTATIONS = ROWS * BANDS // 2
_ODD = np.random.default_rng(4).integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_ADD = np.random.default_rng(5).integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_FOLD = np.random.default_rng(6).integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)
#: Bits of the parity sketch of a set, in words of 64.
SKETCH = 128
#: Words whose hash a Python worker remembers.
_REMEMBERED = 1 << 18
_hashes: dict[str, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hash(word: str) -> int:
    """A 64-bit hash of a word, the same on every machine."""
    h = _hashes.get(word)
    if h is None:
        if len(_hashes) >= _REMEMBERED:
            _hashes.clear()
        h = _hashes[word] = xxhash.xxh3_64_intdigest(word)
    return h


def word_set(text: str) -> np.ndarray:
    """The sorted hashes of the text's words, as signed integers."""
    found = np.fromiter((word_hash(w) for w in words(text)), dtype=np.uint64)
    return np.sort(found.view(np.int64))


def set_hash(hashes: np.ndarray) -> int:
    """A hash of a word set."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The BANDS bucket keys of each set, from the least and the greatest hash under each permutation."""
    if not sets:
        return np.zeros((0, BANDS), np.int64)
    flat = np.concatenate(sets).view(np.uint64)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    values = np.empty((2 * PERMUTATIONS, len(sets)), np.uint32)
    for k in range(PERMUTATIONS):
        x = ((flat * _ODD[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)
        values[2 * k] = np.minimum.reduceat(x, starts)
        values[2 * k + 1] = np.maximum.reduceat(x, starts)
    v = values.reshape(BANDS, ROWS, len(sets)).astype(np.uint64)
    keys = _mix((_mix(v) * _FOLD[None, :, None]).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)[:, None])
    return keys.T.view(np.int64)


def parity(hashes: np.ndarray) -> tuple[int, int]:
    """The parity of each of SKETCH bins of the set."""
    bits = np.bincount((hashes.view(np.uint64) >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return tuple(int(x) for x in np.packbits(bits.astype(np.uint8)).view(np.int64))


def _sets(batches: Iterator[pd.DataFrame], least_words: int) -> Iterator[pd.DataFrame]:
    """(id, class, words); words only with the first row of each class in a partition."""
    seen: set[int] = set()
    for batch in batches:
        ids, classes, found, sketches = [], [], [], []
        for i, text in zip(batch["id"], batch["text"]):
            x = word_set(text)
            if len(x) < max(1, least_words):
                continue
            c = set_hash(x)
            ids.append(i)
            classes.append(c)
            found.append(None if c in seen else x)
            sketches.append(parity(x) if c not in seen else (0, 0))
            seen.add(c)
        p = np.array(sketches, dtype=np.int64).reshape(-1, 2)
        yield pd.DataFrame({"id": pd.Series(ids, dtype="int64"), "class": pd.Series(classes, dtype="int64"), "words": pd.Series(found, dtype=object), "p": p[:, 0], "q": p[:, 1]})


@F.pandas_udf(T.ArrayType(T.LongType()))
def _bands(s: pd.Series) -> pd.Series:
    keys = band_keys([np.asarray(x, np.int64) for x in s])
    return pd.Series(list(keys), index=s.index, dtype=object)


@dataclass
class Similar:
    """Pairs of classes (a < b) with their share, the rows of each class, and the words of each class."""

    classes: DataFrame
    membership: DataFrame


def similar_classes(df: DataFrame, key: str, columns: list[str], threshold: float = 0.8, least_words: int = 1) -> Similar:
    """Classes of records with equal word sets, and all pairs of classes whose word share is at least `threshold`."""
    text = F.concat_ws("\n", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    narrow = df.select(F.col(key).cast("long").alias("id"), text.alias("text")).where("id is not null")
    table = cut(narrow.mapInPandas(lambda it: _sets(it, least_words), "id long, class long, words array<long>, p long, q long"), "sets")
    sets = table.where("words is not null").select("class", "words", "p", "q")
    # one shuffle serves both sides of the join, which AQE splits where a bucket is hot
    buckets = sets.select("class", F.explode(_bands("words")).alias("bucket"))
    pairs = (
        buckets.alias("x").join(buckets.alias("y"), F.expr("x.bucket = y.bucket and x.class < y.class"))
        .select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()
    )
    sketch = sets.select("class", F.size("words").alias("n"), "p", "q").distinct()
    side = lambda s: sketch.select(*[F.col(c).alias(s if c == "class" else f"{c}{s}") for c in sketch.columns])
    differ = F.bit_count(F.col("pa").bitwiseXOR(F.col("pb"))) + F.bit_count(F.col("qa").bitwiseXOR(F.col("qb")))
    near = differ <= (F.col("na") + F.col("nb")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    pairs = cut(pairs.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b"), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    one = sets.select("class", "words").join(ends, "class", "left_semi").groupBy("class").agg(F.first("words").alias("words"))
    one = cut(one, "candidates")
    common = F.size(F.array_intersect("wa", "wb"))
    share = common / (F.size("wa") + F.size("wb") - common)
    checked = (
        pairs.join(one.select(F.col("class").alias("a"), F.col("words").alias("wa")), "a")
        .join(one.select(F.col("class").alias("b"), F.col("words").alias("wb")), "b")
        .select("a", "b", share.alias("share")).where(F.col("share") >= threshold)
    )
    return Similar(cut(checked, "similar"), table.select("id", "class").distinct())


def pairs(similar: Similar) -> DataFrame:
    """(a, b), a < b: every pair of rows, within a class and across similar classes."""
    m = similar.membership
    x, y = m.alias("x"), m.alias("y")
    within = x.join(y, F.expr("x.class = y.class and x.id < y.id")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    c = similar.classes
    left = c.join(m.select(F.col("class").alias("a"), F.col("id").alias("i")), "a")
    both = left.join(m.select(F.col("class").alias("b"), F.col("id").alias("j")), "b")
    return within.union(both.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")))


def groups(df: DataFrame, key: str, similar: Similar) -> DataFrame:
    """(key, group, size): every row with its group, named by its least row id, and the group's size."""
    ids = df.select(F.col(key).cast("long").alias("id")).where("id is not null").distinct()
    m = similar.membership
    linked = connected_components(similar.classes)
    component = m.join(linked.withColumnsRenamed({"node": "class"}), "class", "left").select("id", F.coalesce("component", "class").alias("component"))
    named = component.groupBy("component").agg(F.min("id").alias("group"), F.count(F.lit(1)).alias("size"))
    placed = component.join(named, "component").select("id", "group", "size")
    return ids.join(placed, "id", "left").select(F.col("id").alias(key), F.coalesce("group", "id").alias("group_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"))
