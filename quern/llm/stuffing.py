"""Keyword-stuffed and link-list pages (problem 10).

Each text is cut into blocks of about BLOCK characters, and every block is compressed on its own, with its digits
masked and runs of one sign made short.  Spark takes the quartiles of the ratio over all different blocks of the corpus
by language and length, so that copies don't move them.  A block is redundant where the logarithm of its ratio lies
DEEP robust spreads below the median.  Redundant blocks are confirmed by the density of marks that close sentences: in
prose it keeps within a range; lists of phrases, links and tags have fewer, and phrases made up as sentences have more.
A page is stuffed where confirmed blocks make up MOSTLY of it or more.

Sentences of SENTENCE words or more that are repeated as a whole come once before anything is measured, so that notices
with repeated warnings are no cases; blocks that are mostly signs and digits, such as code and tables of numbers, are
none either.

Defined results: null, empty and blank texts are no cases; repeated rows are judged each; a class of language and length
with fewer than LEAST different blocks goes by the nearest one of the language that has more.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.shared import cut

#: Characters of a block.
BLOCK = 1200
#: A block is redundant this many spreads below the median of the logarithms of ratios; the least spread.
DEEP, SPREAD = 3.5, 0.02
#: A ratio that is redundant in any language, however redundant the rest of the corpus is.
EXTREME = 0.2
#: Different blocks that a class of language and length needs to go by its own ratios.
LEAST = 30
#: Marks that close sentences, by word: prose has neither fewer nor more.  More counts only from MARKS marks on.
FEWEST, GREATEST, MARKS = 0.02, 0.095, 5
#: Words of a block, at least: a run of signs without spaces repeats no phrase.
WORDS = 8
#: Share of letters in the signs of a block, at least.
LETTERS = 0.64
#: Words of a sentence that comes once.
SENTENCE = 6
#: Share of a page's characters in confirmed blocks.
MOSTLY = 0.4

_DIGIT = re.compile(r"\d")
#: Leaders of contents pages and rules of tables, which any text may have.
_RUN = re.compile(r"([^\w\s])\1{2,}")
_UNIT = re.compile(r"(?<=[.!?؟۔।])\s+|\n+")
_CLOSED = re.compile(r"[.!?؟۔।][\"'”»)\]]*\s*$")
_MARK = re.compile(r"[^\W\d_][\"'”»)\]]*[.!?؟۔।]+[\"'”»)\]]*(?=\s|$)|\d[.!?؟۔।]+(?=\s+[^\s\d]*[^\W\d_]|$)")
_NUMBERED = re.compile(r"^\s*\d+[.)]\s", re.M)


def once(text: str) -> str:
    """The lines and sentences of a text; long sentences that are repeated as a whole come once."""
    seen, out = set(), []
    for u in _UNIT.split(text):
        key = u.strip().lower()
        if not key:
            continue
        if key.count(" ") >= SENTENCE - 1 and _CLOSED.search(key):
            if key in seen:
                continue
            seen.add(key)
        out.append(u)
    return "\n".join(out)


def blocks(text: str) -> list[str]:
    """The text in blocks of equal length, of at most BLOCK characters."""
    n = max(1, -(-len(text) // BLOCK))
    size = -(-len(text) // n)
    return [text[i : i + size] for i in range(0, len(text), size)]


def length_class(n: int) -> int:
    """Lengths by powers of the square root of two."""
    return int(2 * (n.bit_length() - 1)) + int(n * n * 2 >= 1 << 2 * n.bit_length()) if n > 0 else 0


def measures(text: str | None) -> list[dict]:
    """What is measured of each block: its language as far as it matters here (one or more bytes for most letters),
    length class, ratio, hash, characters, and whether its marks and letters let it be no prose."""
    if not text or not text.strip():
        return []
    out = []
    for b in blocks(once(text)):
        low = _RUN.sub(r"\1", _DIGIT.sub("0", b.lower()))
        raw = low.encode("utf-8", "replace")
        words, marks = len(b.split()), len(_MARK.findall(_NUMBERED.sub("", b)))
        letters, signs = sum(map(str.isalpha, b)), sum(not c.isspace() for c in b)
        odd = words >= WORDS and marks < FEWEST * words or marks > GREATEST * words and marks >= MARKS
        out.append({"wide": 2 * len(raw) > 3 * len(low), "length": length_class(len(low)), "ratio": len(zlib.compress(raw, 6)) / len(raw), "block": xxhash.xxh3_64_intdigest(raw) - (1 << 63), "chars": len(b), "odd": odd and letters > LETTERS * signs})
    return out


def found(df: DataFrame, key: str, text: str, gate: bool = True) -> DataFrame:
    """(key): the rows whose text is mostly stuffing.

    Texts are read and compressed once, in `measured`; what is measured is cut and judged inside Spark.  The usual
    ratios are one row for each of two languages and some forty lengths, whatever the size of the corpus.  Without
    `gate` every block counts as redundant, to show what the ratio does.
    """
    kind = df.schema[key].dataType.simpleString()

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "blocks": pd.Series([measures(t) if isinstance(t, str) else [] for t in b["t"]], index=b.index, dtype=object)})

    narrow = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    rows = cut(narrow.mapInPandas(measured, f"k {kind}, blocks array<struct<wide:boolean,length:int,ratio:double,block:bigint,chars:int,odd:boolean>>"), "blocks")
    different = rows.select(F.explode("blocks").alias("b")).select("b.*").groupBy("wide", "length", "block").agg(F.first("ratio").alias("ratio"))
    quartiles = different.groupBy("wide", "length").agg(F.percentile_approx("ratio", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias("q"), F.count(F.lit(1)).alias("n"))
    # ratios below these are redundant; at most 2 languages x 64 lengths
    spread = F.greatest(F.lit(SPREAD), (F.log(F.col("q")[2]) - F.log(F.col("q")[0])) / 1.349)
    classes = quartiles.select("wide", "length", "n", F.exp(F.log(F.col("q")[1]) - DEEP * spread).alias("limit")).collect()
    limits = []
    for r in classes:  # a class of few blocks goes by the nearest one that has enough, or else the largest
        own = [x for x in classes if x["wide"] == r["wide"]]
        near = min(own, key=lambda x: (x["n"] < LEAST, abs(x["length"] - r["length"]) if x["n"] >= LEAST else -x["n"], x["length"]))
        limits.append((int(r["length"]) * 2 + int(r["wide"]), max(near["limit"], EXTREME)))
    limit = F.create_map(*[F.lit(x) for pair in limits for x in pair]) if limits else F.lit(None).cast("map<int,double>")
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, b: s + b["chars"])
    redundant = lambda b: b["ratio"] < F.coalesce(limit[b["length"] * 2 + b["wide"].cast("int")], F.lit(0.0)) if gate else F.lit(True)
    stuffed = F.filter("blocks", lambda b: b["odd"] & redundant(b))
    return rows.where((F.size("blocks") > 0) & (total(stuffed) >= MOSTLY * total(F.col("blocks")))).select(F.col("k").alias(key))
