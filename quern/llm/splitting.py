"""Splitting oversized items at natural boundaries (problem 1), by structure-tree packing.

A text is parsed into a tree: sections under headings by level, blocks between blank lines (fences and tables stay
whole), lines, sentences, words and, for runs without any boundary, grapheme clusters.  Sibling subtrees are merged
from the left while they stay under the limit; only nodes over the limit are opened.  The leaves of the packing cover
the text without gaps; each piece but the first starts with an overlap from the end of the one before it, cut at a
sentence or word start.

Defined results: null gives no piece; the empty text gives one empty piece; a text under the limit is one piece, equal
to the text; repeated rows give their pieces each.  Dropping the first `overlap_chars` of every piece and joining the
rest gives the text back.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP, CHARS = 800, 50, 3.5
_HEADING = re.compile(r"^[ ]{0,3}(?:(#{1,6})[ \t]+\S|<h([1-6])\b|(={2,6})[^=\n]+={2,6}[ \t]*$|\\(chapter|section|subsection|subsubsection)\b)", re.M)
_LATEX = {"chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4}
_WHOLE = re.compile(r"^[ ]{0,3}(```|~~~).*?(?:^[ ]{0,3}\1[^\n]*$|\Z)|<table\b.*?(?:</table>|\Z)|^\{\|.*?(?:^\|\}|\Z)|\\begin\{(\w+\*?)\}.*?(?:\\end\{\2\}|\Z)", re.S | re.M | re.I)
_BLANK = re.compile(r"\n[ \t]*\n\s*")
_ROW = re.compile(r"</tr>\s*|</li>\s*|</p>\s*")
_LINE = re.compile(r"\n+")
_SENTENCE = re.compile(r"[.!?؟۔।][\"'”»)\]]*\s+|[;؛]\s+")
_CLAUSE = re.compile(r"[,،:]\s+")
_SPACE = re.compile(r"\s+")
_CLUSTER = regex.compile(r"\X")

Span = tuple[int, int]


def tokens(n: int) -> int:
    """Tokens of n code points."""
    return int(n / CHARS)


def most_chars(limit: int) -> int:
    """The greatest number of code points of at most `limit` tokens."""
    n = int((limit + 1) * CHARS)
    return n - 1 if n >= (limit + 1) * CHARS else n


def _sections(text: str, a: int, b: int, level: int) -> list[Span]:
    """The part before the first heading of the level, and the section of each."""
    heads = [m.start() for m in _HEADING.finditer(text, a, b) if _level(m) == level and m.start() > a]
    if heads:  # a line of code that looks like a heading opens no section
        whole = [m.span() for m in _WHOLE.finditer(text, a, b)]
        ends = [y for _, y in whole]
        heads = [h for h in heads if (k := bisect_right(ends, h)) == len(whole) or h < whole[k][0]]
    return _between(a, b, heads)


def _level(m: re.Match) -> int:
    return len(m[1]) if m[1] else int(m[2]) if m[2] else len(m[3]) if m[3] else _LATEX[m[4]]


def _between(a: int, b: int, cuts: list[int]) -> list[Span]:
    ends = [a, *cuts, b]
    return [(x, y) for x, y in zip(ends, ends[1:]) if x < y]


def _blocks(text: str, a: int, b: int) -> list[Span]:
    """Blocks between blank lines; fences, tables and environments are not cut inside, and stand alone."""
    whole = [m.span() for m in _WHOLE.finditer(text, a, b)]
    cuts = {p for s in whole for p in s if a < p < b}
    ends = [y for _, y in whole]
    for m in _BLANK.finditer(text, a, b):
        k = bisect_right(ends, m.end())
        if a < m.end() < b and (k == len(whole) or m.end() <= whole[k][0]):
            cuts.add(m.end())
    return _between(a, b, sorted(cuts))


def _after(pattern: re.Pattern, text: str, a: int, b: int) -> list[Span]:
    return _between(a, b, [m.end() for m in pattern.finditer(text, a, b) if a < m.end() < b])


#: The children of a node, from the coarsest kind to the finest.
_KINDS = [*[lambda t, a, b, k=k: _sections(t, a, b, k) for k in range(1, 7)], _blocks, *[lambda t, a, b, p=p: _after(p, t, a, b) for p in (_ROW, _LINE, _SENTENCE, _CLAUSE, _SPACE, _CLUSTER)]]


def _pack(text: str, a: int, b: int, limit: int, kind: int = 0) -> list[Span]:
    """The spans of a node under the limit, siblings merged."""
    if b - a <= limit:
        return [(a, b)]
    if kind == len(_KINDS):  # one cluster over the limit
        return [(i, min(i + limit, b)) for i in range(a, b, limit)]
    spans: list[Span] = []
    for x, y in _KINDS[kind](text, a, b):
        opened = y - x > limit
        for s in _pack(text, x, y, limit, kind + 1) if opened else [(x, y)]:
            if spans and s[1] - spans[-1][0] <= limit:
                spans[-1] = (spans[-1][0], s[1])
            else:
                spans.append(s)
    return spans


def _overlap(text: str, a: int, b: int, most: int) -> int:
    """Where the overlap from the span (a, b) begins: at a sentence, else a word, within `most` code points."""
    lo = max(a, b - most)
    if lo == a:
        return a if b - a <= most else b
    for pattern in (_SENTENCE, _LINE, _SPACE):
        for m in pattern.finditer(text, max(a, lo - 1), b):
            if lo <= m.end() < b:
                return m.end()
    return b


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end, overlap) of each piece: it holds text[start:end], of which the first `overlap` repeat."""
    most = most_chars(limit)
    if len(text) <= most:
        return [(0, len(text), 0)]
    shared = min(most_chars(overlap), most // 2) if overlap > 0 else 0
    spans = _pack(text, 0, len(text), most - shared)
    out = [(*spans[0], 0)]
    for (pa, pb), (a, b) in zip(spans, spans[1:]):
        start = _overlap(text, pa, pb, shared) if shared else a
        out.append((start, b, a - start))
    return out


def measured(text: Column) -> Column:
    """Tokens of a text."""
    return F.floor(F.length(text) / F.lit(CHARS)).cast("int")


def split(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """`df` with one row a piece: the text column holds the piece, `token_count` and `is_oversized` are measured anew on
    the piece (so none is over the limit), `was_oversized` tells whether the whole text was, and `piece_index`,
    `piece_start` (code points) and `overlap_chars` are added.

    Texts under the limit don't leave the JVM.
    """
    added = {"token_count", "is_oversized", "was_oversized", "piece_index", "piece_start", "overlap_chars"}
    rest = [c for c in df.columns if c not in added | {text}]
    rows = df.where(F.col(text).isNotNull()).withColumn("__tokens", measured(F.col(text)))
    small = rows.where(F.col("__tokens") <= limit).select(*rest, F.col(text), F.col("__tokens").alias("token_count"), F.lit(False).alias("is_oversized"), F.lit(False).alias("was_oversized"), F.lit(0).alias("piece_index"), F.lit(0).alias("piece_start"), F.lit(0).alias("overlap_chars"))

    @F.pandas_udf("array<struct<piece:string,token_count:int,piece_index:int,piece_start:int,overlap_chars:int>>")
    def cut_up(s: pd.Series) -> pd.Series:
        return pd.Series([[{"piece": t[a:b], "token_count": tokens(b - a), "piece_index": i, "piece_start": a, "overlap_chars": o} for i, (a, b, o) in enumerate(pieces(t, limit, overlap))] for t in s], index=s.index, dtype=object)

    large = rows.where(F.col("__tokens") > limit).select(*rest, F.explode(cut_up(F.col(text))).alias("__p")).select(*rest, F.col("__p.piece").alias(text), "__p.token_count", (F.col("__p.token_count") > limit).alias("is_oversized"), F.lit(True).alias("was_oversized"), "__p.piece_index", "__p.piece_start", "__p.overlap_chars")
    return small.unionByName(large)
