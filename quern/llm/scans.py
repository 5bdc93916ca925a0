"""Noise in text from scanned pages (problem 6).

Lines of each different text are classified: a running header has the skeleton of the title its source file is named
after, or is a short line that, with its digits masked, returns in the file beside changing page numbers; a page number
stands alone or beside a header.  Of the remaining lines, words broken over a line end are found, and all words are
counted inside each task before they are shuffled, so that only sums by word meet.  Spark groups the words by the
skeleton of their confusable glyphs over the whole corpus: a rare form gives way to a form at least RATIO times as
frequent that the words after it support.  Only the few words that may be misread are then looked up in the texts
again: a bitmap of fixed size tells them apart, and an exact join follows.  Reflow runs in SQL windows.

Words count once for each different text, so that copies of a scan don't make its misread words frequent.

Defined results: null and empty texts have no noise and stay as they are, and so does, byte by byte, every text without
noise; equal rows count once in `noise` and come back each in `repaired`; a null source file has no title, so only
repeated lines are its headers.  Code fences, tables, formulas and environments of a noisy text keep their lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.shared import cut

#: A form gives way to one this many times as frequent.
RATIO = 10
#: Share of a misread form's following words that also follow the frequent form, at least.
FIT = 0.3
#: A line beside page numbers is a header where it returns this often in a file.
REPEATS = 5
#: Bits of the map that tells words that may be misread, and their forms, from the others; the join after it is exact.
BITS = 1 << 23
#: Different words or pairs of words that a task holds before it hands their sums on.
HELD = 400_000
# Glyphs that scans confuse, by script; digraphs come after single glyphs.
LATIN_GLYPHS = ("1!|i0@59et6", "lllloasgcfb")
LATIN_DIGRAPHS = (("rl", "n"), ("ll", "h"), ("cl", "d"), ("rn", "m"))
#: Three strokes may be a glyph and a digraph either way; the second order reads the other way.
LATIN_DIGRAPHS_2 = (("cl", "d"), ("rl", "n"), ("ll", "h"), ("rn", "m"))
ARABIC_GLYPHS = ("1|١٣9٤٥", "لااموعه")
_MARK = "[-‐­¬]"
_DIGIT = "[0-9٠-٩۰-۹]"
_EDGE = "[\\s‎‏]"
_PAGE = re.compile(
    rf"{_EDGE}*(?:[—–-]+\s*)?[\[(]?\s*(?:(?:p[a@][g9][ec]|pp?\.|[ص][ف]?[ح]?[ةه]?|ص٥حة|seite)\s*)?{_DIGIT}{{1,4}}\s*"
    rf"(?:(?:/|of|o[ft]|من)\s*{_DIGIT}{{1,4}})?\s*[\])]?(?:\s*[—–-]+)?\s*\Z", re.I | re.A
)
_HEAD = re.compile(
    rf"{_EDGE}*(?:({_DIGIT}{{1,4}})\s*[|·—–-]\s*)?(\S.*?)(?:\s*[—–-]\s*\S+\s+\S{{1,4}}?)?"
    rf"(?:\s*[|·—–-]\s*({_DIGIT}{{1,4}})|({_DIGIT}{{1,4}}))?\s*\Z", re.A
)
_LINES = re.compile(r"\r?\n")
_DIGITS = re.compile(f"{_DIGIT}+")
_SIGNS = re.compile(r"(?:[^\w!@|]|_)+")
_LEFT = re.compile(r"^(?:[^\w!@|]|_)+|(?:[^\w@|]|_)+$")
_ENDED = re.compile(r"[.؟?!،,:;؛]$")
_NO_HEADER = re.compile(r"[<>&\\=\[\]{}$]|^\s*[|#*+-]")
_BROKEN = re.compile(rf"[^\W\d_]{_MARK}$")
_GOES_ON = re.compile(r"\s*[@!|$0-9١٣٤٥]*[^\W\d_]")
_HEADWORD = re.compile(rf"(\S*){_MARK}\s*$")
_ARABIC = re.compile("[ء-ي]")
_LATIN_MAP, _ARABIC_MAP = str.maketrans(*LATIN_GLYPHS), str.maketrans(*ARABIC_GLYPHS)


def skeleton(word: Column, digraphs: tuple = LATIN_DIGRAPHS) -> Column:
    """A word with confusable glyphs made one, by the script of its letters."""
    low = F.lower(word)
    latin = F.translate(low, *LATIN_GLYPHS)
    for pair, one in digraphs:
        latin = F.replace(latin, F.lit(pair), F.lit(one))
    return F.when(low.rlike("[ء-ي]"), F.translate(low, *ARABIC_GLYPHS)).otherwise(latin)


def skeleton_of(word: str) -> str:
    """The same of a string."""
    low = word.lower()
    if _ARABIC.search(low):
        return low.translate(_ARABIC_MAP)
    low = low.translate(_LATIN_MAP)
    for pair, one in LATIN_DIGRAPHS:
        low = low.replace(pair, one)
    return low


def _plain(text: str) -> str:
    """The skeleton of a whole line, without spaces and signs other than confusable ones."""
    return skeleton_of(_SIGNS.sub("", text))


def title(source_file: str | None) -> str:
    """The skeleton of the title a source file is named after: no extension, no trailing number, spaces for joiners."""
    if not source_file:
        return ""
    bare = re.sub(r"\.[A-Za-z0-9]{1,5}$", "", source_file)
    return _plain(re.sub("[_-]+", " ", re.sub(r"[\s_-]+\d{3,}$", "", bare)))


def _short(line: str) -> bool:
    """Whether a line may be a header: neither long nor closed by a sign."""
    return 4 <= len(line.strip(" ")) and len(line) <= 160 and not _ENDED.search(line.rstrip(" "))


def masked(line: str) -> tuple[str, str] | None:
    """(the line with its digits masked, its page number) of a line beside a page number, else None."""
    if not _short(line) or _NO_HEADER.search(line):
        return None
    lead, core, tail, glued = _parts(line)
    if not (lead or tail) or not re.search(r"[^\W\d_]{2}", core):
        return None
    return _DIGITS.sub("#", core.lower()), f"{lead}|{tail}|{glued}"


def _parts(line: str) -> tuple[str, str, str, str]:
    m = _HEAD.match(line)
    return tuple(x or "" for x in m.groups()) if m else ("", "", "", "")


def classified(lines: list[str], name: str, often: frozenset[int] = frozenset()) -> list[tuple[int, bool, bool]]:
    """(place, titled header, page) of each line that is a header or a page number.

    name: the skeleton of the file's title; often: the places of the lines that return in the file.
    """
    out = []
    n = len(name)
    for i, line in enumerate(lines):
        if len(line) > 160 or not line:
            continue
        digits = _DIGITS.search(line)
        if digits and len(line) <= 60 and _PAGE.match(line):
            out.append((i, False, True))
            continue
        headed = i in often
        titled = beside = glued_title = False
        if headed or n >= 6 and len(line) >= n and _short(line):
            # a first look at the letters alone, without the ends, which signs beside them may change
            if headed or name[3:-3] in _plain(line):
                lead, core, tail, glued = _parts(line)
                beside = bool(lead or tail or glued)
                glued_title = bool(glued) and _plain(core + glued) == name
                titled = n >= 6 and _short(line) and (_plain(core) == name or glued_title)
        if titled or headed:
            out.append((i, titled, beside and not glued_title))
    return out


def _clean(raw: str) -> str:
    return _LEFT.sub("", raw)


class _Words(dict):
    """Raw words to clean ones, remembered within bounds."""

    def __missing__(self, raw: str) -> str:
        if len(self) >= HELD:
            self.clear()
        x = self[raw] = raw if raw.isalnum() else _clean(raw)
        return x


def bodies(lines: list[str], gone: set[int]) -> tuple[list[str], list[tuple[int, bool, str, str]]]:
    """(lines without headers and page numbers, with broken words joined at the end of their first line; the breaks).

    A break is (place, soft, joined word, word with its hyphen).
    """
    kept = [(i, x) for i, x in enumerate(lines) if i not in gone and x.strip(" ")]
    out, breaks, before = [], [], False
    for k, (i, line) in enumerate(kept):
        body, trimmed = line, line.rstrip(" ")
        broken = False
        if trimmed[-1:] in "-‐­¬" and _BROKEN.search(trimmed) and k + 1 < len(kept) and not re.match(r"\s*[-|]", line) and _GOES_ON.match(kept[k + 1][1]):
            broken = True
        if before:
            body = re.sub(r"^\s*\S+", "", body)
        if broken:
            head = m[1] if (m := _HEADWORD.search(line)) else ""
            rest = (kept[k + 1][1].split(None, 1) or [""])[0]
            body = f"{_HEADWORD.sub('', body)} {head}{rest}"
            breaks.append((i, trimmed[-1] != "-", _clean((head + rest).lower()), _clean(f"{head}-{rest}".lower())))
        out.append(body)
        before = broken
    return out, breaks


class _Text:
    """One text of a batch: its classified lines, and its words by line."""

    def __init__(self, text: str, host: str | None, often, titles: dict, words: _Words) -> None:
        if host not in titles:
            if len(titles) > 10_000:
                titles.clear()
            titles[host] = title(host)
        lines = _LINES.split(text)
        self.special = classified(lines, titles[host], frozenset(often) if often is not None else frozenset())
        body, self.breaks = bodies(lines, {i for i, _, _ in self.special})
        self.words = [[y for y in (words[x] for x in line.lower().split()) if y] for line in body]


def _first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """kind 0: a word with its count in the task; 1: a header or page line; 2: a broken word."""
    titles, words, counts = {}, _Words(), Counter()
    names = ["kind", "row", "pos", "a", "b", "n"]

    def sums() -> pd.DataFrame:
        out = pd.DataFrame({"kind": 0, "row": 0, "pos": 0, "a": pd.Series([*counts], dtype=object), "b": pd.Series([None] * len(counts), dtype=object), "n": np.fromiter(counts.values(), np.int64, len(counts))})
        counts.clear()
        return out

    for b in batches:
        rows = []
        for row, text, host, often, first in zip(b["row"], b["text"], b["host"], b["often"], b["first"]):
            t = _Text(text, host, often, titles, words)
            rows += [(1, row, i, None, None, int(titled) + 2 * int(page)) for i, titled, page in t.special]
            rows += [(2, row, i, joined, compound, int(soft)) for i, soft, joined, compound in t.breaks]
            if first:
                for w in t.words:
                    counts.update(w)
        if len(counts) >= HELD:
            yield sums()
        yield pd.DataFrame(rows, columns=names).astype({"a": object, "b": object, "n": "int64", "row": "int64", "pos": "int64", "kind": "int64"})
    yield sums()


def _second_pass(batches: Iterator[pd.DataFrame], tokens: np.ndarray, pairs: np.ndarray, support: bool) -> Iterator[pd.DataFrame]:
    """kind 0: a word that may be misread, with the word before it; 1: a word of letters and the skeleton of the word
    after it, with their count in the task; 2, where `support` is asked for: the word before a form, and the form."""
    titles, words, known = {}, _Words(), {}
    after, before = Counter(), Counter()

    def marks(w: str) -> int:
        """1: may be misread; 2: a form, or a word of letters that may be misread."""
        m = known.get(w)
        if m is None:
            if len(known) >= HELD:
                known.clear()
            h = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), 42) % BITS
            m = known[w] = int(tokens[h >> 6] >> np.uint64(h & 63) & np.uint64(1)) + 2 * int(pairs[h >> 6] >> np.uint64(h & 63) & np.uint64(1))
        return m

    def sums() -> pd.DataFrame:
        keys = [(1, *k) for k in after] + [(2, *k) for k in before]
        out = pd.DataFrame(keys, columns=["kind", "a", "b"]).assign(row=0, n=[*after.values(), *before.values()]).astype({"kind": "int64", "a": object, "b": object, "n": "int64"})
        after.clear()
        before.clear()
        return out[["kind", "row", "a", "b", "n"]]

    mask = lambda w: _DIGITS.sub("0", w)
    for b in batches:
        rows = []
        for row, text, host, often, first in zip(b["row"], b["text"], b["host"], b["often"], b["first"]):
            hits = {}
            for line in _Text(text, host, often, titles, words).words:
                for k, w in enumerate(line):
                    m = marks(w)
                    if not m:
                        continue
                    if m & 1:
                        hits[w, mask(line[k - 1]) if k else None] = None
                    if m & 2 and first:
                        if k + 1 < len(line):
                            after[w, skeleton_of(mask(line[k + 1]))] += 1
                        if support and k:
                            before[mask(line[k - 1]), w] += 1
            rows += [(0, row, *h, 1) for h in hits]
        if len(after) + len(before) >= HELD:
            yield sums()
        yield pd.DataFrame(rows, columns=["kind", "row", "a", "b", "n"]).astype({"kind": "int64", "row": "int64", "a": object, "b": object, "n": "int64"})
    yield sums()


def _bitmap(words: DataFrame) -> np.ndarray:
    """The bits of a column of words, as BITS / 64 numbers at most."""
    h = F.pmod(F.xxhash64("word"), F.lit(BITS))
    rows = words.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")).collect()
    out = np.zeros(BITS // 64, np.int64)
    for r in rows:
        out[r["at"]] = r["bits"]
    return out.view(np.uint64)


def _candidates(counts: DataFrame) -> DataFrame:
    """(token, form, form_n): each rare token with the frequent forms of its skeleton."""
    counts = counts.where(F.col("token").rlike(r"\p{L}") & (F.length("token") >= 2))
    counts = counts.select("token", "n", F.explode(F.array_distinct(F.array(skeleton(F.col("token")), F.concat(F.lit("2"), skeleton(F.col("token"), LATIN_DIGRAPHS_2))))).alias("skeleton"))
    forms = counts.where(F.col("token").rlike(r"^\p{L}[\p{L}'’-]*\p{L}$") & (F.col("n") >= 5))
    # forms that no other form of the skeleton outnumbers by far
    best = forms.groupBy("skeleton").agg(F.max("n").alias("most"))
    frequent = forms.join(best, "skeleton").where(F.col("n") * RATIO > F.col("most")).select("skeleton", "most", F.col("token").alias("form"), F.col("n").alias("form_n"))
    return counts.join(frequent, "skeleton").where((F.col("n") * RATIO <= F.col("most")) & (F.col("token") != F.col("form"))).select("token", "form", "form_n").distinct()


def _supported(found: DataFrame, after: DataFrame) -> DataFrame:
    """The candidates but those of letters alone whose next words do not stand after the form: they may be words."""
    own = found.where(F.col("token").rlike(r"^\p{L}+$")).join(after, "token")
    known = after.select(F.col("token").alias("form"), "after", F.lit(1).alias("known"))
    fits = own.join(known, ["form", "after"], "left").groupBy("token", "form").agg(((F.sum(F.coalesce("known", F.lit(0)) * F.col("n")) + 1) / (F.sum("n") + 1)).alias("fit"))
    return found.join(fits, ["token", "form"], "left").where((F.coalesce("fit", F.lit(1.0)) >= FIT)).select("token", "form", "form_n")


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines of each text that may be headers beside a page number."""
    for b in batches:
        rows = [(row, host, i, *m) for row, host, t in zip(b["row"], b["host"], b["text"]) for i, x in enumerate(_LINES.split(t)) if _DIGITS.search(x) and (m := masked(x))]
        yield pd.DataFrame(rows, columns=["row", "host", "pos", "masked", "number"]).astype({"row": "int64", "pos": "int32", "host": object, "masked": object, "number": object})


class Scans:
    """The noise of a table, and its repair; the different texts are cut once for all passes."""

    def __init__(self, df: DataFrame, key: str, text: str, host: str, support: bool = False) -> None:
        self.df, self.key, self.text, self.host = df, key, text, host
        spark = df.sparkSession
        # copies are one row before they are shuffled
        texts = df.select(F.col(text).alias("text"), F.col(host).alias("host")).where("text <> ''").distinct()
        texts = cut(texts.select(F.xxhash64("text", "host").alias("row"), F.xxhash64("text").alias("same"), "text", "host"), "texts")
        # lines that return beside page numbers in a file: their places, a few for each text that has any
        near_number = rf"[|·—–-]\s*{_DIGIT}{{1,4}}\s*(?:\n|\r|$)|(?:^|\n)\s*{_DIGIT}{{1,4}}\s*[|·—–-]"
        lines = texts.where(F.col("text").rlike(near_number)).select("row", "host", "text").mapInPandas(_headers, "row long, host string, pos int, masked string, number string")
        lines = cut(lines, "headers")
        often = lines.groupBy("host", "masked").agg(F.countDistinct("number").alias("n")).where(F.col("n") >= REPEATS).select(F.col("host").alias("h"), F.col("masked").alias("m"))
        found = lines.join(often, F.col("host").eqNullSafe(F.col("h")) & (F.col("masked") == F.col("m"))).groupBy("row").agg(F.collect_set("pos").alias("often"))
        found = cut(found.withColumnRenamed("row", "r"), "often")
        # of one text in several files, one counts
        again = cut(texts.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("least")).where("n > 1").select(F.col("same").alias("s"), "least"), "again")
        self.texts = texts.join(found, F.col("row") == F.col("r"), "left").join(again, F.col("same") == F.col("s"), "left")
        self.texts = self.texts.select("row", "text", "host", "often", (F.coalesce("least", "row") == F.col("row")).alias("first"))
        one = cut(self.texts.mapInPandas(_first_pass, "kind long, row long, pos long, a string, b string, n long"), "lines")
        self.special = one.where("kind = 1").select("row", F.col("pos").cast("int").alias("pos"), (F.col("n") % 2 == 1).alias("titled"), (F.col("n") >= 2).alias("page"))
        counts = cut(one.where("kind = 0").groupBy(F.col("a").alias("token")).agg(F.sum("n").alias("n")), "counts")
        # a plain hyphen may belong to a compound: whichever form is more frequent elsewhere decides
        ends = one.where("kind = 2").select("row", F.col("pos").cast("int").alias("pos"), (F.col("n") == 1).alias("soft"), F.col("a").alias("joined"), F.col("b").alias("compound"))
        hard = ends.where("not soft").join(counts.select(F.col("token").alias("joined"), F.col("n").alias("nj")), "joined", "left").join(counts.select(F.col("token").alias("compound"), F.col("n").alias("nc")), "compound", "left")
        self.ends = cut(hard.select("row", "pos", (F.coalesce("nc", F.lit(0)) <= F.coalesce("nj", F.lit(0))).alias("broken")).union(ends.where("soft").select("row", "pos", F.lit(True))), "ends")
        candidates = cut(_candidates(counts), "candidates")
        tokens = _bitmap(candidates.select(F.col("token").alias("word")))
        pairs = _bitmap(candidates.where(F.lit(support) | F.col("token").rlike(r"^\p{L}+$")).select(F.explode(F.array("token", "form")).alias("word")))
        sent = spark.sparkContext.broadcast((tokens, pairs))
        two = cut(self.texts.mapInPandas(lambda it: _second_pass(it, *sent.value, support), "kind long, row long, a string, b string, n long"), "words")
        after = cut(two.where("kind = 1").groupBy(F.col("a").alias("token"), F.col("b").alias("after")).agg(F.sum("n").alias("n")), "after")
        self.misread = cut(_supported(candidates, after), "misread")
        self.hits = two.where("kind = 0").select("row", F.col("a").alias("token"), F.col("b").alias("before"))
        self.support = two.where("kind = 2").groupBy(F.col("a").alias("before"), F.col("b").alias("form")).agg(F.sum("n").alias("support"))

    def _rows(self) -> DataFrame:
        """(row, noise), each once."""
        kind = lambda rows, name: rows.select("row", F.lit(name).alias("noise"))
        words = self.hits.join(self.misread.select("token").distinct(), "token", "left_semi")
        return kind(self.special.where("titled"), "running_header").union(kind(self.special.where("page"), "page_number")).union(kind(self.ends.where("broken"), "hyphenation")).union(kind(words, "misread")).distinct()

    def noise(self) -> DataFrame:
        """(key, noise), each once."""
        rows = self.df.where(F.col(self.text) != "").select(F.col(self.key).alias("k"), F.xxhash64(self.text, self.host).alias("row"))
        return rows.join(self._rows(), "row").select(F.col("k").alias(self.key), "noise").distinct()

    def repaired(self) -> DataFrame:
        """`df` with `repaired_text`: no headers and page numbers, words whole and as read, paragraphs continuous.

        Only noisy texts are reflowed, and of these only lines of prose that break off inside a sentence or where the
        next word had no room.
        """
        hits = self.hits.join(self.misread, "token").select("row", "token", "before", "form", "form_n")
        chosen = hits.join(self.support, ["before", "form"], "left").groupBy("row", "token").agg(F.max_by("form", F.struct(F.coalesce("support", F.lit(0)), "form_n", "form")).alias("form"))
        repairs = chosen.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("token", "form"))).alias("repairs"))
        noisy = self._rows().select("row").union(self.special.select("row")).distinct()
        lines = self.texts.join(noisy, "row", "left_semi").select("row", F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line"))
        lines = lines.join(self.special.select("row", "pos", F.lit(True).alias("gone")), ["row", "pos"], "left").join(self.ends, ["row", "pos"], "left")
        flat = _reflowed(lines).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "gap", "piece", "fixed"))).alias("pieces"))
        fixed = flat.join(repairs, "row", "left").select(F.col("row").alias("__row"), _repair("pieces", "repairs").alias("__repaired"))
        names = [c for c in self.df.columns if c != "repaired_text"]
        rows = self.df.withColumn("__row", F.xxhash64(self.text, self.host))
        done = rows.join(fixed, "__row", "left")
        return done.select(*names, F.when(F.col(self.text).isNull(), None).otherwise(F.coalesce("__repaired", self.text)).alias("repaired_text"))


def _reflowed(lines: DataFrame) -> DataFrame:
    """(row, pos, gap, piece, fixed) of the lines that stay: what goes before each, and whether its words are fixed."""
    w = W.partitionBy("row").orderBy("pos")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    line = F.col("line")
    count = lambda p: F.regexp_count(line, F.lit(p))
    fence = line.rlike(r"^\s*(?:```|~~~)").cast("int")
    opens, closes = count(r"(?i)<(?:table|pre|code|ul|ol|dl)\b|\\begin\{|^\s*\{\||\\\[(?!\])"), count(r"(?i)</(?:table|pre|code|ul|ol|dl)>|\\end\{|^\s*\|\}|\\\]")
    out = lines.withColumns({"f": fence, "o": opens, "c": closes, "d": count(r"\$\$")})
    out = out.withColumns({"fs": F.sum("f").over(upto), "depth": F.sum(F.col("o") - F.col("c")).over(upto), "ds": F.sum("d").over(upto)})
    inside = (F.col("f") > 0) | (F.col("fs") % 2 == 1) | (F.col("depth") > 0) | (F.col("o") + F.col("c") > 0) | (F.col("ds") % 2 == 1) | (F.col("d") > 0)
    out = out.withColumn("fixed", inside)
    out = out.where(~F.coalesce("gone", F.lit(False)) | F.col("fixed"))
    out = out.withColumns({"n": F.row_number().over(w), "blank": F.trim(F.regexp_replace("line", r"[\t\x{00a0}]", " ")) == ""})
    prose = ~F.col("fixed") & ~line.rlike(r"^\s*(?:[|<#>\\]|[-*+•]\s|[0-9٠-٩]{1,3}[.)]\s|!\[|={2,}|-{3,})|\|\s*$")
    out = out.where(~F.col("blank") | F.col("fixed")).withColumns({"prose": prose, "chars": F.length(F.rtrim("line"))})
    width = F.max(F.when(F.col("prose"), F.col("chars"))).over(W.partitionBy("row"))
    lag = lambda c: F.lag(c).over(w)
    out = out.withColumns({"width": width, "p_prose": lag("prose"), "p_fixed": lag("fixed"), "p_chars": lag("chars"), "p_line": lag(F.rtrim("line")), "p_n": lag("n"), "p_pos": lag("pos"), "p_broken": lag("broken")})
    blanks = F.col("n") - F.col("p_n") - 1
    removed = (F.col("pos") - F.col("p_pos") - 1) - blanks > 0
    ended = F.col("p_line").rlike(r"[.!?؟۔:][\"'”»)\]]*$")
    first = F.length(F.regexp_extract("line", r"^\s*(\S*)", 1))
    full = F.col("p_chars") + 1 + first > F.col("width")
    goes_on = ~ended & ((F.col("p_chars") >= 30) | line.rlike(r"^\s*\p{Ll}"))
    wrapped = F.col("prose") & F.col("p_prose") & F.when(blanks == 0, full | goes_on).otherwise(removed & goes_on)
    whole = F.col("p_broken").isNotNull() & ~F.col("fixed") & ~F.col("p_fixed")
    gap = F.when(F.col("p_n").isNull(), "").when(whole, "").when(wrapped, " ").otherwise(F.repeat(F.lit("\n"), (F.when(removed, F.least(blanks, F.lit(1))).otherwise(blanks) + 1).cast("int")))
    piece = F.when(F.col("broken") & ~F.col("fixed"), F.regexp_replace(F.rtrim("line"), f"{_MARK}$", "")).when(F.col("fixed"), line).otherwise(F.rtrim("line"))
    piece = F.when(gap.isin("", " ") & F.col("p_n").isNotNull(), F.ltrim(piece)).otherwise(piece)
    return out.select("row", "pos", gap.alias("gap"), piece.alias("piece"), "fixed")


@F.pandas_udf(T.StringType())
def _repair(pieces: pd.Series, repairs: pd.Series) -> pd.Series:
    """The pieces of a text as one, with misread words of its prose as they should read."""
    edges = re.compile(r"^([^\w!@|]*)(.*?)([^\w@|]*)$", re.S)

    def one(parts, r):
        r = dict(r) if r else {}

        def fix(m):
            a, w, z = edges.match(m[0]).groups()
            form = r.get(w.lower())
            return m[0] if form is None else a + (form[:1].upper() + form[1:] if w[:1].isupper() else form) + z

        out, prose = [], []
        for p in parts:
            if p["fixed"]:
                out += [re.sub(r"\S+", fix, "".join(prose)) if r else "".join(prose), p["gap"] + p["piece"]]
                prose = []
            else:
                prose.append(p["gap"] + p["piece"])
        return "".join([*out, re.sub(r"\S+", fix, "".join(prose)) if r else "".join(prose)])

    return pd.Series([one(p, r) for p, r in zip(pieces, repairs)], index=pieces.index, dtype=object)
