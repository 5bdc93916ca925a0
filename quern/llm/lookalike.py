"""One consistent form for texts that look the same (problem 3).

A longest-match transducer rewrites grapheme clusters (a base and its marks) in a single pass: widths, ligatures
and presentation forms, decomposed accents, spaces, invisible characters and look-alike letters.  Its table is
built from the Unicode character database by rule, and `_checked` refuses a table in which an output would be
rewritten again.  Letters of Cyrillic or Greek inside a Latin word (and the reverse) depend on the word, Persian
and Urdu letter forms inside Arabic on the sentence; both are states of the same pass.

Defined results: null stays null and the empty text stays empty; a text without any such character comes back as
the same string; `changes` says whether a text holds a case (canonical reordering of marks is not one).
"""

from __future__ import annotations

import re
import sys
import unicodedata as ud
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters that look like a Latin letter (from the public Unicode confusables data).
CYRILLIC = dict(zip("аеорсухіјѕԛԝһԁӏАВЕЗКМНОРСТУХІЈЅԚԜҮ", "aeopcyxijsqwhdlAB" "E3KMHOPCTYXIJSQWY"))
GREEK = dict(zip("οανιϲϳρυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "oavicjpukABEZHIKMNOPTYXCJ"))
LATIN_EXTRA = dict(zip("ɑɡ", "ag"))
# Persian and Urdu forms of Arabic letters and digits.
ARABIC = dict(zip("کیہھەے۰۱۲۳۴۵۶۷۸۹", "كيهههي٠١٢٣٤٥٦٧٨٩"))
# Letters that only Persian and Urdu words have, and letters they don't have.
EASTERN, WESTERN = "ٹپچڈگژڑںے۔ۓ", "يكةىإ"
# Signs with the look of a plain sign.
SIGNS = {";": ";", "‐": "-", "‑": "-", "∕": "/", "⁄": "/", "∶": ":", "꞉": ":", "․": ".", "‚": ",", "։": ":", "−": "-", "ː": ":", "ǃ": "!", "٫": ",", "∗": "*", "∣": "|"}
SIGNS.pop("٫"), SIGNS.pop("ː"), SIGNS.pop("−")  # these look or mean otherwise

#: Compatibility forms that look different from their plain text.
_DIFFERENT = re.compile("[…‥℀℁℅℆№℻℡⑴-⒵㈀-㏿ﷰ-﷿¨¯´µ¸˘-˝ͺ΄΅᾽-῾ำຳໜໝཷཹ⩴-⩶‼⁇-⁉″-⁗]")
_KINDS = {"<wide>", "<narrow>", "<font>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>", "<small>", "<vertical>"}


def _checked(table: dict[str, str]) -> dict[str, str]:
    """Refuses a table whose outputs hold keys, so that one pass is enough."""
    for key, out in table.items():
        if any(c in table for c in out):
            raise ValueError(f"{key!r} is rewritten to {out!r}, which would be rewritten again")
    return table


def _singles() -> dict[str, str]:
    table = {}
    for o in range(0x80, 0x1FC00):
        c = chr(o)
        kind, cat = ud.decomposition(c).split(" ")[0], ud.category(c)
        if cat == "Zs" or o in (0x85, 0x2028, 0x2029):
            table[c] = " "
        elif cat == "Cf" and not 0x600 <= o <= 0x605 and o not in (0x6DD, 0x70F, 0x110BD) or o in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, 0x2800) or 0xFE00 <= o <= 0xFE0F:
            table[c] = ""
        elif c in SIGNS:
            table[c] = SIGNS[c]
        elif kind in _KINDS and not _DIFFERENT.match(c) and cat[0] != "M":
            table[c] = ud.normalize("NFKC", c)
        elif cat[0] != "M" and not kind.startswith("<") and len(n := ud.normalize("NFC", c)) == 1 and n != c:
            table[c] = n  # a singleton, such as the ohm sign
    for o in range(0xE0000, 0xE01F0):
        table[chr(o)] = ""
    for c in {*table} & {*CYRILLIC, *GREEK, *LATIN_EXTRA, *ARABIC}:
        del table[c]  # these depend on the word
    for _ in range(3):  # outputs that are keys themselves
        table = {k: "".join(table.get(c, c) for c in v) for k, v in table.items()}
    return _checked(table)


SINGLES = _singles()
_COMPOSED = {ud.normalize("NFD", chr(o))[1:] for o in range(0xC0, 0x2FFF) if len(ud.normalize("NFC", chr(o))) == 1 and len(ud.normalize("NFD", chr(o))) > 1}
#: Marks that compose with some base.
MARKS = "".join(sorted({c for x in _COMPOSED for c in x}))


def _class(chars) -> str:
    """A regex character class body with ranges."""
    codes, out = sorted(map(ord, chars)), []
    for o in codes:
        if out and out[-1][1] == o - 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    text = lambda o: re.escape(chr(o)) if o < 128 else chr(o)
    return "".join(text(a) if a == b else f"{text(a)}-{text(b)}" for a, b in out)


_SUSPECTS = {*SINGLES, *MARKS, *CYRILLIC, *GREEK, *LATIN_EXTRA, *ARABIC}
#: Texts without any of these are in the one form already.
SUSPECT = re.compile(f"[{_class(_SUSPECTS)}]")
#: Characters outside a few ranges without suspects: a cheap first test, here and inside Spark.
UNUSUAL = "[^\\x00-\\x7f،؛؟ء-غف-ي٠-٩]"
_UNUSUAL = re.compile(UNUSUAL)
_USUAL = frozenset(c for c in map(chr, range(0x700)) if not re.match(UNUSUAL, c))
if _USUAL & (_SUSPECTS - {";"}):
    raise ValueError("a suspect character is taken for usual")
_LETTERS = "".join(chr(o) for o in range(0x41, 0x590) if chr(o).isalpha()) + "".join(chr(o) for o in range(0x1E00, 0x2000) if chr(o).isalpha())
_SINGLE_RUN = f"[{_class(SINGLES)}]"
_INVISIBLE = _class(k for k, v in SINGLES.items() if not v)
#: One token of the pass: a word of Latin, Greek or Cyrillic, a word of Arabic, a base with marks, or one single.
_ARABIC_CLASS = "ؠ-يً-ٟ٠-٩ٮ-ۓە-ۜۮ-ۿﭐ-﷯ﹰ-ﻼ"
_TOKEN = re.compile(f"[{_class({*_LETTERS, *MARKS} | {k for k, v in SINGLES.items() if v and (v.isalpha() and ord(v[0]) < 0x590)})}{_INVISIBLE}]+|[{_ARABIC_CLASS}{_INVISIBLE}]+|.[{_class(MARKS)}]+|{_SINGLE_RUN}", re.S)
_CLUSTER = re.compile(f".[{_class(MARKS)}]*", re.S)
_SENTENCE_END = re.compile("[.!?؟\n]|(?<=۔)")
_OTHER_SCRIPT = re.compile("[\u0370-\u03ff\u0400-\u052f\u1f00-\u1fff]")
_ASCII_LETTER = re.compile("[A-Za-z]")
_JOINERS = "‌‍"
_EMOJI = re.compile("[←-⯿\U0001f000-\U0001faff️]")
_CJK = re.compile("[⺀-鿿가-힯]")
_FOREIGN_ALL = CYRILLIC | GREEK
_TO = {"cyrillic": {v: k for k, v in reversed(CYRILLIC.items()) if v.isalpha()}, "greek": {v: k for k, v in reversed(GREEK.items())}}


def _script(c: str) -> str:
    o = ord(c)
    if o < 0x250 or 0x1E00 <= o < 0x1F00 or c in LATIN_EXTRA:
        return "latin" if c.isalpha() else ""
    return "greek" if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000 else "cyrillic" if 0x400 <= o < 0x530 else ""


def _compose(word: str) -> str:
    """Longest match of bases with marks."""
    return ud.normalize("NFC", word) if any(c in MARKS for c in word) else word


class _Around:
    """What letters depend on besides their word, found once a text: its script, and the language of each sentence."""

    def __init__(self, text: str) -> None:
        self.text = text
        self._latin: bool | None = None
        self._spans: tuple[list[int], list[int]] | None = None
        self._eastern: dict[int, bool] = {}

    def latin(self) -> bool:
        """Mostly Latin, without any word that can only be Greek or Cyrillic."""
        if self._latin is None:
            other = _OTHER_SCRIPT.findall(self.text)
            self._latin = all(c in _FOREIGN_ALL for c in other) and len(_ASCII_LETTER.findall(self.text)) > 4 * len(other)
        return self._latin

    def eastern(self, at: int) -> bool:
        """Whether the sentence around a place is Persian or Urdu."""
        if self._spans is None:
            found = [m.span() for m in _SENTENCE_END.finditer(self.text)]
            self._spans = [a for a, _ in found], [b for _, b in found]
        starts, ends = self._spans
        k = bisect_right(ends, at)
        if k not in self._eastern:
            s = self.text[ends[k - 1] if k else 0 : starts[k] if k < len(starts) else None]
            s = "".join(SINGLES.get(c, c) for c in s)
            self._eastern[k] = any(c in EASTERN for c in s) and not any(c in WESTERN for c in s)
        return self._eastern[k]


def _word(word: str, around: _Around) -> str:
    """A word of Latin, Greek or Cyrillic in one script, where its foreign letters all have a look-alike."""
    word = "".join(SINGLES.get(c, c) for c in word)
    if word.isascii():
        return word
    word = _compose(word)
    kinds = {_script(c) for c in word} - {""}
    if kinds <= {"latin"}:
        return "".join(LATIN_EXTRA.get(c, c) for c in word) if any(c in LATIN_EXTRA for c in word) else word
    foreign = [c for c in word if _script(c) in ("greek", "cyrillic")]
    if "latin" in kinds:
        if all(c in _FOREIGN_ALL for c in foreign):
            return "".join(_FOREIGN_ALL.get(c, c) for c in word)
        if len(kinds) == 2:
            other = _TO[(kinds - {"latin"}).pop()]
            latin = [c for c in word if _script(c) == "latin"]
            if len(foreign) >= len(latin) and all(c in other for c in latin):
                return "".join(other.get(c, c) for c in word)
        return word
    if all(c in _FOREIGN_ALL for c in foreign) and len(foreign) <= 3 and around.latin():
        return "".join(_FOREIGN_ALL.get(c, c) for c in word)  # a short word all of look-alikes
    return word


def normalize(text: str | None) -> str | None:
    """The text in the one form; null for null."""
    if text is None or text.isascii() or not _UNUSUAL.search(text) or not SUSPECT.search(text):
        return text
    return _pass(text)[0]


def changes(text: str | None) -> bool:
    """Whether the text holds a case of problem 3; false for null."""
    return text is not None and not text.isascii() and bool(_UNUSUAL.search(text)) and bool(SUSPECT.search(text)) and _pass(text)[1]


def _pass(text: str) -> tuple[str, bool]:
    case, around = False, _Around(text)

    def out(m: re.Match) -> str:
        nonlocal case
        x, at = m[0], m.start()
        if x.isascii():
            return x
        head = x[0]
        if x.strip("‌‍︎️") == "" and at and (_EMOJI.match(text[at - 1]) or at > 1 and text[at - 1] in "️‍" and _EMOJI.match(text[at - 2])):
            return x  # part of an emoji
        if len(x) == 1 and x in SINGLES and not "ﭐ" <= x <= "ﻼ":
            if SINGLES[x] and not SINGLES[x].isalnum() and 0xFF00 < ord(x) < 0xFF61 and (at and _CJK.match(text[at - 1]) or _CJK.match(text[at + 1 : at + 2])):
                return x  # wide punctuation of Chinese or Japanese
            if x in _JOINERS and at and 0x900 <= ord(text[at - 1]) < 0xE00:
                return x  # joins letters of an Indic script
            case = True
            return SINGLES[x]
        if any("ؠ" <= c <= "ۿ" or "ﭐ" <= c <= "ﻼ" for c in x):
            if any(c in ARABIC or c in _JOINERS for c in x) and around.eastern(at):
                y = "".join(c if c in _JOINERS else SINGLES.get(c, c) for c in x)
            elif any(c in EASTERN for c in x):
                y = "".join(SINGLES.get(c, c) for c in x)
            else:
                y = "".join(ARABIC.get(c, c) for c in "".join(SINGLES.get(c, c) for c in x))
            z = _compose(y)
            case |= y != x or len(z) < len(y)
            return z
        if _script(head) or head in SINGLES or any(_script(c) for c in x):
            y = _word(x, around)
        else:
            y = _compose(x)
        case |= y != x and (len(y) < len(x) or ud.normalize("NFC", x) != y)
        return y

    return _TOKEN.sub(out, text), case


_MARK_CLASS = re.compile(f"[{_class(chr(o) for o in range(0x300, 0x1E000) if ud.category(chr(o))[0] == 'M')}]+")
_COMMON_MARKS = re.compile("[\u0300-\u036f\u064b-\u065f]+")
_WORDS = re.compile(r"[^\W_]+")
_ASCII_WORDS = re.compile(r"[a-z0-9]+")


def folded(text: str) -> str:
    """One form, case folded, without combining marks."""
    if not _UNUSUAL.search(text):
        return _COMMON_MARKS.sub("", ud.normalize("NFD", text.casefold()))
    return _MARK_CLASS.sub("", ud.normalize("NFD", normalize(text).casefold()))


def words(text: str | None) -> list[str]:
    """The words for the word share: one form, case folded, marks dropped, runs of letters and digits, each once."""
    if not text:
        return []
    if text.isascii():
        return list(dict.fromkeys(_ASCII_WORDS.findall(text.lower())))
    return list(dict.fromkeys(_WORDS.findall(folded(text))))


@F.pandas_udf(T.StringType())
def _normalize_udf(s: pd.Series) -> pd.Series:
    return s.map(normalize, na_action="ignore")


@F.pandas_udf(T.BooleanType())
def _changes_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: isinstance(x, str) and changes(x)).astype(bool)


def normalized(col: Column) -> Column:
    """The column in the one form."""
    return _normalize_udf(col)


def normalize_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with the columns replaced by their one form; other columns, also with clashing names, stay as they are."""
    return df.withColumns({c: normalized(F.col(c)) for c in columns})


def looks_plain_but_differs(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field): the texts that hold a case.

    A filter inside Spark keeps the rows with any suspect character, so that only those reach Python.
    """
    long = df.select(F.col(key), F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in columns])).alias("x")).select(key, "x.field", "x.text")
    return long.where(F.col("text").rlike(UNUSUAL)).where(_changes_udf("text")).select(key, "field")


if sys.maxunicode < 0x10FFFF:  # pragma: no cover
    raise ImportError("a wide build of Python is needed")
