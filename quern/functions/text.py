"""Text functions as Spark columns."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.strip takes it, as the body of a character class for Java and RE2 alike.
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(text: Column) -> Column:
    """Without white space at both ends; null for null."""
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def squeeze(text: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode's composed form; null for null."""
    return text.map(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t), na_action="ignore")


def normalized(text: Column) -> Column:
    """Composed form with squeezed white space, the key of exact duplicates; case is kept."""
    return squeeze(nfc(text))


def unix_lines(text: Column) -> Column:
    """Line ends of all kinds as line feeds."""
    return F.regexp_replace(text, "\r\n?", "\n")


def tokens_by_ratio(text: Column, chars_per_token: float = 3.5) -> Column:
    """Tokens as code points by a fixed ratio, rounded down; null for null."""
    return F.floor(F.length(text) / F.lit(float(chars_per_token))).cast("int")


def truncated_to_tokens(text: Column, count: Column, most: int) -> Column:
    """The head of a text whose `count` tokens are more than `most`, in proportion of its code points."""
    keep = F.floor(F.length(text) * (F.lit(float(most)) / count)).cast("int")
    return F.when(count > most, F.substring(text, F.lit(1), keep)).otherwise(text)


def without_thinking(text: Column) -> Column:
    """Without the <think> parts of a model's reply and the white space after each."""
    return F.regexp_replace(text, rf"(?s)<think>.*?</think>[{SPACE}]*", "")


def rendered(template: str, values: dict[str, Column]) -> Column:
    """The template with each {name} of `values` replaced, in one pass: braces inside values stay as they are."""
    if not values:
        return F.lit(template)
    parts = re.split("(" + "|".join(re.escape("{" + k + "}") for k in values) + ")", template)
    return F.concat(*[F.coalesce(values[p[1:-1]].cast("string"), F.lit("")) if p[:1] == "{" and p[1:-1] in values else F.lit(p) for p in parts])


def listed(questions: Column, form: str = "bullet") -> Column:
    """An array of questions as one text: json_list, numbered_list or bullet."""
    if form == "json_list":
        return F.to_json(questions)
    if form == "numbered_list":
        return F.array_join(F.transform(questions, lambda q, i: F.concat((i + 1).cast("string"), F.lit(". "), q)), "\n")
    return F.array_join(F.transform(questions, lambda q: F.concat(F.lit("- "), q)), "\n")


def listed_of(questions: list[str], form: str = "bullet") -> str:
    """`listed` of Python strings."""
    if form == "json_list":
        return json.dumps(questions, ensure_ascii=False)
    return "\n".join(f"{i}. {q}" if form == "numbered_list" else f"- {q}" for i, q in enumerate(questions, 1))


def markers_in(text: Column, markers: list[str]) -> Column:
    """How many entries of the list occur in the text; overlapping entries count each, repeats don't."""
    if not markers:
        return F.lit(0)
    plain = [m for m in markers if m.isascii()]

    @F.pandas_udf(T.IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        # Python finds a word in a text of two-byte characters some ten times as fast as Spark in one of UTF-8
        return pd.Series([len([m for m in (plain if t.isascii() else markers) if m in t]) if isinstance(t, str) else 0 for t in texts], index=texts.index, dtype="int32")

    return count(text)
