"""Model replies: JSON out of free text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_THINK = re.compile(r"<think>.*?</think>\s*", re.S)
_FENCE = re.compile(r"^\s*```[\w-]*\s*\n?|\n?\s*```\s*$")
_COMMA = re.compile(r",(\s*[\]}])")


def repair(text: str | None):
    """The JSON value in a reply, or None: thinking, fences and trailing commas are removed first; failing that, the
    widest array, then the widest object (as an array of one) inside the text is tried."""
    if not isinstance(text, str):
        return None
    t = _COMMA.sub(r"\1", _FENCE.sub("", _THINK.sub("", text).strip()).strip())
    try:
        return json.loads(t)
    except ValueError:
        pass
    for first, last, wrap in (("[", "]", False), ("{", "}", True)):
        a, b = t.find(first), t.rfind(last)
        if 0 <= a < b:
            try:
                value = json.loads(t[a : b + 1])
                return [value] if wrap else value
            except ValueError:
                continue
    return None


def items(text: str | None) -> list[dict]:
    """The question items of a reply: objects with the key `question`."""
    value = repair(text)
    value = [value] if isinstance(value, dict) else value
    return [x for x in value if isinstance(x, dict) and "question" in x] if isinstance(value, list) else []


@F.pandas_udf(T.StringType())
def repaired_json(text: pd.Series) -> pd.Series:
    """The repaired reply as JSON text, null where nothing can be read."""
    return text.map(lambda t: None if (v := repair(t)) is None else json.dumps(v, ensure_ascii=False), na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def question_items(text: pd.Series) -> pd.Series:
    """The question items of a reply, each as JSON text."""
    return text.map(lambda t: [json.dumps(x, ensure_ascii=False) for x in items(t)] if isinstance(t, str) else [])


def field_of(text: Column, field: str | None) -> Column:
    """A field of a reply that is a JSON object, as text, without any repair; the whole object for no field.  Null for
    bad JSON, other values and a missing field."""
    whole = F.when(F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{"), text)
    return whole if field is None else F.get_json_object(whole, f"$.{field}")


def verdict(text: Column, field: str, default: str) -> Column:
    """A field of a judge's JSON reply without any repair; `default` for failed calls, bad JSON or a missing field."""
    return F.coalesce(field_of(text, field), F.lit(default))
