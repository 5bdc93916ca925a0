"""Lines to sentences, with abbreviations, decimals and addresses kept whole."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import SPACE, strip
from quern.operators.lines import SCAN_NOISE, heading_paths, kind

# Abbreviations whose dots end no sentence.
ABBREVIATIONS = ["د.", "أ.", "م.", "أ.د.", "هـ.", "ص.", "ج.", "ط.", "ع.", "رقم.", "ك.و.", "ك.ف.", "ك.ف.أ.", "ر.س.", "e.g.", "i.e.", "etc.", "Dr.", "No.", "vs."]
_DOT, _END = "\x02", "\x01"
_WORD = r"[0-9A-Za-z_\x{00aa}\x{00b5}\x{00ba}\x{00c0}-\x{00d6}\x{00d8}-\x{00f6}\x{00f8}-\x{02c1}\x{0370}-\x{03ff}\x{0400}-\x{0481}\x{0620}-\x{064a}\x{0660}-\x{0669}\x{066e}-\x{06d3}]"


def sentences_of(line: Column, abbreviations: list[str] = ABBREVIATIONS, arabic: bool = True, decimals: bool = True, addresses: bool = True) -> Column:
    """The sentences of a line as an array, without empty ones.

    A sentence ends with one of . ! ? (and the Arabic question mark and full stop) before white space or the end; of
    a double ending, each ends a sentence.  Dots of abbreviations, decimals and addresses are masked before.
    """
    out = F.regexp_replace(line, f"[{_DOT}{_END}]", "")
    entries = sorted({a.rstrip(".") for a in abbreviations if a.rstrip(".")}, key=len, reverse=True)
    if entries:
        # dots inside an entry stand before a letter and end nothing, so only the last one is masked
        out = F.regexp_replace(out, rf"(?i)(?<!{_WORD})({'|'.join(map(re.escape, entries))})\.", f"$1{_DOT}")
    if decimals:
        out = F.regexp_replace(out, r"(\d)\.(?=\d)", f"$1{_DOT}")
    if addresses:
        # only the last dot of an address can stand before white space
        out = F.regexp_replace(out, r"((?:https?://|www\.)\S*)\.(?=\s|$)", f"$1{_DOT}")
    ending = "[.!?؟۔]" if arabic else "[.!?]"
    out = F.regexp_replace(out, rf"({ending})({ending})([{SPACE}]+|$)", f"$1{_END}$2{_END}")
    out = F.regexp_replace(out, rf"({ending})([{SPACE}]+|$)", f"$1{_END}")
    parts = F.transform(F.split(out, _END), lambda x: strip(F.translate(x, _DOT, ".")))
    return F.filter(parts, lambda x: x != "")


def sentences(lines: DataFrame, abbreviations: list[str] = ABBREVIATIONS, noise: list[str] | None = None, arabic: bool = True) -> DataFrame:
    """(doc, line_no, at, sentence, is_heading, heading_level, heading_path) of lines of any kind but noise.

    Headings and list items are one sentence each; headings keep their signs.
    """
    marked = heading_paths(lines.withColumn("kind", kind(F.col("key"), noise=SCAN_NOISE if noise is None else noise)).where(~F.col("kind").isin("blank", "rule", "image", "noise")))
    parts = F.when(F.col("kind") == "text", sentences_of(F.col("key"), abbreviations, arabic)).otherwise(F.array("key"))
    return marked.select("doc", "line_no", F.posexplode(parts).alias("at", "sentence"), (F.col("kind") == "heading").alias("is_heading"), F.when(F.col("kind") == "heading", F.col("heading_level")).alias("heading_level"), "heading_path")
