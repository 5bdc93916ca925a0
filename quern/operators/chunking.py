"""Documents to token-bounded chunks."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.lines import exploded, preprocessed, tables
from quern.operators.sentences import ABBREVIATIONS, sentences

CHUNK = "chunk_id string, chunk_text string, source_file string, section_hierarchy string, token_count int, contains_table boolean, chunk_index int, is_oversized boolean"


@dataclass(frozen=True)
class Chunking:
    """Settings of the whole stage."""

    min_tokens: int = 200
    max_tokens: int = 5000
    overlap_sentences: int = 2
    break_levels: tuple[int, ...] = (1, 2, 3)
    merge_short_tail: bool = True
    chars_per_token: float = 3.5
    repeat_threshold: int = 4
    boilerplate: tuple[str, ...] = ()
    remove_code: bool = True
    tables: bool = True
    min_table_rows: int = 3
    abbreviations: tuple[str, ...] = tuple(ABBREVIATIONS)
    arabic_endings: bool = True
    #: Counts the tokens of a text where given, else code points by chars_per_token; sent to tasks.
    counter: Callable[[str], int] | None = None


def ratio_counter(chars_per_token: float) -> Callable[[str], int]:
    """Tokens by code points."""
    return lambda text: int(len(text) / chars_per_token)


class BpeCounter:
    """Tokens by a byte-pair vocabulary: a file of base64 tokens and their ranks, read once by the driver and sent
    with the counter; the encoder is made once a worker."""

    _made: dict[int, object] = {}

    def __init__(self, path: str, pattern: str) -> None:
        self.pattern = pattern
        with open(path, "rb") as f:
            self.lines = f.read()

    def __call__(self, text: str) -> int:
        key = hash((self.lines, self.pattern))
        if key not in self._made:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in self.lines.splitlines() if x.strip())}
            self._made[key] = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return len(self._made[key].encode_ordinary(text))


def fold(rows: list[tuple[str, int | None, str]], settings: Chunking, count: Callable[[str], int]) -> list[tuple[str, str, int]]:
    """(text, path, tokens) of the text chunks of one document, from its (sentence, heading level, path) in order.

    A heading of a break level ends the chunk if it has the least tokens, else it joins it; the running sum then
    starts again at the heading.  A sentence that would pass the most ends the chunk too, and the next one begins
    with the last `overlap_sentences` sentences.  A short tail joins the last chunk.
    """
    done: list[tuple[str, str, int]] = []
    held: list[tuple[str, str]] = []
    tokens, path = 0, ""

    def close() -> None:
        text = "\n".join(s for s, _ in held)
        done.append((text, held[0][1] or path, count(text)))

    for sentence, level, own in rows:
        n = count(sentence)
        if level in settings.break_levels:
            if held and count("\n".join(s for s, _ in held)) >= settings.min_tokens:
                close()
                held = []
            path = own
            held.append((sentence, own))
            tokens = n
            continue
        if held and tokens + n > settings.max_tokens:
            close()
            held = held[-settings.overlap_sentences :] if settings.overlap_sentences else []
            tokens = sum(count(s) for s, _ in held)
        held.append((sentence, own))
        tokens += n
    if held:
        text = "\n".join(s for s, _ in held)
        if done and settings.merge_short_tail and count(text) < settings.min_tokens:
            joined = done[-1][0] + "\n" + text
            done[-1] = (joined, done[-1][1], count(joined))
        else:
            close()
    return done


def assembled(found_tables: DataFrame, parts: DataFrame, settings: Chunking = Chunking()) -> DataFrame:
    """Chunks of each document: its tables first, in order, then its text.

    A document is one row before it is cut into lines, so the rows of one document are bounded by its text.
    """
    count = settings.counter or ratio_counter(settings.chars_per_token)
    rows = found_tables.select("doc", F.lit(0).alias("part"), F.col("start_line").alias("line_no"), F.lit(0).alias("at"), "text", F.lit(None).cast("int").alias("level"), F.regexp_replace("preceding_heading", r"^#+\s*", "").alias("path")).union(
        parts.select("doc", F.lit(1), "line_no", "at", "sentence", "heading_level", "heading_path")
    )

    # the rows of a document as arrays in order: one Python row a document
    ordered = F.array_sort(F.collect_list(F.struct("part", "line_no", "at", "text", "level", "path")))
    docs = rows.groupBy("doc").agg(ordered.alias("x")).select("doc", *[F.col(f"x.{c}").alias(c) for c in ("part", "text", "level", "path")])

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for doc, part, text, level, path in zip(b["doc"], b["part"], b["text"], b["level"], b["path"]):
                out = []
                body = []
                for kind, t, v, p in zip(part, text, level, path):
                    if kind == 0:
                        n = count(t)
                        out.append((t, p, n, True, n > settings.max_tokens))
                    else:
                        body.append((t, None if v is None or v != v else int(v), p))
                out += [(*c, False, False) for c in fold(body, settings, count)]
                made += [(f"{doc}__chunk_{i}", t, doc, p, n, table, i, over) for i, (t, p, n, table, over) in enumerate(out)]
            yield pd.DataFrame(made, columns=[c.split()[0] for c in CHUNK.split(", ")]).astype({"token_count": int, "chunk_index": int, "contains_table": bool, "is_oversized": bool})

    return docs.mapInPandas(build, CHUNK)


def chunk_documents(df: DataFrame, doc: str, text: str, settings: Chunking = Chunking()) -> DataFrame:
    """Chunks of a table of documents with unique string names; null and empty texts give none."""
    lines = preprocessed(exploded(df.where(F.col(text) != ""), doc, text), settings.repeat_threshold, [*settings.boilerplate], settings.remove_code)
    # lines are numbered anew, as the tables are found in what is left
    from quern.operators.lines import by_doc

    lines = lines.withColumn("line_no", F.row_number().over(by_doc()) - 1)
    found, rest = tables(lines, settings.min_table_rows) if settings.tables else (None, lines)
    parts = sentences(rest, [*settings.abbreviations], arabic=settings.arabic_endings)
    if found is None:
        found = parts.limit(0).select("doc", F.col("line_no").alias("start_line"), F.col("line_no").alias("end_line"), F.col("sentence").alias("preceding_heading"), F.col("sentence").alias("text"))
    return assembled(found, parts, settings)
