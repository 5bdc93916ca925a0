"""Encoding of a corpus with a public byte-level BPE vocabulary (problem 8), by forced boundaries.

A pair of bytes that never stands inside any token of the vocabulary marks a certain token boundary.  Texts are cut at
the certain boundaries before white space that follows something else: there the pattern that splits text before the
merges has a boundary as well, so every fragment can be encoded on its own and the results are concatenated.  Longer
runs without white space are split by the pattern and then at every certain boundary inside.  Fragments return often,
so each worker remembers a bounded number of them.

Defined results: null and empty texts give an empty list; special tokens are ordinary text.  A lone surrogate, which
UTF-8 can't hold, is encoded as U+FFFD.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The folder of the vocabulary files; a parameter of every function here.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fragments that a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 400_000, 64
#: Rows encoded before their ids are handed on.
ROWS = 256
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_PLAIN = re.compile(r"[ \n]?[A-Za-z0-9ء-غف-ي.,;:!?،؟()\"/+=#%*&@<>\[\]{}|_^~$`\\-]+\Z")


class Encoder:
    """Encodes texts with one vocabulary."""

    def __init__(self, lines: bytes) -> None:
        import regex
        import tiktoken

        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())}
        #: Whether a pair of bytes stands inside any token.
        self.inside = np.zeros((256, 256), bool)
        for token in self.ranks:
            for a, b in zip(token, token[1:]):
                self.inside[a, b] = True
        self.pattern = regex.compile(PATTERN)
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.known: dict[str, list[int]] = {}
        # last characters after which a space or a line feed may stand inside a token
        self.unsure_ascii = any(self.inside[a, b] for a in range(33, 127) for b in (32, 10))

    def _certain(self, before: str, after: str) -> bool:
        return not self.inside[before.encode("utf-8", "replace")[-1], ord(after)]

    def fragments(self, text: str) -> list[str]:
        """The text cut at the certain boundaries before white space."""
        parts = _CUT.split(text)
        if len(parts) > 1 and (self.unsure_ascii or not text.isascii()):
            out = [parts[0]]
            for p in parts[1:]:
                if out[-1][-1] < "\x80" and not self.unsure_ascii or self._certain(out[-1][-1], p[0]):
                    out.append(p)
                else:
                    out[-1] += p
            return out
        return parts

    def _fragment(self, text: str) -> list[int]:
        if not _PLAIN.match(text):
            return self.bpe.encode_ordinary(text)  # signs on whose classes patterns may differ
        ids: list[int] = []
        for piece in self.pattern.findall(text):
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                ids.append(whole)
                continue
            a = np.frombuffer(raw, np.uint8)
            cuts = np.flatnonzero(~self.inside[a[:-1], a[1:]]) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(raw)]):
                part = raw[i:j]
                one = self.ranks.get(part)
                if one is not None:
                    ids.append(one)
                else:
                    ids += self.bpe._encode_single_piece(part)
        return ids

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text."""
        if not text:
            return []
        if not text.isascii():
            text = text.encode("utf-8", "surrogatepass").decode("utf-8", "replace") if re.search("[\ud800-\udfff]", text) else text
        known, ids = self.known, []
        for f in self.fragments(text):
            x = known.get(f)
            if x is None:
                x = self._fragment(f)
                if len(f) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[f] = x
            ids += x
        return ids


def read(folder: str = FOLDER, vocabulary: str = VOCABULARY) -> bytes:
    """The vocabulary file, as the driver has it; executors get it with the job and need no such folder."""
    with open(f"{folder}/{vocabulary}", "rb") as f:
        return f.read()


@lru_cache(maxsize=4)
def encoder_of(lines: bytes) -> Encoder:
    """The worker's encoder of a vocabulary."""
    return Encoder(lines)


def encoder(folder: str = FOLDER, vocabulary: str = VOCABULARY) -> Encoder:
    """The encoder of a vocabulary file."""
    return encoder_of(read(folder, vocabulary))


def encoded(df: DataFrame, key: str, text: str, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) of every row."""
    sent = df.sparkSession.sparkContext.broadcast(read(folder, vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder_of(sent.value)
        for b in batches:
            for i in range(0, len(b), ROWS):
                part = b.iloc[i : i + ROWS]
                yield pd.DataFrame({"k": part["k"], "ids": pd.Series([np.array(e.encode(t) if isinstance(t, str) else [], np.int32) for t in part["t"]], index=part.index, dtype=object)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, ids array<int>").select(F.col("k").alias(key), "ids")


def counted(df: DataFrame, columns: list[str], text: str, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns and `n_tokens`, the number of ids of the text."""
    sent = df.sparkSession.sparkContext.broadcast(read(folder, vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder_of(sent.value)
        for b in batches:
            yield b.drop(columns="__text").assign(n_tokens=[len(e.encode(t)) if isinstance(t, str) else 0 for t in b["__text"]])

    narrow = df.select(*columns, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "__text")
    return narrow.mapInPandas(run, f"{schema}, n_tokens long")
