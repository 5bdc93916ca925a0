"""Operators over a model's replies: summaries, dialect scores, tags, rephrasing.

Each renders a prompt for every row, asks a provider once a row (`providers.mapped`) and reads the reply inside Spark.
A failed call or a reply that can't be read never loses a record: every operator has a value for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.replies import field_of
from quern.functions.text import markers_in, rendered, strip, tokens_by_ratio, truncated_to_tokens
from quern.operators.sampling import percentage
from quern.providers import mapped

#: Templates of our own; {name} stands for a column.
SUMMARY = "Summarize this document in a few sentences.\nFile: {source_file}\n\n{document_text}"
GROUNDING = "Is the answer supported by the text? Reply with JSON: classification, reasoning.\nTEXT: {chunk_text}\nQUESTION: {question}\nANSWER: {answer}"
DIALECT = "Rate how natural the dialect is from 1 to 5. Reply with JSON: score, issues.\nQUESTION: {question}\nANSWER: {answer}"
TAGS = "Give one to three short topic tags. Reply with JSON: tags.\nQUESTION: {question}"
REPHRASE = "Say the same in other words. Reply with JSON: question, answer, evaluation_criteria.\nQUESTION: {question}\nANSWER: {answer}\nCRITERIA: {evaluation_criteria}\nCATEGORY: {category}\nDIFFICULTY: {difficulty}"


def _asked(df: DataFrame, template: str, names: dict[str, str], provider_of: Callable[[], object], **calls) -> DataFrame:
    """`df` with the `reply` to the template rendered with its columns."""
    prompt = rendered(template, {name: F.col(c) for name, c in names.items()})
    return mapped(df.withColumn("__prompt", prompt), "__prompt", provider_of, **calls).drop("__prompt")


def _said() -> Column:
    """The text of a successful reply."""
    return F.when(F.col("reply.success"), F.col("reply.text"))


def summarized(documents: DataFrame, name: str, text: str, provider_of: Callable[[], object], template: str = SUMMARY, most_tokens: int = 8000, chars_per_token: float = 3.5, **calls) -> DataFrame:
    """(name, summary) of each document; an empty summary where the call fails or says nothing.

    Of a text over `most_tokens` the head is summarized.  A null text counts as empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(F.col(name).alias("__name"), truncated_to_tokens(body, tokens_by_ratio(body, chars_per_token), most_tokens).alias("__text"))
    asked = _asked(rows, template, {"source_file": "__name", "document_text": "__text"}, provider_of, **calls)
    return asked.select(F.col("__name").alias(name), F.coalesce(strip(_said()), F.lit("")).alias("summary"))


def dialect_judged(df: DataFrame, order: str, provider_of: Callable[[], object], template: str = DIALECT, percent: int = 15, least: float = 4, default: float = 5, seed: int = 42, **calls) -> DataFrame:
    """`df` with `dialect_score` (null for records outside the sample of `percent`) and `dialect_failed`, true where
    the score is under `least`.  A failed call, a bad reply or a missing score counts as `default`."""
    sample = percentage(df.select(order, "question", "answer"), order, percent, seed)
    asked = _asked(sample, template, {"question": "question", "answer": "answer"}, provider_of, **calls)
    scored = asked.select(order, F.coalesce(field_of(_said(), "score").try_cast("double"), F.lit(float(default))).alias("dialect_score"))
    out = df.drop("dialect_score", "dialect_failed").join(scored, order, "left")
    return out.withColumn("dialect_failed", F.coalesce(F.col("dialect_score") < least, F.lit(False)))


def tagged(df: DataFrame, provider_of: Callable[[], object], template: str = TAGS, **calls) -> DataFrame:
    """`df` with `tags` from the model; an empty array for any failure."""
    asked = _asked(df.drop("tags"), template, {"question": "question"}, provider_of, **calls)
    tags = F.from_json(field_of(_said(), "tags"), "array<string>")
    return asked.withColumn("tags", F.coalesce(tags, F.array().cast("array<string>"))).drop("reply")


def rephrased(df: DataFrame, provider_of: Callable[[], object], markers: list[str], template: str = REPHRASE, answer_least: int = 2, criteria: bool = True, check: bool = True, **calls) -> DataFrame:
    """`df` with question, answer and (where `criteria`) evaluation_criteria in other words.

    The texts before are kept as original_question, original_answer and original_evaluation_criteria.  A failed call or
    bad reply keeps them and sets `rephrase_failed`; a missing field keeps its text.  Where `check`, an answer with
    fewer markers than `answer_least` sets `dialect_revalidation_failed`.  Flags are true or null; no record is lost.
    """
    fields = ["question", "answer", "evaluation_criteria"]
    made = [f"original_{c}" for c in fields] + ["rephrase_failed", "dialect_revalidation_failed"]
    asked = _asked(df.drop(*made), template, {c: c for c in [*fields, "category", "difficulty"]}, provider_of, **calls)
    failed = field_of(_said(), None).isNull()
    asked = asked.withColumn("__failed", failed).withColumns({f"original_{c}": F.col(c) for c in fields})
    asked = asked.withColumns({c: F.coalesce(F.when(~F.col("__failed"), field_of(_said(), c)), F.col(c)) for c in (fields if criteria else fields[:2])})
    few = ~F.col("__failed") & (markers_in(F.col("answer"), markers) < answer_least) & F.lit(check)
    flags = {"rephrase_failed": F.when(F.col("__failed"), F.lit(True)), "dialect_revalidation_failed": F.when(few, F.lit(True))}
    return asked.withColumns(flags).drop("__failed", "reply")
