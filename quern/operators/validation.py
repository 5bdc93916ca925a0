"""Checks of question-answer records; every failed one keeps a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import markers_in

# Allowed values, bounds in code points (least, most), and dialect word lists.
REQUIRED = ["question", "answer", "evaluation_criteria", "category", "difficulty"]
CATEGORIES = ["factual", "procedural", "reasoning", "troubleshooting", "conceptual", "comparative"]
DIFFICULTIES = ["easy", "medium", "hard"]
QUESTION, ANSWER, CRITERIA = (15, 500), (30, 2000), (30, 1000)
MARKERS = ["وش", "ايش", "إيش", "ليش", "ابي", "أبي", "ابغى", "أبغى", "اقدر", "أقدر", "وين", "يعني", "كذا", "حق", "عشان", "علشان", "زي", "كيف", "مره", "واجد", "حيل", "ذحين", "الحين", "توه", "يبي", "تبي", "نبي", "طيب", "اوكي", "مو", "ماهو", "لازم", "المفروض", "قاعد", "يقدر", "تقدر", "حقي", "حقك", "عندي", "عندك"]
FORMAL = ["لذلك", "ينبغي", "يتوجب", "نظراً", "بالتالي", "علاوة على ذلك", "إذ أن", "من ثم", "حيث أن", "فضلاً عن", "يتعين", "على صعيد", "تجدر الإشارة"]


def structural_reason(required: list[str] = REQUIRED, question: tuple[int, int] = QUESTION, answer: tuple[int, int] = ANSWER, criteria: tuple[int, int] = CRITERIA, categories: list[str] = CATEGORIES, difficulties: list[str] = DIFFICULTIES) -> Column:
    """The first rule a record fails, or null.

    A null stands for a missing field (they are listed sorted); an empty text is an empty field, white space passes.
    A most of 0 for the criteria turns that rule off.
    """
    missing = F.array_sort(F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda x: x.isNotNull()))
    n = {c: F.length(c) for c in ("question", "answer", "evaluation_criteria")}
    told = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"))
    out = F.when(F.size(missing) > 0, told("missing_fields", F.array_join(missing, ", ")))
    for c in required:
        out = out.when(F.col(c) == "", F.lit("empty_required_field"))
    out = out.when(~n["question"].between(*question), told("question_length", n["question"])).when(~n["answer"].between(*answer), told("answer_length", n["answer"]))
    out = out.when(n["evaluation_criteria"] < criteria[0], told("eval_criteria_too_short", n["evaluation_criteria"]))
    if criteria[1]:
        out = out.when(n["evaluation_criteria"] > criteria[1], told("eval_criteria_too_long", n["evaluation_criteria"]))
    return out.when(~F.col("category").isin(categories), told("invalid_category", F.col("category"))).when(~F.col("difficulty").isin(difficulties), told("invalid_difficulty", F.col("difficulty")))


def with_dialect(df: DataFrame, markers: list[str] = MARKERS, formal: list[str] = FORMAL, question_least: int = 1, answer_least: int = 2, formal_most: int = 3) -> DataFrame:
    """With `dialect_marker_count` (question and answer), `dialect_reason`, null where both counts suffice, and, of
    those alone, `msa_flagged`: true where the answer has more formal markers than allowed, else null, never a reason."""
    q, a = markers_in(F.col("question"), markers), markers_in(F.col("answer"), markers)
    told = F.concat(F.lit("insufficient_dialect_markers: q="), q.cast("string"), F.lit(f"<{question_least} or a="), a.cast("string"), F.lit(f"<{answer_least}"))
    few = (q < question_least) | (a < answer_least)
    return df.withColumns({"dialect_marker_count": q + a, "msa_flagged": F.when(~few & (markers_in(F.col("answer"), formal) > formal_most), F.lit(True)), "dialect_reason": F.when(few, told)})


def by_reason(df: DataFrame, reason: Column, name: str = "discard_reason") -> tuple[DataFrame, DataFrame]:
    """(valid, discarded): rows without a reason, and rows with it in the column `name`."""
    marked = df.withColumn(name, reason)
    return marked.where(F.col(name).isNull()).drop(name), marked.where(F.col(name).isNotNull())


def with_action(df: DataFrame, classification: str, actions: dict[str, str], default: str = "keep") -> DataFrame:
    """With `action` by the classification; `default` for one not listed."""
    out = F.lit(default)
    for name, action in actions.items():
        out = F.when(F.col(classification) == name, F.lit(action)).otherwise(out)
    return df.withColumn("action", out)
