"""The queries of the ten problems, and SQL where SQL can express them over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import lookalike, markup, mixing, near_duplicates, pair_defects, scans, split_overlap, splitting, stuffing, tokens
from quern.shared import table

PAIR = ["question", "answer"]


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split(table(spark, folder, "chunks"), "chunk_id", "chunk_text")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder).where("was_oversized").select("chunk_id").distinct()


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder).select("chunk_id", "source_file", "piece_index", "piece_start", "overlap_chars", "token_count", "is_oversized", "was_oversized", "chunk_text")


def _overlaps(spark: SparkSession, folder: str, coverage: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    evaluation = table(spark, folder, "eval_split").select("eval_id", "source_file", *PAIR, "original_question", "original_answer")
    training = table(spark, folder, "train_split").where("is_eval_mirror is distinct from true").select("train_id", "source_file", *PAIR)
    return split_overlap.overlaps(evaluation, training, "eval_id", "train_id", [PAIR, ["original_question", "original_answer"]], PAIR, threshold=0.7, coverage=coverage), evaluation, training


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _overlaps(spark, folder, coverage=False)[0].select("eval_id", "train_id").distinct()


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    found, evaluation, training = _overlaps(spark, folder, coverage=True)
    return split_overlap.report(found, evaluation, training, "eval_id", "train_id", "source_file")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.looks_plain_but_differs(table(spark, folder, "qa_raw"), "item_seq", PAIR)


def p3_normalized(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.normalize_columns(table(spark, folder, "qa_raw").select("item_seq", *PAIR), PAIR)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    similar = near_duplicates.similar_classes(table(spark, folder, "qa_raw"), "item_seq", PAIR, threshold=0.7, least_words=36)
    return near_duplicates.pairs(similar).toDF("item_seq_a", "item_seq_b")


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    qa = table(spark, folder, "qa_raw")
    return near_duplicates.groups(qa, "item_seq", near_duplicates.similar_classes(qa, "item_seq", PAIR, threshold=0.8))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return markup.named(table(spark, folder, "chunks"), "chunk_id", "chunk_text", "source_file")


def p5_clean(spark: SparkSession, folder: str) -> DataFrame:
    return markup.cleaned(table(spark, folder, "chunks").select("chunk_id", "chunk_text", "source_file"), "chunk_text", "source_file").select("chunk_id", "clean_text", "markup").distinct()


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return scans.Scans(table(spark, folder, "chunks"), "chunk_id", "chunk_text", "source_file").noise()


def p6_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return scans.Scans(table(spark, folder, "chunks"), "chunk_id", "chunk_text", "source_file", support=True).repaired().select("chunk_id", "repaired_text").distinct()


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return pair_defects.flag(table(spark, folder, "qa_raw"), "item_seq", "question", ["answer", "evaluation_criteria"]).distinct()


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return stuffing.found(table(spark, folder, "documents"), "doc_id", "text").distinct()


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encoded(table(spark, folder, "documents"), "doc_id", "text")


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.Mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).documents()


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.Mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).shares()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_pieces, p2_found, p2_report, p3_found, p3_normalized, p4_found, p4_groups, p5_found, p5_clean, p6_found, p6_repaired, p7_found, p8_ids, p9_mix, p9_shares, p10_found)}
SQL: dict[str, str] = {
    "p1_found": "SELECT DISTINCT chunk_id FROM chunks WHERE floor(length(chunk_text) / 3.5) > 800",
}
