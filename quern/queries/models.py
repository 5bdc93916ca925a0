"""Queries on what models say, over stubs whose replies are functions of the prompt, so that SQL can state them."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import providers
from quern.operators import judging, reports, tags, validation
from quern.plans import stages
from quern.shared import table


def _digit(text: str) -> int:
    """The first hexadecimal digit of a prompt's MD5."""
    return int(hashlib.md5(text.encode("utf-8", "replace")).hexdigest()[0], 16)


def _judge(prompt: str) -> str:
    """A score from 1 to 5; no JSON for one prompt of 16, no score for another."""
    d = _digit(prompt)
    return "no verdict" if d == 15 else "{}" if d == 14 else json.dumps({"score": 1 + d % 5, "issues": "none"})


_NAMES = ("safety", "billing", "metering", "outage")


def _tagger(prompt: str) -> str:
    d = _digit(prompt)
    return "none" if d == 15 else json.dumps({"tags": [_NAMES[d % 4], _NAMES[d // 4 % 4]]})


def _summary(prompt: str) -> str:
    return "  \n " if _digit(prompt) == 0 else f"  About {len(prompt)} signs. "


def _rephraser(prompt: str) -> str:
    """The question with a word in front, and a short answer, for three prompts of four; no criteria for one of those."""
    d = _digit(prompt)
    if d % 4 == 0:
        return "[1, 2"
    question = prompt.split("\nQUESTION: ", 1)[1].split("\nANSWER: ", 1)[0]
    said = {"question": f"Please: {question}", "answer": "لازم تبلغ عشان يفحصون" if d % 2 else "Short."}
    return json.dumps(said if d % 4 == 2 else said | {"evaluation_criteria": f"Digit {d}."}, ensure_ascii=False)


def _stub(*answers):
    return lambda: providers.Stub(answers=[*answers])


def summaries_made(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("name"), "text")
    return judging.summarized(docs, "name", "text", _stub((".", _summary)), most_tokens=200)


def dialect_scores(spark, folder):
    rows = table(spark, folder, "qa_raw").select("item_seq", "question", "answer")
    return judging.dialect_judged(rows, "item_seq", _stub((".", _judge))).select("item_seq", "dialect_score", "dialect_failed")


def tags_generated(spark, folder):
    rows = table(spark, folder, "qa_raw").select("item_seq", "question")
    return judging.tagged(rows, _stub((".", _tagger))).select("item_seq", F.array_join("tags", "|").alias("tags"))


def _originals(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "eval_split")
    return e.select("eval_id", *[F.col(f"original_{c}").alias(c) for c in ("question", "answer", "evaluation_criteria")], "category", "difficulty")


def rephrased_items(spark, folder):
    out = judging.rephrased(_originals(spark, folder), _stub((".", _rephraser)), validation.MARKERS)
    return out.select("eval_id", "question", "answer", "evaluation_criteria", F.md5("original_answer").alias("original"), "rephrase_failed", "dialect_revalidation_failed")


def similar_tags(spark, folder):
    return tags.merged_into(table(spark, folder, "train_split"), "train_id", "tags", 0.3)


def tags_normalized(spark, folder):
    train = table(spark, folder, "train_split").select("train_id", "tags")
    return tags.merged(train, "train_id", "tags", tags.merged_into(train, "train_id", "tags", 0.3)).select("train_id", F.array_join("tags", "|").alias("tags"))


def cluster_stats(spark, folder):
    return reports.cluster_stats(table(spark, folder, "train_split"))


def split_distributions(spark, folder):
    return reports.split_distributions(table(spark, folder, "train_split"), table(spark, folder, "eval_split"))


def judged_and_cleaned(spark, folder):
    """The whole of stage 3 with judges."""
    rows = table(spark, folder, "qa_raw").select("item_seq", "question", "answer", "evaluation_criteria", "category", "difficulty", "chunk_id", "source_file", "context")
    stub = _stub((r"^Is the answer", lambda m: json.dumps({"classification": "not_supported" if _digit(m) == 0 else "fully_supported"})), (r"^Rate", _judge), (r"^Give", _tagger))
    out = stages.cleaned(rows, provider_of=stub)
    return out.select("item_seq", "discard_stage", "discard_reason", "grounding_classification", F.array_join("tags", "|").alias("tags"))


_HEX = "(strpos('0123456789abcdef', substr(md5(p), 1, 1)) - 1)"


def _q(text: str) -> str:
    """A SQL string, with its line feeds as chr(10)."""
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _rendered(template: str, columns: dict[str, str]) -> str:
    out = _q(template)
    for name, c in columns.items():
        out = out.replace("{" + name + "}", f"' || coalesce({c}, '') || '")
    return out


_PRESENT = "(" + " + ".join(f"CAST(contains(coalesce(answer, ''), '{w}') AS INT)" for w in validation.MARKERS) + ")"
QUERIES = {f.__name__: f for f in (summaries_made, dialect_scores, tags_generated, rephrased_items, similar_tags, tags_normalized, cluster_stats, split_distributions, judged_and_cleaned)}
SQL = {
    "summaries_made": f"""WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS name, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, floor(length(coalesce(text, '')) / 3.5) AS k FROM documents),
c AS (SELECT name, CASE WHEN k > 200 THEN substr(text, 1, CAST(floor(n * (200.0::DOUBLE / k)) AS INT)) ELSE text END AS body FROM t),
r AS (SELECT name, {_rendered(judging.SUMMARY, {"source_file": "name", "document_text": "body"})} AS p FROM c)
SELECT name, CASE WHEN {_HEX} = 0 THEN '' ELSE 'About ' || length(p) || ' signs.' END AS summary FROM r""",
    "dialect_scores": f"""WITH s AS (SELECT item_seq, {_rendered(judging.DIALECT, {"question": "question", "answer": "answer"})} AS p, row_number() OVER (ORDER BY md5('42:' || CAST(item_seq AS VARCHAR)), item_seq) <= greatest(1, (SELECT count(*) FROM qa_raw) * 15 // 100) AS chosen FROM qa_raw),
d AS (SELECT item_seq, chosen, {_HEX} AS d FROM s),
x AS (SELECT item_seq, CASE WHEN chosen THEN CAST(CASE WHEN d >= 14 THEN 5 ELSE 1 + d % 5 END AS DOUBLE) END AS dialect_score FROM d)
SELECT item_seq, dialect_score, coalesce(dialect_score < 4, false) AS dialect_failed FROM x""",
    "tags_generated": f"""WITH r AS (SELECT item_seq, {_rendered(judging.TAGS, {"question": "question"})} AS p FROM qa_raw), d AS (SELECT item_seq, {_HEX} AS d FROM r), n AS (SELECT ['safety', 'billing', 'metering', 'outage'] AS n)
SELECT item_seq, CASE WHEN d = 15 THEN '' ELSE n[1 + d % 4] || '|' || n[1 + d // 4 % 4] END AS tags FROM d, n""",
    "rephrased_items": f"""WITH o AS (SELECT eval_id, original_question AS question, original_answer AS answer, original_evaluation_criteria AS evaluation_criteria, category, difficulty FROM eval_split),
r AS (SELECT *, {_rendered(judging.REPHRASE, {c: c for c in ("question", "answer", "evaluation_criteria", "category", "difficulty")})} AS p FROM o),
d AS (SELECT *, {_HEX} AS d FROM r),
x AS (SELECT eval_id, d, CASE WHEN d % 4 = 0 THEN question ELSE 'Please: ' || coalesce(question, '') END AS question, answer AS before, CASE WHEN d % 4 = 0 THEN answer WHEN d % 2 = 1 THEN 'لازم تبلغ عشان يفحصون' ELSE 'Short.' END AS answer, CASE WHEN d % 4 IN (0, 2) THEN evaluation_criteria ELSE 'Digit ' || d || '.' END AS evaluation_criteria FROM d)
SELECT eval_id, question, answer, evaluation_criteria, md5(before) AS original, CASE WHEN d % 4 = 0 THEN true END AS rephrase_failed, CASE WHEN d % 4 <> 0 AND {_PRESENT} < 2 THEN true END AS dialect_revalidation_failed FROM x""",
    "cluster_stats": "SELECT count(*) FILTER (WHERE cluster_id = -1) AS noise_points, count(DISTINCT cluster_id) FILTER (WHERE cluster_id <> -1) AS clusters FROM train_split",
    "split_distributions": " UNION ALL ".join(
        f"SELECT '{c}' AS field, coalesce(CAST({c} AS VARCHAR), 'unknown') AS value, count(*) FILTER (WHERE s = 't') AS train, count(*) FILTER (WHERE s = 'e') AS eval FROM (SELECT {c}, 't' AS s FROM train_split UNION ALL SELECT {c}, 'e' FROM eval_split) GROUP BY 2"
        for c in ("cluster_id", "difficulty", "category")
    ),
}
