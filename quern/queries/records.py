"""Queries on question-answer records."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import providers
from quern.functions import replies, text as X
from quern.operators import dedup, reports, sampling, validation
from quern.plans import stages
from quern.shared import table

_FIELDS = ["item_seq", "question", "answer", "evaluation_criteria", "category", "difficulty", "chunk_id", "source_file", "context"]


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "qa_raw").select(*_FIELDS)


def structural_reasons(spark, folder):
    return _raw(spark, folder).select("item_seq", validation.structural_reason().alias("discard_reason"))


def structural_split(spark, folder):
    valid, discarded = validation.by_reason(_raw(spark, folder), validation.structural_reason())
    return valid.select("item_seq", F.lit(None).cast("string").alias("discard_reason")).union(discarded.select("item_seq", "discard_reason")).select("item_seq", F.coalesce(F.substring_index("discard_reason", ":", 1), F.lit("valid")).alias("kind"))


def dialect_markers(spark, folder):
    return validation.with_dialect(_raw(spark, folder)).select("item_seq", "dialect_marker_count", F.coalesce("msa_flagged", F.lit(False)).alias("msa_flagged"), "dialect_reason")


def grounding_actions(spark, folder):
    rows = validation.with_action(table(spark, folder, "eval_split"), "grounding_classification", {"fully_supported": "keep", "partially_supported": "keep", "not_supported": "discard"})
    return rows.groupBy("grounding_classification", "action").agg(F.count(F.lit(1)).alias("items"))


def exact_duplicates(spark, folder):
    return dedup.exact(_raw(spark, folder), "item_seq", "question").select("item_seq", F.coalesce("duplicate_of", "item_seq").alias("first_item"))


def fuzzy_duplicates(spark, folder):
    return dedup.fuzzy(_raw(spark, folder), "item_seq", "question", "answer").select("item_seq", "removed")


def loop_repeats(spark, folder):
    return dedup.in_loop(_raw(spark, folder).where("chunk_id is not null"), "chunk_id", "item_seq", "question").select("item_seq", "repeats")


def cleaned_records(spark, folder):
    return stages.cleaned(_raw(spark, folder)).select("item_seq", "discard_stage", "discard_reason", "dialect_marker_count")


def cleaning_report(spark, folder):
    marked = dedup.exact(_raw(spark, folder).withColumn("r", validation.structural_reason()), "item_seq", "question")
    stage = F.when(F.col("r").isNotNull(), "structural").when(F.col("duplicate_of").isNotNull(), "exact_duplicate")
    return reports.cleaning_report(marked.withColumn("stage", stage), "stage", ["structural", "exact_duplicate"])


def question_lists(spark, folder):
    rows = _raw(spark, folder).where("chunk_id is not null").groupBy("chunk_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_seq", "question"))), lambda x: x["question"]).alias("q"))
    return rows.select("chunk_id", F.md5(X.listed(F.col("q"), "numbered_list")).alias("numbered"), F.md5(X.listed(F.col("q"))).alias("bullets"))


def thinking_removed(spark, folder):
    reply = F.concat(F.lit("<think>"), F.coalesce("context", F.lit("")), F.lit("</think>\n "), F.col("question"))
    return _raw(spark, folder).select("item_seq", X.without_thinking(reply).alias("text"))


def repaired_replies(spark, folder):
    body = F.to_json(F.struct("question", "answer"))
    reply = F.concat(F.lit("<think>x</think>```json\n["), body, F.lit(",]\n```"))
    got = F.from_json(replies.repaired_json(reply), "array<struct<question:string,answer:string>>")
    return _raw(spark, folder).select("item_seq", got[0]["question"].alias("question"), got[0]["answer"].alias("answer"))


def event_verdicts(spark, folder):
    return table(spark, folder, "events").select(replies.verdict(F.col("props"), "k", "none").alias("verdict"), "event_type").groupBy("verdict", "event_type").agg(F.count(F.lit(1)).alias("events"))


def normalized_questions(spark, folder):
    return _raw(spark, folder).select("item_seq", F.md5(X.normalized(F.col("question"))).alias("digest"))


def generated_items(spark, folder):
    def provider() -> providers.Stub:
        # the first question, then another one twice, of which the second time is a repeat; then nothing
        def answer(m: str) -> str:
            kind, chunk = m.split("|", 1)
            said = hashlib.md5(f"{'1' if kind == 'initial 0' else '2'}{chunk}".encode()).hexdigest()
            return "[]" if kind == "followup 9" else json.dumps([{"question": said, "answer": "A"}])

        return providers.Stub(answers=[(".", answer)])

    chunks = table(spark, folder, "chunks").select("chunk_id", "source_file", "section_hierarchy", "chunk_text").dropDuplicates(["chunk_id"])
    made = providers.generated(chunks, provider, lambda c, kind, so_far: f"{kind} {len(so_far)}|{c['chunk_id']}")
    return made.select("chunk_id", "place", "item", "generation_model", "total_iterations", "total_questions")


def judged_records(spark, folder):
    rows = _raw(spark, folder).withColumn("prompt", F.concat_ws("\n", "question", "answer"))
    stub = lambda: providers.Stub(answers=[("SCADA", '{"classification": "not_supported"}'), (".", '{"classification": "fully_supported"}')])
    found = replies.verdict(F.when(F.col("reply.success"), F.col("reply.text")), "classification", "fully_supported")
    return providers.mapped(rows, "prompt", stub).select("item_seq", found.alias("classification"), F.col("reply.prompt_tokens").alias("prompt_tokens"))


def usage_report(spark, folder):
    calls = table(spark, folder, "qa_raw").select(F.col("generation_model").alias("model"), F.length("context").alias("prompt_tokens"), F.length("answer").alias("completion_tokens"))
    out = reports.usage(calls, [("flash-lite", 0.1, 0.4), ("flash", 0.3, 2.5), ("pro", 1.25, 10.0)])
    return out.withColumn("cost", F.round("cost", 6))


def tag_ranking(spark, folder):
    return reports.tag_counts(table(spark, folder, "train_split"), "tags", "train_id", 30)


def tags_merged(spark, folder):
    merged = {"safety": "السلامة", "billing": "الفواتير", "metering": "العدادات"}
    return table(spark, folder, "train_split").select("train_id", F.array_join(reports.latest_tags(F.col("tags"), merged), "|").alias("tags"))


def _counts(name: str, by: str):
    def run(spark, folder):
        return reports.split_counts(table(spark, folder, "train_split"), table(spark, folder, "eval_split"), by)

    run.__name__ = name
    return run


def split_report(spark, folder):
    return reports.split_report(table(spark, folder, "train_split"), table(spark, folder, "eval_split"))


def sampled_items(spark, folder):
    return sampling.percentage(_raw(spark, folder), "item_seq", 15).select("item_seq")


def allocations(spark, folder):
    return sampling.allocations(table(spark, folder, "train_split").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size")))


def stratified_split(spark, folder):
    return sampling.stratified(table(spark, folder, "train_split"), "train_id", "difficulty").select("train_id")


def train_remainder(spark, folder):
    train, evaluation = sampling.split(table(spark, folder, "train_split"), "train_id", "difficulty")
    return train.select("train_id", F.lit("train").alias("split")).union(evaluation.select("train_id", F.lit("eval").alias("split")))


def eval_mirror(spark, folder):
    e = table(spark, folder, "eval_split")
    original = e.select("eval_id", F.col("original_question").alias("question"), F.col("original_answer").alias("answer"))
    return sampling.mirror(original, e, "eval_id").select("eval_id", F.md5("question").alias("q"), F.md5("rephrased_question").alias("rq"), F.md5("rephrased_answer").alias("ra"))


def final_train(spark, folder):
    m = table(spark, folder, "mirror_split").withColumnRenamed("eval_id", "train_id")
    out = sampling.final_train(table(spark, folder, "train_split").drop("is_eval_mirror"), m)
    return out.select("train_id", "is_eval_mirror", F.md5("question").alias("question"), F.md5("answer").alias("answer"))


_BAD = "concat_ws(', ', CASE WHEN answer IS NULL THEN 'answer' END, CASE WHEN category IS NULL THEN 'category' END, CASE WHEN difficulty IS NULL THEN 'difficulty' END, CASE WHEN evaluation_criteria IS NULL THEN 'evaluation_criteria' END, CASE WHEN question IS NULL THEN 'question' END)"
_REASON = f"""CASE WHEN {_BAD} <> '' THEN 'missing_fields: ' || {_BAD}
WHEN question = '' OR answer = '' OR evaluation_criteria = '' OR category = '' OR difficulty = '' THEN 'empty_required_field'
WHEN length(question) NOT BETWEEN 15 AND 500 THEN 'question_length: ' || length(question)
WHEN length(answer) NOT BETWEEN 30 AND 2000 THEN 'answer_length: ' || length(answer)
WHEN length(evaluation_criteria) < 30 THEN 'eval_criteria_too_short: ' || length(evaluation_criteria)
WHEN length(evaluation_criteria) > 1000 THEN 'eval_criteria_too_long: ' || length(evaluation_criteria)
WHEN category NOT IN ({', '.join(f"'{c}'" for c in validation.CATEGORIES)}) THEN 'invalid_category: ' || category
WHEN difficulty NOT IN ('easy', 'medium', 'hard') THEN 'invalid_difficulty: ' || difficulty END"""
_NORMAL = f"trim(regexp_replace(nfc_normalize(question), '[{X.SPACE}]+', ' ', 'g'), ' ')"


def _marks(column: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains(coalesce({column}, ''), '{w}') AS INT)" for w in words) + ")"


def _counts_sql(by: str) -> str:
    return f"SELECT coalesce(CAST({by} AS VARCHAR), 'unknown') AS value, count(*) FILTER (WHERE s = 't') AS train, count(*) FILTER (WHERE s = 'e') AS eval FROM (SELECT {by}, 't' AS s FROM train_split UNION ALL SELECT {by}, 'e' FROM eval_split) GROUP BY 1"


_LOT = "md5('42:' || CAST(train_id AS VARCHAR))"
_ALLOCATED = """z AS (SELECT cluster_id, count(*) AS size FROM train_split GROUP BY 1),
b AS (SELECT *, CAST(greatest(1, floor(sum(size) OVER () * 0.12::DOUBLE)) AS BIGINT) AS budget, sum(size) OVER () AS total FROM z),
a AS (SELECT *, least(size, greatest(2, CAST(floor(CAST(budget * size AS DOUBLE) / total) AS BIGINT))) AS a FROM b),
n AS (SELECT cluster_id, size, CAST(CASE WHEN sum(a) OVER () > budget THEN greatest(2, CAST(floor(CAST(a * budget AS DOUBLE) / sum(a) OVER ()) AS BIGINT)) ELSE a END AS BIGINT) AS allocated FROM a)"""
_PICKED = f"""{_ALLOCATED}, t AS (SELECT train_id, cluster_id, coalesce(difficulty, 'unknown') AS s FROM train_split),
q AS (SELECT t.cluster_id, s, greatest(1, CAST(floor(CAST(any_value(allocated) * count(*) AS DOUBLE) / any_value(size)) AS BIGINT)) AS quota, any_value(allocated) AS allocated FROM t JOIN n USING (cluster_id) GROUP BY 1, 2),
r AS (SELECT train_id, cluster_id, allocated, quota, row_number() OVER (PARTITION BY t.cluster_id, s ORDER BY {_LOT}, train_id) AS i FROM t JOIN q USING (cluster_id, s)),
u AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY CAST(i > quota AS INT), {_LOT}, train_id) AS k FROM r)"""

QUERIES = {
    f.__name__: f
    for f in (
        structural_reasons, structural_split, dialect_markers, grounding_actions, exact_duplicates, fuzzy_duplicates, loop_repeats, cleaned_records, cleaning_report, question_lists, thinking_removed, repaired_replies,
        event_verdicts, normalized_questions, generated_items, judged_records, usage_report, tag_ranking, tags_merged, _counts("cluster_counts", "cluster_id"), _counts("difficulty_counts", "difficulty"),
        _counts("category_counts", "category"), _counts("source_counts", "source_file"), split_report, sampled_items, allocations, stratified_split, train_remainder, eval_mirror, final_train,
    )
}
SQL = {
    "structural_reasons": f"SELECT item_seq, {_REASON} AS discard_reason FROM qa_raw",
    "structural_split": f"SELECT item_seq, CASE WHEN r IS NULL THEN 'valid' ELSE split_part(r, ':', 1) END AS kind FROM (SELECT item_seq, {_REASON} AS r FROM qa_raw)",
    "dialect_markers": f"WITH m AS (SELECT item_seq, {_marks('question', validation.MARKERS)} AS q, {_marks('answer', validation.MARKERS)} AS a, {_marks('answer', validation.FORMAL)} AS f FROM qa_raw) SELECT item_seq, CAST(q + a AS INT) AS dialect_marker_count, f > 3 AND q >= 1 AND a >= 2 AS msa_flagged, CASE WHEN q < 1 OR a < 2 THEN 'insufficient_dialect_markers: q=' || q || '<1 or a=' || a || '<2' END AS dialect_reason FROM m",
    "grounding_actions": "SELECT grounding_classification, CASE WHEN grounding_classification = 'not_supported' THEN 'discard' ELSE 'keep' END AS action, count(*) AS items FROM eval_split GROUP BY 1, 2",
    "exact_duplicates": f"SELECT item_seq, min(item_seq) OVER (PARTITION BY {_NORMAL}) AS first_item FROM qa_raw",
    "cleaning_report": f"""WITH m AS (SELECT {_REASON} AS r, min(item_seq) OVER (PARTITION BY {_NORMAL}) <> item_seq AS d FROM qa_raw),
n AS (SELECT count(*) AS n, count(r) AS s, count(*) FILTER (WHERE r IS NULL AND d) AS e FROM m)
SELECT 0 AS step_no, 'input' AS step, n AS remaining, CAST(0 AS BIGINT) AS discarded FROM n UNION ALL SELECT 1, 'structural', n - s, s FROM n UNION ALL SELECT 2, 'exact_duplicate', n - s - e, e FROM n""",
    "question_lists": "WITH r AS (SELECT chunk_id, question, item_seq, row_number() OVER (PARTITION BY chunk_id ORDER BY item_seq) AS i FROM qa_raw WHERE chunk_id IS NOT NULL) SELECT chunk_id, md5(string_agg(i || '. ' || question, chr(10) ORDER BY item_seq)) AS numbered, md5(string_agg('- ' || question, chr(10) ORDER BY item_seq)) AS bullets FROM r GROUP BY 1",
    "thinking_removed": f"SELECT item_seq, regexp_replace('<think>' || coalesce(context, '') || '</think>' || chr(10) || ' ' || question, '(?s)<think>.*?</think>[{X.SPACE}]*', '', 'g') AS text FROM qa_raw",
    "repaired_replies": "SELECT item_seq, question, answer FROM qa_raw",
    "event_verdicts": "SELECT coalesce(CAST(json_extract_string(props, '$.k') AS VARCHAR), 'none') AS verdict, event_type, count(*) AS events FROM events GROUP BY 1, 2",
    "normalized_questions": f"SELECT item_seq, md5({_NORMAL}) AS digest FROM qa_raw",
    "generated_items": """WITH c AS (SELECT DISTINCT chunk_id FROM chunks), p AS (SELECT unnest([0, 1]) AS place)
SELECT chunk_id, CAST(place AS INT) AS place, '{"question": "' || md5((place + 1) || chunk_id) || '", "answer": "A"}' AS item, 'stub-1' AS generation_model, CAST(4 AS INT) AS total_iterations, CAST(2 AS INT) AS total_questions FROM c, p""",
    "judged_records": "SELECT item_seq, CASE WHEN contains(concat_ws(chr(10), question, answer), 'SCADA') THEN 'not_supported' ELSE 'fully_supported' END AS classification, CAST(floor(length(concat_ws(chr(10), question, answer)) / 3.5) AS INT) AS prompt_tokens FROM qa_raw",
    "usage_report": """SELECT generation_model AS model, count(*) AS calls, CAST(sum(length(context)) AS BIGINT) AS prompt_tokens, CAST(sum(length(answer)) AS BIGINT) AS completion_tokens,
round((sum(length(context)) * CASE WHEN contains(coalesce(generation_model, ''), 'flash-lite') THEN 0.1::DOUBLE WHEN contains(coalesce(generation_model, ''), 'flash') THEN 0.3::DOUBLE WHEN contains(coalesce(generation_model, ''), 'pro') THEN 1.25::DOUBLE ELSE 0.25::DOUBLE END
+ sum(length(answer)) * CASE WHEN contains(coalesce(generation_model, ''), 'flash-lite') THEN 0.4::DOUBLE WHEN contains(coalesce(generation_model, ''), 'flash') THEN 2.5::DOUBLE WHEN contains(coalesce(generation_model, ''), 'pro') THEN 10.0::DOUBLE ELSE 1.5::DOUBLE END) / 1e6::DOUBLE, 6) AS cost FROM qa_raw GROUP BY 1""",
    "tag_ranking": "WITH t AS (SELECT train_id, unnest(tags) AS tag, unnest(range(len(tags))) AS place FROM train_split) SELECT tag, count(*) AS count, min(train_id) AS first_seen FROM t WHERE tag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, min(struct_pack(o := train_id, a := place)) LIMIT 30",
    "tags_merged": "SELECT train_id, array_to_string(list_transform(tags, lambda t: CASE t WHEN 'safety' THEN 'السلامة' WHEN 'billing' THEN 'الفواتير' WHEN 'metering' THEN 'العدادات' ELSE t END), '|') AS tags FROM train_split",
    "cluster_counts": _counts_sql("cluster_id"),
    "difficulty_counts": _counts_sql("difficulty"),
    "category_counts": _counts_sql("category"),
    "source_counts": _counts_sql("source_file"),
    "split_report": """WITH a AS (SELECT count(*) FILTER (WHERE NOT coalesce(is_eval_mirror, false)) AS t, count(*) FILTER (WHERE coalesce(is_eval_mirror, false)) AS m FROM train_split), b AS (SELECT count(*) AS e, count(*) FILTER (WHERE coalesce(rephrase_failed, false)) AS f FROM eval_split), c AS (SELECT count(DISTINCT cluster_id) AS n FROM (SELECT cluster_id FROM train_split UNION ALL SELECT cluster_id FROM eval_split))
SELECT t + e AS total_items, t AS train_items, e AS eval_items, m AS eval_mirrors, f AS rephrase_failures, n AS clusters_found FROM a, b, c""",
    "sampled_items": "SELECT item_seq FROM qa_raw QUALIFY row_number() OVER (ORDER BY md5('42:' || CAST(item_seq AS VARCHAR)), item_seq) <= greatest(1, (SELECT count(*) FROM qa_raw) * 15 // 100)",
    "allocations": f"WITH {_ALLOCATED} SELECT cluster_id, size, allocated FROM n",
    "stratified_split": f"WITH {_PICKED} SELECT train_id FROM u WHERE k <= allocated",
    "train_remainder": f"WITH {_PICKED} SELECT train_id, CASE WHEN k <= allocated THEN 'eval' ELSE 'train' END AS split FROM u",
    "eval_mirror": "SELECT eval_id, md5(original_question) AS q, md5(question) AS rq, md5(answer) AS ra FROM eval_split",
    "final_train": "SELECT train_id, false AS is_eval_mirror, md5(question) AS question, md5(answer) AS answer FROM train_split UNION ALL SELECT eval_id, true, md5(question), md5(answer) FROM mirror_split",
}
