"""Queries on documents, lines, sentences and chunks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators import chunking, lines, sentences
from quern.shared import table

SPACE = X.SPACE


def _chunk_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.exploded(table(spark, folder, "chunks").select("chunk_id", "chunk_text").distinct(), "chunk_id", "chunk_text")


def _document_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.exploded(table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text"), "doc_id", "text")


def _sql_lines(source: str) -> str:
    return rf"""WITH d AS ({source}),
p AS (SELECT doc, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS a FROM d WHERE text IS NOT NULL),
l AS (SELECT doc, unnest(range(len(a))) AS line_no, unnest(a) AS raw FROM p),
k AS (SELECT *, regexp_replace(raw, '^[{SPACE}]+|[{SPACE}]+$', '', 'g') AS key FROM l)"""


_CHUNK_SQL = _sql_lines("SELECT DISTINCT chunk_id AS doc, chunk_text AS text FROM chunks")
_DOCUMENT_SQL = _sql_lines("SELECT CAST(doc_id AS VARCHAR) AS doc, text FROM documents")
_CODE_SQL = """f AS (SELECT *, starts_with(key, '```') AS fence, sum(CAST(starts_with(key, '```') AS INT)) OVER (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS opened FROM k),
c AS (SELECT doc, line_no, raw, key FROM f WHERE NOT fence AND opened % 2 = 0)"""
_REPEAT_SQL = """r AS (SELECT doc, key FROM c WHERE key <> '' AND NOT regexp_matches(key, '^[<#|]') GROUP BY doc, key HAVING count(*) >= 4),
w AS (SELECT c.* FROM c LEFT JOIN r USING (doc, key) WHERE r.doc IS NULL)"""


def lines_without_code(spark, folder):
    return lines.without_code(_chunk_lines(spark, folder)).select("doc", F.col("line_no").cast("long").alias("line_no"), "key")


def lines_without_repeats(spark, folder):
    return lines.without_repeats(_document_lines(spark, folder)).select("doc", F.col("line_no").cast("long").alias("line_no"), "key")


def boilerplate_removed(spark, folder):
    kept = lines.without_boilerplate(_document_lines(spark, folder), ["Related pages", "روابط ذات صلة"])
    return kept.select("doc", F.col("line_no").cast("long").alias("line_no"), "key")


def preprocessed_documents(spark, folder):
    return lines.joined(lines.preprocessed(_document_lines(spark, folder))).select("doc", F.md5("text").alias("digest"), F.length("text").alias("chars"))


def line_kinds(spark, folder):
    return _chunk_lines(spark, folder).select("doc", F.col("line_no").cast("long").alias("line_no"), lines.kind(F.col("key")).alias("kind"))


def heading_paths(spark, folder):
    out = lines.heading_paths(lines.without_code(_chunk_lines(spark, folder)))
    return out.where("heading_path <> ''").select("doc", F.col("line_no").cast("long").alias("line_no"), "heading_path")


def pipe_tables(spark, folder):
    out = lines.pipe_tables(_chunk_lines(spark, folder)).where("table_id is not null")
    return out.groupBy("doc", F.col("table_id").cast("long").alias("start_line")).agg(F.count(F.lit(1)).alias("rows"))


def extracted_tables(spark, folder):
    found, _ = lines.tables(_chunk_lines(spark, folder))
    return found.select("doc", *[F.col(c).cast("long").alias(c) for c in ("start_line", "end_line")], "preceding_heading", "text")


def table_lines_removed(spark, folder):
    return lines.tables(_chunk_lines(spark, folder))[1].select("doc", F.col("line_no").cast("long").alias("line_no"), "key")


def sentence_split(spark, folder):
    rows = _document_lines(spark, folder).where("key <> ''").select("doc", F.col("line_no").cast("long").alias("line_no"), F.posexplode(sentences.sentences_of(F.col("key"), [])).alias("at", "sentence"))
    return rows.select("doc", "line_no", F.col("at").cast("long").alias("at"), "sentence")


def sentences_of_chunks(spark, folder):
    out = sentences.sentences(lines.without_code(_chunk_lines(spark, folder)))
    return out.withColumns({c: F.col(c).cast("long") for c in ("line_no", "at", "heading_level")})


def chunk_documents(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc"), "text")
    return chunking.chunk_documents(docs, "doc", "text", chunking.Chunking(min_tokens=60, max_tokens=200))


def token_counts(spark, folder):
    n = X.tokens_by_ratio(F.col("chunk_text"))
    return table(spark, folder, "chunks").select("chunk_id", n.alias("measured"), (F.coalesce("token_count", F.lit(-1)) != n).alias("stale")).distinct()


def summary_input(spark, folder):
    n = X.tokens_by_ratio(F.col("text"))
    return table(spark, folder, "documents").where("text is not null").select("doc_id", F.length(X.truncated_to_tokens(F.col("text"), n, 200)).alias("chars"))


def summary_lookup(spark, folder):
    from quern.plans.stages import with_summaries

    chunks = table(spark, folder, "chunks").select("chunk_id", "source_file").distinct()
    return with_summaries(chunks, table(spark, folder, "summaries")).select("chunk_id", "document_summary")


def pending_chunks(spark, folder):
    from quern.plans.stages import pending

    return pending(table(spark, folder, "chunks").select("chunk_id", "source_file").distinct(), table(spark, folder, "qa_raw").where("chunk_id is not null"))


def prompts(spark, folder):
    t = "File: {file}\nSection: {section}\nText: {text} {other}"
    cols = {"file": F.col("source_file"), "section": F.col("section_hierarchy"), "text": F.col("chunk_text")}
    return table(spark, folder, "chunks").select("chunk_id", F.md5(X.rendered(t, cols)).alias("digest")).distinct()


def _kind_case() -> str:
    noise = "|".join(f"(?:{lines.unicode_classes(p)})" for p in lines.SCAN_NOISE)
    return f"""CASE WHEN key = '' THEN 'blank' WHEN regexp_matches(key, '{lines.RULE}') THEN 'rule' WHEN regexp_matches(key, '{lines.IMAGE}') THEN 'image'
WHEN regexp_matches(key, '{noise}') THEN 'noise' WHEN regexp_matches(key, '{lines.HEADING}') THEN 'heading' WHEN regexp_matches(key, '{lines.LIST_ITEM}') THEN 'list_item' ELSE 'text' END"""


def _paths(source: str) -> str:
    """Common table expressions t and h: headings, and the path of each line of `source` (doc, line_no, key)."""
    level = f"length(regexp_extract(key, '{lines.HEADING}', 1))"
    title = f"regexp_replace(regexp_extract(key, '{lines.HEADING}', 2), '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"
    last = ", ".join(f"last_value(CASE WHEN level = {i} THEN {{'n': line_no, 't': title}} END IGNORE NULLS) OVER w AS h{i}" for i in range(1, 7))
    keep = ", ".join(f"CASE WHEN h{i}.n > greatest(-1{''.join(f', coalesce(h{j}.n, -1)' for j in range(1, i))}) THEN h{i}.t END" for i in range(1, 7))
    return f"""t AS (SELECT *, {level} AS level, {title} AS title FROM {source}),
g AS (SELECT *, {last} FROM t WINDOW w AS (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
h AS (SELECT *, concat_ws(' > ', {keep}) AS heading_path FROM g)"""


def _split(column: str, source: str, abbreviations: list[str]) -> str:
    """Common table expressions up to s5: the sentences `a` of the column of each row of `source`."""
    entries = "|".join(re.escape(a.rstrip(".")).replace("'", "''") for a in sorted(abbreviations, key=len, reverse=True))
    mask = "x"
    for _ in range(2 if entries else 0):  # a match takes the sign before it, so neighbours need another turn
        mask = f"regexp_replace({mask}, '(?i)(^|[^{sentences._WORD[1:-1]}])({entries})\\.', '\\1\\2' || chr(2), 'g')"
    return rf"""s0 AS (SELECT *, regexp_replace({column}, '[\x01\x02]', '', 'g') AS x FROM {source}),
s1 AS (SELECT * REPLACE (regexp_replace({mask}, '([0-9])\.([0-9])', '\1' || chr(2) || '\2', 'g') AS x) FROM s0),
s2 AS (SELECT * REPLACE (regexp_replace(x, '((?:https?://|www\.)\S*)\.(\s|$)', '\1' || chr(2) || '\2', 'g') AS x) FROM s1),
s3 AS (SELECT * REPLACE (regexp_replace(x, '([.!?؟۔])([.!?؟۔])(?:[{SPACE}]+|$)', '\1' || chr(1) || '\2' || chr(1), 'g') AS x) FROM s2),
s4 AS (SELECT *, string_split(regexp_replace(x, '([.!?؟۔])(?:[{SPACE}]+|$)', '\1' || chr(1), 'g'), chr(1)) AS parts FROM s3),
s5 AS (SELECT *, list_filter(list_transform(parts, lambda v: regexp_replace(replace(v, chr(2), '.'), '^[{SPACE}]+|[{SPACE}]+$', '', 'g')), lambda v: v <> '') AS a FROM s4)"""


_SENTENCE_SQL = f"""{_DOCUMENT_SQL}, own AS (SELECT doc, line_no, key FROM k WHERE key <> ''), {_split('key', 'own', [])}
SELECT doc, line_no, unnest(range(len(a))) AS at, unnest(a) AS sentence FROM s5"""
_CHUNK_SENTENCES = f"""{_CHUNK_SQL}, {_CODE_SQL}, y AS (SELECT doc, line_no, key, {_kind_case()} AS kind FROM c), z AS (SELECT * FROM y WHERE kind NOT IN ('blank', 'rule', 'image', 'noise')), {_paths('z')},
{_split('key', 'h', sentences.ABBREVIATIONS)}, f1 AS (SELECT doc, line_no, kind, level, heading_path, CASE WHEN kind = 'text' THEN a ELSE [key] END AS a FROM s5)
SELECT doc, line_no, unnest(range(len(a))) AS at, unnest(a) AS sentence, kind = 'heading' AS is_heading, CASE WHEN kind = 'heading' THEN CAST(level AS BIGINT) END AS heading_level, heading_path FROM f1"""
# tables: runs of pipe rows, and HTML blocks, each from an opener to the next closer; pointers lead from a block to the
# first opener after it, so that only blocks that a reader from the top would take are reached
def _tables(k: str) -> str:
    """Common table expressions up to n: the lines of `k` with the table that each belongs to, and the heading before."""
    return rf"""pr AS (SELECT *, starts_with(key, '|') AND ends_with(key, '|') AS bar FROM {k}),
pg AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc, bar ORDER BY line_no) AS g FROM pr),
pt AS (SELECT doc, g, min(line_no) AS a, max(line_no) AS b FROM pg WHERE bar GROUP BY doc, g HAVING count(*) >= 3 AND bool_or(regexp_matches(key, '^\|[\s\-:]+\|'))),
ho AS (SELECT doc, line_no AS o FROM {k} WHERE regexp_matches(key, '(?i)^<table[\s>]')),
he AS (SELECT ho.doc, o, coalesce((SELECT min(line_no) FROM {k} x WHERE x.doc = ho.doc AND x.line_no > o AND regexp_matches(x.key, '(?i)</table>')), (SELECT max(line_no) FROM {k} x WHERE x.doc = ho.doc)) AS e FROM ho),
hv AS (SELECT doc, o, e FROM he WHERE (SELECT count(*) FROM {k} x WHERE x.doc = he.doc AND x.line_no BETWEEN o AND e AND regexp_matches(x.key, '(?i)<tr[\s>]')) >= 3),
hn AS (SELECT v.doc, v.o, v.e, (SELECT min(o) FROM hv x WHERE x.doc = v.doc AND x.o > v.e) AS nxt FROM hv v),
ht AS (SELECT doc, o, e, nxt FROM hn WHERE (doc, o) IN (SELECT (doc, min(o)) FROM hv GROUP BY doc) UNION ALL SELECT hn.doc, hn.o, hn.e, hn.nxt FROM ht JOIN hn ON hn.doc = ht.doc AND hn.o = ht.nxt),
m AS (SELECT l.doc, l.line_no, l.raw, l.key, coalesce(pt.a, ht.o) AS id FROM {k} l LEFT JOIN pt ON pt.doc = l.doc AND l.line_no BETWEEN pt.a AND pt.b LEFT JOIN ht ON ht.doc = l.doc AND l.line_no BETWEEN ht.o AND ht.e),
n AS (SELECT *, last_value(CASE WHEN id IS NULL AND regexp_matches(key, '^#{{1,6}}\s+') THEN key END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS heading FROM m),
tx AS (SELECT doc, id AS start_line, max(line_no) + 1 AS end_line, coalesce(arg_min(heading, line_no), '') AS preceding_heading, string_agg(raw, chr(10) ORDER BY line_no) AS body FROM n WHERE id IS NOT NULL GROUP BY doc, id),
tb AS (SELECT doc, start_line, end_line, preceding_heading, CASE WHEN preceding_heading <> '' THEN preceding_heading || chr(10) || chr(10) || body ELSE body END AS text FROM tx)"""


_TABLES = f"{_CHUNK_SQL.replace('WITH d AS', 'WITH RECURSIVE d AS', 1)}, {_tables('k')}"


def _chunks_sql(least: int, most: int) -> str:
    """The fold of sentences to chunks, one sentence of every document a turn."""
    size = lambda x: f"CAST(floor(length({x}) / 3.5) AS BIGINT)"
    held = "array_to_string(fr.held, chr(10))"
    at_break = "coalesce(s.level, 0) IN (1, 2, 3)"
    closed = f"(len(fr.held) > 0 AND CASE WHEN {at_break} THEN {size(held)} >= {least} ELSE fr.tokens + s.n > {most} END)"
    rest = lambda c: f"CASE WHEN {closed} THEN CASE WHEN {at_break} THEN CAST([] AS VARCHAR[]) ELSE fr.{c}[-2:] END ELSE fr.{c} END"
    return f"""{_DOCUMENT_SQL.replace('WITH d AS', 'WITH RECURSIVE d AS', 1)}, {_CODE_SQL}, {_REPEAT_SQL},
kk AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY line_no) - 1 AS line_no, raw, key FROM w), {_tables('kk')},
y AS (SELECT doc, line_no, key, {_kind_case()} AS kind FROM n WHERE id IS NULL), z AS (SELECT * FROM y WHERE kind NOT IN ('blank', 'rule', 'image', 'noise')), {_paths('z')},
{_split('key', 'h', sentences.ABBREVIATIONS)}, f1 AS (SELECT doc, line_no, kind, level, heading_path, CASE WHEN kind = 'text' THEN a ELSE [key] END AS a FROM s5),
f2 AS (SELECT doc, line_no, kind, level, heading_path, unnest(range(len(a))) AS place, unnest(a) AS sentence FROM f1),
st AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY line_no, place) AS i, sentence, CASE WHEN kind = 'heading' THEN level END AS level, heading_path AS own, {size('sentence')} AS n FROM f2),
fr AS (SELECT DISTINCT doc, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS held, CAST([] AS VARCHAR[]) AS hp, CAST(0 AS BIGINT) AS tokens, '' AS path, CAST(NULL AS VARCHAR) AS out_text, CAST(NULL AS VARCHAR) AS out_path FROM st UNION ALL
SELECT fr.doc, s.i, list_concat({rest('held')}, [s.sentence]), list_concat({rest('hp')}, [s.own]),
CASE WHEN {at_break} THEN s.n WHEN {closed} THEN s.n + coalesce(list_sum(list_transform(fr.held[-2:], lambda v: {size('v')})), 0) ELSE fr.tokens + s.n END,
CASE WHEN {at_break} THEN s.own ELSE fr.path END, CASE WHEN {closed} THEN {held} END, CASE WHEN {closed} THEN coalesce(nullif(fr.hp[1], ''), fr.path) END
FROM fr JOIN st s ON s.doc = fr.doc AND s.i = fr.i + 1),
fe AS (SELECT doc, i, out_text AS text, out_path AS path FROM fr WHERE out_text IS NOT NULL),
ft AS (SELECT doc, i + 1 AS i, array_to_string(held, chr(10)) AS text, coalesce(nullif(hp[1], ''), path) AS path FROM fr QUALIFY row_number() OVER (PARTITION BY doc ORDER BY i DESC) = 1),
fl AS (SELECT ft.*, (SELECT max(i) FROM fe WHERE fe.doc = ft.doc) AS last, {size('text')} < {least} AS short FROM ft),
fb AS (SELECT fe.doc, fe.i, CASE WHEN fl.short AND fl.last = fe.i THEN fe.text || chr(10) || fl.text ELSE fe.text END AS text, fe.path FROM fe JOIN fl USING (doc) UNION ALL SELECT doc, i, text, path FROM fl WHERE NOT (short AND last IS NOT NULL)),
fo AS (SELECT doc, 0 AS part, start_line AS i, text, regexp_replace(preceding_heading, '^#+\\s*', '') AS path FROM tb UNION ALL SELECT doc, 1, i, text, path FROM fb),
fq AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY part, i) - 1 AS k FROM fo)
SELECT doc || '__chunk_' || k AS chunk_id, text AS chunk_text, doc AS source_file, path AS section_hierarchy, CAST({size('text')} AS INT) AS token_count, part = 0 AS contains_table, CAST(k AS INT) AS chunk_index, part = 0 AND {size('text')} > {most} AS is_oversized FROM fq"""


QUERIES = {f.__name__: f for f in (lines_without_code, lines_without_repeats, boilerplate_removed, preprocessed_documents, line_kinds, heading_paths, pipe_tables, extracted_tables, table_lines_removed, sentence_split, sentences_of_chunks, chunk_documents, token_counts, summary_input, summary_lookup, pending_chunks, prompts)}
SQL = {
    "lines_without_code": f"{_CHUNK_SQL}, {_CODE_SQL} SELECT doc, line_no, key FROM c",
    "lines_without_repeats": f"{_DOCUMENT_SQL}, c AS (SELECT * FROM k), {_REPEAT_SQL} SELECT doc, line_no, key FROM w",
    "boilerplate_removed": f"{_DOCUMENT_SQL} SELECT doc, line_no, key FROM k WHERE key NOT IN ('Related pages', 'روابط ذات صلة')",
    "extracted_tables": f"{_TABLES} SELECT doc, start_line, end_line, preceding_heading, text FROM tb",
    "chunk_documents": _chunks_sql(60, 200),
    "table_lines_removed": f"{_TABLES} SELECT doc, line_no, key FROM n WHERE id IS NULL",
    "sentences_of_chunks": _CHUNK_SENTENCES,
    "preprocessed_documents": f"{_DOCUMENT_SQL}, {_CODE_SQL}, {_REPEAT_SQL}, t AS (SELECT doc, string_agg(raw, chr(10) ORDER BY line_no) AS text FROM w GROUP BY doc) SELECT doc, md5(text) AS digest, CAST(length(text) AS INT) AS chars FROM t",
    "line_kinds": f"{_CHUNK_SQL} SELECT doc, line_no, {_kind_case()} AS kind FROM k",
    "heading_paths": f"{_CHUNK_SQL}, {_CODE_SQL}, {_paths('c')} SELECT doc, line_no, heading_path FROM h WHERE heading_path <> ''",
    "pipe_tables": rf"""{_CHUNK_SQL}, t AS (SELECT *, starts_with(key, '|') AND ends_with(key, '|') AS row FROM k),
g AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc, row ORDER BY line_no) AS g FROM t)
SELECT doc, min(line_no) AS start_line, count(*) AS rows FROM g WHERE row GROUP BY doc, g HAVING count(*) >= 3 AND bool_or(regexp_matches(key, '^\|[\s\-:]+\|'))""",
    "sentence_split": _SENTENCE_SQL,
    "token_counts": "SELECT DISTINCT chunk_id, CAST(floor(length(chunk_text) / 3.5) AS INT) AS measured, coalesce(token_count, -1) <> CAST(floor(length(chunk_text) / 3.5) AS INT) AS stale FROM chunks",
    "summary_input": "WITH t AS (SELECT doc_id, length(text) AS n, CAST(floor(length(text) / 3.5) AS INT) AS k FROM documents WHERE text IS NOT NULL) SELECT doc_id, CAST(CASE WHEN k > 200 THEN floor(n * (200.0::DOUBLE / k)) ELSE n END AS INT) AS chars FROM t",
    "summary_lookup": "SELECT DISTINCT c.chunk_id, coalesce(nullif(s.summary, ''), 'No summary available.') AS document_summary FROM chunks c LEFT JOIN summaries s USING (source_file)",
    "pending_chunks": "SELECT DISTINCT chunk_id, source_file FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM qa_raw q WHERE q.chunk_id = c.chunk_id)",
    "prompts": "SELECT DISTINCT chunk_id, md5('File: ' || coalesce(source_file, '') || chr(10) || 'Section: ' || coalesce(section_hierarchy, '') || chr(10) || 'Text: ' || coalesce(chunk_text, '') || ' {other}') AS digest FROM chunks",
}
