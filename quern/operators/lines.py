"""Documents as lines: code, repeated lines, noise, headings, tables.

Every operator takes lines as `exploded` gives them (doc, line_no, raw, key) and keeps other columns.  Lines of one
document meet in windows by document; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from quern.functions.text import SPACE, strip, unix_lines

# Lines that are noise of a scan, as patterns.
SCAN_NOISE = [
    r"^\d+$",
    r"^[-|_*+]$",
    r"^\d+\s*\(.*\)$",
    r"^\d+\s*\|",
    r"^\d{1,3}\s+[\x{0600}-\x{06FF}]",
    r"^[\x{0600}-\x{06FF}][\x{0600}-\x{06FF}\s]+\|\s*\d{1,3}\s*$",
    r"^[\x{0600}-\x{06FF}][\x{0600}-\x{06FF}\s]+\d{1,3}\s*$",
    r"^The page features\b",
    r"^\[The (image|page|document)\b",
    r"^Image:|^Icon:|^Figure:|^Photo:|^Graphic:",
    r"^SERA\s+(logo|-)",
    r"^[-*]\s+(An?|The)\b.*\b(tower|lines|utilities|gear|sign|unit|charging|cable|outlet|equipment|plug|ambulance|hazard|shock|gloves|helmet|ladder|fence|panel|meter|transformer|generator|circuit|wire|pole|substation)\b",
]
HEADING = f"^(#{{1,6}})[{SPACE}]+(.+)$"
RULE = f"^[-*_]{{3,}}[{SPACE}]*$"
IMAGE = r"^!\[.*\]"
LIST_ITEM = rf"^[-*][{SPACE}]+|^\p{{Nd}}+\.[{SPACE}]+"


def unicode_classes(pattern: str) -> str:
    """A pattern whose \\d and \\s take the digits and white space of all scripts, in Java as in RE2."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = pattern[i : i + 2]
        if c in ("\\d", "\\s"):
            body = "\\p{Nd}" if c == "\\d" else SPACE
            out.append(body if inside else f"[{body}]")
            i += 2
            continue
        if c[0] == "\\":
            out.append(c)
            i += 2
            continue
        inside = True if c[0] == "[" else False if c[0] == "]" else inside
        out.append(c[0])
        i += 1
    return "".join(out)


def by_doc() -> W:
    return W.partitionBy("doc").orderBy("line_no")


def exploded(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, line_no, raw, key): the lines of each text; key is the line without white space at its ends.

    A null text has no lines, the empty text one empty line.  Documents need unique names.
    """
    parts = df.select(F.col(doc).alias("doc"), F.posexplode(F.split(unix_lines(F.col(text)), "\n", -1)).alias("line_no", "raw"))
    return parts.withColumn("key", strip(F.col("raw")))


def without_code(lines: DataFrame) -> DataFrame:
    """Without fenced code and its fences; an unclosed fence drops the rest of the document."""
    fence = F.startswith("key", F.lit("```"))
    opened = F.sum(fence.cast("int")).over(by_doc())
    return lines.withColumns({"__fence": fence, "__opened": opened}).where(~F.col("__fence") & (F.col("__opened") % 2 == 0)).drop("__fence", "__opened")


def without_repeats(lines: DataFrame, threshold: int = 4) -> DataFrame:
    """Without lines that occur `threshold` times or more in their document; blank lines and lines that begin with
    <, # or | stay.  0 turns it off.

    Counts are summed before the shuffle and joined back, so that a long document is no single task.
    """
    if threshold <= 0:
        return lines
    counted = (F.col("key") != "") & ~F.col("key").rlike(r"^[<#|]")
    often = lines.where(counted).groupBy("doc", "key").count().where(F.col("count") >= threshold).select("doc", "key")
    return lines.join(often, ["doc", "key"], "left_anti").select(*lines.columns)


def without_boilerplate(lines: DataFrame, boilerplate: list[str]) -> DataFrame:
    """Without lines equal to an entry of the list."""
    return lines.where(~F.col("key").isin([*boilerplate])) if boilerplate else lines


def preprocessed(lines: DataFrame, threshold: int = 4, boilerplate: list[str] = (), code: bool = True) -> DataFrame:
    """Without code, repeats and boilerplate, in this order."""
    return without_boilerplate(without_repeats(without_code(lines) if code else lines, threshold), [*boilerplate])


def kind(key: Column, rules: bool = True, images: bool = True, noise: list[str] | None = None) -> Column:
    """blank, rule, image, noise, heading, list_item or text, the first that fits."""
    noise = [unicode_classes(p) for p in (SCAN_NOISE if noise is None else noise)]
    out = F.when(key == "", "blank")
    if rules:
        out = out.when(key.rlike(RULE), "rule")
    if images:
        out = out.when(key.rlike(IMAGE), "image")
    if noise:
        out = out.when(key.rlike("|".join(f"(?:{p})" for p in noise)), "noise")
    return out.when(key.rlike(HEADING), "heading").when(key.rlike(LIST_ITEM), "list_item").otherwise("text")


def heading_paths(lines: DataFrame) -> DataFrame:
    """With `heading_level`, `heading_path` (titles from the top joined by ' > ') and `in_force` (the last heading's
    level).  A heading ends those of its own and lower ranks; lines before any heading have an empty path."""
    w = by_doc()
    level = F.length(F.regexp_extract("key", HEADING, 1))
    title = strip(F.regexp_extract("key", HEADING, 2))
    out = lines.withColumns({"heading_level": F.when(F.col("key").rlike(HEADING), level), "__title": title})
    # the last heading of each rank, with its place
    out = out.withColumns({f"__h{i}": F.last(F.when(F.col("heading_level") == i, F.struct("line_no", F.col("__title").alias("title"))), ignorenulls=True).over(w) for i in range(1, 7)})
    kept = []
    for i in range(1, 7):
        above = F.greatest(F.lit(-1), *[F.coalesce(F.col(f"__h{j}.line_no"), F.lit(-1)) for j in range(1, i)]) if i > 1 else F.lit(-1)
        kept.append(F.when(F.col(f"__h{i}.line_no") > above, F.col(f"__h{i}.title")))
    return out.withColumn("heading_path", F.concat_ws(" > ", *kept)).withColumn("in_force", F.last("heading_level", ignorenulls=True).over(w)).drop("__title", *[f"__h{i}" for i in range(1, 7)])


def pipe_tables(lines: DataFrame, min_rows: int = 3) -> DataFrame:
    """With `table_id`, the first line of the pipe table a line belongs to, or null.

    A table is a run of lines that begin and end with a pipe, of `min_rows` lines or more, one of which begins with a
    cell of spaces, dashes and colons.
    """
    w = by_doc()
    row = F.startswith("key", F.lit("|")) & F.endswith("key", F.lit("|"))
    out = lines.withColumn("__row", row)
    out = out.withColumn("__run", F.sum((~F.col("__row")).cast("int")).over(w))
    run = W.partitionBy("doc", "__run", "__row")
    ruled = F.max(F.col("key").rlike(r"^\|[\s\-:]+\|")).over(run)
    good = F.col("__row") & (F.count(F.lit(1)).over(run) >= min_rows) & ruled
    return out.withColumn("table_id", F.when(good, F.min("line_no").over(run))).drop("__row", "__run")


def html_tables(lines: DataFrame, min_rows: int = 3) -> DataFrame:
    """With `html_id`, the first line of the HTML table block a line belongs to, or null.

    A block goes from a line with <table to the first later line with </table>, or to the end; it needs `min_rows`
    lines with <tr.  Blocks don't overlap: openers inside a taken block don't count, those inside a refused one do.

    Openers with one closer form a group, and the first with enough rows takes it, as it covers the others.  Only an
    opener on the closer line of the group before (an edge) may lie inside a taken block.  A group with another opener
    is taken anyway; in a chain of groups that have edges alone, every second one is, counted from the last group
    that is certain.  So windows over lines and groups do without a sequential pass.
    """
    w = by_doc()
    later, upto = w.rowsBetween(1, W.unboundedFollowing), w.rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("doc")
    out = lines.withColumns({"__open": F.col("key").rlike(r"(?i)^<table[\s>]"), "__close": F.col("key").rlike(r"(?i)</table>"), "__tr": F.col("key").rlike(r"(?i)<tr[\s>]").cast("int")})
    none = F.max("line_no").over(whole) + 1
    out = out.withColumns({"__to": F.coalesce(F.min(F.when(F.col("__close"), F.col("line_no"))).over(later), none), "__rows": F.sum("__tr").over(upto)})
    # the running sums grow, so that of the next closer is the least of those at later closers
    at_close = F.coalesce(F.min(F.when(F.col("__close"), F.col("__rows"))).over(later), F.max("__rows").over(whole))
    able = out.withColumn("__n", at_close - F.col("__rows") + F.col("__tr")).where(F.col("__open") & (F.col("__n") >= min_rows))
    groups = able.groupBy("doc", "__to").agg(F.min(F.when(F.col("__close"), F.col("line_no"))).alias("edge"), F.min(F.when(~F.col("__close"), F.col("line_no"))).alias("inner"))
    g = W.partitionBy("doc").orderBy("__to")
    touches = F.coalesce(F.lag("__to").over(g) == F.col("edge"), F.lit(False))
    groups = groups.withColumns({"touches": touches, "nth": F.row_number().over(g)})
    groups = groups.withColumn("certain", F.when(F.col("inner").isNotNull() | ~F.col("touches"), F.col("nth")))
    groups = groups.withColumn("taken", (F.col("nth") - F.last("certain", ignorenulls=True).over(g)) % 2 == 0)
    free = F.col("edge").isNotNull() & ~(F.col("touches") & F.coalesce(F.lag("taken").over(g), F.lit(False)))
    starts = groups.withColumn("free", free).where("taken").select("doc", F.when(F.col("free"), F.col("edge")).otherwise(F.col("inner")).alias("line_no"), F.col("__to").alias("__end"))
    out = lines.join(starts, ["doc", "line_no"], "left")
    block = F.last(F.when(F.col("__end").isNotNull(), F.struct("line_no", F.col("__end").alias("to"))), ignorenulls=True).over(w)
    out = out.withColumn("__block", block)
    return out.withColumn("html_id", F.when(F.col("line_no") <= F.col("__block.to"), F.col("__block.line_no"))).select(*lines.columns, "html_id")


def tables(lines: DataFrame, min_rows: int = 3, heading: bool = True) -> tuple[DataFrame, DataFrame]:
    """(tables, remaining lines).  tables: doc, start_line, end_line (exclusive), preceding_heading, text.

    Pipe tables and HTML blocks; the last heading line outside any table goes before the text, with a blank line.
    """
    marked = html_tables(pipe_tables(lines, min_rows), min_rows)
    marked = marked.withColumn("__id", F.coalesce("table_id", "html_id"))
    outside = F.when(F.col("__id").isNull() & F.col("key").rlike(r"^#{1,6}\s+"), F.col("key"))
    marked = marked.withColumn("__heading", F.last(outside, ignorenulls=True).over(by_doc()))
    found = marked.where("__id is not null").groupBy("doc", F.col("__id").alias("start_line")).agg(
        (F.max("line_no") + 1).alias("end_line"), F.first("__heading").alias("preceding_heading"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "raw"))), lambda x: x["raw"]), "\n").alias("__text"),
    )
    text = F.when(F.col("preceding_heading").isNotNull(), F.concat("preceding_heading", F.lit("\n\n"), "__text")).otherwise(F.col("__text")) if heading else F.col("__text")
    found = found.select("doc", "start_line", "end_line", F.coalesce("preceding_heading", F.lit("")).alias("preceding_heading"), text.alias("text"))
    return found, marked.where("__id is null").select(*lines.columns)


def joined(lines: DataFrame) -> DataFrame:
    """(doc, text): the lines of each document as one text again."""
    return lines.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "raw"))), lambda x: x["raw"]), "\n").alias("text"))
