"""The four stages as plans with their sinks, and a runner that keeps and skips stages that are done."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.replies import verdict
from quern.functions.text import listed_of, rendered
from quern.operators import clustering, dedup, judging, reports, sampling, tags, validation
from quern.operators.chunking import Chunking, chunk_documents
from quern.operators.neighbours import similar_vectors
from quern.providers import GENERATED, embedded, generated, mapped
from quern.shared import cut
from quern.sources.files import save_report, there

#: Where a record may go out, in the order of the checks.
STAGES = ["structural", "grounding", "dialect", "dialect_judge", "exact_duplicate", "fuzzy_duplicate", "semantic_duplicate"]


@dataclass(frozen=True)
class Cleaning:
    """Settings of the cleaning stage."""

    fuzzy_threshold: float = 0.85
    semantic_threshold: float = 0.92
    neighbours: int = 20
    dialect_percent: int = 15
    dialect_least: float = 4
    tag_threshold: float = 0.85
    grounding_actions: dict = field(default_factory=lambda: {"fully_supported": "keep", "partially_supported": "keep", "not_supported": "discard"})


def chunks(documents: DataFrame, settings: Chunking = Chunking()) -> DataFrame:
    """Stage 1: (source_file, text) to chunks."""
    return chunk_documents(documents, "source_file", "text", settings)


def pending(chunk_table: DataFrame, done: DataFrame) -> DataFrame:
    """Chunks that are not in the checkpoint."""
    return chunk_table.join(done.select("chunk_id").distinct(), "chunk_id", "left_anti")


def with_summaries(chunk_table: DataFrame, summaries: DataFrame, default: str = "No summary available.") -> DataFrame:
    """Chunks with the summary of their file, or the default where there is none or an empty one."""
    s = summaries.select("source_file", F.when(F.col("summary") != "", F.col("summary")).alias("document_summary"))
    return chunk_table.join(s, "source_file", "left").withColumn("document_summary", F.coalesce("document_summary", F.lit(default)))


def cleaned(raw: DataFrame, order: str = "item_seq", settings: Cleaning = Cleaning(), provider_of: Callable[[], object] | None = None) -> DataFrame:
    """Stage 3: raw records with `discard_stage` and `discard_reason` (null for those that stay), dialect counts and,
    where a provider is given, `grounding_classification` and merged `tags`.  Each check runs over what the ones before
    have left; with a provider a sample is judged for its dialect."""
    names = raw.columns

    def out(marked: DataFrame, stage: str) -> DataFrame:
        return marked.where("__reason is not null").select(*left.columns, F.lit(stage).alias("discard_stage"), F.col("__reason").alias("discard_reason"))

    left = raw
    gone = []
    marked = left.withColumn("__reason", validation.structural_reason())
    gone.append(out(marked, "structural"))
    left = marked.where("__reason is null").drop("__reason")
    if provider_of:
        prompt = rendered(judging.GROUNDING, {"chunk_text": F.col("context"), "question": F.col("question"), "answer": F.col("answer")})
        asked = cut(mapped(left.withColumn("__prompt", prompt), "__prompt", provider_of), "grounding")
        found = verdict(F.when(F.col("reply.success"), F.col("reply.text")), "classification", "fully_supported")
        left = validation.with_action(asked.withColumn("grounding_classification", found), "grounding_classification", settings.grounding_actions).drop("__prompt", "reply")
        marked = left.withColumn("__reason", F.when(F.col("action") == "discard", F.concat(F.lit("grounding_"), "grounding_classification")))
        gone.append(out(marked, "grounding").drop("action"))
        left = marked.where("__reason is null").drop("__reason", "action")
    left = validation.with_dialect(left)
    marked = left.withColumnRenamed("dialect_reason", "__reason")
    left = marked.drop("__reason")
    gone.append(out(marked, "dialect"))
    left = cut(marked.where("__reason is null").drop("__reason"), "dialect")
    if provider_of:
        judged = cut(judging.dialect_judged(left, order, provider_of, percent=settings.dialect_percent, least=settings.dialect_least), "dialect_judge")
        marked = judged.withColumn("__reason", F.when(F.col("dialect_failed"), F.lit("llm_dialect_check_failed"))).drop("dialect_score", "dialect_failed")
        gone.append(out(marked, "dialect_judge"))
        left = cut(judging.tagged(marked.where("__reason is null").drop("__reason"), provider_of), "tags")
    for stage, mark in (
        ("exact_duplicate", lambda d: dedup.exact(d, order, "question").withColumn("__reason", F.when(F.col("duplicate_of").isNotNull(), F.lit("exact_duplicate"))).drop("duplicate_of")),
        ("fuzzy_duplicate", lambda d: dedup.fuzzy(d, order, "question", "answer", settings.fuzzy_threshold).withColumn("__reason", F.when(F.col("removed"), F.lit("fuzzy_duplicate"))).drop("removed")),
        ("semantic_duplicate", lambda d: semantic(d, order, settings).withColumn("__reason", F.when(F.col("removed"), F.lit("semantic_duplicate"))).drop("removed")),
    ):
        marked = cut(mark(left), stage)
        gone.append(out(marked, stage))
        left = marked.where("__reason is null").drop("__reason")
    if "tags" in left.columns:
        left = tags.merged(left, order, "tags", cut(tags.merged_into(left, order, "tags", settings.tag_threshold), "merged"))
    result = left.withColumns({"discard_stage": F.lit(None).cast("string"), "discard_reason": F.lit(None).cast("string")})
    for g in gone:
        result = result.unionByName(g, allowMissingColumns=True)
    return result.select(*names, *[c for c in result.columns if c not in names])


def semantic(df: DataFrame, order: str, settings: Cleaning = Cleaning(), vectors: DataFrame | None = None) -> DataFrame:
    """With `removed`: whether the greedy run over similar vectors removes the record; the longer criteria stay."""
    v = vectors if vectors is not None else embedded(df.select(F.col(order).alias("item_seq"), "question"), "question").select("item_seq", "vec")
    edges = dedup.ranked_edges(similar_vectors(v, "item_seq", "vec", settings.semantic_threshold), settings.neighbours)
    weights = df.select(F.col(order).alias("node"), F.coalesce(F.length("evaluation_criteria"), F.lit(0)).alias("weight"))
    gone = dedup.greedy(edges, weights)
    return df.join(gone.select(F.col("node").alias(order), F.lit(True).alias("__gone")), order, "left").withColumn("removed", F.coalesce("__gone", F.lit(False))).drop("__gone").select(*df.columns, "removed")


def evaluated(records: DataFrame, labels: DataFrame, order: str = "item_seq", stratum: str = "difficulty") -> tuple[DataFrame, DataFrame]:
    """Stage 4: (train, evaluation) of records with their cluster."""
    return sampling.split(records.drop("cluster_id").join(labels.select(order, "cluster_id"), order), order, stratum)


def summaries_of(documents: DataFrame, provider_of: Callable[[], object], **settings) -> DataFrame:
    """(source_file, summary) of each document (source_file, text)."""
    return judging.summarized(documents, "source_file", "text", provider_of, **settings)


#: Templates of the generation's prompts.
INITIAL = "Write question and answer pairs on the text as a JSON array.\nFile: {source_file}\nSummary: {document_summary}\nSection: {section_hierarchy}\n\n{chunk_text}"
FOLLOWUP = "Write more pairs on the text, none of these again; reply with [] where there are none.\n{existing_questions}\n\n{chunk_text}"


def generation_prompt(initial: str = INITIAL, followup: str = FOLLOWUP, form: str = "numbered_list") -> Callable[[dict, str, list[str]], str]:
    """The prompt of a chunk: the initial one, or one that lists the questions so far."""

    def prompt(chunk: dict, kind: str, so_far: list[str]) -> str:
        template, values = (initial, chunk) if kind == "initial" else (followup, chunk | {"existing_questions": listed_of(so_far, form)})
        out = template
        for part in {p.split("}")[0] for p in template.split("{")[1:]}:
            out = out.replace("{" + part + "}", f"\0{part}\0")
        pieces = out.split("\0")  # values are put in once, whatever braces they hold
        return "".join(p if k % 2 == 0 else str(values.get(p) or "") for k, p in enumerate(pieces))

    return prompt


def generate(chunk_table: DataFrame, summaries: DataFrame, folder: str, provider_of: Callable[[], object], batch: int = 10_000, **settings) -> DataFrame:
    """Stage 2: the generated items of all chunks, kept under `folder` and resumed where a run broke off.

    Chunks that are not done are cut into batches by hash; each batch is written under a name of its own and then noted
    as done, failed chunks too.  A batch that broke off has no note, so its rows don't count and are made again.
    """
    spark = chunk_table.sparkSession
    done_at, raw_at = f"{folder}/done", f"{folder}/raw"
    left = chunk_table.dropDuplicates(["chunk_id"])
    if there(spark, done_at):
        left = pending(left, spark.read.parquet(done_at))
    left = cut(with_summaries(left, summaries), "pending")
    n = left.count()
    parts = -(-n // batch)
    for k in range(parts):
        own = left.where(F.pmod(F.xxhash64("chunk_id"), F.lit(parts)) == k)
        run = uuid.uuid4().hex
        generated(own, provider_of, generation_prompt(), columns=("document_summary",), **settings).where("item is not null").write.parquet(f"{raw_at}/run={run}")
        own.select("chunk_id", F.lit(run).alias("run")).write.mode("append").parquet(done_at)
    if not there(spark, raw_at):
        return spark.createDataFrame([], GENERATED)
    return spark.read.parquet(raw_at).join(spark.read.parquet(done_at).select("run").distinct(), "run", "left_semi").drop("run")


def records_of(items: DataFrame) -> DataFrame:
    """Generated items as records: the fields of each item's JSON, where it came from, and `item_seq`, a hash of the
    chunk and the item's place in it, which names and orders them."""
    fields = F.from_json("item", "struct<question:string,answer:string,evaluation_criteria:string,category:string,difficulty:string>")
    seq = F.shiftrightunsigned(F.xxhash64("chunk_id", "place"), 1).alias("item_seq")
    meta = F.struct("total_iterations", "total_questions", "timestamp").alias("generation_metadata")
    return items.select(seq, fields.alias("x"), "chunk_id", "source_file", "section_hierarchy", "context", "generation_model", meta).select("item_seq", "x.*", "chunk_id", "source_file", "section_hierarchy", "context", "generation_model", "generation_metadata")


def clean_to(raw: DataFrame, folder: str, order: str = "item_seq", settings: Cleaning = Cleaning(), provider_of: Callable[[], object] | None = None) -> tuple[DataFrame, DataFrame]:
    """Stage 3 with its sinks: (cleaned records, their vectors); cleaned, discarded, embeddings and report are kept
    under `folder` and read where they are there."""
    spark = raw.sparkSession
    at = lambda name: f"{folder}/{name}"
    if not (there(spark, at("cleaned")) and there(spark, at("embeddings"))):
        marked = cut(cleaned(raw, order, settings, provider_of), "marked")
        marked.where("discard_stage is null").drop("discard_stage", "discard_reason").write.mode("overwrite").parquet(at("cleaned"))
        marked.where("discard_stage is not null").write.mode("overwrite").parquet(at("discarded"))
        embedded(marked.where("discard_stage is null").select(order, "question"), "question").select(order, "vec").write.mode("overwrite").parquet(at("embeddings"))
        steps = {r["step"]: {"remaining": r["remaining"], "discarded": r["discarded"]} for r in report_of(marked).collect()}
        save_report(spark, steps, at("cleaning_report.json"))
    return spark.read.parquet(at("cleaned")), spark.read.parquet(at("embeddings"))


def evaluate_to(records: DataFrame, vectors: DataFrame, folder: str, provider_of: Callable[[], object], order: str = "item_seq", stratum: str = "difficulty", method: str = "density", include_mirror: bool = True, clusters: dict | None = None) -> dict[str, DataFrame]:
    """Stage 4 with its sinks: clusters, split, rephrasing, mirror, final training set and split report, kept under
    `folder` (train, eval_rephrased, eval_mirror, split_report.json) and read where they are there."""
    spark = records.sparkSession
    names = ("train", "eval_rephrased", "eval_mirror")
    if not all(there(spark, f"{folder}/{n}") for n in names):
        labels = cut(clustered(vectors, order, "vec", method, **(clusters or {})), "labels")
        train, evaluation = evaluated(records, labels, order, stratum)
        evaluation = cut(evaluation, "evaluation")
        said = cut(judging.rephrased(evaluation, provider_of, validation.MARKERS), "rephrased")
        mirrored = cut(sampling.mirror(evaluation, said, order), "mirror")
        final = sampling.final_train(train, mirrored if include_mirror else mirrored.limit(0))
        for name, df in zip(names, (final, said, mirrored)):
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
        final = spark.read.parquet(f"{folder}/train")
        report = reports.split_report(final, said).first().asDict()
        for r in reports.split_distributions(final, said).collect():  # one row a cluster, difficulty and category
            report.setdefault(f"{r['field']}_distribution", {})[r["value"]] = {"train": r["train"], "eval": r["eval"]}
        save_report(spark, report, f"{folder}/split_report.json")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def pipeline(documents: DataFrame, folder: str, provider_of: Callable[[], object], chunking: Chunking = Chunking(), cleaning: Cleaning = Cleaning(), method: str = "density", **generation) -> dict[str, DataFrame]:
    """All four stages over documents (source_file, text), each kept under `folder`."""
    spark = documents.sparkSession
    made = run(spark, [("summaries", lambda _: summaries_of(documents, provider_of), True), ("chunks", lambda _: chunks(documents, chunking), True)], folder)
    raw = records_of(generate(made["chunks"], made["summaries"], f"{folder}/generation", provider_of, **generation))
    done, vectors = clean_to(raw, f"{folder}/cleaning", settings=cleaning, provider_of=provider_of)
    return evaluate_to(done, vectors, f"{folder}/evaluation", provider_of, method=method)


def run(spark: SparkSession, steps: list[tuple[str, Callable[[dict], DataFrame], bool]], folder: str) -> dict[str, DataFrame]:
    """Runs the steps in order; each is written under its name, one already there is read instead, and one that is
    turned off must be there.  A step without rows ends the run with SystemExit(1)."""
    done: dict[str, DataFrame] = {}
    for name, step, enabled in steps:
        path = f"{folder}/{name}"
        if not there(spark, path):
            if not enabled:
                raise SystemExit(1)
            step(done).write.parquet(path)
        done[name] = spark.read.parquet(path)
        if done[name].isEmpty():
            raise SystemExit(1)
    return done


def report_of(marked: DataFrame) -> DataFrame:
    """Counts of records after each check of `cleaned`."""
    return reports.cleaning_report(marked, "discard_stage", STAGES)


def clustered(vectors: DataFrame, order: str = "item_seq", vec: str = "vec", method: str = "density", **settings) -> DataFrame:
    """(order, cluster_id): by density with noise given to its nearest cluster, by k-means, or all one cluster."""
    if method == "density":
        return clustering.with_noise_assigned(clustering.density_clusters(vectors, order, vec, **settings), vectors, order, vec)
    if method == "kmeans":
        return clustering.kmeans(vectors, order, vec, **settings)
    return vectors.select(order, F.lit(0).alias("cluster_id"))
