"""Files, settings, model calls, stages and streams."""

import hashlib
import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern import providers
from quern.functions import text as X
from quern.operators import tags, validation
from quern.operators.chunking import Chunking, chunk_documents
from quern.plans import config, stages
from quern.sources import files
from quern.streaming import ingest


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.md").write_bytes("x\r\ny\rz".encode())
    (tmp_path / "in" / "c.txt").write_text("no")
    assert [tuple(r) for r in files.read_documents(spark, str(tmp_path / "in")).collect()] == [("b.md", "x\ny\nz")]
    df = spark.createDataFrame([(1, "س"), (2, None)], "id long, t string")
    out = str(tmp_path / "out")
    files.write_jsonl(df, out)
    files.write_jsonl(df, out, append=True)
    assert files.read_jsonl(spark, out, "id long, t string").count() == 4
    assert files.read_jsonl(spark, str(tmp_path / "none"), "id long").count() == 0
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\n\n{bad\n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "id long").collect()
    files.write_report({"a": 1}, str(tmp_path / "r" / "x.json"))
    assert files.read_json(spark, str(tmp_path / "r" / "x.json")).first()["a"] == 1
    files.save_embeddings(spark.createDataFrame([(1, [1.0])], "item_seq long, vec array<double>"), str(tmp_path / "e"))
    assert files.load_embeddings(spark, str(tmp_path / "e")).count() == 1 and files.load_embeddings(spark, str(tmp_path / "f")) is None


def test_environment():
    base = {"judge_llm": {"model": "a"}}
    assert config.overridden(base, {"JUDGE_MODEL": "b", "LOG_LEVEL": ""}) == {"judge_llm": {"model": "b"}} and base["judge_llm"]["model"] == "a"


def test_rate_limiter():
    now, slept = [0.0], []
    limiter = providers.RateLimiter(3, clock=lambda: now[0], sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(4):
        limiter.acquire()
    assert slept == [20.0, 20.0, 20.0]


def test_retries():
    slept = []
    reply = providers.retried(lambda: (_ for _ in ()).throw(RuntimeError("429 busy")), 2, 1.0, slept.append, lambda: 1.0)
    assert not reply.success and reply.error == "429 busy" and slept == [10.0, 10.0]
    with pytest.raises(ValueError):
        providers.Stub().call("painter", [])


def test_generation_loop():
    replies = iter(['[{"question": "first question"}]', '[{"question": "first question!"}]', "broken", '[{"question": "another thing"}]'])
    ask = lambda kind, so_far: providers.Reply(next(replies))
    assert [x["question"] for x in providers.generate({}, ask)[0]] == ["first question"]
    same = lambda kind, so_far: providers.Reply('[{"question": "same question"}]')
    assert providers.generate({}, same) == ([{"question": "same question"}], 3)
    failing = lambda kind, so_far: providers.Reply(success=False)
    assert providers.generate({}, failing) == ([], 10) and providers.generate({}, failing, stop_on_failure=True) == ([], 2)


def test_text_functions(spark):
    row = spark.range(1).select(
        X.strip(F.lit("  a \x1f")).alias("s"), X.rendered("{a} {b} {c}", {"a": F.lit("{b}"), "b": F.lit("2")}).alias("r"),
        X.markers_in(F.lit("حقي حقي"), ["حق", "حقي", "وش"]).alias("m"), X.without_thinking(F.lit("<think>a\nb</think> \nc")).alias("t"),
        X.listed(F.array(F.lit("x"), F.lit("y")), "numbered_list").alias("l"), X.truncated_to_tokens(F.lit("abcdefghij"), F.lit(4), 2).alias("c"),
    ).first()
    assert tuple(row) == ("a", "{b} 2 {c}", 2, "c", "1. x\n2. y", "abcde")


def test_structural_bounds(spark):
    ok = {"question": "q" * 15, "answer": "a" * 30, "evaluation_criteria": "e" * 30, "category": "factual", "difficulty": "easy"}
    cases = [
        ({}, None), ({"question": None, "category": None}, "missing_fields: category, question"), ({"answer": ""}, "empty_required_field"), ({"answer": " " * 30}, None), ({"question": "q" * 14}, "question_length: 14"),
        ({"question": "q" * 501}, "question_length: 501"), ({"answer": "a" * 2001}, "answer_length: 2001"), ({"evaluation_criteria": "e"}, "eval_criteria_too_short: 1"),
        ({"evaluation_criteria": "e" * 1001}, "eval_criteria_too_long: 1001"), ({"category": "x"}, "invalid_category: x"), ({"difficulty": "x"}, "invalid_difficulty: x"),
    ]
    df = spark.createDataFrame([(i, *[{**ok, **c}[k] for k in validation.REQUIRED]) for i, (c, _) in enumerate(cases)], "i int, " + ", ".join(f"{k} string" for k in validation.REQUIRED))
    assert [r[0] for r in df.orderBy("i").select(validation.structural_reason()).collect()] == [w for _, w in cases]


def _records(spark):
    q = lambda x: f"وش لازم أسوي مع العداد رقم {x} الحين"
    rows = [
        (1, q("١١١١"), "لازم تبلغ مقدم الخدمة عشان يفحص العداد", "c" * 40), (2, q("١١١١"), "لازم تبلغ مقدم الخدمة عشان يفحص العداد الثاني", "c" * 40), (3, q("١١١٢"), "لازم تبلغ مقدم الخدمة عشان يفحص العداد الجديد كله", "c" * 40),
        (4, "short", "x", "y"), (5, "What should the tenant do with the meter?", "The tenant should call the office and wait.", "c" * 40), (6, "كيف أقدر أغير خطة السداد عندي بالمكتب؟", "تقدر تروح المكتب عشان يغيرون لك الخطة", "c" * 40),
    ]
    return spark.createDataFrame([(*r, "factual", "easy", "ctx") for r in rows], "item_seq long, question string, answer string, evaluation_criteria string, category string, difficulty string, context string")


def test_markers_are_counted_in_batches(spark):
    df = spark.createDataFrame([("حقي عشان عشان",), ("no such word",), ("is ok",), ("ok وش",), ("",), (None,)], "t string").select(X.markers_in(F.col("t"), ["حق", "حقي", "عشان", "وش", "ok"]).alias("n"))
    assert [r["n"] for r in df.collect()] == [3, 0, 1, 2, 0, 0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan  # a filter of an array is not compiled


def test_cleaning(spark):
    stub = lambda: providers.Stub(answers=[("خطة السداد", '{"classification": "not_supported"}'), (".", "no json")])
    out = stages.cleaned(_records(spark), provider_of=stub)
    got = {r["item_seq"]: r["discard_reason"] for r in out.collect()}
    assert got == {1: "fuzzy_duplicate", 2: "exact_duplicate", 3: None, 4: "question_length: 5", 5: "insufficient_dialect_markers: q=0<1 or a=0<2", 6: "grounding_not_supported"}
    report = {r["step"]: r["remaining"] for r in stages.report_of(out).collect()}
    assert report["input"] == 6 and report["semantic_duplicate"] == 1
    assert stages.cleaned(_records(spark).where("false")).count() == 0


def test_runner(spark, tmp_path):
    made = []

    def step(done):
        made.append(1)
        return spark.range(3)

    steps = [("a", step, True), ("b", lambda d: d["a"].where("id > 0"), True)]
    assert stages.run(spark, steps, str(tmp_path))["b"].count() == 2
    stages.run(spark, steps, str(tmp_path))
    assert made == [1]
    with pytest.raises(SystemExit):
        stages.run(spark, [("c", step, False)], str(tmp_path))
    with pytest.raises(SystemExit):
        stages.run(spark, [("d", lambda d: spark.range(0), True)], str(tmp_path))


def _merged_one_by_one(rows, vectors, threshold):
    """The sequential rule restated."""
    seen = Counter(t for _, ts in rows for t in ts or [] if t is not None)
    names, out = [*seen], {}
    for i, a in enumerate(names):
        if a in out:
            continue
        for b in names[i + 1 :]:
            if b not in out and float(np.dot(vectors[a], vectors[b])) >= threshold:
                winner, other = (a, b) if seen[a] >= seen[b] else (b, a)
                out[other] = winner
    return out


def test_merged_tags(spark):
    rng = np.random.default_rng(5)
    for trial in range(3):
        names = [f"t{i}" for i in range(14)]
        vectors = {n: v / np.linalg.norm(v) for n, v in zip(names, rng.normal(size=(14, 3)))}
        rows = [(i, [names[k] for k in rng.integers(0, 14, rng.integers(0, 4))] if i % 5 else None) for i in range(40)]
        df = spark.createDataFrame(rows, "id long, tags array<string>")
        embed = lambda texts, v=vectors: [None if t is None else v[t].tolist() for t in texts]
        found = {r["tag"]: r["merged"] for r in tags.merged_into(df, "id", "tags", 0.6, embed).collect()}
        want = _merged_one_by_one(rows, vectors, 0.6)
        assert found == want, trial
        got = {r["id"]: r["tags"] for r in tags.merged(df, "id", "tags", tags.merged_into(df, "id", "tags", 0.6, embed)).collect()}
        assert got == {i: None if ts is None else [want.get(t, t) for t in ts] for i, ts in rows}


def _talk(fails: str = "\0"):
    """A stub of all roles: chunks give two items at first and one more."""

    def item(prompt, word):
        return {"question": f"وش {word} {hashlib.md5(prompt.encode()).hexdigest()[:24]} يا مقدم الخدمة؟", "answer": f"لازم تبلغ مقدم الخدمة عشان يفحص {hashlib.md5((word + prompt).encode()).hexdigest()}", "evaluation_criteria": "c" * 40, "category": "factual", "difficulty": "easy"}

    def first(m):
        if fails in m:
            raise RuntimeError("no service")
        return json.dumps([item(m, "first"), item(m, "second")])

    return lambda: providers.Stub(answers=[(r"^Write question", first), (r"^Write more", lambda m: "[]" if "3. " in m else json.dumps([item(m, "third")])), (r"^Summarize", "A guide."), (r"^Is the answer", '{"classification": "fully_supported"}'), (r"^Rate", '{"score": 5}'), (r"^Give", '{"tags": ["safety"]}'), (r"^Say", lambda m: json.dumps({"question": "وش السؤال الجديد؟", "answer": "لازم تبلغ عشان كذا"}))])


def test_all_stages_in_a_chain(spark, tmp_path):
    docs = spark.createDataFrame([(f"d{i}.md", f"# Part {i}\n" + " ".join(f"The tenant number {k} of file {i} should call the office." for k in range(8))) for i in range(12)], "source_file string, text string")
    out = stages.pipeline(docs, str(tmp_path), _talk(), Chunking(min_tokens=10, max_tokens=60), stages.Cleaning(fuzzy_threshold=0.999, semantic_threshold=0.9999), batch=7)
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    raw = spark.read.parquet(str(tmp_path / "generation" / "raw"))
    assert raw.select("chunk_id").distinct().count() == chunks.count() and raw.count() == 3 * chunks.count()
    assert {r[0] for r in spark.read.parquet(str(tmp_path / "summaries")).select("summary").distinct().collect()} == {"A guide."}
    kept = spark.read.parquet(str(tmp_path / "cleaning" / "cleaned"))
    report = json.loads((tmp_path / "evaluation" / "split_report.json").read_text())
    n = out["eval_rephrased"].count()
    assert n > 0 and out["eval_mirror"].count() == n and out["train"].where("is_eval_mirror").count() == n
    assert out["train"].where("not is_eval_mirror").count() + n == kept.count() == report["total_items"]
    assert report["difficulty_distribution"]["easy"]["eval"] == n and report["rephrase_failures"] == 0
    assert out["eval_rephrased"].where("dialect_revalidation_failed").count() == 0 and out["train"].columns.count("tags") == 1
    again = stages.pipeline(docs, str(tmp_path), lambda: None, Chunking(min_tokens=10, max_tokens=60), batch=7)  # all is there
    assert again["train"].count() == out["train"].count()


def test_generation_resumes_and_skips_failed_chunks(spark, tmp_path):
    rows = [(f"c{i}", "f", "", f"text {i} {'broken' if i == 3 else ''}") for i in range(8)]
    chunks = spark.createDataFrame(rows, "chunk_id string, source_file string, section_hierarchy string, chunk_text string")
    none = spark.createDataFrame([], "source_file string, summary string")

    def prompt(chunk, kind, so_far):
        if chunk["chunk_id"] == "c3":
            raise RuntimeError("no prompt")
        return stages.generation_prompt()(chunk, kind, so_far)

    skipped = providers.generated(chunks, _talk(), prompt).where("error is not null").collect()
    assert [(r["chunk_id"], r["item"], r["error"]) for r in skipped] == [("c3", None, "no prompt")]
    with pytest.raises(Exception, match="no prompt"):
        providers.generated(chunks, _talk(), prompt, skip_failed=False).count()
    first = stages.generate(chunks.where("chunk_id < 'c5'"), none, str(tmp_path), _talk("broken"), batch=2)
    assert {r[0] for r in first.select("chunk_id").distinct().collect()} == {"c0", "c1", "c2", "c3", "c4"}
    assert {r[0]: r[1] for r in first.groupBy("chunk_id").count().collect()}["c3"] == 3  # the first call failed, later ones gave three
    (tmp_path / "raw" / "run=lost").mkdir()
    first.limit(1).write.mode("append").parquet(str(tmp_path / "raw" / "run=lost"))  # a batch that broke off
    both = stages.generate(chunks, none, str(tmp_path), _talk(), batch=2)
    assert both.select("chunk_id").distinct().count() == 8 and both.count() == first.count() + 9
    assert both.where("timestamp is null or generation_model is null").count() == 0


def test_adapters_and_roles():
    slept = []

    class Chat:
        def chat(self, model, messages, format, options, think):
            self.seen = (model, format, options["num_predict"], think)
            return {"message": {"content": "<think>x</think> done"}, "prompt_eval_count": 3, "eval_count": 2}

    class Models:
        def generate_content(self, model, contents, config):
            self.seen = (model, contents, config)
            if len(slept) < 1:
                raise RuntimeError("RESOURCE_EXHAUSTED")
            return type("R", (), {"text": "hi", "usage_metadata": type("U", (), {"prompt_token_count": 5, "candidates_token_count": 7})})

    chat, models = Chat(), Models()
    local = providers.Ollama({"model": "m", "think": True, "requests_per_minute": 1e9}, chat)
    hosted = providers.Gemini({"model": "g", "requests_per_minute": 1e9}, type("C", (), {"models": models})(), sleep=slept.append)
    router = providers.Router({"generation": hosted, "judge": local})
    assert router.call("judge", [{"role": "user", "content": "q"}], max_tokens=100, json_mode=True).text == "done" and chat.seen == ("m", "json", 16384, True)
    got = router.call("generation", [{"role": "system", "content": "s"}, {"role": "user", "content": "a"}, {"role": "user", "content": "b"}], json_mode=True)
    assert got.text == "hi" and models.seen[1] == "a\n\nb" and models.seen[2]["system_instruction"] == ["s"] and models.seen[2]["response_mime_type"] == "application/json"
    assert router.usage == [("g", 5, 7)] and slept[0] >= 5
    with pytest.raises(ValueError):
        router.call("painter", [])
    made = providers.Router.of({"generation_llm": {"provider": "gemini"}, "judge_llm": {"provider": "ollama"}})
    assert isinstance(made.by_role["judge"], providers.Ollama) and isinstance(made.by_role["generation"], providers.Gemini)
    for wrong in ({"mode": "x"}, {"mode": "cloud"}):
        with pytest.raises((ValueError, ImportError)):
            providers.Ollama(wrong).client


def test_switches():
    base = {"generation_llm": {"provider": "gemini", "model": "g"}, "judge_llm": {"provider": "ollama", "think": True, "timeout_seconds": 9}}
    out = config.overridden(base, {"GENERATION_PROVIDER": "Ollama", "OLLAMA_MODEL": "q", "OLLAMA_HOST": "h", "GOOGLE_API_KEY": "k"})
    assert out["generation_llm"] == {"provider": "ollama", "model": "q", "host": "h", "mode": "local", "think": True, "timeout_seconds": 9}
    assert out["judge_llm"]["model"] == "q" and "api_key" not in out["judge_llm"] and base["judge_llm"] == {"provider": "ollama", "think": True, "timeout_seconds": 9}
    assert config.overridden({"judge_llm": {"provider": "gemini"}}, {"GOOGLE_CLOUD_PROJECT": "p"})["judge_llm"]["project"] == "p"


def test_chunks_by_another_counter(spark):
    df = spark.createDataFrame([("d", "One two three. Four five six. Seven eight.")], "doc string, text string")
    out = chunk_documents(df, "doc", "text", Chunking(min_tokens=1, max_tokens=6, overlap_sentences=0, counter=lambda t: len(t.split()))).orderBy("chunk_index").collect()
    assert [r["token_count"] for r in out] == [6, 2]


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [{"question": q, "answer": "a" * 40, "evaluation_criteria": "e" * 40, "category": "factual", "difficulty": "easy", "at": "2026-01-01T00:00:00"} for q in ("What now, please tell?", "What  now, please tell?", "short")]
    (folder / "1.jsonl").write_text("\n".join(map(json.dumps, rows)))
    stream = ingest.validated(ingest.records(spark, str(folder), "question string, answer string, evaluation_criteria string, category string, difficulty string, at timestamp"))
    query = ingest.write(ingest.once(stream, "question", "at"), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 2 and out.where("discard_reason is null").count() == 1
