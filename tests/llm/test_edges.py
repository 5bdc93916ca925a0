"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import base64
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.llm import lookalike, markup, mixing, near_duplicates, pair_defects, scans, split_overlap, splitting, stuffing, tokens

LONG = "The limit for the bushing in Tal Wabri is 7 volts. " * 4000
TEXTS = [None, "", "   \n ", "a", "؟", LONG, LONG, "x" * 50_000, "كلمة واحدة", "퟿​", "Ｆｕｌｌ ｗｉｄｔｈ"]
EXTRA = "id long, text string, class long, words string, k string, q string, t string, key string, row long, pos int, line string, n int, kind string, markup string, clean_text string, repaired_text string, label string, bucket long, at int, vec string, n_tokens long, hash long, copies int, token_count int, is_oversized boolean, piece_index int, title string, host string, h string, path string, ids string, language string, length int, ratio double, duplicate_of long, share double"


def _frame(spark, texts, names="key_id long, body string, source string"):
    rows = [(i, t, [None, "a", "a", "b"][i % 4]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, names)
    clash = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in EXTRA.split(", ")}
    return df.withColumns({**clash, "ID": F.lit(1)} if False else clash)


@pytest.fixture(params=["rows", "empty"])
def df(request, spark):
    full = _frame(spark, TEXTS)
    return full if request.param == "rows" else full.where("key_id < 0")


def test_lookalike(df):
    rows = {r["key_id"]: r["body"] for r in lookalike.normalize_columns(df, ["body"]).collect()}
    assert len(rows) in (0, len(TEXTS))
    if rows:
        assert rows[0] is None and rows[1] == "" and rows[10] == "Full width" and rows[5] == LONG
    found = {(r[0], r[1]) for r in lookalike.looks_plain_but_differs(df, "key_id", ["body", "source"]).collect()}
    assert found == ({(9, "body"), (10, "body")} if rows else set())


def test_near_duplicates(df):
    similar = near_duplicates.similar_classes(df, "key_id", ["body"], threshold=0.8)
    pairs = {tuple(r) for r in near_duplicates.pairs(similar).collect()}
    groups = {r["key_id"]: r["group_id"] for r in near_duplicates.groups(df, "key_id", similar).collect()}
    assert pairs == ({(5, 6)} if groups else set())
    if groups:
        assert len(groups) == len(TEXTS) and groups[6] == 5 and groups[0] == 0


def test_split_overlap(df):
    found = split_overlap.overlaps(df, df.withColumnRenamed("key_id", "train"), "key_id", "train", [["body"], ["source", "body"]], ["body"])
    rows = {(r["key_id"], r["train"]) for r in found.where("kind = 0").collect()}
    if df.isEmpty():
        assert not rows
    else:
        assert {(5, 6), (6, 5), (3, 3), (7, 7), (8, 8)} <= rows and not any(0 in r or 1 in r or 2 in r for r in rows)
    split_overlap.report(found, df, df.withColumnRenamed("key_id", "train"), "key_id", "train", "source").collect()


def test_markup(df):
    rows = {r["key_id"]: r for r in markup.cleaned(df, "body", "source").collect()}
    if rows:
        assert len(rows) == len(TEXTS) and rows[0]["clean_text"] is None and rows[1]["clean_text"] == "" and rows[0]["markup"] == []


def test_scans(df):
    s = scans.Scans(df, "key_id", "body", "source")
    assert s.noise().count() == 0
    rows = {r["key_id"]: r["repaired_text"] for r in s.repaired().collect()}
    assert len(rows) == df.count()
    if rows:
        assert rows[0] is None and rows[3] == "a"


def test_pair_defects(df):
    rows = {tuple(r) for r in pair_defects.flag(df, "key_id", "source", ["body"]).collect()}
    assert rows == ({(i, "body", "empty") for i in (0, 1, 2, 4, 9)} if df.count() else set())


def test_tokens(df):
    rows = {r["key_id"]: r["ids"] for r in tokens.encoded(df, "key_id", "body").collect()}
    assert len(rows) == df.count()
    if rows:
        assert rows[0] == [] and rows[1] == [] and rows[5] == rows[6] and len(rows[3]) == 1


def test_mixing(df, spark):
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1), ("missing", None, 1)], "source string, target_share double, max_repeats int")
    mix = mixing.Mix(df, targets, key="key_id", text="body")
    rows = mix.documents().collect()
    assert all(r["copies"] <= {"a": 2, "b": 1}[r["source"]] for r in rows)
    assert len(mix.shares().collect()) == 3
    assert not mixing.Mix(df, targets.where("false"), key="key_id", text="body").documents().collect()


def test_splitting(df):
    rows = splitting.split(df, "key_id", "body").collect()
    whole = Counter()
    texts = {}
    for r in sorted(rows, key=lambda r: (r["key_id"], r["piece_index"])):
        whole[r["key_id"]] += 1
        texts[r["key_id"]] = texts.get(r["key_id"], "") + r["body"][r["overlap_chars"] :]
        assert r["token_count"] <= 800 and r["token_count"] == int(len(r["body"]) / 3.5) and int(r["overlap_chars"] / 3.5) <= 50
    if rows:
        assert texts == {i: t for i, t in enumerate(TEXTS) if t is not None} and whole[7] > 1


def test_stuffing(df):
    assert {r[0] for r in stuffing.found(df, "key_id", "body").collect()} == set()


def test_a_hot_class_is_one_row_a_task(spark):
    copies = spark.range(3000).select(F.col("id").alias("key_id"), F.lit("one two three four five six").alias("body"))
    similar = near_duplicates.similar_classes(copies, "key_id", ["body"])
    assert similar.classes.count() == 0 and similar.membership.select("class").distinct().count() == 1
    assert near_duplicates.groups(copies, "key_id", similar).where("group_size = 3000").count() == 3000


def test_key_of_the_vocabulary():
    assert base64.b64decode("IQ==") == b"!" and tokens.encoder().encode("!") == [0]
