"""Operators against plain restatements of their rules on random inputs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import replies
from quern.functions.similarity import common_subsequence, common_subsequences, indel_ratio
from quern.operators import chunking, clustering, components, dedup, lines, neighbours, sampling, sentences


def _lines(spark, texts):
    return lines.exploded(spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc string, text string"), "doc", "text")


def _by_doc(rows, value):
    out = {}
    for r in sorted(rows, key=lambda r: (r["doc"], r["line_no"])):
        out.setdefault(r["doc"], []).append((r["line_no"], r[value]))
    return out


def test_code_repeats_and_boilerplate(spark):
    text = "a\n```\nx\n```\nb\nb\nb\nb\n# h\n# h\n# h\n# h\nfoot\nc\n```py\nrest\nc"
    out = lines.preprocessed(_lines(spark, [text, None, ""]), 4, ["foot"]).orderBy("line_no").collect()
    assert [r["raw"] for r in out if r["doc"] == "d0"] == ["a", "# h", "# h", "# h", "# h", "c"]
    assert [r["raw"] for r in out if r["doc"] == "d2"] == [""]


def test_heading_paths(spark):
    rng = random.Random(1)
    texts = ["\n".join(rng.choice(["# A", "## B", "### C", "#### D", "##### E", "###### F", "x", "y", "####### no"]) for _ in range(40)) for _ in range(12)]
    got = _by_doc(lines.heading_paths(_lines(spark, texts)).collect(), "heading_path")
    for i, t in enumerate(texts):
        stack, want = [], []
        for line in t.split("\n"):
            if m := re.match(r"^(#{1,6})\s+(.+)$", line):
                while stack and stack[-1][0] >= len(m[1]):
                    stack.pop()
                stack.append((len(m[1]), m[2]))
            want.append(" > ".join(x for _, x in stack))
        assert [p for _, p in got[f"d{i}"]] == want


def _html_blocks(text, least):
    ls, i, out = [x.strip() for x in text.split("\n")], 0, []
    while i < len(ls):
        if re.match(r"(?i)<table[\s>]", ls[i]):
            end = next((j for j in range(i + 1, len(ls)) if "</table>" in ls[j].lower()), len(ls) - 1)
            if sum(bool(re.search(r"(?i)<tr[\s>]", x)) for x in ls[i : end + 1]) >= least:
                out.append((i, end))
                i = end + 1
                continue
        i += 1
    return out


def test_html_tables(spark):
    rng = random.Random(2)
    texts = ["\n".join(rng.choice(["<table>", "</table>", "<tr>", "<tr>", "x", "</table> <tr>", "<table> a </table>"]) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    got = _by_doc(lines.html_tables(_lines(spark, texts), 2).collect(), "html_id")
    for i, t in enumerate(texts):
        want = {j: a for a, b in _html_blocks(t, 2) for j in range(a, b + 1)}
        assert {n: h for n, h in got[f"d{i}"] if h is not None} == want, t


def test_pipe_tables(spark):
    texts = ["| a |\n| b |", "| a |\n| b |\n| c |", "| a |\n|---|\n| c |\nx\n| d |", "| a |\n| b |\n|  |"]
    got = _by_doc(lines.pipe_tables(_lines(spark, texts)).collect(), "table_id")
    assert [{n for n, t in got[f"d{i}"] if t is not None} for i in range(4)] == [set(), set(), {0, 1, 2}, {0, 1, 2}]


def test_tables_with_headings(spark):
    found, rest = lines.tables(_lines(spark, ["## T\nx\n| a |\n|-|\n| c |\n<table>\n<tr>\n<tr>\n<tr>\n</table>\nend"]))
    rows = found.orderBy("start_line").collect()
    assert [(r["start_line"], r["end_line"]) for r in rows] == [(2, 5), (5, 10)] and rows[0]["text"] == "## T\n\n| a |\n|-|\n| c |"
    assert [r["raw"] for r in rest.orderBy("line_no").collect()] == ["## T", "x", "end"]


@pytest.mark.parametrize(
    "line, want",
    [
        ("Wait... ok", ["Wait..", ".", "ok"]), ("Hello?! World", ["Hello?", "!", "World"]), ("هل؟ نعم۔ لا", ["هل؟", "نعم۔", "لا"]),
        ("see www.a.b. Next", ["see www.a.b. Next"]), ("e.g. this. That", ["e.g. this.", "That"]), ("قدره 5 ك.ف.أ. تقريبا. تم", ["قدره 5 ك.ف.أ. تقريبا.", "تم"]),
        ("Dr. No. 5 costs 3.5. Yes", ["Dr. No. 5 costs 3.5.", "Yes"]), ("", []), ("كم. بعد", ["كم.", "بعد"]), ("E.G. Up", ["E.G. Up"]),
    ],
)
def test_sentences(spark, line, want):
    assert spark.range(1).select(sentences.sentences_of(F.lit(line)).alias("s")).first()["s"] == want


def test_fold():
    s = chunking.Chunking(min_tokens=5, max_tokens=10, overlap_sentences=1, chars_per_token=1.0)
    count = chunking.ratio_counter(1.0)
    assert chunking.fold([("abc", None, ""), ("# h", 1, "h"), ("defg", None, "h")], s, count) == [("abc\n# h\ndefg", "h", 12)]
    out = chunking.fold([("aaaaaa", None, ""), ("bbbbbb", None, ""), ("cc", None, "")], s, count)
    assert out == [("aaaaaa", "", 6), ("aaaaaa\nbbbbbb", "", 13), ("bbbbbb\ncc", "", 9)]
    assert chunking.fold([("aaaaaa", None, ""), ("# hh", 1, "hh"), ("c", None, "hh")], s, count) == [("aaaaaa", "", 6), ("# hh\nc", "hh", 6)]
    assert chunking.fold([("aaaaaa", None, ""), ("# h", 1, "h")], s, count) == [("aaaaaa\n# h", "", 10)]
    assert chunking.fold([], s, count) == []


def test_chunks(spark):
    docs = spark.createDataFrame([("a.md", "# T\nOne. Two.\n\n| x |\n|--|\n| y |\n## U\nThree."), ("b.md", None), ("c.md", "")], "source_file string, text string")
    rows = chunking.chunk_documents(docs, "source_file", "text", chunking.Chunking(min_tokens=1, max_tokens=50)).orderBy("chunk_index").collect()
    assert [(r["chunk_id"], r["contains_table"], r["section_hierarchy"], r["chunk_text"]) for r in rows] == [
        ("a.md__chunk_0", True, "T", "# T\n\n| x |\n|--|\n| y |"), ("a.md__chunk_1", False, "T", "# T\nOne.\nTwo."), ("a.md__chunk_2", False, "T > U", "## U\nThree."),
    ]


def _greedy(order, partners, weight, first=False):
    removed = set()
    for i in order:
        if i in removed:
            continue
        for j in partners.get(i, []):
            if j in removed:
                continue
            if first or weight[i] >= weight[j]:
                removed.add(j)
            else:
                removed.add(i)
    return removed


@pytest.mark.parametrize("keep", ["heavier", "first"])
@pytest.mark.parametrize("directed", [False, True])
def test_greedy(spark, keep, directed):
    rng = random.Random(3)
    edges, weights, want = [], [], set()
    for g in range(150):
        n = rng.randint(2, 9)
        ids = [g * 100 + k for k in range(n)]
        weight = {i: rng.randint(0, 3) for i in ids}
        partners = {}
        for i in ids:
            pool = [j for j in ids if j != i and (directed or j > i) and rng.random() < 0.4]
            if directed:
                rng.shuffle(pool)
            partners[i] = pool
        edges += [(i, j) for i, js in partners.items() for j in js]
        weights += weight.items()
        want |= _greedy(ids, partners, weight, keep == "first")
    got = dedup.greedy(spark.createDataFrame(edges, "i long, j long"), spark.createDataFrame(weights, "node long, weight int"), keep)
    assert {r[0] for r in got.collect()} == want


def test_indel():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert common_subsequence(a, b) == t[-1][-1]
    assert indel_ratio("", "") == 1.0 and indel_ratio("abc", "abd") == pytest.approx(2 / 3)


def test_similar_strings(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 60))) for _ in range(25)]
    texts = list(base)
    for t in base:
        for _ in range(3):
            x = list(t)
            for _ in range(rng.randint(0, 6)):
                x[rng.randrange(len(x))] = rng.choice("abcxyz")
            texts.append("".join(x))
    texts += ["a", "b", "ab", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r["i"], r["j"]) for r in dedup.similar_strings(df, "id", "text", 0.85).collect()}
    want = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if i < j and a is not None and b is not None and a != b and indel_ratio(a, b) >= 0.85}
    assert got == want
    rows = dedup.fuzzy(df.withColumn("w", F.repeat(F.lit("x"), (F.col("id") % 4).cast("int"))), "id", "text", "w").collect()
    same = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if i < j and a is not None and a == b}
    partners = {}
    for i, j in sorted(want | same):
        partners.setdefault(i, []).append(j)
    assert {r["id"] for r in rows if r["removed"]} == _greedy(range(len(texts)), partners, {i: i % 4 for i in range(len(texts))})


def test_similar_strings_of_all_lengths(spark):
    rng = random.Random(8)
    texts = []
    for n in (40, 63, 64, 65, 127, 128, 129, 200, 300):
        for letters in ("abcdef gh", "\u0627\u0628\u062a\u062b \u062c\u062d", "a\U0001f600b\U0001f601c "):
            base = [rng.choice(letters) for _ in range(n)]
            for share in (0, 0.02, 0.05, 0.1, 0.13, 0.16, 0.2):
                x = list(base)
                for _ in range(int(share * n)):
                    k = rng.randrange(len(x))
                    x[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
                texts.append("".join(x))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r["i"], r["j"]): r["ratio"] for r in dedup.similar_strings(df, "id", "text", 0.85).collect()}
    want = {(i, j): indel_ratio(a, b) for i, a in enumerate(texts) for j, b in enumerate(texts) if i < j and a != b and indel_ratio(a, b) >= 0.85}
    assert got == pytest.approx(want) and len(want) > 100


@pytest.mark.parametrize("keep", ["heavier", "first"])
def test_copies_of_similar_texts_are_few_edges(spark, monkeypatch, keep):
    rng = random.Random(9)
    texts = [rng.choice(["where is the meter of flat 12", "where is the meter of flat 13", "where is the meter of hut 13", "", "other"]) for _ in range(600)]
    weights = [rng.choice([1, 1, 2, 3, 5, 8]) for _ in texts]
    seen, greedy = [], dedup.greedy
    monkeypatch.setattr(dedup, "greedy", lambda edges, *rest: seen.append(edges.count()) or greedy(edges, *rest))
    df = spark.createDataFrame([(i, t, "x" * w) for i, (t, w) in enumerate(zip(texts, weights))], "id long, text string, w string")
    rows = dedup.fuzzy(df, "id", "text", "w", keep=keep).collect()
    partners = {i: [j for j in range(i + 1, len(texts)) if indel_ratio(a, texts[j]) >= 0.85] for i, a in enumerate(texts)}
    assert len(rows) == 600 and {r["id"] for r in rows if r["removed"]} == _greedy(range(len(texts)), partners, weights, keep == "first")
    assert seen[0] <= 300  # some 36,000 pairs of records are similar


def test_exact_keeps_the_first(spark):
    df = spark.createDataFrame([(3, "a  b"), (1, " a b "), (2, "A b"), (4, None), (5, None), (6, "é"), (7, "é")], "id long, q string")
    got = {r["id"]: r["duplicate_of"] for r in dedup.exact(df, "id", "q").collect()}
    assert got == {3: 1, 1: None, 2: None, 4: None, 5: 4, 6: None, 7: 6}


def test_in_loop(spark):
    df = spark.createDataFrame([(1, "c", "abcdefghij"), (2, "c", "abcdefghiX"), (3, "d", "abcdefghij"), (4, "c", "abcdefghXX"), (5, "c", "zzz")], "id long, g string, q string")
    assert {r["id"] for r in dedup.in_loop(df, "g", "id", "q").collect() if r["repeats"]} == {2}  # 0.8 itself is kept


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, 1000 + i) for i in range(1, 200)] + [(2000 + i, 2001 + i) for i in range(60)] + [(5000, 5000), (None, 1)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None:
            ra, rb = find(a), find(b)
            top[max(ra, rb)] = min(ra, rb)
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in top}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 8))
    x[200:] = x[:200] + rng.normal(size=(200, 8)) * 0.2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    s = x @ x.T
    got = {(r["i"], r["j"]) for r in neighbours.similar_vectors(df, "id", "vec", 0.92).collect()}
    assert got == {(i, j) for i in range(400) for j in range(400) if s[i, j] >= 0.92}
    near = {(r["query"], r["rank"]): r["neighbour"] for r in neighbours.nearest(df.where("id % 20 = 0"), df, "id", "vec", 3).collect()}
    assert all(near[i, k + 1] == np.argsort(-s[i], kind="stable")[k] for i in range(0, 400, 20) for k in range(3))
    assert neighbours.similar_vectors(df.where("id < 0"), "id", "vec", 0.9).count() == 0


def test_density():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(60, 2)) * 0.1 + c for c in ((0, 0), (5, 5), (0, 5))] + [rng.uniform(-20, 20, size=(12, 2))])
    labels = clustering.density_labels(x)
    assert [set(labels[a : a + 60][labels[a : a + 60] >= 0]) for a in (0, 60, 120)] == [{0}, {1}, {2}] and (labels[:180] >= 0).mean() > 0.85
    assert (labels[180:] == -1).mean() > 0.5 and set(clustering.density_labels(x[:5])) == {-1}


def test_kmeans(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 6)) * 20
    x = np.concatenate([c + rng.normal(size=(30, 6)) for c in centres])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").repartition(3)
    got = {r["id"]: r["cluster_id"] for r in clustering.kmeans(df, "id", "vec", most=8, starts=4).collect()}
    assert len(got) == 150 and len(set(got.values())) == 5 and all(len({got[30 * k + i] for i in range(30)}) == 1 for k in range(5))
    assert {r["cluster_id"] for r in clustering.kmeans(df.limit(2), "id", "vec").collect()} == {0} and clustering.kmeans(df.limit(0), "id", "vec").count() == 0


def test_neighbour_map():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(40, 8)) + c * 12 for c in np.eye(8)[:3]])
    y = clustering.neighbour_coordinates(x, turns=300)
    middle = np.array([y[a : a + 40].mean(0) for a in (0, 40, 80)])
    own = max(np.linalg.norm(y[40 * k : 40 * k + 40] - middle[k], axis=1).max() for k in range(3))
    assert min(np.linalg.norm(middle[i] - middle[j]) for i in range(3) for j in range(i)) > 2 * own
    assert clustering.neighbour_coordinates(x[:2]).shape == (2, 2)


def test_in_loop_keeps_the_first_batch(spark):
    rows = [(1, 1, "How do I read the meter?", True), (1, 2, "How do I read the meter??", True), (1, 3, "How do I read the meter!", False), (2, 4, "How do I read the meter?", None)]
    df = spark.createDataFrame(rows, "g long, id long, q string, first boolean")
    assert {r["id"] for r in dedup.in_loop(df, "g", "id", "q", initial="first").where("repeats").collect()} == {3}
    assert {r["id"] for r in dedup.in_loop(df, "g", "id", "q").where("repeats").collect()} == {2, 3}


def test_common_subsequences_of_many_pairs():
    rng = random.Random(6)
    left, right = (["".join(rng.choice("abcde ف") for _ in range(rng.choice([0, 1, 63, 64, 65, 130, 200, 520]))) for _ in range(24)] for _ in range(2))
    i, j = (a.ravel() for a in np.meshgrid(np.arange(24), np.arange(24)))
    assert common_subsequences(left, right, i, j, step=50).tolist() == [common_subsequence(left[a], right[b]) for a, b in zip(i, j)]


def test_allocations(spark):
    sizes = spark.createDataFrame([(0, 1), (1, 2), (2, 97)], "cluster_id int, size long")
    assert {r["cluster_id"]: r["allocated"] for r in sampling.allocations(sizes).collect()} == {0: 2, 1: 2, 2: 9}


def test_sampling(spark):
    df = spark.range(1000).select(F.col("id").alias("item"), (F.col("id") % 3).cast("string").alias("difficulty"), (F.col("id") % 2).alias("cluster_id"))
    train, evaluation = sampling.split(df, "item", "difficulty")
    assert evaluation.count() == 120 and train.count() == 880 and train.join(evaluation, "item").count() == 0
    assert sampling.percentage(df, "item", 15).count() == 150 and sampling.percentage(df.limit(3), "item", 1).count() == 1
    assert sampling.percentage(df.where("false"), "item", 15).count() == 0


@pytest.mark.parametrize(
    "text, want",
    [
        ('```json\n[{"question": "q"},]\n```', [{"question": "q"}]), ("<think>[1]</think> []", []), ('Sure: [{"question": "a"}] done', [{"question": "a"}]),
        ('x {"question": "a", "b": 1,} y', [{"question": "a", "b": 1}]), ('x {"question": "a", "b": [1,]} y', []), ('{"question": 1}', [{"question": 1}]), ("nothing", []), (None, []), ('[{"q": 1}, 3]', []), ("", []),
    ],
)
def test_replies(text, want):
    assert replies.items(text) == want
