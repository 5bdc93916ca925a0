"""Results of the training-data operators against brute force, exact round trips and planted cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import lookalike, markup, mixing, near_duplicates, pair_defects, scans, split_overlap, splitting, stuffing, tokens

WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lmnrst"]


def _share(a, b):
    x, y = set(lookalike.words(a)), set(lookalike.words(b))
    return len(x & y) / len(x | y) if x | y else 0.0


def _edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        k = rng.randrange(len(out))
        match rng.randrange(4):
            case 0:
                out[k] = rng.choice(WORDS)
            case 1:
                out.insert(k, rng.choice(WORDS))
            case 2:
                del out[k]
            case _:
                j = rng.randrange(len(out))
                out[k], out[j] = out[j], out[k]
    return out


def _corpus(seed, n):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        base = [rng.choice(WORDS) for _ in range(rng.randint(40, 90))]
        texts.append(" ".join(base))
        texts += [" ".join(_edited(rng, base, rng.randint(0, 7))) for _ in range(rng.choice([0, 0, 1, 2]))]
    rng.shuffle(texts)
    return texts


def test_near_duplicates_find_what_brute_force_finds(spark):
    texts = _corpus(1, 150)
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "id long, question string, answer string")
    found = {tuple(r) for r in near_duplicates.pairs(near_duplicates.similar_classes(df, "id", ["question", "answer"], 0.7, 36)).collect()}
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if _share(texts[i], texts[j]) >= 0.7 and min(len(lookalike.words(texts[i])), len(lookalike.words(texts[j]))) >= 36}
    assert found <= want and len(found) >= 0.99 * len(want) > 50


def test_sketch_never_refuses_a_true_pair():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(-(2**62), 2**62, 60)
        b = np.concatenate([a[: rng.integers(30, 60)], rng.integers(-(2**62), 2**62, rng.integers(0, 20))])
        differ = len(set(a.tolist()) ^ set(b.tolist()))
        bits = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(near_duplicates.parity(np.unique(a)), near_duplicates.parity(np.unique(b))))
        assert bits <= differ


def test_split_overlaps_find_what_brute_force_finds(spark):
    texts = _corpus(3, 150)
    cutoff = len(texts) // 3
    short = ["alpha beta", "beta alpha", "one two three four five six seven eight nine ten", "one two three four five six seven eight nine eleven"]
    e, t = texts[:cutoff] + short, texts[cutoff:] + short
    left = spark.createDataFrame([(i, x, "") for i, x in enumerate(e)], "eval_id long, q string, a string")
    right = spark.createDataFrame([(i, x, "") for i, x in enumerate(t)], "train_id long, q string, a string")
    rows = split_overlap.overlaps(left, right, "eval_id", "train_id", [["q", "a"]], ["q", "a"], 0.7).collect()
    found = {(r["eval_id"], r["train_id"]) for r in rows}
    want = {(i, j) for i, x in enumerate(e) for j, y in enumerate(t) if _share(x, y) >= 0.7}
    assert found <= want and len(found) >= 0.97 * len(want)
    same = [r for r in rows if r["share"] == 1.0 and len(e[r["eval_id"]].split()) > 40 and e[r["eval_id"]] == t[r["train_id"]]]
    assert all(r["coverage"] > 20 for r in same)


def test_split_overlaps_lose_no_pair_without_a_run(spark):
    rng = random.Random(7)
    e, t = [], []
    for n in [27, 29, *range(30, 90)] * 4:
        base = rng.sample(WORDS, n)
        other = list(base)
        spread = rng.randint(5, 7)  # no run of eight words is left
        for k in range(rng.randrange(spread), n, spread):
            other[k] = rng.choice(WORDS)
        e.append(" ".join(base))
        t.append(" ".join(other + rng.sample(WORDS, rng.choice([0, 0, 3]))))
    left = spark.createDataFrame([(i, x, "") for i, x in enumerate(e)], "eval_id long, q string, a string")
    right = spark.createDataFrame([(i, x, "") for i, x in enumerate(t)], "train_id long, q string, a string")
    found = {(r["eval_id"], r["train_id"]) for r in split_overlap.overlaps(left, right, "eval_id", "train_id", [["q", "a"]], ["q", "a"], 0.7).collect()}
    want = {(i, j) for i, x in enumerate(e) for j, y in enumerate(t) if _share(x, y) >= 0.7}
    assert found == want and len(want) > 50


@pytest.mark.parametrize(
    "text, want",
    [
        ("Ｆｕｌｌ", "Full"), ("re\u0301sume\u0301", "résumé"), ("a\u00a0b\u2003c", "a b c"), ("zero\u200bwidth\ufeff", "zerowidth"), ("оf thе рanel", "of the panel"), ("ﬁre", "fire"), ("مکتب", "مكتب"), ("ﻻزم", "لازم"),
        ("\u0627\u0654بغى", "أبغى"), ("رقم ۱۲", "رقم ١٢"), ("71 ℃", "71 °C"), ("а", "а"), ("Ωmega", "Ωmega"), ("𝐁old", "Bold"), ("кaбель", "кабель"),
    ],
)
def test_one_form(text, want):
    assert lookalike.normalize(text) == want and lookalike.changes(text) == (text != want) and not lookalike.changes(want)


@pytest.mark.parametrize("text", ["الملصق فيه كلمة щит بلغة المصنع", "m² ① Ω °C", "خَطَر", "Ça va, Çubuk kapıyı", "مرمت کی ٹیم سب سے پہلے ہے", "👷🏽‍♂️ ✅ ⚡️", "क्‍ष", "٩٣٠٢١٧", "“quotes” — dash…", "中文，标点。"])
def test_ordinary_texts_are_no_cases(text):
    assert lookalike.normalize(text) == text and not lookalike.changes(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_one_pass_is_enough(text):
    once = lookalike.normalize(text)
    assert lookalike.normalize(once) == once


@pytest.mark.parametrize(
    "text, want",
    [
        ("a <b>c</b> &amp; d", ["html"]), ("x <!-- y -->", ["html"]), ("V < 18 and I > 74, R&D; Q&A", []), ("# Title\nx", ["markdown"]), ("x\n\n- a\n- b", ["markdown"]), ("a **b** `c`", ["markdown"]), ("~~x~~", ["markdown"]),
        ("| a | b |\n|---|---|\n| c | d |", ["markdown"]), ("- [ ] task", ["markdown"]), ("Clearance is 2\n* 48 = twice", []), ("''x'' [[a|b]]", ["wiki"]), ("== H ==", ["wiki"]), ("{| class=\"wikitable\"\n|-\n| a || b\n|}", ["wiki"]),
        ("{{cite|x}}", ["wiki"]), ("[http://a.example b]", ["wiki"]), (r"\section{A} $x = 1$", ["latex"]), (r"\begin{itemize}\item a\end{itemize}", ["latex"]), ("between $37 and $68", []), ("5% (see column 2)", []), ("Pole #48 and pole #81", []),
        ("```\n<b> [[x]] \\item\n```", ["markdown"]), ("Use slot 39|73 of the rack.", []), ("", []), (None, []),
    ],
)
def test_markup_kinds(text, want):
    assert markup.kinds(text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("<h2>T</h2><ul><li>a</li><li>b &lt; c</li></ul><script>x</script>", "## T\n- a\n- b < c"), ("<table><tr><th>a</th><td>1</td></tr></table>", "| a | 1 |"), ("**a** [b](http://x) ~~c~~", "a b c"),
        ("Title\n=====\n- [x] do", "# Title\n- do"), ("== H ==\n''i'' [[p|q]] {{w|t|l=1}}", "## H\ni q t"), (r"\section{S} \textbf{b} \SI{5}{\kilo\watt} $I^2 R$", "## S b 5 kilowatt $I^2 R$"),
        ("```python\na < b\n```\nx", "```\na < b\n```\nx"), ("{|\n! h !! i\n|-\n| a || b\n|}", "| h | i |\n| a | b |"), ("V < 18 and <b>I</b> > 74", "V < 18 and I > 74"), (r"\begin{equation}x=1\end{equation}", "$$ x=1 $$"),
    ],
)
def test_clean_text(text, want):
    assert markup.clean(text) == want


def test_hosts_drop_containers_without_prose(spark):
    page = "<div class='menu1'><a href='x'>one</a><a href='y'>two</a></div><div class='body'>Real text here.</div>"
    df = spark.createDataFrame([(i, page, "h") for i in range(3)], "id long, t string, host string")
    assert {r["clean_text"] for r in markup.cleaned(df, "t", "host").collect()} == {"Real text here."}


def test_scans(spark):
    clean = "The tenant should inspect the meter cabinet and report the network office before the summer peak."
    rows = [(f"c{i}", clean, "Guide_to_Meters_000001.md") for i in range(1)] + [(f"d{i}", f"{clean} Form {i} applies.", "other_000002.md") for i in range(60)]
    noisy = "Guide to Meters | 12\nThe tenarit should insp-\n— 13 —\nect the mcter cab¬\ninet and rep0rt the nefwork offlce before the low-\nvoltage peak."
    plain = "A low-voltage line. This annex belongs to Guide to Meters."
    rows += [("n", noisy, "Guide_to_Meters_000001.md"), ("p", plain, "Guide_to_Meters_000001.md"), ("q", "Use type H07RN-F, M12, 11kV and B-101.", "Guide_to_Meters_000001.md")]
    rows += [(f"l{i}", f"The low-voltage network line {i}.", "x_000003.md") for i in range(12)]
    s = scans.Scans(spark.createDataFrame(rows, "chunk_id string, chunk_text string, source_file string"), "chunk_id", "chunk_text", "source_file")
    found = {}
    for r in s.noise().collect():
        found.setdefault(r["chunk_id"], set()).add(r["noise"])
    assert found == {"n": {"running_header", "page_number", "hyphenation", "misread"}}
    text = {r["chunk_id"]: r["repaired_text"] for r in s.repaired().collect()}["n"]
    assert text.startswith("The tenant should inspect the meter cabinet and report the network")


def test_defects_on_held_out_rows():
    rng = random.Random(4)
    nouns, acts, times = ["the meter", "the fuse", "the cabinet", "the relay", "the panel", "the cable"], ["inspect", "replace", "record", "seal", "clean", "test"], ["before the summer peak", "after heavy rain", "every 12 months", "when the key is missing"]
    sentence = lambda: f"The tenant should {rng.choice(acts)} {rng.choice(nouns)} and {rng.choice(acts)} {rng.choice(nouns)} {rng.choice(times)}."
    question = lambda: f"When may the tenant {rng.choice(acts)} {rng.choice(nouns)} {rng.choice(times)}?"
    arabic = "الملف رقم 12 يوضح أن المستأجر يفحص العداد بعد المطر. فيه رسم على الكيبل."
    qs = [question() for _ in range(600)] + ["متى يقدر المستأجر يفحص العداد؟"] * 60
    ts = [" ".join(sentence() for _ in range(3)) for _ in range(600)] + [arabic] * 60
    model = pair_defects.train(qs, [ts])
    q, t = question(), " ".join(sentence() for _ in range(3))
    cases = {t: None, t.rstrip("."): None, f"{q} {t}": None, "N/A": "empty", "  ": "empty", q: "copied_question", f"You are asking: {q}": "copied_question", "I cannot answer questions concerning the fuse. Ask the office instead.": "refusal", arabic: "wrong_language", t[: t.rindex(" and")] + " and the": "truncated", t + " The steps are:": "truncated", "El inquilino debe revisar el contador en un plazo de 3 días con la oficina": "wrong_language"}
    got = pair_defects.judge(model, [q] * len(cases), list(cases), 0)
    wrong = [(c, g) for (c, w), g in zip(cases.items(), got) if g != w]
    assert len(wrong) <= 1, wrong
    assert pair_defects.judge(None, [q], [None], 0) == ["empty"] and pair_defects.train([], [[]]) is None


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoding_equals_the_whole_text_encoding(text):
    e = tokens.encoder()
    clean = text.encode("utf-8", "replace").decode() if any("\ud800" <= c <= "\udfff" for c in text) else text
    if clean == text:
        assert e.encode(text) == e.bpe.encode_ordinary(text) and e.bpe.decode(e.encode(text)) == text


def test_encoding_of_hard_texts():
    e = tokens.encoder()
    for t in ["a  b \n c\n\n\nd\t e ", " lead", "٠ ٠à à à\u00a0x", "it's they'LL 've", "x" * 3000, "ـ" * 500, "a\u001cb \u0085c", "\u3000\u3000 x", "日本語 テキスト", "👷🏽‍♂️ ✅"]:
        assert e.encode(t) == e.bpe.encode_ordinary(t), t


def test_mix(spark):
    rng = random.Random(5)
    docs = [(i, rng.choice(["big"] * 8 + ["small"] * 2 + ["other"]), "word " * rng.randint(1, 40)) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("absent", 0.0, 1)], "source string, target_share double, max_repeats int")
    mix = mixing.Mix(df, targets)
    shares = {r["source"]: r for r in mix.shares().collect()}
    assert abs(shares["big"]["actual_share"] - 0.5) < 0.005 and shares["small"]["most_copies"] <= 3 and shares["absent"]["taken_tokens"] == 0
    rows = {r["doc_id"]: r["copies"] for r in mix.documents().collect()}
    less = {r["doc_id"]: r["copies"] for r in mixing.Mix(df, targets, total=mix.total / 2).documents().collect()}
    assert all(rows.get(k, 0) >= n for k, n in less.items())  # a larger budget keeps what a smaller one takes
    with pytest.raises(ValueError):
        mixing.Mix(df, targets.union(targets))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["# H\n", "## I\n", "word ", "Sentence ends. ", "\n\n", "- item\n", "| a | b |\n", "x" * 40, "é́́", "<table><tr><td>1</td></tr></table>\n", "```\ncode\n```\n", "نص عربي. "]), max_size=80))
def test_pieces(parts):
    text = "".join(parts)
    out = splitting.pieces(text, 20, 4)
    assert "".join(text[a + o : b] for a, b, o in out) == text
    assert all(int((b - a) / 3.5) <= 20 and int(o / 3.5) <= 4 for a, b, o in out)


def test_pieces_break_at_headings():
    section = "Some words of a sentence. " * 12
    text = "".join(f"# Part {i}\n\n{section}\n\n" for i in range(6))
    starts = [text[a + o : a + o + 6] for a, b, o in splitting.pieces(text, 200, 10)]
    assert all(s.startswith("# Part") for s in starts)
    assert splitting.most_chars(800) == 2803 and splitting.tokens(2803) == 800 and splitting.tokens(2804) == 801


def test_stuffed_pages(spark):
    prose = " ".join(f"The tenant number {i} should ask the {w} office about the {v} before the summer." for i, (w, v) in enumerate(zip(WORDS, WORDS[40:])) if i < 12)
    rng = random.Random(6)
    keys = ["solar panel price", "cheap meter repair", "ev charger install"]
    stuffed = " ".join(rng.choice(keys) for _ in range(80))
    links = "\n".join(f"{rng.choice(keys)} http://shop{i}.example/p{i}" for i in range(20))
    tags = " ".join("#" + rng.choice(keys).replace(" ", rng.choice(["", "_"])) for _ in range(40))
    contents = "\n".join(f"{w} {v} ........ {i}" for i, (w, v) in enumerate(zip(WORDS, WORDS[7:])) if i < 30)
    code = "Set the limits so.\n" + "\n".join(f"    if load[{i}] >= {i * 7}: trip({i}, t={i}e-3)" for i in range(10))
    notice = "Never open the door while the light is on. Call the office of the district at once please.\n" * 12
    cases = [prose, prose + "\nRelated pages\n" + links[:150], contents, code, notice, stuffed, links, tags, None, ""]
    df = spark.createDataFrame(list(enumerate(cases)), "id long, t string").repartition(2)
    many = spark.createDataFrame([(1000 + i, prose.replace("tenant", w)) for i, w in enumerate(WORDS[:60])], "id long, t string")
    assert {r["id"] for r in stuffing.found(df.union(many), "id", "t").collect()} == {5, 6, 7}


def test_copies_of_a_stuffed_page_do_not_hide_it(spark):
    rng = random.Random(8)
    keys = ["solar panel price", "cheap meter repair", "ev charger install"]
    prose = [" ".join(f"The {rng.choice(WORDS)} of number {i} should ask the {rng.choice(WORDS)} office about the {rng.choice(WORDS)}." for i in range(14))[:900] for _ in range(40)]
    stuffed, other = (" ".join(rng.choice(keys) for _ in range(80))[:900] for _ in range(2))
    letters = [" ".join(rng.choice(WORDS) for _ in range(400))[:400] for _ in range(20)]  # of another length
    rows = [*prose, other, *letters, *[stuffed] * 60]
    df = spark.createDataFrame(list(enumerate(rows)), "id long, t string").repartition(3)
    assert {r["id"] for r in stuffing.found(df, "id", "t").collect()} == {40, *range(61, 121)}


def test_copies_of_a_scan_do_not_hide_its_misread_words(spark):
    clean = "The tenant should inspect the meter cabinet and report the network office before the summer peak."
    rows = [(f"d{i}", f"{clean} Form {i} applies.", "other_000002.md") for i in range(60)]
    rows += [(f"n{i}", clean.replace("network", "nefwork"), f"scan{i % 2}.md") for i in range(40)] + [("m", "Ask the nefwork office first.", "x_000003.md")]
    s = scans.Scans(spark.createDataFrame(rows, "chunk_id string, chunk_text string, source_file string"), "chunk_id", "chunk_text", "source_file")
    assert {(r["chunk_id"], r["noise"]) for r in s.noise().collect()} == {(k, "misread") for k in ["m", *[f"n{i}" for i in range(40)]]}
    assert {r["repaired_text"] for r in s.repaired().where("chunk_id like 'n%'").collect()} == {clean}


def test_redundancy_decides(spark):
    contents = "\n".join(f"{w} {v} office" for w, v in zip(WORDS[:60], WORDS[100:]))
    rng = random.Random(9)
    stuffed = " ".join(rng.choice(["solar panel price", "cheap meter repair", "ev charger install"]) for _ in range(60))
    prose = [" ".join(f"The {rng.choice(WORDS)} of number {i} should ask the {rng.choice(WORDS)} office about the {rng.choice(WORDS)}." for i in range(14))[:900] for _ in range(60)]
    df = spark.createDataFrame(list(enumerate([contents, stuffed, *prose])), "id long, t string")
    assert {r["id"] for r in stuffing.found(df, "id", "t").collect()} == {1}
    assert {r["id"] for r in stuffing.found(df, "id", "t", gate=False).collect()} == {0, 1}


def test_noise_free_texts_and_blocks_stay_as_they_are(spark):
    head = "Guide to Meters | 12\n"
    code = "```python\nfor x in y:\n    print(x)\n\nif x: go()\n```"
    table = "| a | b |\n|---|---|\n| 1 | 2 |"
    form = "Name: A\nAge: 3"
    rows = [("code", code), ("form", form), ("gaps", "One paragraph here.\n\n\nAnother one.\n"), ("noisy", f"{head}The tenant should inspect the meter cabinet and re-\nport the\nnetwork office before noon. It is late\n{head}in the day.\n\n{form}\n\n{code}\n{table}\n$$\nx = 1\ny\n$$")]
    rows += [(f"d{i}", f"The tenant should report {i} to the office.") for i in range(3)]
    df = spark.createDataFrame([(k, t, "Guide_to_Meters_000001.md") for k, t in rows], "k string, t string, h string")
    got = {r["k"]: r["repaired_text"] for r in scans.Scans(df, "k", "t", "h", support=True).repaired().collect()}
    assert all(got[k] == t for k, t in rows if k != "noisy")
    assert got["noisy"] == f"The tenant should inspect the meter cabinet and report the network office before noon. It is late in the day.\n\n{form}\n\n{code}\n{table}\n$$\nx = 1\ny\n$$"


def test_long_texts_take_linear_time():
    import time

    def seconds(text):
        began = time.process_time()
        lookalike.normalize(text)
        return time.process_time() - began

    for sentence in ("مرمت کی ٹیم سب سے پہلے ہے اور یہ پینل بند کرے۔ ", "The panel of the оld meter is here and it works fine. "):
        small, large = seconds(sentence * 400), seconds(sentence * 6400)
        assert large < 60 * max(small, 0.005)


def test_suffix_arrays():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40, 200):
        x = rng.integers(0, 4, n)
        order = split_overlap.suffix_array(x)
        assert order.tolist() == sorted(range(n), key=lambda i: x[i:].tolist())
        prefixes = split_overlap.common_prefixes(x, order)
        for k in range(1, n):
            a, b = x[order[k - 1] :], x[order[k] :]
            m = min(len(a), len(b))
            assert prefixes[k] == next((i for i in range(m) if a[i] != b[i]), m)


def test_coverage_equals_brute_force():
    rng = random.Random(11)
    for _ in range(150):
        a = [rng.randrange(12) for _ in range(rng.randint(1, 40))]
        b = (a[: rng.randint(0, 20)] + [rng.randrange(12) for _ in range(rng.randint(0, 20))]) or [1]
        spans = {tuple(b[i : i + split_overlap.SPAN]) for i in range(len(b))}
        want = {j for i in range(len(a) - split_overlap.SPAN + 1) if tuple(a[i : i + split_overlap.SPAN]) in spans for j in range(i, i + split_overlap.SPAN)}
        assert split_overlap.covered(np.array(a), np.array(b)) == len(want)


def test_canonical_suffixes_lose_no_pair():
    rng = np.random.default_rng(12)
    counts = rng.integers(0, 1000, split_overlap.BUCKETS)
    met = 0
    for t in (0.5, 0.7, 0.8):
        for _ in range(1500):
            n = int(rng.integers(1, 60))
            a = rng.integers(1, 2**63, n, dtype=np.uint64)
            b = np.concatenate([a[rng.random(n) < rng.uniform(t, 1)], rng.integers(1, 2**63, int(rng.integers(0, 2 + n // 5)), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            if len(b) and len(np.intersect1d(a, b)) >= t * len(np.union1d(a, b)):
                met += 1
                assert np.intersect1d(split_overlap.starts(a.view(np.int64), counts, t)[0], split_overlap.starts(b.view(np.int64), counts, t)[0]).size
    assert met > 500


def test_mix_of_many_sources(spark):
    targets = spark.range(1000).selectExpr("concat('s', id) as source", "0.001D as target_share", "2 as max_repeats")
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('s', id % 1000) as source", "repeat('word ', cast(id % 7 + 1 as int)) as text")
    mix = mixing.Mix(docs, targets)
    assert mix.documents().where("copies > 2").count() == 0 and mix.shares().count() == 1000


def test_fences_and_clusters_stay_whole():
    text = "Intro text here. " * 120 + "\n\n```python\n" + "# comment line of code\nx = 1\n" * 55 + "```\n\n# Next\n" + "More words. " * 100
    a, b = text.index("```python"), text.index("```\n\n#") + 3
    assert any(x + o <= a and b <= y for x, y, o in splitting.pieces(text))
    assert all(y % 2 == 0 for _, y, _ in splitting.pieces("🇸🇦" * 3000))


def test_nested_markup():
    nested = r"\begin{center}\begin{tabular}{l}a & b \\ c & d\end{tabular}\end{center} \emph{\textbf{\underline{\texttt{x}}}}"
    assert "| a | b |\n| c | d |" in markup.clean(nested) and markup.clean(nested).endswith("x")
    assert markup.clean("{{a|{{b|{{c|{{d|{{e|deep}}}}}}}}}}") == "deep"
    assert markup.kinds("<div class='menu'>[[a]] text</div>", frozenset({"div.menu"})) == ["html"]


def test_contexts_are_counted_as_they_stand():
    rng = random.Random(13)
    texts = []
    for _ in range(60):
        words = [rng.choice("abcdefg") for _ in range(rng.randint(1, 14))]
        texts.append(" ".join(w + rng.choice(["", "", "", "."]) for w in words))
    runs, ends = {}, {}
    for t in texts:
        x = pair_defects._ids(t)
        for i, h in enumerate(x):
            last = i + 1 == len(x)
            if h == 1 or last and 1 in x:
                continue
            before = 0 if i == 0 or x[i - 1] == 1 else x[i - 1]
            runs[before, h] = runs.get((before, h), 0) + 1
            ends[before, h] = ends.get((before, h), 0) + (last or x[i + 1] == 1)
    keys, got, closing = pair_defects._counted(texts, np.full(pair_defects.MAP // 64, ~np.uint64(0)))
    sums = pair_defects.Sums(keys, got, closing)
    pairs = np.array([*runs], dtype=np.uint64)
    none = np.zeros(len(pairs), np.uint64)
    of = pair_defects._keys(none, none, none, pairs[:, 0], pairs[:, 1])[:, 3]
    assert sums.of(of)[0].tolist() == [*runs.values()] and sums.of(of)[1].tolist() == [*ends.values()]


def test_defects_of_a_table_where_copies_are_a_third(spark):
    rng = random.Random(14)
    nouns, acts = ["the meter", "the fuse", "the cabinet", "the relay", "the panel"], ["inspect", "replace", "record", "seal", "clean"]
    whole = lambda: " ".join(f"The tenant should {rng.choice(acts)} {rng.choice(nouns)} and {rng.choice(acts)} {rng.choice(nouns)} before the summer peak." for _ in range(2))
    rows = [(i, f"When may the tenant {rng.choice(acts)} {rng.choice(nouns)}?", whole()) for i in range(400)]
    cut_short = whole()[:-14]  # the same text, cut inside a sentence, delivered again and again
    rows += [(1000 + i, "When may the tenant seal the fuse?", cut_short) for i in range(200)]
    rows += [(2000, "When may the tenant seal the fuse?", None), (2001, "When may the tenant seal the fuse?", "I cannot answer questions concerning the fuse. Ask the office instead.")]
    df = spark.createDataFrame(rows, "id long, q string, a string")
    found = {(r["id"], r["defect"]) for r in pair_defects.flag(df, "id", "q", ["a"]).collect()}
    assert {(1000 + i, "truncated") for i in range(200)} | {(2000, "empty"), (2001, "refusal")} <= found and len(found) <= 210
