"""Markup residue in documents (problem 5): HTML, Markdown, wiki and LaTeX to clean text.

Step 1 scores the containers of every text under a generalised path of tags and classes: characters of text, less those
inside links, less a cost for each tag inside.  Step 2 lets the texts of one host (a source file, a site) vote in Spark
on each path: it wins where the scores of its containers there sum up to more than nothing, so that scripts, menus and
footers lose.  Step 3 extracts again from the winning paths: the losing containers of each text are left out, and the
rest is rewritten: headings become `#` lines, lists `-` or numbered lines, tables pipe rows, code stays fenced and
formulas stay between dollar signs.

`kinds` names the languages with at least one construct in what is extracted.  A construct counts for one language: code
and formulas are taken out before others are looked for.  Defined results: null stays null without kinds; the empty
text stays empty; unclosed tags and fences end with the text; a null host is a host of its own.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.shared import cut

# Element names of HTML, and names of LaTeX commands that need no argument.
ELEMENTS = frozenset("a abbr address article aside audio b blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark meta nav noscript object ol option p pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr tt u ul var video wbr".split())
COMMANDS = frozenset("item noindent par newpage clearpage hline toprule midrule bottomrule centering maketitle tableofcontents leq geq neq times cdot pm approx infty sum int alpha beta gamma delta epsilon theta lambda mu pi rho sigma tau phi omega Delta Gamma Theta Lambda Sigma Phi Omega ldots dots quad qquad left right medskip bigskip smallskip newline linebreak large Large small tiny bfseries itshape kilo watt volt ampere ohm".split())
VOID = frozenset("area base br col embed hr img input link meta source wbr".split())
#: Characters of text that a tag inside a container costs.
TAG_COST = 2
# Elements that parts of lists and tables need, which cost nothing and stay with their container.
PARTS = frozenset("a tr td th li ul ol tbody thead tfoot table br".split())
_NONE: frozenset[str] = frozenset()
NO_PROSE = frozenset("script style template noscript iframe svg nav footer aside".split())

_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)(\s[^<>]*)?/?>")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_ENTITY = re.compile(r"&(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});")
_FENCE = re.compile(r"^[ ]{0,3}(```+|~~~+)[^\n`]*\n(.*?)(?:^[ ]{0,3}\1[`~]*[ \t]*$|\Z)", re.S | re.M)
_OPEN_FENCE = re.compile(r"^[ ]{0,3}(```|~~~)", re.M)
_CODE = re.compile(r"(?<!`)(`{1,2})(?!`)([^`\n]+)\1(?!`)")
_IMAGE = re.compile(r"!\[([^\]\n]*)\]\(([^()\s]+)[^()\n]*\)")
_LINK = re.compile(r"(?<!!)\[([^\[\]\n]*)\]\(([^()\s]+)[^()\n]*\)")
_AUTOLINK = re.compile(r"<(https?://[^\s<>]+)>")
_BOLD = re.compile(r"(\*\*\*|\*\*|(?<!\w)___|(?<!\w)__)(?=[^\s*_])([^\n]*?[^\s*_\\])\1(?!\w)")
_ITALIC = re.compile(r"(?<![\w*\\])\*(?=[^\s*])([^*\n]*[^\s*])\*(?![\w*])|(?<![\w_\\])_(?=[^\s_])([^_\n]*[^\s_])_(?![\w_])")
_STRIKE = re.compile(r"~~(?=[^\s~])([^\n~]*?[^\s~])~~")
_ATX = re.compile(r"^ {0,3}(#{1,6})[ \t]+(\S[^\n]*?)[ \t]*#*$", re.M)
_SETEXT = re.compile(r"^(?![ \t]*(?:[-*+>|=#]|\d+[.)]))([ \t]*\S[^\n]*)\n(={2,}|-{2,})[ \t]*$", re.M)
_RULE = re.compile(r"^ {0,3}(?:\*[ ]*){3,}$|^ {0,3}(?:-[ ]*){3,}$|^ {0,3}(?:_[ ]*){3,}$", re.M)
_DELIMITER = re.compile(r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$|^[ \t]*\|[ \t]*:?-{2,}:?[ \t]*\|[ \t]*$", re.M)
#: Signs at a line start that open a block, if the line does not continue a sentence.
_BLOCK = re.compile(r"^([ \t]*)([-*+]|\d{1,3}[.)]|>+)[ \t]+(\S.*)$")
_ANY_BLOCK = re.compile(r"^[ \t]*(?:[-*+]|\d{1,3}[.)]|>+)[ \t]+\S", re.M)
_SENTENCE_END = re.compile(r"[.!?؟۔:;،,|`>)\]}*_~]\s*$|^\s*$")
_WIKI_LINK = re.compile(r"\[\[([^\[\]\n|]+)(?:\|([^\[\]\n]*))?\]\]")
_TEMPLATE = re.compile(r"\{\{([^{}]*)\}\}")
_QUOTES = re.compile(r"'{5}([^\n']+)'{5}|'''([^\n]+?)'''|''([^\n']+)''")
_WIKI_HEAD = re.compile(r"^(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", re.M)
_WIKI_TABLE = re.compile(r"^\{\|[^\n]*\n(.*?)(?:^\|\}|\Z)", re.S | re.M)
_EXTERNAL = re.compile(r"(?<!\[)\[((?:https?:)?//[^\s\[\]]+)[ \t]+([^\[\]\n]+)\](?!\()")
_MAGIC = re.compile(r"__[A-Z]{3,}__|^#(?:REDIRECT|تحويل)\b", re.M)
_WIKI_ITEM = re.compile(r"^(?:[*#:;]{2,}(?<!##)(?<!\*\*)|[:;])[ \t]*[^\s*#][^\n]*$", re.M)
_REF = re.compile(r"<(ref|nowiki|gallery|references)\b[^<>]*?(?:/>|>)", re.I)
_DISPLAY = re.compile(r"\$\$(.+?)\$\$|\\\[(.+?)\\\]|\\\((.+?)\\\)", re.S)
_INLINE = re.compile(r"(?<![\\$\w])\$(?![\s]*\d+(?:[.,]\d+)?[^=^_\\$]*\$)(?=[^$\n]*(?:[\\^_={}]|^))([^$\n]{1,200})\$(?![\d])|(?<![\\$\w])\$([A-Za-z])\$")
_COMMAND = re.compile(r"(?<![\w:\\])\\([a-zA-Z]+)\*?(?=(\s*[\[{])?)")
#: An environment without another one inside.
_ENVIRONMENT = re.compile(r"\\begin\{(\w+\*?)\}(?:\[[^\]]*\])?(?:\{[^{}]*\})*((?:(?!\\begin\{).)*?)(?:\\end\{\1\}|\Z)", re.S)
_ARGUMENT = re.compile(r"(?<![\w:\\])\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}")
#: Signs of prose such as "V < 18", which open no tag.
_OPEN_SIGN = re.compile(r"<(?![a-zA-Z/!])|<(?=/?[a-zA-Z]\w*[^\w\s>/])")
_ROW_END = re.compile(r"[^\n]&[^\n]*\\\\[ \t]*$", re.M)


def _is_tag(m: re.Match) -> bool:
    return m[1].lower() in ELEMENTS or bool(m[2] and "=" in m[2]) and m[1].lower() not in ("ref", "gallery")


def _is_entity(m: re.Match) -> bool:
    return m[1][0] == "#" or f"{m[1]};" in html.entities.html5


def _is_command(m: re.Match) -> bool:
    return m[2] is not None or m[1] in COMMANDS


def _blocks(text: str) -> bool:
    """Whether a list item or a quotation begins on a line that does not continue the one before."""
    before = ""
    for line in text.split("\n"):
        if (m := _BLOCK.match(line)) and (_SENTENCE_END.search(before) or _BLOCK.match(before)) and not re.fullmatch(r"\s*-\s*\d+\s*-\s*", line):
            if not (m[2][0].isdigit() and len(m[2]) > 3):
                return True
        before = line
    return False


def kinds(text: str | None, dropped: frozenset[str] = frozenset()) -> list[str]:
    """The languages of which the text holds a construct, in the order html, markdown, wiki, latex; those other than
    HTML are looked for outside containers on dropped paths."""
    if not text or not re.search(r"[<&#*_`~\[{\\$|>=']|^\s*(?:[-+]|\d+[.)])\s|__|^[:;]|^-{2,}", text, re.M):
        return []
    found = set()
    has = lambda *signs: any(x in text for x in signs)
    if has("`", "~~~") and (_OPEN_FENCE.search(text) or _CODE.search(text)):
        found.add("markdown")
        text = _CODE.sub(" ", _FENCE.sub("\n", text))
    if has("<", "&"):
        bare = re.sub(r"<(pre|code|script|style)\b[^<>]*>.*?</\1>", " ", text, flags=re.S | re.I)
        if _COMMENT.search(text) or any(_is_tag(m) for m in _TAG.finditer(text)) or any(_is_entity(m) for m in _ENTITY.finditer(text)):
            found.add("html")
        if dropped:
            p = _Plain(dropped)
            p.feed(_OPEN_SIGN.sub("\2", bare))
            p.close()
            bare = "".join(p.out).replace("\2", "<")
        text = _TAG.sub(lambda m: " " if _is_tag(m) else m[0], _COMMENT.sub(" ", bare))
    if has("\\", "$") and (_DISPLAY.search(text) or _INLINE.search(text) or any(_is_command(m) for m in _COMMAND.finditer(text)) or _ROW_END.search(text) or "\\begin{" in text):
        found.add("latex")
        text = _INLINE.sub(" ", _DISPLAY.sub(" ", text))
    if (
        has("{|") and _WIKI_TABLE.search(text) or has("[[") and _WIKI_LINK.search(text) or has("{{") and _TEMPLATE.search(text) or has("''") and _QUOTES.search(text) or has("==") and _WIKI_HEAD.search(text)
        or has("//") and _EXTERNAL.search(text) or has("__", "#") and _MAGIC.search(text) or has("<") and _REF.search(text) or has("**", "##", "*#", "#*", ":", ";") and _WIKI_ITEM.search(text)
    ):
        found.add("wiki")
        text = _WIKI_HEAD.sub("", _WIKI_TABLE.sub("\n", text))
    if "markdown" not in found and (
        has("#") and _ATX.search(text) or has("==", "--") and _SETEXT.search(text) or has("*", "_") and (_BOLD.search(text) or _ITALIC.search(text)) or has("](") and (_IMAGE.search(text) or _LINK.search(text))
        or has("~~") and _STRIKE.search(text) or has("*", "-", "_") and _RULE.search(text) or has("--") and _DELIMITER.search(text) or has("<http") and _AUTOLINK.search(text) or _ANY_BLOCK.search(text) and _blocks(text)
    ):
        found.add("markdown")
    return [k for k in ("html", "markdown", "wiki", "latex") if k in found]


def _general(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """A tag with its first class, digits masked."""
    name = next((v for k, v in attrs if k == "class" and v), "")
    return tag + ("." + re.sub(r"\d+", "0", name.split()[0]) if name.split() else "")


class _Containers(HTMLParser):
    """Text, text in links and number of tags of every container, by generalised path."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[list] = []
        self.done: list[tuple[str, int, int, int]] = []

    def handle_starttag(self, tag, attrs):
        cost = int(tag not in PARTS)
        if tag not in VOID:
            self.stack.append([tag, _general(tag, attrs), 0, 0, cost])
        elif self.stack:
            self.stack[-1][4] += cost

    def handle_data(self, data):
        if self.stack:
            n = len(data.strip())
            self.stack[-1][2] += n
            if any(s[0] == "a" for s in self.stack):
                self.stack[-1][3] += n

    def handle_endtag(self, tag):
        if not any(s[0] == tag for s in self.stack):
            return
        while self.stack:
            path = " ".join(s[1] for s in self.stack[-3:])
            t, _, text, link, tags = self.stack.pop()
            if t in NO_PROSE:
                text = link = 0
            self.done.append((path, text, link, tags))
            if self.stack:
                for i, x in ((2, text), (3, link), (4, tags)):
                    self.stack[-1][i] += x
            if t == tag:
                break

    def close(self):
        super().close()
        while self.stack:
            self.handle_endtag(self.stack[-1][0])


def containers(text: str | None) -> list[tuple[str, float]]:
    """(generalised path, score) of each container: its text outside links, less a cost for each tag.

    Up to a fifth of a container's text may stand in links for nothing, as prose has links too.
    """
    if not text or "<" not in text:
        return []
    p = _Containers()
    p.feed(text)
    p.close()
    return [(path, text_n - 1.25 * link - TAG_COST * (tags - 1) if text_n else -1.0) for path, text_n, link, tags in p.done if path.rsplit(" ", 1)[-1].split(".")[0] not in PARTS]


class _Plain(HTMLParser):
    """The source of a text without the containers on dropped paths."""

    def __init__(self, dropped: frozenset[str]) -> None:
        super().__init__(convert_charrefs=False)
        self.dropped, self.out, self.stack, self.skip = dropped, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            self.stack.append((tag, _general(tag, attrs)))
            if self.skip or " ".join(s[1] for s in self.stack[-3:]) in self.dropped:
                self.skip += 1
        if not self.skip:
            self.out.append(self.get_starttag_text() or "")

    def handle_endtag(self, tag):
        if any(s[0] == tag for s in self.stack):
            while self.stack:
                t, _ = self.stack.pop()
                self.skip -= bool(self.skip)
                if t == tag:
                    break
        if not self.skip:
            self.out.append(f"</{tag}>")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)

    def handle_entityref(self, name):
        if not self.skip:
            self.out.append(f"&{name};")

    def handle_charref(self, name):
        if not self.skip:
            self.out.append(f"&#{name};")


class _Extract(HTMLParser):
    """HTML to clean text without the containers on dropped paths."""

    def __init__(self, dropped: frozenset[str]) -> None:
        super().__init__(convert_charrefs=False)
        self.dropped, self.out, self.stack, self.lists, self.cells, self.skip = dropped, [], [], [], None, 0

    def _line(self):
        if self.out and not "".join(self.out[-2:]).endswith("\n"):
            self.out.append("\n")

    def handle_starttag(self, tag, attrs):
        if tag not in ELEMENTS:
            if not self.skip:
                self.out.append(self.get_starttag_text() or "")
            return
        if tag in VOID:
            if self.skip:
                return
            if tag in ("br", "hr"):
                self.out.append("\n")
            elif tag == "img":
                self.out.append(next((v for k, v in attrs if k == "alt" and v), ""))
            return
        self.stack.append((tag, _general(tag, attrs)))
        path = " ".join(s[1] for s in self.stack[-3:])
        if self.skip or tag in NO_PROSE or path in self.dropped:
            self.skip += 1
            self.stack[-1] = (tag, "\0" + self.stack[-1][1])
            return
        if tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        elif tag == "li":
            self._line()
            if self.lists and self.lists[-1][0] == "ol":
                self.lists[-1][1] += 1
                self.out.append(f"{self.lists[-1][1]}. ")
            else:
                self.out.append("- ")
        elif re.fullmatch(r"h[1-6]", tag):
            self._line()
            self.out.append("#" * int(tag[1]) + " ")
        elif tag == "pre":
            self._line()
            self.out.append("```\n")
        elif tag == "tr":
            self._line()
            self.cells = 0
        elif tag in ("td", "th"):
            self.out.append("| ")
        elif tag in ("p", "div", "table", "section", "article", "blockquote", "dl", "dt", "dd", "caption"):
            self._line()

    def handle_endtag(self, tag):
        if tag not in ELEMENTS or not any(s[0] == tag for s in self.stack):
            return
        while self.stack:
            t, general = self.stack.pop()
            if general.startswith("\0"):
                self.skip -= 1
            elif t in ("ul", "ol"):
                if self.lists:
                    self.lists.pop()
                self._line()
            elif t == "pre":
                self._line()
                self.out.append("```\n")
            elif t == "tr":
                self.out.append("|\n")
            elif t in ("td", "th"):
                self.out.append(" ")
            elif re.fullmatch(r"h[1-6]|li|p|div|table|section|article|blockquote|dt|dd|caption", t):
                self._line()
            if t == tag:
                break

    def handle_data(self, data):
        if self.skip:
            return
        if self.stack and self.stack[-1][0] in ("table", "tr", "thead", "tbody", "tfoot", "ul", "ol"):
            if data.strip():
                self.out.append(data)
            return
        self.out.append(data)

    def handle_entityref(self, name):
        if not self.skip:
            self.out.append(html.entities.html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name):
        if not self.skip:
            self.out.append(html.unescape(f"&#{name};"))


def _table(rows: list[list[str]]) -> str:
    return "\n".join("| " + " | ".join(c.strip() for c in r) + " |" for r in rows if any(c.strip() for c in r))


def _wiki_table(m: re.Match) -> str:
    rows, row = [], []
    for line in m[1].split("\n"):
        if line.startswith("|-"):
            rows.append(row)
            row = []
        elif line.startswith("|+"):
            row.append(line[2:])
        elif line.startswith(("|", "!")):
            row += [c.split("|", 1)[-1] if re.match(r"\s*\w+\s*=", c) else c for c in re.split(r"\|\||!!", line[1:])]
    return _table([*rows, row]) + "\n"


def _environment(m: re.Match) -> str:
    name, body = m[1].rstrip("*"), m[2]
    if name in ("equation", "align", "gather", "multline", "displaymath", "math", "eqnarray"):
        return f"\n$$ {body.strip()} $$\n"
    if name in ("tabular", "tabularx", "longtable", "array"):
        return "\n" + _table([r.split("&") for r in re.sub(r"\\(?:hline|toprule|midrule|bottomrule)", "", body).split("\\\\")]) + "\n"
    if name in ("verbatim", "lstlisting", "minted"):
        return f"\n```\n{body.strip()}\n```\n"
    n = iter(range(1, 10**6))
    return re.sub(r"[ \t]*\\item(?:\[[^\]]*\])?[ \t]*", lambda _: f"{next(n)}. " if name == "enumerate" else "- ", body)


def _until(pattern: re.Pattern, by, text: str) -> str:
    """Replaces matches, which have none inside, from the innermost outward until there is none."""
    n = 1
    while n:
        text, n = pattern.subn(by, text)
    return text


def clean(text: str | None, dropped: frozenset[str] = frozenset()) -> str | None:
    """The text without markup, with headings, lists, tables, code and formulas kept as such."""
    if not text:
        return text
    kept: list[str] = []

    def keep(s: str) -> str:
        kept.append(s)
        return f"\0{len(kept) - 1}\0"

    text = text.replace("\0", "")
    text = _FENCE.sub(lambda m: keep("```\n" + m[2].rstrip("\n") + "\n```"), text)
    text = re.sub(r"^[ ]{0,3}(```|~~~).*$", "", text, flags=re.M)
    text = _CODE.sub(lambda m: keep(m[2]), text)
    text = _COMMENT.sub("", text)
    text = _until(_ENVIRONMENT, _environment, text)
    text = _DISPLAY.sub(lambda m: keep(f"$$ {next(g for g in m.groups() if g is not None).strip()} $$"), text)
    text = _INLINE.sub(lambda m: keep(m[0]), text)
    if any(_is_tag(m) for m in _TAG.finditer(text)) or _ENTITY.search(text):
        # signs of prose such as "V < 18" must not open a tag
        p = _Extract(dropped)
        p.feed(_OPEN_SIGN.sub(lambda m: keep("<"), text))
        p.close()
        text = "".join(p.out)
    text = _WIKI_TABLE.sub(_wiki_table, text)
    text = re.sub(r"\[\[(?:File|Image|ملف|صورة):[^\[\]|]*(?:\|[^\[\]|]*)*?\|?([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\[\[(?:Category|تصنيف):([^\[\]|]*)(?:\|[^\[\]]*)?\]\]", r"\1", text)
    text = _WIKI_LINK.sub(lambda m: m[2] or m[1], text)
    text = _until(_TEMPLATE, lambda m: "، ".join(x for x in m[1].split("|")[1:] if "=" not in x), text)
    text = _EXTERNAL.sub(r"\2", _REF.sub("", _MAGIC.sub("", text)))
    text = _QUOTES.sub(lambda m: next(g for g in m.groups() if g is not None), text)
    text = _WIKI_HEAD.sub(lambda m: keep("#" * len(m[1])) + " " + m[2], text)
    text = re.sub(r"\\(chapter|section|subsection|subsubsection|paragraph)\*?\{([^{}]*)\}", lambda m: "#" * (1 + ("chapter", "section", "subsection", "subsubsection", "paragraph").index(m[1])) + " " + m[2], text)
    text = re.sub(r"\\SI\{([^{}]*)\}\{([^{}]*)\}", lambda m: m[1] + " " + m[2].replace("\\", ""), text)
    text = re.sub(r"\\(?:ref|label|cite|eqref|pageref|includegraphics|usepackage|documentclass)(?:\[[^\]]*\])?\{[^{}]*\}", "", text)
    text = _until(_ARGUMENT, r"\1", text)
    text = _COMMAND.sub(lambda m: "" if _is_command(m) else m[0], text)
    text = re.sub(r"\\\\(?=\s|$)", "", re.sub(r"\\([%&#_${}])", r"\1", text))
    text = _SETEXT.sub(lambda m: ("# " if m[2][0] == "=" else "## ") + m[1].strip(), text)
    text = _RULE.sub("", _DELIMITER.sub("\1", text)).replace("\1\n", "").replace("\1", "")
    text = _AUTOLINK.sub(r"\1", _LINK.sub(r"\1", _IMAGE.sub(r"\1", text)))
    for _ in range(2):
        text = _ITALIC.sub(lambda m: m[1] or m[2], _BOLD.sub(r"\2", _STRIKE.sub(r"\1", text)))
    text = re.sub(r"^[ \t]*[*+-][ \t]+\[[ xX]\][ \t]*", "- ", text, flags=re.M)
    lines, before = [], ""
    for line in text.split("\n"):
        m = _BLOCK.match(line)
        if m and (_SENTENCE_END.search(before) or _BLOCK.match(before)):
            lines.append(m[3] if m[2][0] == ">" else m[1] + ("- " if m[2] in "*+-" else m[2] + " ") + m[3])
        else:
            lines.append(line.rstrip())
        before = line
    text = re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n")
    for _ in range(2):
        text = re.sub("\0(\\d+)\0", lambda m: kept[int(m[1])], text)
    return text


def _with_lost(df: DataFrame, text: str, host: str) -> DataFrame:
    """`df` with `__lost`, the losing paths of each text, or null.

    Scores are summed by host and path inside each task before they meet; what comes back to a text are the paths that
    it has itself, so that no list grows with its host, and a host of a third of all rows is split like any hot key.
    """

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(r, h, path, v) for r, h, t in zip(b["r"], b["h"], b["t"]) for path, v in containers(t)]
            yield pd.DataFrame(rows, columns=["r", "h", "path", "score"]).astype({"r": "int64", "h": object, "path": object, "score": float})

    row = F.xxhash64(text, host)
    texts = df.select(row.alias("r"), F.coalesce(F.col(host), F.lit("")).alias("h"), F.col(text).alias("t")).where(F.col("t").contains("<"))
    scored = cut(texts.mapInPandas(score, "r long, h string, path string, score double"), "scores")
    losing = scored.groupBy("h", "path").agg(F.sum("score").alias("score")).where("score <= 0").select("h", "path")
    lost = cut(scored.select("r", "h", "path").distinct().join(losing, ["h", "path"]).groupBy("r").agg(F.collect_set("path").alias("__lost")), "lost")
    return df.withColumn("__r", row).join(lost.withColumnRenamed("r", "__r"), "__r", "left").drop("__r")


def named(df: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """(key, markup): each language of which a text holds a construct in what is extracted from the winning paths."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, m) for k, t, d in zip(b["k"], b["t"], b["__lost"]) for m in kinds(t, _NONE if d is None else frozenset(d))]
            yield pd.DataFrame({"k": pd.Series([r[0] for r in rows], dtype=b["k"].dtype), "markup": pd.Series([r[1] for r in rows], dtype=object)})

    narrow = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(host).alias("h")).where("t <> ''")
    found = _with_lost(narrow, "t", "h").select("k", "t", "__lost").mapInPandas(run, f"k {df.schema[key].dataType.simpleString()}, markup string")
    return found.select(F.col("k").alias(key), "markup").distinct()


def cleaned(df: DataFrame, text: str, host: str) -> DataFrame:
    """`df` with `clean_text` and `markup` (array of languages), by consensus of each host's paths."""

    @F.pandas_udf("clean_text string, markup array<string>")
    def extract(t: pd.Series, d: pd.Series) -> pd.DataFrame:
        out = []
        for x, p in zip(t, d):
            lost = _NONE if p is None else frozenset(p)
            found = kinds(x, lost) if isinstance(x, str) else []
            # a text without any construct is clean as it is
            out.append((clean(x, lost) if found else x if isinstance(x, str) else None, found))
        return pd.DataFrame(out, columns=["clean_text", "markup"]).astype(object)

    names = [c for c in df.columns if c not in ("clean_text", "markup")]
    return _with_lost(df, text, host).withColumn("__x", extract(F.col(text), F.col("__lost"))).select(*names, "__x.clean_text", "__x.markup")
