"""Broken prompt and response pairs (problem 7).

A multi-label linear classifier on hashed word n-grams and pair features.  Its training rows are made from a bounded
sample of the table itself: responses are truncated, replaced by copies of their question, swapped with a response
in another language, or replaced by refusals; untouched responses are the negatives.  A first model finds the
sample's own defects, which are then left out of the negatives of the second.  Thresholds are calibrated on held-out
made rows.  The label `empty` needs no model: a null, or a text without letters and digits or that only says that
there is nothing.

Only the gradient fit and the thresholds come from the sample.  How often the words before an ending without a mark
stand at all, and how often they close a sentence, is counted over all rows: the contexts of such endings are taken
first, a bitmap of fixed size tells them from the others while every text is counted, and the sums are joined back.

`flag` gives one row for each defective row and field.  Defined results: a null question counts as empty; a table
without any usable sample gives only `empty`; repeated rows are flagged each; of several
labels one counts: empty, wrong_language, copied_question, refusal, truncated.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.lookalike import normalize
from quern.shared import cut

#: Rows of the labelled sample, at most.
SAMPLE = 2500
BITS = 18
LABELS = ("truncated", "refusal", "copied_question", "wrong_language")
#: Of several labels the first counts: a text in another language looks broken off as well.
ORDER = (3, 2, 1, 0)
# Texts that say that there is nothing.
NOTHING = {"na", "n a", "none", "null", "nil", "nan", "tbd", "tba", "todo", "empty", "no answer", "unknown", "undefined", "not available", "not applicable", "لا يوجد", "لايوجد", "لا شيء", "لا شي", "غير متوفر", "غير متاح", "فارغ", "بدون", "ما فيه", "br", "nbsp"}
# Frequent function words of languages in Latin letters.
FUNCTION_WORDS = {
    "en": "the a an of and or to in on at is are was be been must may should can cannot for with by from if when once that this it its not before after while because since so as under per what how why who where which do does".split(),
    "es": "el la los las de del y o un una en es está por para con que se al antes después cada no su cuando".split(),
    "fr": "le la les des de du et ou un une en est par pour avec que se au aux avant après chaque ne pas sur dans il".split(),
    "tr": "ve bir bu için ile de da önce sonra içinde her gün kadar olarak daha en çok değil".split(),
    "de": "der die das und oder ein eine einen in ist zu mit von für nicht vor nach den dem wird auf bei".split(),
    "it": "il lo la gli le di e o un una in è per con che si non prima dopo del della".split(),
    "pt": "o a os as de do da e ou um uma em é por para com que se não antes depois ao".split(),
    "id": "dan atau yang di ke dari untuk dengan ini itu tidak sebelum setelah pada".split(),
}
# Refusals to make training rows from; {t} is a topic, {u} a party.
REFUSALS = {
    "en": ["I'm sorry, but I can't help with {t}.", "I cannot answer questions concerning {t}. Ask {u} instead.", "I am unable to answer this question about {t}.", "As an AI language model, I have no authority to discuss {t}.", "My guidelines do not let me discuss {t}.", "This request about {t} goes beyond what I am able to do.", "Unfortunately the passage says nothing about {t}, so no answer.", "I lack the information on {t}. Please consult {u}.", "I'd rather not comment on {t}.", "I won't be able to provide details on {t}; please contact {u}.", "Sorry, this is outside my scope.", "I do not have enough information to answer.", "It would not be appropriate for me to advise on {t}.", "I must decline to answer this about {t}.", "Sure! However, I must decline to explain {t}.", "Apologies, I am unable to provide instructions for {t}.", "It would not be appropriate for me to say anything on {t}."],
    "ar": ["عذراً، ما أقدر أساعدك في موضوع {t}.", "آسف، هذا السؤال عن {t} خارج نطاقي.", "أعتذر عن الإجابة بخصوص {t}.", "ما أقدر أجاوب على هالسؤال، اسأل {u} أحسن.", "لا يمكنني تقديم المساعدة في {t}، تواصل مع {u}.", "أنا نموذج لغوي وما عندي صلاحية أتكلم عن {t}.", "للأسف النص ما فيه شيء عن {t} ولا أقدر أعطيك جواب.", "ما يصير أفتي في {t}، سامحني.", "لا أستطيع الإجابة عن هذا السؤال حول {t}.", "ليس لدي معلومات كافية عن {t}، راجع {u}.", "ما عندي معلومات عن {t}، كلم {u}.", "أفضل ما أعلق على {t}.", "أعتذر عن الإجابة.", "أعتذر، ما أقدر أعطيك جواب عن {t}."],
}
# Words put before a repeated question, and leads of lists that break off.
ASKED = {"en": ["You are asking: ", "Question: ", "Your question: ", "You asked: ", ""], "ar": ["سؤالك: ", "السؤال: ", "تسأل: ", "تقصد: ", ""]}
ASIDES = {"en": ["for example", "that is", "see", "such as", "e.g."], "ar": ["مثل", "شوف", "يعني", "مثلاً", "أي"]}
LEADS = {"en": ["You will need:", "The steps are:", "As follows:", "For example,", "including:", "and the following:"], "ar": ["لازم تجهز التالي:", "والخطوات هي:", "كالتالي:", "مثل:", "وتشمل:", "وهي:"]}

# Frequent words of Arabic and Urdu, to make texts in another language from.
OTHER_WORDS = {"ar": "في من على إلى عن هذا هذه كان قبل بعد مع كل أو ثم التي الذي عند حتى لم قد".split(), "eastern": "کے کی میں سے ہے کو پر یہ اور نہیں ہیں تھا ایک کا لیے بعد پہلے گا کرتا ہوں".split()}

_WORD = re.compile(r"[^\W_]+")
_STOPS = frozenset(".!?؟۔।")
_MASK = np.uint64((1 << BITS) - 1)
_DIGITS = re.compile(r"\d+")
_LETTER = re.compile(r"[^\W\d_]")
_EASTERN = re.compile("[ٹپچڈگژڑںےھہکی]+")
_ARABIC = re.compile("[ء-ي]+")
_LATIN = re.compile("[A-Za-zÀ-ɏ]+")
_OTHER = re.compile("[Ѐ-ӿऀ-ॿ฀-๿぀-ヿ一-鿿가-힯Ͱ-Ͽ֐-׿]+")
_END_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_BARE_ITEM = re.compile(r"(^|\n)\s*(\d{1,2}[.)]|[-*•])$")
_SENTENCE = re.compile(r"(?<=[.!?؟۔।])\s+")
_FUNCTION = {lang: frozenset(v) for lang, v in FUNCTION_WORDS.items()}


def is_empty(text: str | None) -> bool:
    """Whether a text has no content; true for null."""
    if text is None:
        return True
    if len(text) > 60 and _WORD.search(text):
        return False
    w = _WORD.findall(text)
    return not w or len(w) <= 3 and " ".join(w).casefold() in NOTHING


#: Each function word with the languages that have it, English first.
_HAVE: dict[str, tuple[str, ...]] = {w: tuple(k for k, v in _FUNCTION.items() if w in v) for v in _FUNCTION.values() for w in v}


def language(text: str, words: list[str] | None = None) -> str:
    """ar, an eastern language in Arabic letters, a language in Latin letters, another script, or nothing; words: those
    of the text in lower case, where they are known."""
    words = _WORD.findall(text.lower()) if words is None else words
    if text.isascii():
        words = [x for x in words if x[0] > "9"]
        if sum(map(len, words)) < 4:
            return ""
    else:
        a = sum(map(len, _ARABIC.findall(text)))
        e = sum(map(len, _EASTERN.findall(text))) if a else 0
        if a < 4 or 4 * a < 3 * sum(map(len, words)):  # not clearly Arabic letters
            lat, o = sum(map(len, _LATIN.findall(text))), sum(map(len, _OTHER.findall(text)))
            if not a and not lat:
                e = sum(map(len, _EASTERN.findall(text)))
            if a + e + lat + o < 4:
                return ""
            if o > max(a + e, lat):
                return "other"
            if a + e <= lat:
                return _latin_language([x for x in words if not x[0].isdigit()])
        return "eastern" if e > 0.08 * (a + e) else "ar"
    return _latin_language(words)


def _latin_language(words: list[str]) -> str:
    score = dict.fromkeys(_FUNCTION, 0)
    for x in words:
        if x in _HAVE:
            for k in _HAVE[x]:
                score[k] += 1
    best = max(score, key=score.get)
    if score["en"] >= score[best]:
        return "en" if score["en"] > 0 or len(words) < 6 else "latin"
    return best


class _Remembered(dict):
    """Numbers of words, remembered within bounds."""

    def __init__(self, number) -> None:
        super().__init__()
        self.number = number

    def __missing__(self, x: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        h = self[x] = self.number(x)
        return h


#: Words or tokens a worker remembers.
_REMEMBERED = 300_000
_word_ids = _Remembered(lambda w: zlib.crc32((w if not w[0].isdigit() else _DIGITS.sub("0", w)).encode()) | 1 << 32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & _MASK


#: Features of a text: hashed ids with a value each, in one flat array by text.
@dataclass
class Features:
    ids: np.ndarray
    values: np.ndarray
    starts: np.ndarray  # one more than texts


DENSE = 31


#: Contexts of an ending, the most telling first, and those of its last two tokens alone; bits of the map of contexts.
LEVELS, CONTEXTS, MAP = 4, 6, 1 << 24
_token_ids = _Remembered(lambda x: (xxhash.xxh3_64_intdigest(_DIGITS.sub("0", x)) | 2) & ~1 if x not in _STOPS else 1)


def _ids(text: str) -> list[int]:
    """The tokens of a text as numbers; 1 for a mark that closes a sentence."""
    return [_token_ids[x] for x in _END_TOKEN.findall(text.lower())]


def _keys(h1: np.ndarray, h2: np.ndarray, t2: np.ndarray, t1: np.ndarray, t0: np.ndarray) -> np.ndarray:
    """The contexts of the last token of a begun sentence, by its first two and last three tokens (0 for none): first
    and last three, first and last two, last three, last two, the last token, and the one before it."""

    def mixed(kind: int, *parts: np.ndarray) -> np.ndarray:
        x = np.full(len(t0), kind * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for p in parts:
            x = (x ^ p) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
        return x

    return np.stack([mixed(1, h1, h2, t2, t1, t0), mixed(2, h1, h2, t1, t0), mixed(3, t2, t1, t0), mixed(4, t1, t0), mixed(5, t0), mixed(5, t1)], axis=1)


def open_endings(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(contexts, closed): the contexts of each text's ending, zeros where it ends with a sign or a mark, and whether
    the text has any mark, so that its own ending is not counted."""
    rows, at, closed = [], [], np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        t = t.rstrip()
        last = max(t.rfind(c) for c in _STOPS)
        closed[i] = last >= 0
        if not t or not t[-1].isalnum():
            continue
        x = _ids(t[last + 1 :])
        if x:
            at.append(i)
            rows.append((x[0], x[1] if len(x) > 1 else 0, x[-3] if len(x) > 2 else 0, x[-2] if len(x) > 1 else 0, x[-1]))
    out = np.zeros((len(texts), CONTEXTS), np.uint64)
    if rows:
        out[at] = _keys(*np.array(rows, dtype=np.uint64).T)
    return out, closed


def _counted(texts: list[str], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, runs, ends) of the contexts in the map: how often each stands in these texts, and closes a sentence.

    An ending without a mark, in a text with marks, tells nothing and is left out.
    """
    tokens = [_ids(t) for t in texts]
    lens = np.array([len(x) for x in tokens], np.int64)
    x = np.array([h for t in tokens for h in t], dtype=np.uint64)
    if not len(x):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), lens)
    stop = x == 1
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    begins = first | np.concatenate([[True], stop[:-1]])
    start = np.maximum.accumulate(np.where(begins, np.arange(len(x)), 0))
    place = np.arange(len(x)) - start
    back = lambda n: np.where(place >= n, x[np.maximum(np.arange(len(x)) - n, 0)], np.uint64(0))
    second = np.where(place >= 1, x[np.minimum(start + 1, len(x) - 1)], np.uint64(0))
    last = np.concatenate([first[1:], [True]])
    marks = np.bincount(owner, stop, len(texts)) > 0
    end = np.where(last, ~marks[owner], np.concatenate([stop[1:], [False]]))
    ok = np.flatnonzero(~stop & ~(last & marks[owner]))
    keys = _keys(x[start[ok]], second[ok], back(2)[ok], back(1)[ok], x[ok])[:, : CONTEXTS - 1]
    ends = np.broadcast_to(end[ok][:, None], keys.shape)
    at = keys % np.uint64(MAP)
    hit = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    hit[:, LEVELS] &= ~last[ok]  # a single token counts where something follows it: a word cut short never does
    found, inverse = np.unique(keys[hit], return_inverse=True)
    return found, np.bincount(inverse, minlength=len(found)).astype(np.int64), np.bincount(inverse, ends[hit], len(found)).astype(np.int64)


def ending_features(runs: np.ndarray, ends: np.ndarray, own: np.ndarray, at_end: np.ndarray, followed: np.ndarray) -> np.ndarray:
    """(known, share, last token new, token before it new) from the sums of CONTEXTS contexts by row.

    own tells whether the row's own ending is among the sums, at_end whether there as an end, followed whether its last
    token was followed by something there.  The first context that stands three times or more otherwise tells the share
    of it that closes a sentence; a token that is followed by something less often elsewhere is new.
    """
    n = runs[:, :LEVELS] - own[:, None]
    e = np.clip(ends[:, :LEVELS] - (own & at_end)[:, None], 0, None)
    enough = n >= 3
    level = enough.argmax(axis=1)
    rows = np.arange(len(n))
    known = enough[rows, level]
    share = np.where(known, np.minimum(1.0, e[rows, level] / np.maximum(n[rows, level], 1)), 0.5)
    return np.stack([known.astype(float), share, (runs[:, 4] - followed < 3).astype(float), (runs[:, 5] - 1 < 3).astype(float)], axis=1)


def _pair(qlang: str, qset: set[str], text: str, words: list[str], ending: list[float]) -> list[float]:
    """Features of the pair, besides the n-grams; ending: see `ending_features`."""
    own = set(words)
    extra = len([1 for w in words if w not in qset])
    both = len(own & qset)
    lang = language(text, words)
    tail = text[-1:] if text else " "
    n = len(words)
    open_ = text.count("(") > text.count(")")
    known, share, new, new_before = ending if tail.isalnum() else (0.0, 0.5, 0.0, 0.0)
    return [
        1.0, float(bool(qlang and lang and qlang != lang)), float(bool(qlang and lang and qlang == lang)), float(not lang),
        extra / (n + 1), min(extra, 12) / 4, both / (len(qset) + 1), both / (len(own) + 1), float(extra <= 3 and both >= 0.8 * len(qset)),
        float(tail in ".!?؟۔।"), float(tail.isdigit()), float(tail == ":"), float(tail in ",،;؛"), float(tail in "([{«\"-"), float(tail.isalpha()), float(tail in ")]}»"),
        float(bool(_BARE_ITEM.search(text[-12:]))), float(text.endswith("...") or text.endswith("…")), min(n, 40) / 40, float(n < 15), float(open_), float(extra == 0), float(tail in "?؟"), float(text.count('"') % 2),
        float(new and tail.isalpha()), float(n > 1 and new_before), float(open_ and "(" in text[-30:]),
        known * share, known * (1 - share), float(known > 0 and share > 0.85), float(known > 0 and share < 0.15),
    ]


def featurize(questions: list[str], texts: list[str], tag: int, endings: np.ndarray) -> Features:
    """Whole-text word n-grams (1 and 2), n-grams of the ending, and pair features; `tag` tells the fields apart."""
    flat: list[int] = []
    lens, dense, ends = [], [], []
    asked: dict[str, tuple[str, set[str]]] = {}
    for q, t, own in zip(questions, texts, endings.tolist()):
        t = t.rstrip()
        if q not in asked:
            qw = _WORD.findall(q.lower())
            asked[q] = language(q, qw), set(qw)
        w = _WORD.findall(t.lower())
        flat += [_word_ids[x] for x in w]
        lens.append(len(w))
        dense.append(_pair(*asked[q], t, w, own))
        # the ending, without a closing full stop, as tokens with signs
        e = _END_TOKEN.findall(t[-120:].rstrip(".").lower())[-4:]
        e = [_DIGITS.sub("0", x) for x in e]
        stop = "." if t.endswith(".") else ""
        grams = ["E1" + stop + "|".join(e[-1:]), "E2" + stop + "|".join(e[-2:]), "E3" + stop + "|".join(e[-3:]), "E4" + stop + "|".join(e[-4:])]
        ends.append([zlib.crc32(f"{tag}{g}".encode()) for g in grams])
    n = len(texts)
    ids = np.array(flat, dtype=np.uint64)
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    owner = np.repeat(np.arange(n), lens)
    grams, owners = [_mix(ids)], [owner]
    for k in (2,):
        x = ids.copy()
        for j in range(1, k):
            x = x * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([ids[j:], np.zeros(j, np.uint64)])[: len(ids)] if len(ids) else x
        ok = np.arange(len(ids)) + k <= offsets[owner + 1] if len(ids) else np.zeros(0, bool)
        grams.append(_mix(x[ok]))
        owners.append(owner[ok])
    g, o = np.concatenate(grams), np.concatenate(owners)
    counts = np.bincount(o, minlength=n) if n else np.zeros(0)
    v = 2.0 / np.sqrt(counts[o] + 1.0)
    e = (_mix(np.array(ends, dtype=np.uint64).reshape(n, 4) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(1 << BITS)).ravel()
    d = np.array(dense, dtype=np.float64).reshape(n, DENSE)
    base = 2 << BITS
    all_ids = np.concatenate([g, e, np.tile(np.arange(base + tag * DENSE, base + tag * DENSE + DENSE, dtype=np.uint64), n)]).astype(np.int64)
    all_values = np.concatenate([v, np.full(4 * n, 1.0), d.ravel()])
    owners_all = np.concatenate([o, np.repeat(np.arange(n), 4), np.repeat(np.arange(n), DENSE)])
    order = np.argsort(owners_all, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(owners_all, minlength=n))]) if n else np.zeros(1)
    return Features(all_ids[order], all_values[order], starts.astype(np.int64))


SIZE = (2 << BITS) + 2 * DENSE


def scores(f: Features, weights: np.ndarray) -> np.ndarray:
    """Margins by text and label."""
    if len(f.starts) < 2:
        return np.zeros((0, len(LABELS)))
    return np.add.reduceat(weights[f.ids] * f.values[:, None], f.starts[:-1], axis=0)


def fit(f: Features, y: np.ndarray, known: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.2, seed: int = 7) -> np.ndarray:
    """Weights by AdaGrad on the logistic loss; `known` tells which labels of a row count."""
    rng, w, g2 = np.random.default_rng(seed), np.zeros((SIZE, len(LABELS)), np.float32), np.full((SIZE, len(LABELS)), 1e-3, np.float32)
    n = len(y)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(n), max(1, n // batch)):
            take = np.concatenate([np.arange(f.starts[r], f.starts[r + 1]) for r in rows])
            owner = np.repeat(np.arange(len(rows)), f.starts[rows + 1] - f.starts[rows])
            ids, v = f.ids[take], f.values[take]
            z = np.stack([np.bincount(owner, w[ids, k] * v, len(rows)) for k in range(len(LABELS))], axis=1)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * known[rows]
            u, inverse = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(inverse, err[owner, k] * v, len(u)) for k in range(len(LABELS))], axis=1)
            # by the languages of the pair alone: a swapped response may be in any language
            grad[(u < 2 << BITS) | ((u - (2 << BITS)) % DENSE > 3), LABELS.index("wrong_language")] = 0
            grad += 1e-5 * w[u]
            g2[u] += grad**2
            w[u] -= (rate * grad / np.sqrt(g2[u])).astype(np.float32)
    return w


@dataclass
class Model:
    """Sparse weights and a threshold for each label."""

    index: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    size: int = SIZE
    dense: np.ndarray | None = field(default=None, repr=False)

    def table(self) -> np.ndarray:
        if self.dense is None:
            self.dense = np.zeros((self.size, len(LABELS)), np.float32)
            self.dense[self.index] = self.weights
        return self.dense

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "dense"} | {"dense": None}


def _made(rng: np.random.Generator, q: str, t: str, other: str | None) -> list[tuple[str, int]]:
    """Damaged versions of a response, with the index of their label (-1 for versions that are still whole)."""
    lang = "ar" if language(q) == "ar" else "en"
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    out: list[tuple[str, int]] = []
    for _ in range(3):
        at = int(rng.integers(max(2, len(t) // 5), max(3, len(t) - 2)))
        cutoff = t[:at].rstrip()
        if len(cutoff) > 8 and cutoff[-1] not in ".!?؟۔।" and t[at : at + 1] not in ".!?؟۔।":
            out.append((cutoff, 0))
    parts = _SENTENCE.split(t)
    if len(parts) > 1 and rng.random() < 0.5:
        whole = " ".join(parts[: int(rng.integers(1, len(parts)))])
        out.append((whole + " " + pick(LEADS[lang]), 0))
    if rng.random() < 0.2:
        n = len(parts) + 1
        out.append((t + pick([f"\n{n}.", f" \n{n}. ", f"\n{n})", "\n-", "\n•"]), 0))
    if rng.random() < 0.3:
        word = t.split()
        k = int(rng.integers(max(1, len(word) // 3), len(word))) if len(word) > 2 else 1
        out.append((" ".join(word[:k]).rstrip(".") + pick([",", " (", " -", "،", ":", "\n2.", "\n-"]), 0))
    if rng.random() < 0.3:
        word = t.rstrip(" .").split()
        k = len(word) if rng.random() < 0.5 else int(rng.integers(max(1, len(word) // 3), len(word) + 1))
        out.append((" ".join(word[:k]).rstrip(".،,") + " (" + pick([*ASIDES[lang], ""]), 0))
    w = q.split()
    i = int(rng.integers(max(1, len(w) - 3)))
    topic, party = " ".join(w[i : i + int(rng.integers(1, 4))]).strip("?؟.،,"), " ".join(pick(t.split() or ["-"]) for _ in range(2)).strip(".،,")
    out.append((pick(REFUSALS[lang]).format(t=topic, u=party), 1))
    bare = q.strip().rstrip("?؟.")
    out.append((pick(ASKED[lang]) + pick([q, bare + ".", bare, bare + "...", f'"{q}"', f"{q} {q}", q.lower(), q + "\n"]), 2))
    if other:
        out.append((other, 3))
    out.append((t.rstrip(" ."), -1))  # a missing full stop alone is no defect
    out.append((pick(ASKED[lang]) + q + " " + t, -1))  # nor is a repeated question before the answer
    return out


@dataclass
class Sums:
    """The sums of contexts, by key in order."""

    keys: np.ndarray
    runs: np.ndarray
    ends: np.ndarray

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(runs, ends) of an array of contexts; 0 where there is none."""
        if not len(self.keys):
            return np.zeros(keys.shape, np.int64), np.zeros(keys.shape, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[at] == keys) & (keys != 0)
        return np.where(hit, self.runs[at], 0), np.where(hit, self.ends[at], 0)


#: A row of the training set: field, question, text, label (-1 for a whole text), whether it is made.
Row = tuple[int, str, str, int, bool]


def prepared(questions: list[str], fields: list[list[str | None]], seed: int = 7) -> list[list[Row]]:
    """The rows of each usable response of a sample: itself, and what is made of it; none for a sample too small."""
    rng = np.random.default_rng(seed)
    qs = [normalize(q) or "" for q in questions]
    base: list[tuple[int, str, str]] = []
    for tag, texts in enumerate(fields):
        base += [(tag, q, normalize(t)) for q, t in zip(qs, texts) if not is_empty(t) and q]
    if len(base) < 50:
        return []
    by_lang: dict[tuple[int, str], list[str]] = {}
    for tag, q, t in base:
        by_lang.setdefault((tag, language(t)), []).append(t)
    langs = {tag: [k[1] for k, v in by_lang.items() if k[0] == tag and k[1] and len(v) >= 3] for tag in range(len(fields))}
    out = []
    for tag, q, t in base:
        own = language(q)
        others = [x for x in langs[tag] if x != own]
        other = None
        if others and own:
            pool = by_lang[tag, others[int(rng.integers(len(others)))]]
            other = pool[int(rng.integers(len(pool)))]
        if not other or rng.random() < 0.2:
            other = _foreign(rng, own)
        out.append([(tag, q, t, -1, False), *[(tag, q, x, k, True) for x, k in _made(rng, q, t, other)]])
    return out


def endings_of(rows: list[Row], sums: Sums) -> np.ndarray:
    """`ending_features` of training rows: a text cut short was counted at that place before it was cut, inside a
    sentence, and a text that only lacks its mark as an end."""
    keys, closed = open_endings([r[2] for r in rows])
    runs, ends = sums.of(keys)
    made, label = np.array([r[4] for r in rows], bool), np.array([r[3] for r in rows])
    own = (keys[:, 0] != 0) & np.where(made, label <= 0, ~closed)
    return ending_features(runs, ends, own, label < 0, made & (label <= 0))


def train(questions: list[str], fields: list[list[str | None]], seed: int = 7, sums: Sums | None = None, made: list[list[Row]] | None = None) -> Model | None:
    """The classifier from a sample of questions and their responses (one list for each field); contexts are counted
    over the sample itself unless the sums over a whole table are given."""
    rng = np.random.default_rng(seed)
    groups = made if made is not None else prepared(questions, fields, seed)
    if not groups:
        return None
    rows = [r for g in groups for r in g]
    if sums is None:
        keys = np.unique(open_endings([r[2] for r in rows])[0])
        sums = Sums(*_counted([g[0][2] for g in groups], map_of(keys)))
    n_fields = 1 + max(r[0] for r in rows)
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    order = np.argsort([r[0] for r in rows], kind="stable")
    rows, owner = [rows[i] for i in order], owner[order]
    endings = endings_of(rows, sums)
    tags = np.array([r[0] for r in rows])
    parts = [featurize([r[1] for r in rows if r[0] == t], [r[2] for r in rows if r[0] == t], t, endings[tags == t]) for t in range(n_fields)]
    shift = np.cumsum([0, *[f.starts[-1] for f in parts]])
    f = Features(np.concatenate([x.ids for x in parts]), np.concatenate([x.values for x in parts]), np.concatenate([parts[0].starts, *[x.starts[1:] + s for x, s in zip(parts[1:], shift[1:])]]))
    y = np.stack([(np.array([r[3] for r in rows]) == k).astype(float) for k in range(len(LABELS))], axis=1)
    whole = np.array([not r[4] for r in rows])
    # Each half is cleaned by a model of the other half, which has not seen its defects as negatives.
    half = (rng.random(len(groups)) < 0.5)[owner]
    sound = np.zeros(len(groups), bool)
    for side in (False, True):
        used = np.flatnonzero(half == side)
        w = fit(_subset(f, used), y[used], np.ones_like(y[used]), epochs=2)
        judged = np.flatnonzero((half != side) & whole)
        sound[owner[judged[(scores(_subset(f, judged), w) < -1).all(axis=1)]]] = True
    kept = np.flatnonzero(sound[owner])
    held = rng.random(len(kept)) < 0.15
    used, test = kept[~held], kept[held]
    weights = fit(_subset(f, used), y[used], np.ones_like(y[used]), epochs=4)
    z = scores(_subset(f, test), weights)
    limits = []
    for k in range(len(LABELS)):
        s, truth = z[:, k], y[test][:, k]
        if not truth.any():
            limits.append(float("inf"))
            continue
        order = np.argsort(-s)
        tp = np.cumsum(truth[order])
        f1 = 2 * tp / (np.arange(1, len(order) + 1) + max(1, truth.sum()))
        best = np.flatnonzero(f1 >= f1.max() - 1e-3)
        # the middle of the range of thresholds that do as well
        top, low = s[order][best[0]], s[order][best[-1]]
        below = s[s < low]
        limits.append(float(top + (below.max() if len(below) else low - 2)) / 2)
    used = np.flatnonzero(np.abs(weights).max(axis=1) > 1e-3)
    return Model(used, weights[used], np.array(limits))


def map_of(keys: np.ndarray) -> np.ndarray:
    """The map of contexts."""
    out = np.zeros(MAP // 64, np.uint64)
    at = keys % np.uint64(MAP)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def _foreign(rng: np.random.Generator, lang: str) -> str | None:
    """A text in a language other than `lang`, from frequent words; None where that is unknown."""
    pools = [w for k, w in {**FUNCTION_WORDS, **OTHER_WORDS}.items() if k != lang]
    if not lang:
        return None
    pool = pools[int(rng.integers(len(pools)))]
    return " ".join(pool[int(i)] for i in rng.integers(len(pool), size=int(rng.integers(6, 40)))) + "."


def _subset(f: Features, rows: np.ndarray) -> Features:
    take = np.concatenate([np.arange(f.starts[r], f.starts[r + 1]) for r in rows]) if len(rows) else np.zeros(0, np.int64)
    return Features(f.ids[take], f.values[take], np.concatenate([[0], np.cumsum(f.starts[rows + 1] - f.starts[rows])]).astype(np.int64))


def judge(model: Model | None, questions: list[str | None], texts: list[str | None], tag: int, endings: np.ndarray | None = None) -> list[str | None]:
    """The defect of each response, or None; endings: `ending_features` of the responses, nothing known without."""
    out: list[str | None] = ["empty" if is_empty(t) else None for t in texts]
    rows = [i for i, x in enumerate(out) if x is None]
    if model is None or not rows:
        return out
    told = np.tile([0.0, 0.5, 0.0, 0.0], (len(rows), 1)) if endings is None else endings[rows]
    z = scores(featurize([normalize(questions[i]) or "" for i in rows], [normalize(texts[i]) for i in rows], tag, told), model.table()) - model.thresholds
    for i, row in zip(rows, z):
        out[i] = next((LABELS[k] for k in ORDER if row[k] > 0), None)
    return out


def _strings(s: pd.Series) -> list[str | None]:
    return [x if isinstance(x, str) else None for x in s]


def _take_endings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows, with the contexts of the ending of each response that has an open one."""
    for b in batches:
        keys, closed = open_endings([normalize(t) or "" if isinstance(t, str) else "" for t in b["t"]])
        yield b.assign(keys=[k.view(np.int64) if k[0] else None for k in keys], closed=closed)


def _count_contexts(batches: Iterator[pd.DataFrame], bits: np.ndarray, columns: list[str]) -> Iterator[pd.DataFrame]:
    for b in batches:
        texts = [normalize(t) for c in columns for t in b[c] if isinstance(t, str)]
        keys, runs, ends = _counted(texts, bits)
        yield pd.DataFrame({"key": keys.view(np.int64), "runs": runs, "ends": ends})


def flag(df: DataFrame, key: str, question: str, fields: list[str], sample: int = SAMPLE) -> DataFrame:
    """(key, field, defect) for each defective row and field, by a model fitted on at most `sample` different rows of
    `df`, those with the least hashed keys, and the contexts of all rows."""
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    names = [f"f{i}" for i in range(len(fields))]
    narrow = df.select(F.col(key).alias("k"), F.col(question).alias("q"), *[F.col(c).alias(n) for c, n in zip(fields, names)])
    # copies are one row, by the least lot of their keys; some more than the sample pass the filter, so that no task
    # sends many
    lot = F.shiftrightunsigned(F.xxhash64(F.lit(7), "k"), 24)
    total = max(1, narrow.count())
    some = narrow.where("q is not null").where(lot < F.lit(int(min(1.0, (1.5 * sample + 200) / total) * (1 << 40))))
    rows = some.groupBy("q", *names).agg(F.min(lot).alias("lot")).orderBy("lot", "q", *names).limit(sample).toPandas()
    made = prepared(rows["q"].tolist(), [_strings(rows[n]) for n in names])
    # one row a response: those with an open ending, with its contexts, and the others
    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("tag"), F.col(n).alias("t")) for i, n in enumerate(names)]))
    schema = f"k {df.schema[key].dataType.simpleString()}, q string, tag int, t string"
    long = narrow.select("k", "q", parts.alias("x")).select("k", "q", "x.tag", "x.t")
    ends_open = F.col("t").isNotNull() & ~F.col("t").rlike(r"[.!?؟۔।][\s]*$")
    taken = cut(long.where(ends_open).mapInPandas(_take_endings, f"{schema}, keys array<long>, closed boolean").withColumn("id", F.monotonically_increasing_id()), "endings")
    keys = taken.select("id", "closed", F.posexplode("keys").alias("level", "key"))
    own = np.unique(open_endings([r[2] for g in made for r in g])[0])
    bits = _bits(keys) | map_of(own[own != 0])
    sent = context.broadcast(bits)
    counted = narrow.select(*names).mapInPandas(lambda it: _count_contexts(it, sent.value, names), "key long, runs long, ends long")
    sums = cut(counted.groupBy("key").agg(F.sum("runs").alias("runs"), F.sum("ends").alias("ends")), "contexts")
    # the sample's own contexts come to the driver, a few for each of its rows
    wanted = spark.createDataFrame(pd.DataFrame({"key": own.view(np.int64)}), "key long")
    told = sums.join(wanted, "key", "left_semi").toPandas() if len(own) else pd.DataFrame({"key": [], "runs": [], "ends": []})
    order = np.argsort(told["key"].to_numpy(np.int64).view(np.uint64))
    model = train([], [], sums=Sums(told["key"].to_numpy(np.int64).view(np.uint64)[order], told["runs"].to_numpy(np.int64)[order], told["ends"].to_numpy(np.int64)[order]), made=made)
    fitted = context.broadcast(model)
    by_row = keys.join(sums, "key").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("level", F.struct("runs", "ends")))).alias("sums"))
    known = taken.drop("keys").join(by_row, "id", "left").select("k", "q", "tag", "t", "closed", *[F.coalesce(F.element_at("sums", F.lit(i))[c], F.lit(0)).alias(f"{c}{i}") for c in ("runs", "ends") for i in range(CONTEXTS)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for tag, name in enumerate(fields):
                part = b[b["tag"] == tag]
                endings = None
                if "closed" in part:
                    runs, ends = (part[[f"{c}{i}" for i in range(CONTEXTS)]].to_numpy(np.int64) for c in ("runs", "ends"))
                    counted_too = ~part["closed"].to_numpy(bool)
                    endings = ending_features(runs, ends, counted_too, counted_too, np.zeros(len(part), bool))
                found = judge(fitted.value, _strings(part["q"]), _strings(part["t"]), tag, endings)
                hit = [i for i, x in enumerate(found) if x]
                yield pd.DataFrame({"k": part["k"].to_numpy()[hit], "field": pd.Series([name] * len(hit), dtype=object), "defect": pd.Series([found[i] for i in hit], dtype=object)})

    out = f"{schema.split(', ')[0]}, field string, defect string"
    rest = long.where(~F.coalesce(ends_open, F.lit(False))).mapInPandas(run, out)
    return known.mapInPandas(run, out).union(rest).select(F.col("k").alias(key), "field", "defect")


def _bits(keys: DataFrame) -> np.ndarray:
    """The map of a column of contexts: MAP / 64 rows at most come to the driver."""
    # keys are unsigned; their remainder by a power of two is that of their lowest bits
    h = F.col("key").bitwiseAND(F.lit(MAP - 1)).cast("int")
    rows = keys.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, h & 63)")).alias("bits")).toPandas()
    out = np.zeros(MAP // 64, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(np.uint64)
