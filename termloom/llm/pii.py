"""Personal data: base patterns and a linear-chain conditional random field.

Base spans are found in linear time whatever the text holds. The random field labels
words from word-shape features (shape, neighbours' shapes, digit counts, cue words); it is
trained by gradient steps on the small labelled table below and adds spans that
the base patterns miss, such as a phone number without a plus sign. Only words with a
digit or an at sign can be part of an entity, so it decodes segments around those words:
all segments of an Arrow batch at once, grouped by length, by Viterbi in numpy.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


KINDS = ["email", "ip", "card", "phone"]
LABELS = ["O", *KINDS]
AROUND = 3

# Base patterns -----------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, from one at sign to the next."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers at a time from each run of dotted numbers."""
    for run in _DOTTED.finditer(text):
        four, start, at = [], run.start(), run.start()
        for part in run[0].split("."):
            if not four:
                start = at
            four = [*four, part] if part else []
            at += len(part)
            if len(four) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    yield start, at
                four = []
            at += 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches by start, then kind as listed."""
    found = [(*s, "email") for s in emails(text)]
    if _DIGIT.search(text):
        found += [(*s, "ip") for s in addresses(text)]
        found += [(*s, "card") for s in cards(text)]
        if "+" in text:
            found += [(*s, "phone") for s in phones(text)]
    return ordered(found)


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# The random field --------------------------------------------------------------------

#: The labelled table: words, and one letter each (o, e, i, c, p for the labels in order).
LABELLED = [
    ("please call me at +1 (415) 555-0132 before noon", "oooopppoo"),
    ("my phone is 415-555-0132 thanks", "ooopo"),
    ("phone: (415) 555-0132 or later", "oppoo"),
    ("tel 030 1234567 in the morning", "oppooo"),
    ("tel. 0049 89 1234567 office", "opppo"),
    ("reach us on 555.123.4567 today", "ooopo"),
    ("fax +44 20 7946 0958 only", "oppppo"),
    ("mobile 07700 900123 (evenings)", "oppo"),
    ("write to jane.doe@example.com soon", "ooeo"),
    ("mail me: bob99@mail.example.org.", "ooe"),
    ("contact info@example.net, or ask", "oeoo"),
    ("send it to a.b+c@sub.example.co.uk now", "oooeo"),
    ("the old root@localhost account was closed", "oooooo"),
    ("ask tim_7@host.example.com, please", "oeo"),
    ("mail: kate88@corp.example.com now", "oeo"),
    ("from x1y2@site2.example.org; and more", "oeoo"),
    ("reply to: z-9@example.net thanks, bye", "ooeoo"),
    ("cc team.42@list.example.info, today", "oeo"),
    ("server 10.0.0.12 is down", "oioo"),
    ("login from 192.168.1.77 at 10:45", "ooioo"),
    ("host 172.16.254.1:8080 answered", "oio"),
    ("card 4111 1111 1111 1111 exp 12/27", "occccoo"),
    ("paid with 5500-0000-0000-0004 yesterday", "ooco"),
    ("visa 4012888888881881 was charged", "ocoo"),
    ("amex 3782 822463 10005 on file", "occcoo"),
    ("in 2019 about 300 people came", "oooooo"),
    ("chapter 3 and 4 of volume 12", "ooooooo"),
    ("version 2.10.3 was released on 2020-01-31", "oooooo"),
    ("it costs 12.50 or 1,200 in total", "ooooooo"),
    ("pages 100-120 and 45 more", "ooooo"),
    ("room 101 at 9:30 on 3/4", "oooooo"),
    ("token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff here", "oooo"),
    ("order 100234 has 3 items", "ooooo"),
    ("in 1998, 1999 and 2000 it rained", "ooooooo"),
    ("score 3-2 after 90 minutes", "ooooo"),
    ("isbn 978-3-16-148410-0 second edition", "oooo"),
    ("the sum of 15 and 27 is 42", "oooooooo"),
    ("follow @someone for 10% off", "ooooo"),
    ("she ran 5 km in 25:30 @ noon", "oooooooo"),
]
_LETTER = dict(zip("oeicp", range(5), strict=True))
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CUES = frozenset("tel tel. tel: phone phone: fax mobile call mail mail: email card visa amex host server".split())
_SHAPES = str.maketrans(
    {**{chr(c): "d" for c in range(48, 58)}, **{chr(c): "X" for c in range(65, 91)},
     **{chr(c): "x" for c in range(97, 123)}}
)
ROUNDS, RATE, PENALTY = 200, 0.3, 0.02


def shape(word: str) -> str:
    """Letters as X and x, digits as d, other characters as they are; runs shortened to two."""
    return re.sub(r"(.)\1{2,}", r"\1\1", word.translate(_SHAPES))


def possible(word: str) -> bool:
    """Whether a word may be part of an entity."""
    return "@" in word[1:-1] or _DIGIT.search(word) is not None


def features(words: list[str]) -> list[list[str]]:
    """Names of the active features by word."""
    shapes = ["<", *[shape(w) for w in words], ">"]
    out = []
    for i, word in enumerate(words):
        digits = sum(c.isdigit() for c in word)
        names = [f"s{shapes[i + 1]}", f"p{shapes[i]}", f"n{shapes[i + 2]}", f"d{min(digits, 17)}",
                 f"dots{min(word.count('.'), 4)}", f"dash{min(word.count('-'), 4)}"]
        if "@" in word[1:-1]:
            names.append("at." if "." in word.rpartition("@")[2] else "at")
        for k, name in ((i - 1, "cue1"), (i - 2, "cue2")):
            if k >= 0 and words[k].lower() in _CUES:
                names.append(name)
        out.append(names)
    return out


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, names: dict[str, int], state: np.ndarray, step: np.ndarray):
        self.names, self.state, self.step = names, state, step

    def scores(self, words: list[str]) -> np.ndarray:
        """One row per word and column per label; impossible labels are ruled out."""
        out = np.zeros((len(words), len(LABELS)))
        for i, active in enumerate(features(words)):
            out[i] = self.state[[self.names[f] for f in active if f in self.names]].sum(axis=0)
            if not possible(words[i]):
                out[i, 1:] = -1e6
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train() -> Field:
    """Maximum likelihood with an L2 penalty, by AdaGrad over the labelled table."""
    rows = [(t.split(), [_LETTER[c] for c in y]) for t, y in LABELLED]
    assert all(len(w) == len(y) for w, y in rows)
    names: dict[str, int] = {}
    for words, _ in rows:
        for active in features(words):
            for f in active:
                names.setdefault(f, len(names))
    size = len(LABELS)
    model = Field(names, np.zeros((len(names), size)), np.zeros((size, size)))
    sums = [np.full_like(model.state, 1e-8), np.full_like(model.step, 1e-8)]
    for _ in range(ROUNDS):
        grads = [-PENALTY * model.state, -PENALTY * model.step]
        for words, gold in rows:
            x, n = model.scores(words), len(words)
            ahead, back = np.zeros((n, size)), np.zeros((n, size))
            ahead[0] = x[0]
            for i in range(1, n):
                ahead[i] = x[i] + _log_sum(ahead[i - 1][:, None] + model.step, 0)
            for i in range(n - 2, -1, -1):
                back[i] = _log_sum(model.step + x[i + 1] + back[i + 1], 1)
            total = _log_sum(ahead[-1], 0)
            own = -np.exp(ahead + back - total)
            own[np.arange(n), gold] += 1
            for i, active in enumerate(features(words)):
                for f in active:
                    grads[0][names[f]] += own[i]
            for i in range(1, n):
                both = ahead[i - 1][:, None] + model.step + x[i] + back[i] - total
                grads[1] -= np.exp(both)
                grads[1][gold[i - 1], gold[i]] += 1
        for value, grad, total in zip((model.state, model.step), grads, sums, strict=True):
            total += grad**2
            value += RATE * grad / np.sqrt(total)
    return model


def viterbi(model: Field, sequences: list[np.ndarray]) -> list[np.ndarray]:
    """Best labels of many sequences of scores; those of similar length go together."""
    out: list[np.ndarray] = [np.zeros(0, int)] * len(sequences)
    groups: dict[int, list[int]] = {}
    for k, x in enumerate(sequences):
        groups.setdefault((len(x) - 1).bit_length(), []).append(k)
    for members in groups.values():
        lengths = np.array([len(sequences[k]) for k in members])
        longest = int(lengths.max())
        x = np.zeros((len(members), longest, len(LABELS)))
        for row, k in enumerate(members):
            x[row, : len(sequences[k])] = sequences[k]
        best = x[:, 0].copy()
        came = np.zeros(x.shape, np.int8)
        for i in range(1, longest):
            step = best[:, :, None] + model.step
            came[:, i] = step.argmax(axis=1)
            best = np.where((i < lengths)[:, None], step.max(axis=1) + x[:, i], best)
        at = best.argmax(axis=1)
        labels = np.zeros((len(members), longest), int)
        for i in range(longest - 1, -1, -1):
            inside = i < lengths
            labels[inside, i] = at[inside]
            at = np.where(inside & (i > 0), came[np.arange(len(members)), i, at], at)
        for row, k in enumerate(members):
            out[k] = labels[row, : lengths[row]]
    return out


def segments(text: str) -> list[list[tuple[int, int]]]:
    """Word spans around the words that may be part of an entity, as separate runs."""
    if not _DIGIT.search(text) and "@" not in text:
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    spots = [i for i, (a, b) in enumerate(words) if possible(text[a:b])]
    runs: list[list[int]] = []
    for i in spots:
        if runs and i - AROUND <= runs[-1][1]:
            runs[-1][1] = i + AROUND + 1
        else:
            runs.append([max(0, i - AROUND), i + AROUND + 1])
    return [words[a:b] for a, b in runs]


_EDGE = "()[]{}<>,;:.!?\"'#*$%&|"


def plausible(kind: str, found: str) -> bool:
    """Whether a decoded span can be what its label says."""
    digits = sum(c.isdigit() for c in found)
    if kind == "email":
        return "@" in found[1:-1] and "." in found.rpartition("@")[2]
    if kind == "ip":
        return any(True for _ in addresses(found))
    if kind == "card":
        return 13 <= digits <= 19 and not any(c.isalpha() for c in found)
    return 7 <= digits <= 15 and not any(c.isalpha() for c in found)


def decoded(text: str, runs: list[list[tuple[int, int]]], labels: list[np.ndarray]) -> list[tuple[int, int, str]]:
    """Spans of the labels, without punctuation at the ends."""
    out = []
    for run, marks in zip(runs, labels, strict=True):
        i = 0
        while i < len(run):
            j = i
            # Cards and phone numbers may have blanks inside, the others are one word.
            while LABELS[marks[i]] in ("card", "phone") and j + 1 < len(run) and marks[j + 1] == marks[i]:
                j += 1
            if marks[i]:
                start, end = run[i][0], run[j][1]
                while start < end and text[start] in _EDGE.replace("(", ""):
                    start += 1
                while end > start and text[end - 1] in _EDGE:
                    end -= 1
                kind = LABELS[marks[i]]
                if plausible(kind, text[start:end]):
                    out.append((start, end, kind))
            i = j + 1
    return out


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def with_added(base: list[tuple[int, int, str]], more: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Base spans and those of ``more`` that overlap none of them."""
    starts = sorted((a, b) for a, b, _ in base)
    out, k, reach = list(base), 0, -1
    for a, b, kind in sorted(more):
        while k < len(starts) and starts[k][0] < b:
            reach = max(reach, starts[k][1])
            k += 1
        if reach <= a:
            out.append((a, b, kind))
    return ordered(out)


SCHEMA = """doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,
spans string, n_added long"""


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts and digest, all ``spans`` and ``n_added`` for every row.

    Null and empty texts have no spans; rows that share an id are rows of their own.
    """
    model = train()
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].fill_null("").to_pylist()
            runs = [segments(t) for t in texts]
            scores = [
                model.scores([t[a:b] for a, b in r]) for t, rs in zip(texts, runs, strict=True) for r in rs
            ]
            labels = iter(viterbi(model, scores))
            rows = []
            for text, own in zip(texts, runs, strict=True):
                base = base_spans(text)
                found = decoded(text, own, [next(labels) for _ in own])
                every = with_added(base, found)
                counts = [sum(s[2] == kind for s in base) for kind in KINDS]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, digest, written(every), len(every) - len(base)))
            columns = [batch["doc_id"], *(list(zip(*rows, strict=True)) or [[]] * (len(names) - 1))]
            made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(made, names)

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return slim.mapInArrow(run, SCHEMA)
