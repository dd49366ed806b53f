"""Operator 8: personal data by patterns and a linear-chain conditional random field.

Base spans come from fixed patterns. The field labels the words that have a digit or an ``@``:
other words are outside by a hard constraint, so the chain falls apart into runs of such words in
a line, and decoding only those runs is exact. Features are word shapes, digit counts, the check
digit, neighbours and cue words around. The field is trained on the small labelled table below by
gradient steps on the exact likelihood, and decoded by Viterbi over numpy batches of runs of equal
length. Its spans are added where no base span lies.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import whole_row

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

# The labelled table: [kind text] marks a span.
LABELLED = """
call [phone (974) 555-3436] before noon
phone [phone 974-555-0123] or write
tel [phone 030 901820] in the morning
tel. [phone 0211 555 0199]
fax: [phone 555-7713] please
mobile [phone 07700 900123] after six
my phone is [phone (017) 555-7713] at work
cell [phone 212.555.0187] only
reach me at [phone +1 (974) 555-3436] today
telephone [phone +49 30 901820] ext 4
write to [email und.34@mail7.example.com] soon
mail [email jane.roe@example.org] about it
email [email admin@localhost] for access
e-mail: [email j_doe@intranet] now
contact [email bob99@corp] or [phone 555-0134] today
user [email 27@mail6.example.com] wrote
host [ip 97.51.17.173] answered
ip [ip 10.0.0.1] is up
from [ip 192.168.7.20] to [ip 192.168.7.21] at night
address [ip 129.38.82.176] was seen
server [ip 170.106.47.218] rebooted
card [card 4111 1111 1111 1111] was charged
paid with [card 5500005555555559] yesterday
visa [card 4012888888881881] expires 12/27
number [card 4111-1111-1111-1111] on file
the card [card 378282246310005] is mine
order 5927243074273351 was shipped
invoice 9000426309966109 is due
that 7536784127813050 was here
and 4845168114407329 thereafter
number 1234567812345678 in the list
the id 2353820953013749 is free
on 9807915762804491 they met
ref 4465758382889437 4465758382889437 twice
ids 2353820953013749 4550997810720808 and 7536784127813050 4845168114407329 here
parcel 00340434161094042557 is late
licensed under CC BY-NC 4.0.
the license, version 2.0.
public license, version 3.
version 10.15.7 was released in 2019
python 3.11.4 and 3.12.0 are out
in 1984 about 300 people came
from 1914 to 1918 it was
page 12 of 240
on 2024-05-17 at 10:30 we met
between 09:15 and 17:45 daily
costs 19.99 or 1,299.00 in all
about 25% of 1,500,000 votes
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" in use
key 9f86d081884c7d659a2feaa0c55ad015 again
chapter 7 section 3.2.1 line 44
route 66 and gate b12
isbn 978-3-16-148410-0 in print
room 404 on floor 4
born 03.10.1990 in town
score 3-2 after 90 minutes
model x2000 and mk3
see @someone and @team42 there
add 1 + 2 = 3
mp3 and h264 files
covid19 and b2b
1st 2nd 3rd and 4th
100 200 300 400 500
12 34 56 78
phone 5 of 10 was sold
version 1.2.3.4.5 is odd
size 1024x768 pixels
"""


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


_SPECIAL = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by kind, then start. Every scan is linear in the text: the
    local part of an address is taken backwards from its ``@``, and digit runs are not re-tried."""
    out, done = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            before = text[done : m.start()]
            start = m.start() - (len(before) - len(before.rstrip(LOCAL_CHARS)))
            if start < m.start():
                out.append(("email", start, m.end()))
                done = m.end()
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isascii() and c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def _core(word: str, start: int) -> tuple[str, int, int]:
    """A word without the punctuation around it (an opening plus or bracket before a digit stays)."""
    left = re.match(r"[^\w+(@]*", word).end()
    right = len(word) - len(re.search(r"[\W_]*\Z", word[left:])[0]) if word[left:] else left
    if right <= left:
        left, right = 0, len(word)
    return word[left:right], start + left, start + right


def _word_before(text: str, at: int) -> str:
    """The nearest word before ``at`` on its line, lower-cased, however far; empty if there is none."""
    end = at
    while end and not (text[end - 1].isalnum() or text[end - 1] in "_\n"):
        end -= 1
    start = end
    while start and (text[start - 1].isalnum() or text[start - 1] == "_"):
        start -= 1
    return text[start:end].lower()


_AFTER = re.compile(r"[^\w\n]*(\w+)")


def runs(text: str) -> list[dict]:
    """Runs of neighbouring words with a digit or an ``@``: words, places and the words around."""
    out, last = [], None
    for m in _WORD.finditer(text):
        if last is None or text[last : m.start()].strip(" \t") or m.start() - last > 3:
            out.append({"words": [], "at": [], "prev": _word_before(text, m.start()), "end": 0})
        word, s, e = _core(m.group(), m.start())
        out[-1]["words"].append(word)
        out[-1]["at"].append((s, e))
        out[-1]["end"] = last = m.end()
    for r in out:
        after = _AFTER.match(text, r["end"])
        r["next"] = after[1].lower() if after else ""
    return out


def word_features(word: str) -> list[str]:
    digits = [c for c in word if c.isascii() and c.isdigit()]
    n = len(digits)
    full = re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", word))
    shape = re.sub(r"(.)\1+", r"\1", full)
    size = str(n) if n <= 5 else "6-8" if n <= 8 else "9-12" if n <= 12 else "13-19" if n <= 19 else "20+"
    out = [f"shape={shape}", f"digits={size}", f"chars={''.join(sorted(set(shape)))}"]
    if len(full) <= 16:
        out.append(f"full={full}")
    if 12 < n < 20:
        out.append(f"check={luhn(''.join(digits))}")
    if n and any(c.isalpha() for c in word) and "@" not in word:
        out.append("letters and digits")
    return out


def run_features(run: dict) -> list[list[str]]:
    words = [word_features(w) for w in run["words"]]
    out = []
    whole = [c for w in run["words"] for c in w if c.isascii() and c.isdigit()]
    joined = [f"run check={luhn(''.join(whole))}"] if 12 < len(whole) < 20 and len(words) > 1 else []
    for i, own in enumerate(words):
        prev = words[i - 1][:1] if i else [f"cue {run['prev']}", "first"]
        after = words[i + 1][:1] if i + 1 < len(words) else [f"cue {run['next']}", "last"]
        out.append(["bias", *own, *joined, *[f"before {x}" for x in prev], *[f"after {x}" for x in after]])
    return out


def labelled_table(lines: str = LABELLED) -> list[tuple[str, list[tuple[str, int, int]]]]:
    out = []
    for line in filter(None, lines.split("\n")):
        text, spans, rest = "", [], line
        while m := re.search(r"\[(\w+) ([^\]]*)\]", rest):
            text += rest[: m.start()]
            spans.append((m[1], len(text), len(text) + len(m[2])))
            text, rest = text + m[2], rest[m.end() :]
        out.append((text + rest, spans))
    return out


class Field:
    """The trained field: weights of features by label, and of label pairs."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray, begin: np.ndarray):
        self.names, self.emit, self.move, self.begin = names, emit, move, begin

    def scores(self, features: list[list[list[str]]]) -> np.ndarray:
        """Runs of one length to runs x words x labels."""
        n, t = len(features), len(features[0])
        known = [[[self.names[f] for f in w if f in self.names] for w in r] for r in features]
        width = max(1, max(len(w) for r in known for w in r))
        at = np.full((n, t, width), len(self.emit) - 1)
        for i, r in enumerate(known):
            for j, w in enumerate(r):
                at[i, j, : len(w)] = w
        return self.emit[at].sum(axis=2)

    def viterbi(self, emit: np.ndarray) -> np.ndarray:
        n, t, k = emit.shape
        best, back = emit[:, 0] + self.begin, np.zeros((n, t, k), np.int8)
        for j in range(1, t):
            paths = best[:, :, None] + self.move[None]
            back[:, j] = paths.argmax(axis=1)
            best = paths.max(axis=1) + emit[:, j]
        out = np.zeros((n, t), np.int8)
        out[:, -1] = best.argmax(axis=1)
        for j in range(t - 1, 0, -1):
            out[:, j - 1] = back[np.arange(n), j, out[:, j]]
        return out


def _forbidden() -> tuple[np.ndarray, np.ndarray]:
    """An inside label only follows the beginning or inside of its kind."""
    move, begin = np.zeros((len(LABELS), len(LABELS))), np.zeros(len(LABELS))
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            begin[j] = -1e4
            move[[i for i, x in enumerate(LABELS) if x[1:] != label[1:]], j] = -1e4
    return move, begin


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(table: list[tuple[str, list[tuple[str, int, int]]]] | None = None, ridge: float = 0.02, steps: int = 250) -> Field:
    """Fit by gradient steps (with per-weight scaling) on the mean log likelihood."""
    data = defaultdict(list)
    for text, spans in table if table is not None else labelled_table():
        for r in runs(text):
            label, open_kind = [], None
            for s, e in r["at"]:
                kind = next(((k, a) for k, a, b in spans if s < b and e > a), None)
                label.append(0 if kind is None else LABELS.index(("I-" if kind == open_kind else "B-") + kind[0]))
                open_kind = kind
            data[len(label)].append((run_features(r), label))
    names: dict[str, int] = {}
    for group in data.values():
        for features, _ in group:
            for w in features:
                for f in w:
                    names.setdefault(f, len(names))
    k = len(LABELS)
    fixed_move, fixed_begin = _forbidden()
    field = Field(names, np.zeros((len(names) + 1, k)), fixed_move.copy(), fixed_begin.copy())
    sets = [(np.array([y for _, y in g]), [f for f, _ in g]) for g in data.values()]
    total = sum(len(y) for y, _ in sets)
    params = [field.emit, field.move, field.begin]
    square = [np.full_like(p, 1e-8) for p in params]
    for _ in range(steps):
        grads = [ridge * field.emit, ridge * (field.move - fixed_move), ridge * (field.begin - fixed_begin)]
        for y, features in sets:
            e = field.scores(features)
            n, t, _ = e.shape
            forward, backward = [e[:, 0] + field.begin], [np.zeros((n, k))]
            for j in range(1, t):
                forward.append(_lse(forward[-1][:, :, None] + field.move, 1) + e[:, j])
            for j in range(t - 1, 0, -1):
                backward.insert(0, _lse(field.move[None] + (e[:, j] + backward[0])[:, None, :], 2))
            z = _lse(forward[-1], 1)
            for j in range(t):
                p = np.exp(forward[j] + backward[j] - z[:, None])
                p[np.arange(n), y[:, j]] -= 1
                for i, f in enumerate(features):
                    grads[0][[names[x] for x in f[j]]] += p[i] / total
                if j == 0:
                    grads[2] += p.sum(axis=0) / total
                else:
                    pair = forward[j - 1][:, :, None] + field.move + (e[:, j] + backward[j])[:, None, :] - z[:, None, None]
                    pair = np.exp(pair)
                    pair[np.arange(n), y[:, j - 1], y[:, j]] -= 1
                    grads[1] += pair.sum(axis=0) / total
        for p, g, s, fixed in zip(params, grads, square, (None, fixed_move, fixed_begin)):
            s += g * g
            move = 0.3 * g / np.sqrt(s)
            p -= move if fixed is None else np.where(fixed < 0, 0, move)
        field.emit[-1] = 0
    return field


def find(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """Base spans and added spans of every text."""
    base = [base_spans(t) if _SPECIAL.search(t) else [] for t in texts]
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    by_length = defaultdict(list)
    for i, t in enumerate(texts):
        if _SPECIAL.search(t):
            taken = sorted((s, e) for _, s, e in base[i])
            edge = np.array([s for s, _ in taken])
            reach = np.maximum.accumulate([e for _, e in taken]) if taken else []
            for r in runs(t):
                # A run that lies inside base spans word by word needs no decoding.
                if taken and all(_covered(edge, reach, s, e) for s, e in r["at"]):
                    continue
                by_length[len(r["words"])].append((i, r, edge, reach))
    for group in by_length.values():
        for g in range(0, len(group), 512):
            part = group[g : g + 512]
            path = field.viterbi(field.scores([run_features(r) for _, r, _, _ in part]))
            for (i, r, edge, reach), labels in zip(part, path.tolist()):
                j = 0
                while j < len(labels):
                    stop = j + 1
                    if labels[j]:
                        while stop < len(labels) and LABELS[labels[stop]][0] == "I":
                            stop += 1
                        s, e = r["at"][j][0], r["at"][stop - 1][1]
                        if not _touches(edge, reach, s, e):
                            added[i].append((LABELS[labels[j]][2:], s, e))
                    j = stop
    return list(zip(base, added))


def _touches(edge, reach, s: int, e: int) -> bool:
    at = int(np.searchsorted(edge, e)) - 1
    return at >= 0 and reach[at] > s


def _covered(edge, reach, s: int, e: int) -> bool:
    at = int(np.searchsorted(edge, s, side="right")) - 1
    return at >= 0 and reach[at] >= e


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


FOUND = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """``doc_id``, base counts per kind, ``base_sha256`` and all ``spans`` per row of ``docs``.

    A null text is empty; whole texts are read; repeated rows give equal results; an empty table
    gives no rows; other columns are not read. Training data and model are small and fixed.
    """
    model = field or train()

    @F.pandas_udf(FOUND)
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            rows = []
            for base, added in find([t or "" for t in texts], model):
                kinds = [k for k, _, _ in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append([*[kinds.count(k) for k in KINDS], digest, _joined(base + added)])
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])

    return docs.select(F.col(id_col).alias("doc_id"), scan(F.col(text_col)).alias("r")).select("doc_id", "r.*")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", field: Field | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, and the length column
    brought up to date where it was set. Spans that overlap become one, named after the first.
    Null texts stay null; columns and order as they were. Repeated rows are redacted alike; an empty
    table gives no rows."""
    model = field or train()

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out = []
            for t, (base, added) in zip(texts, find([t or "" for t in texts], model)):
                spans, made, at = sorted(base + added, key=lambda x: (x[1], -x[2])), [], 0
                for kind, s, e in spans:
                    if s >= at:
                        made += [t[at:s], f"<{kind.upper()}>"]
                    at = max(at, e)
                out.append("".join(made) + t[at:] if spans else t)
            yield pd.Series(out, dtype=object)

    new = docs.select(whole_row(docs), clean(F.col(text_col)).alias("_clean"))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("_clean").alias(c))
        elif c == chars_col:
            length = F.length("_clean").cast(docs.schema[c].dataType)
            cols.append(F.when(F.col("_row")[c].isNotNull(), length).alias(c))
        else:
            cols.append(F.col("_row")[c].alias(c))
    return new.select(*cols)
