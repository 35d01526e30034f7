"""Personal data in texts: fixed patterns, and a semi-Markov CRF that finds further spans.

The patterns give the base spans. The CRF scores whole candidate segments (up to ``MAX_TOKENS``
tokens), and one dynamic programme over a stretch of text chooses boundaries and kinds jointly.
It is trained here on stretches around base spans, some of them rewritten into forms that the
patterns miss (``name [at] host.org``, a phone number without country code).
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import small_batches
from riskweave.session import materialize, ship_package

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24
MARGIN = 48
#: Bound on the stretches the CRF is fitted to; they are those with the smallest hash.
TRAIN_STRETCHES = 300

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping; found from the @ sign, so that a long word is read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        host = _HOST.match(text, at)
        start = at
        while start > free and (c := text[start - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            start -= 1
        if host and start < at:
            yield start, host.end()
            free = host.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all pattern matches, in code points, by kind and start."""
    if not _ANY.search(text):
        return []
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in _CARD.finditer(text)
              if m.end() - m.start() <= 40 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


# --- candidate segments and their features ------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\s|[^\W0-9A-Za-z_]+|.", re.S)
_TRIGGER = re.compile(r"[0-9]|@|[(\[{]\s?at\s?[)\]}]|\bat\b\s?[A-Za-z0-9-]+\.[A-Za-z0-9-]|\bdot\b", re.I)
_AT = re.compile(r"@|[(\[{]\s?at\s?[)\]}]|\bat\b", re.I)
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SAID_MAIL = re.compile(
    r"[A-Za-z0-9._%+-]+\s?(?:[(\[{]\s?at\s?[)\]}]|\bat\b)\s?[A-Za-z0-9-]+"
    r"(?:(?:\.|\s?(?:[(\[{]\s?dot\s?[)\]}]|\bdot\b)\s?)[A-Za-z0-9-]+)+", re.I)
_LOCAL_PHONE = re.compile(r"\(?[0-9]{2,5}\)?[ .-]{1,2}[0-9]{3,4}[ .-][0-9]{3,5}")
_DATE = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}|[0-9]{1,2}[-./ ][0-9]{1,2}[-./ ](?:19|20)[0-9]{2})(?![0-9])")
#: Stretches without personal data that every fit learns from.
CLEAN = ("on 2020-11-12 10:30 and 2019-01-02 11:12:13", "from 12.11.2020 to 31-12-2021 at 5", "isbn 978-3-16-148410-0 and 1-86197-876-6",
         "order 123456789 of 4500 1234 items", "rows 100 200 300 400 500", "version 2.0.1 of 10.4", "1234 5678 and 1000-2000-3000")
_KEYWORD = re.compile(r"\b(?:phone|tel|call|fax|mobile|card|visa|mail|email|contact|ip|host|addr)\w*\W*$", re.I)
_DIGIT_BOUNDS = (0, 3, 8, 12, 15, 19)
N_FEATURES = 32


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text that may hold personal data, merged where they touch."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _features(s: str, before: str, after: str, n_tokens: int) -> list[int]:
    """Indexes of the features that hold for a whole segment."""
    d = _digits(s)
    parts = s.split(".")
    dotted = len(parts) == 4 and all(p.isdigit() and len(p) < 4 for p in parts)
    separators = {c for c in s if not c.isalnum()}
    letters = any(c.isalpha() for c in s)
    checks = (
        True, s[0] == "+", "@" in s, _AT.search(s) is not None and "@" not in s,
        13 <= len(d) <= 19 and not letters and luhn(d), 13 <= len(d) <= 19 and not luhn(d),
        dotted and all(int(p) <= 255 for p in parts), dotted and any(int(p) > 255 for p in parts),
        not letters and separators <= {" ", "-"}, not letters and bool(separators) and separators <= set(" ().-+"),
        letters, bool(re.search(r"[.\s)\]}][A-Za-z]{2,8}$", s)),
        bool(before) and (before[-1].isalnum() or before[-1] in "@_%+-") and s[0] != "(", bool(before) and before[-1] in "./#$",
        bool(after) and (after[0].isalnum() or after[0] in "@_%"), bool(re.match(r"[.-][A-Za-z0-9]", after)),
        any(c.isspace() for c in s), _KEYWORD.search(before) is not None,
        n_tokens <= 3, n_tokens >= 10, s.count("(") != s.count(")"),
        _DATE.search(s) is not None, _MAIL.fullmatch(s) is not None, _SAID_MAIL.fullmatch(s) is not None, _LOCAL_PHONE.fullmatch(s) is not None,
    )
    found = [i for i, c in enumerate(checks) if c]
    found.append(len(checks) + sum(len(d) > bound for bound in _DIGIT_BOUNDS[:-1]))
    return found


def candidates(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int]], np.ndarray]:
    """Token bounds of a stretch, candidate segments (first token, token after the last), their features."""
    bounds = [start, *(m.end() for m in _TOKEN.finditer(text, start, end))]
    tokens = [text[a:b] for a, b in zip(bounds, bounds[1:])]
    segments, rows = [], []
    for i, first in enumerate(tokens):
        if not (first[0].isascii() and (first[0].isalnum() or first[0] in "+(")):
            continue
        signs, digits, words, blanks = 0, 0, 0, 0
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            t = tokens[j]
            if t == "\n" or not t.isascii() or blanks > 6:
                break
            signs += t == "@" or t.lower() == "at"
            digits += len(t) if t.isdigit() else 0
            words += t.isalpha() and t.lower() not in ("at", "dot")
            blanks += t.isspace()
            if not t.isalnum() or (not signs and (words or digits < 4)):
                if words and not signs and blanks > 1:
                    break
                continue
            a, b = bounds[i], bounds[j + 1]
            on = np.zeros(N_FEATURES)
            on[_features(text[a:b], text[max(0, a - 24):a], text[b:b + 2], j + 1 - i)] = 1
            segments.append((i, j + 1))
            rows.append(on)
    return bounds, segments, np.array(rows).reshape(len(rows), N_FEATURES)


# --- the semi-Markov CRF ------------------------------------------------------------------


def _by_end(segments: list[tuple[int, int]], n: int) -> list[list[int]]:
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(segments):
        ending[j].append(k)
    return ending


def decode(weights: np.ndarray, text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Best segmentation of a stretch; text outside segments scores 0 a token."""
    bounds, segments, rows = candidates(text, start, end)
    if not segments:
        return []
    scores = rows @ weights.T
    kinds, best_of = scores.argmax(axis=1), scores.max(axis=1)
    n = len(bounds) - 1
    best, back = [0.0] * (n + 1), [-1] * (n + 1)
    for j, ending in enumerate(_by_end(segments, n)):
        if j:
            best[j] = best[j - 1]
        for k in ending:
            if best_of[k] > 0 and best[segments[k][0]] + best_of[k] > best[j]:
                best[j], back[j] = best[segments[k][0]] + best_of[k], k
    found, j = [], n
    while j > 0:
        if back[j] < 0:
            j -= 1
        else:
            i, _ = segments[back[j]]
            found.append((KINDS[kinds[back[j]]], bounds[i], bounds[j]))
            j = i
    return found[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _expected(scores: np.ndarray, segments: list[tuple[int, int]], n: int) -> np.ndarray:
    """Probability of every (segment, kind), by the forward and backward sums."""
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (i, _) in enumerate(segments):
        starting[i].append(k)
    each = np.logaddexp.reduce(scores, axis=1).tolist()
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for j, ending in enumerate(_by_end(segments, n)):
        if j:
            forward[j] = _log_sum([forward[j - 1], *(forward[segments[k][0]] + each[k] for k in ending)])
    for i in range(n - 1, -1, -1):
        backward[i] = _log_sum([backward[i + 1], *(backward[segments[k][1]] + each[k] for k in starting[i])])
    out = np.array([forward[i] + backward[j] for i, j in segments])
    return np.exp(scores + (out - forward[n])[:, None])


def fit(samples: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 50, rate: float = 0.7, decay: float = 2e-4) -> np.ndarray:
    """Weights (kind x feature) that maximise the likelihood of the labelled spans.

    Every weight of the segment's length and of leaving text alone comes from the bias. Without
    samples all scores are negative, so that nothing is added.
    """
    data = []
    for text, spans in samples:
        bounds, segments, rows = candidates(text, 0, len(text))
        if not segments:
            continue
        place, at = {b: i for i, b in enumerate(bounds)}, {s: k for k, s in enumerate(segments)}
        gold = np.zeros((len(segments), len(KINDS)))
        for kind, a, b in spans:
            k = at.get((place.get(a), place.get(b)))
            if k is not None:
                gold[k, KINDS.index(kind)] = 1
        # tokens between the ends of segments change no probability, so they are left out
        ends = {e: i for i, e in enumerate(sorted({x for s in segments for x in s}))}
        data.append(([(ends[i], ends[j]) for i, j in segments], rows, gold, len(ends) - 1))
    weights = np.zeros((len(KINDS), N_FEATURES))
    weights[:, 0] = -4
    seen = np.full(weights.shape, 1e-2)
    for _ in range(rounds if data else 0):
        slope = -decay * len(data) * weights
        for segments, rows, gold, n in data:
            slope += (gold - _expected(rows @ weights.T, segments, n)).T @ rows
        seen += slope**2
        weights += rate * slope / np.sqrt(seen)
    return weights


def rewritten(text: str, spans: list[tuple[str, int, int]], turn: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The stretch with its spans in forms that the patterns miss."""
    out, made, done = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < done:
            continue
        s = text[a:b]
        if kind == "email":
            if turn % 5 > 2:
                s = re.sub(r"[0-9]+", "x" * (turn % 2), s)
            s = s.replace("@", (" at ", " [at] ", "(at)", " (at) ")[turn % 4])
            if turn % 3:
                head, _, host = s.rpartition(" " if " " in s else ")")
                s = s[: len(s) - len(host)] + host.replace(".", (" dot ", " [dot] ")[turn % 2])
        elif kind == "phone":
            s = re.sub(r"^\+[0-9]{1,3}[ -]?(?=[(0-9])", "", s)
        out += text[done:a]
        made.append((kind, len(out), len(out) + len(s)))
        out, done = out + s, b
    return out + text[done:], made


def _place(row: tuple[str, str]) -> tuple[bytes, tuple[str, str]]:
    return hashlib.md5(row[0].encode("utf-8", "surrogatepass")).digest(), row


def _labelled(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Stretches with the spans inside them: of those with a span and of those without, ``most`` of smallest hash."""
    kept: dict[bool, set] = {True: set(), False: set()}
    for frame in batches:
        for text in frame["text"]:
            if text and _ANY.search(text):
                spans = base_spans(text)
                for a, b in stretches(text):
                    if b - a <= 1000:
                        inside = ",".join(f"{k}:{s - a}:{e - a}" for k, s, e in spans if s >= a and e <= b)
                        kept[bool(inside)].add((text[a:b], inside))
        for label, rows in kept.items():
            if len(rows) > 10 * most:
                kept[label] = set(heapq.nsmallest(most, rows, key=_place))
    rows = [x for found in kept.values() for x in heapq.nsmallest(most, found, key=_place)]
    yield pd.DataFrame(rows, columns=["stretch", "spans"])


def parse(spans: str) -> list[tuple[str, int, int]]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]


def train(docs: DataFrame, text: str = "text", most: int = TRAIN_STRETCHES) -> np.ndarray:
    """Fit on at most ``most`` stretches (those of smallest hash, half of them with a span)."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    half = most // 2
    found = docs.select(F.col(text).alias("text")).mapInPandas(lambda batches: _labelled(batches, half), "stretch string, spans string")
    found = materialize(found, "stretches").distinct()
    rows = []
    for label in (F.col("spans") != "", F.col("spans") == ""):
        each = found.where(label).orderBy(F.md5("stretch"), "stretch", "spans").limit(half)
        rows += [(r["stretch"], parse(r["spans"])) for r in each.collect()]
    made = [rewritten(t, s, i) for i, (t, s) in enumerate(rows) if s]
    return fit(rows + made + [(t, []) for t in CLEAN * max(1, len(rows) // 40)])


def all_spans(text: str, weights: np.ndarray) -> tuple[list, list]:
    """Base spans, and base and added spans by kind and start; an added span touches no base span."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for a, b in stretches(text):
        added += [s for s in decode(weights, text, a, b) if not any(s[1] < e and c < s[2] for c, e in taken)]
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find(docs: DataFrame, weights: np.ndarray | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, counts of base spans per kind, ``base`` and ``spans`` (arrays of kind:start:end).

    One row per row of ``docs``; NULL text counts as empty; other columns are left out.
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    weights = train(docs, text) if weights is None else weights

    @F.pandas_udf("struct<base:array<string>,spans:array<string>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            pairs = [all_spans(t, weights) if t else ((), ()) for t in texts]
            as_text = [[f"{k}:{a}:{b}" for k, a, b in s] for pair in pairs for s in pair]
            yield pd.DataFrame({"base": as_text[::2], "spans": as_text[1::2]})

    found = docs.select(F.col(key), spans(F.col(text)).alias("found"))

    def count(kind: str):
        return F.size(F.filter("found.base", lambda s: s.startswith(kind + ":"))).cast("long").alias(f"n_{kind}")

    return found.select(key, *[count(k) for k in KINDS], "found.base", "found.spans")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Text with its spans replaced by ``[KIND]``; overlapping spans become one mark."""
    out, done = "", 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out, done = out + text[done:a] + f"[{kind.upper()}]", b
        else:
            done = max(done, b)
    return out + text[done:]
