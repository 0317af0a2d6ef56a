"""Personal data: fixed patterns with checks, plus spans a semi-Markov conditional random field adds.

The field works on stretches around digits, at signs and plus signs.  A
stretch is cut into tokens; a segment is one token outside any entity, or up to
``MOST_TOKENS`` tokens as one entity of a kind.  Features look at the whole
segment (does it match a kind's full form, does its checksum hold, what
touches its ends), so a boundary that splits two neighbouring numbers rightly
wins over one that runs them together.  The best segmentation comes from
dynamic programming over end positions, linear in the stretch.

Weights are trained by maximum likelihood (forward-backward over segments) on
windows of the table itself, with the fixed patterns' spans as truth; the field
then reads spans those patterns must drop.  Windows come from every stretch of
every text, a bounded number for each kind and as many without a span, so rare
kinds are seen however many other numbers there are.  A kind without any
example is never added.  Spans of the fixed patterns stay, the field adds only
spans that touch none of them.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.text import each, small_batches, text_udf
from isobar.staging import discard, stage

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# A chain of numbers begins where no digit stands before, and its parts are possessive: a run that fails
# is tried neither again from inside nor from its later digits, so every pattern is linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_NUMBER = re.compile(r"[0-9]")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HOT = re.compile(r"[0-9@+]+")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)

#: Tokens of an entity at most; the field adds no longer one (the fixed patterns know no such bound).
MOST_TOKENS = 20
#: Characters that a stretch reaches beyond its hot ones: of a longer word the field sees so much, and an entity of it no more.
REACH = 64
WINDOW = 3 * REACH
#: Tokens whose segments are described together, so that a stretch of any length needs little memory.
TOKENS_AT_ONCE = 2000


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if n % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            out.append(("email", begin, found.end()))
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def addresses(text: str) -> list[Span]:
    """Dotted runs of numbers, four by four."""
    out = []
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        begin = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = begin + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", begin, end))
            begin = end + 1
    return out


def cards(text: str) -> list[Span]:
    out = []
    for chain in _CHAIN.finditer(text):
        digits = _digits(chain.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", chain.start(), chain.end()))
    return out


def phones(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans by kind, then start."""
    out = emails(text) if "@" in text else []
    if _NUMBER.search(text):
        out = out + addresses(text) + cards(text) + (phones(text) if "+" in text else [])
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text that the field reads: hot characters with the words around them, at most ``REACH`` to each side."""
    out: list[tuple[int, int]] = []
    for hot in _HOT.finditer(text):
        begin, end = hot.span()
        if out and end <= out[-1][1]:
            continue
        low, high = max(0, begin - REACH), min(len(text), end + REACH)
        while begin > low and not text[begin - 1].isspace():
            begin -= 1
        while end < high and not text[end].isspace():
            end += 1
        if out and begin <= out[-1][1] + 2:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


_EMAIL_FORM = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_FORM = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_CARD_FORM = re.compile(r"[0-9]+|[0-9]{3,6}(?:[\x20-][0-9]{2,7})+")
_PHONE_FORM = re.compile(r"\+[0-9]{1,3}(?:[\x20.-]?\(?[0-9]{2,5}\)?)+")

FEATURES = 12


def features(span: str, left: str, right: str) -> list[float] | None:
    """What a segment looks like as a whole; None if it can't be an entity."""
    email = "@" in span
    digits = _digits(span)
    if email:
        if span.count("@") > 1 or any(c.isspace() for c in span):
            return None
    elif len(digits) < 4 or any(c.isalpha() for c in span):
        return None
    ip = bool(_IP_FORM.fullmatch(span)) and all(int(p) <= 255 for p in span.split("."))
    card = 16 <= len(digits) <= 19 and bool(_CARD_FORM.fullmatch(span))
    valid = card and luhn(digits)
    phone = span[0] == "+" and 8 <= len(digits) <= 15 and bool(_PHONE_FORM.fullmatch(span))
    return [
        1.0,
        float(email and bool(_EMAIL_FORM.fullmatch(span))),
        float(ip),
        float(valid),
        float(card and not valid),
        float(phone),
        float(left.isalnum()),
        float(right.isalnum()),
        float(left in "+@.-_%" and left != ""),
        float(right in "@-_%" and right != ""),
        min(len(digits), 20) / 10,
        float(any(c.isspace() for c in span)),
    ]


@dataclass
class Lattice:
    """The segments of one stretch that may be entities, by token positions."""

    size: int
    offsets: list[int]
    begin: np.ndarray
    end: np.ndarray
    phi: np.ndarray


def _tokens(part: str) -> list[int]:
    """Where each token of ``part`` begins, and its end."""
    return [m.start() for m in _TOKEN.finditer(part)] + [len(part)]


def _described(part: str, tokens: list[int], first: int, last: int, before: str, after: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, features) of the segments that begin at tokens ``first`` up to ``last``."""
    size = len(tokens) - 1
    begins, ends, rows = [], [], []
    for i in range(first, min(last, size)):
        opening = part[tokens[i]]
        if opening != "+" and not opening.isalnum():
            continue
        for j in range(i + 1, min(i + MOST_TOKENS, size) + 1):
            closing = part[tokens[j] - 1]
            if not closing.isalnum():
                if closing == "\n":
                    break
                continue
            left = part[tokens[i] - 1] if i else before
            right = part[tokens[j]] if j < size else after
            row = features(part[tokens[i] : tokens[j]], left, right)
            if row is not None:
                begins.append(i)
                ends.append(j)
                rows.append(row)
    return np.array(begins, int), np.array(ends, int), np.array(rows).reshape(-1, FEATURES)


def lattice(part: str, before: str = "", after: str = "") -> Lattice:
    """Segments of ``part``; ``before`` and ``after`` are the characters that touch it."""
    tokens = _tokens(part)
    return Lattice(len(tokens) - 1, tokens, *_described(part, tokens, 0, len(tokens), before, after))


def best(part: str, weights: np.ndarray, before: str = "", after: str = "") -> list[tuple[int, int, int]]:
    """(kind, first character, end) of the best segmentation; ties: the fewest entities, then the first listed."""
    tokens, useful = _tokens(part), []
    for first in range(0, len(tokens) - 1, TOKENS_AT_ONCE):
        begin, end, phi = _described(part, tokens, first, first + TOKENS_AT_ONCE, before, after)
        if len(begin):
            scores = phi @ weights.T
            kind = scores.argmax(1)
            value = scores[np.arange(len(kind)), kind]
            some = value > 0
            useful += zip(begin[some].tolist(), end[some].tolist(), kind[some].tolist(), value[some].tolist())
    size = len(tokens) - 1
    arriving: dict[int, list[int]] = {}
    for s, (_, j, _, _) in enumerate(useful):
        arriving.setdefault(j, []).append(s)
    total, back = [0.0] * (size + 1), [-1] * (size + 1)
    for j in range(1, size + 1):
        total[j] = total[j - 1]
        for s in arriving.get(j, ()):
            if (t := total[useful[s][0]] + useful[s][3]) > total[j]:
                total[j], back[j] = t, s
    out, j = [], size
    while j:
        if back[j] < 0:
            j -= 1
        else:
            i, end, kind, _ = useful[back[j]]
            out.append((kind, tokens[i], tokens[end]))
            j = i
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + float(np.log(np.exp(np.array(values) - top).sum()))


def marginals(lat: Lattice, scores: np.ndarray) -> tuple[np.ndarray, float]:
    """Probability of each segment and kind, and the log of the sum over all segmentations."""
    arriving: dict[int, list[int]] = {}
    leaving: dict[int, list[int]] = {}
    for s, (i, j) in enumerate(zip(lat.begin.tolist(), lat.end.tolist())):
        arriving.setdefault(j, []).append(s)
        leaving.setdefault(i, []).append(s)
    top = scores.max(1)
    summed = (top + np.log(np.exp(scores - top[:, None]).sum(1))).tolist()
    ahead, behind = [0.0] * (lat.size + 1), [0.0] * (lat.size + 1)
    for j in range(1, lat.size + 1):
        ahead[j] = _log_sum([ahead[j - 1]] + [ahead[lat.begin[s]] + summed[s] for s in arriving.get(j, ())])
    for i in range(lat.size - 1, -1, -1):
        behind[i] = _log_sum([behind[i + 1]] + [behind[lat.end[s]] + summed[s] for s in leaving.get(i, ())])
    whole = ahead[lat.size]
    around = np.array(ahead)[lat.begin] + np.array(behind)[lat.end] - whole
    return np.exp(scores + around[:, None]), whole


@dataclass(frozen=True)
class Field:
    """samples: windows to train on at most for each kind, and as many without a span.  rounds: passes over them.  penalty: of squared weights."""

    samples: int = 300
    rounds: int = 40
    rate: float = 0.5
    penalty: float = 1e-3


def examples(part: str) -> Iterator[tuple[Lattice, np.ndarray]]:
    """Every stretch of a part with segments, and which segment is which kind by the fixed patterns."""
    base = base_spans(part)
    for begin, end in stretches(part):
        lat = lattice(part[begin:end], part[begin - 1 : begin], part[end : end + 1])
        if not len(lat.begin):
            continue
        at = {o + begin: n for n, o in enumerate(lat.offsets)}
        wanted = np.zeros((len(lat.begin), len(KINDS)))
        places = {(int(i), int(j)): s for s, (i, j) in enumerate(zip(lat.begin, lat.end))}
        taken: list[tuple[int, int]] = []
        for kind, a, b in base:
            s = places.get((at.get(a, -1), at.get(b, -1)))
            if s is not None and all(b <= x or a >= y for x, y in taken):
                wanted[s, KINDS.index(kind)] = 1
                taken.append((a, b))
        yield lat, wanted


def train(parts: list[str], how: Field = Field()) -> np.ndarray:
    """Weights (kind x feature) by maximum likelihood of the fixed patterns' spans; no part: all zero, nothing is added."""
    every = [example for part in parts for example in examples(part)]
    weights = np.zeros((len(KINDS), FEATURES))
    if not every:
        return weights
    weights[:, 0] = -4.0  # entities are rare until seen
    squares = np.full_like(weights, 1e-8)
    for _ in range(how.rounds):
        slope = -how.penalty * len(every) * weights
        for lat, wanted in every:
            expected, _ = marginals(lat, lat.phi @ weights.T)
            slope += (wanted - expected).T @ lat.phi
        squares += slope * slope
        weights = weights + how.rate * slope / np.sqrt(squares)
    return weights


def _cut(text: str, begin: int, tied: bytearray) -> int:
    """Where a window from ``begin`` ends: the last blank beside something other than digits, else a token's end, never inside a span if that can be."""
    free = [p for p in range(begin + WINDOW, begin, -1) if not tied[p]]
    for p in free:
        if text[p - 1].isspace() and not (text[p - 2 : p - 1].isdigit() and text[p].isdigit()):
            return p
    return next((p for p in free if not (text[p - 1].isalnum() and text[p].isalnum())), begin + WINDOW)


def windows(text: str) -> Iterator[tuple[str, set[str]]]:
    """All stretches in windows of at most ``WINDOW`` characters, with the kinds of their spans.

    A window that cuts a span, or looks by itself as if it had other spans than in its text, would teach the wrong thing and is left out.
    """
    parts = stretches(text)
    if not parts:
        return
    base = sorted(base_spans(text), key=lambda s: s[1])
    starts, tied = [a for _, a, _ in base], bytearray(len(text) + 1)
    for _, a, b in base:
        tied[a + 1 : b] = b"\1" * (b - a - 1)
    for begin, stop in parts:
        while begin < stop:
            end = stop if stop - begin <= WINDOW else _cut(text, begin, tied)
            if not tied[begin] and not tied[end]:
                spans = {(k, a - begin, b - begin) for k, a, b in base[bisect_left(starts, begin) : bisect_left(starts, end)]}
                if spans == set(base_spans(text[begin:end])):
                    yield text[begin:end], {k for k, _, _ in spans}
            begin = end


NO_KIND = "none"


def smallest(texts: Iterable[str | None], most: int) -> dict[str, dict[bytes, str]]:
    """By kind, and ``NO_KIND``, the ``most`` different windows of smallest hash that teach it."""
    kept: dict[str, dict[bytes, str]] = {k: {} for k in (*KINDS, NO_KIND)}
    tops: dict[str, list[tuple[int, bytes]]] = {k: [] for k in kept}
    for text in texts:
        for near, kinds in windows(text or ""):
            key = hashlib.blake2b(near.encode(), digest_size=16).digest()
            order = -int.from_bytes(key)
            wants = {k for k in (*kinds, NO_KIND) if key not in kept[k] and (len(tops[k]) < most or order > tops[k][0][0])}
            if not wants or not (taught := [wanted for _, wanted in examples(near)]):
                continue
            marked = sum(w.sum(0) for w in taught)
            for k in wants & ({k for k, n in zip(KINDS, marked) if n} or {NO_KIND}):
                kept[k][key] = near
                heapq.heappush(tops[k], (order, key))
                if len(tops[k]) > most:
                    del kept[k][heapq.heappop(tops[k])[1]]
    return kept


def fit(docs: DataFrame, how: Field = Field(), *, text: str = "text") -> np.ndarray:
    """Train on windows of every stretch of every text: by kind, and of those without a span, the ``how.samples`` of smallest hash."""
    most = how.samples

    def run(batches):
        kept = smallest((t for batch in batches for t in each(batch.column(0))), most)
        rows = [{"kind": k, "hash": h, "near": near} for k, found in kept.items() for h, near in found.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("kind", pa.string()), ("hash", pa.binary()), ("near", pa.string())]))

    small_batches()
    # At most 5 x samples rows a partition.
    found = stage(docs.select(F.col(f"`{text}`").alias("body")).mapInArrow(run, "kind string, hash binary, near string"), "windows")
    tops = [found.filter(F.col("kind") == k).distinct().orderBy("hash").limit(most) for k in (*KINDS, NO_KIND)]
    rows = reduce(DataFrame.unionAll, tops).collect()  # 5 x samples x 192 characters
    discard(found)
    return train([near for _, near in sorted({(bytes(r.hash), r.near) for r in rows})], how)


def added_spans(text: str, base: list[Span], weights: np.ndarray) -> list[Span]:
    """Spans of the field that touch no base span, by kind and start."""
    ordered = sorted((x, y) for _, x, y in base)
    starts = [x for x, _ in ordered]
    furthest = list(accumulate((y for _, y in ordered), max))  # end of the base spans that start up to here
    out = []
    for begin, end in stretches(text):
        for kind, i, j in best(text[begin:end], weights, text[begin - 1 : begin], text[end : end + 1]):
            a, b = begin + i, begin + j
            before = bisect_left(starts, b)
            if not before or furthest[before - 1] <= a:
                out.append((KINDS[kind], a, b))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(text: str | None, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, by kind, then start."""
    text = text or ""
    base = base_spans(text)
    more = added_spans(text, base, weights) if weights.any() and _HOT.search(text) else []
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1]))


def spans(text: Column, weights: np.ndarray) -> Column:
    """``n_email n_ip n_card n_phone base_sha256 spans`` of a text; NULL counts as empty.

    The counts and the digest are of the base spans.  Positions are code points, ends exclusive.
    """

    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for text in each(texts):
            base, every = find(text, weights)
            counts = {f"n_{k}": sum(s[0] == k for s in base) for k in KINDS}
            rows.append(counts | {"base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(every)})
        counted = [(f"n_{k}", pa.int64()) for k in KINDS]
        return pa.array(rows, pa.struct(counted + [("base_sha256", pa.string()), ("spans", pa.string())]))

    return text_udf(run, ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")(text)


def masked(text: str | None, weights: np.ndarray) -> str | None:
    """The text with every span replaced by its kind in brackets; spans that overlap are replaced as one."""
    if not text:
        return text
    _, every = find(text, weights)
    if not every:
        return text
    out, done = [], 0
    for kind, a, b in sorted(every, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redacted(text: Column, weights: np.ndarray) -> Column:
    """``masked`` on a text column; NULL stays NULL."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([masked(t, weights) for t in each(texts)], pa.string())

    return text_udf(run, "string")(text)
