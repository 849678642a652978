"""Personal data: generators propose overlapping spans, boosted trees score them, calibrated thresholds choose.

Base spans (``email``, ``ip``, ``card``, ``phone``) follow fixed patterns and checks and are always kept.
The method adds spans of the same kinds that the patterns miss: a number next to other digits, a phone
number without its country code, a written-out address.

* **Generators** propose every span that could be meant: address-like runs around an @ sign or its written
  forms, four neighbouring parts of dotted numbers, and runs of whole digit groups with 13 to 19 (card) or
  7 to 15 (phone) digits. Proposals overlap; their number is linear in the text.
* **Trees** (depth 3, logistic loss, histograms) score a proposal from its format (digits, groups,
  separators, checksums) and its context (neighbouring characters, cue words before it).
* **Training** needs no labels: windows around all base spans of all texts are the true cases, proposals
  in the windows that differ from the base span, and proposals far from any pattern, are the false ones. True
  spans are also set beside other digits, or rewritten in forms that no pattern takes, and replaced by
  look-alikes (failing checksums, dates, identifiers), so that the trees learn borders and forms. Equal
  windows count once. Spark adds up equal cases (a row of whole-number features each); a tree needs only sums
  per node, feature and bin, which are whole numbers, so any order of adding gives the same trees. Up to
  ``LOCAL_CASES`` different cases are fitted on the driver; beyond that each level's sums are one Spark job.
* **Thresholds** are set per kind on a third of the windows that the trees did not see: the lowest calibrated
  probability, one half or more, at which the precision is at least ``PRECISION``; a kind that never reaches
  it adds nothing.

Of chosen proposals that overlap, the most probable stays (then the longer, then the first); proposals
that overlap a base span are left out. Text is scanned as UTF-8, as all patterns are ASCII; spans are in code
points, end exclusive. Null and empty texts have no spans; repeated rows are equal; without any base span
no model is trained and only base spans are returned.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.llm.rows import map_rows, utf8
from tidepool.session import stage_table

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")
IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DOTTED = re.compile(rb"[0-9]++(?:\.[0-9]++){3,}+")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
NUMBERS = re.compile(rb"[+(]?[0-9](?:[\x20().-]{0,3}[0-9])++")
GROUP = re.compile(rb"[0-9]++")
LABEL, DOT = rb"[A-Za-z0-9-]{1,63}+", rb"(?:\x20?(?:\[dot\]|\(dot\)|\{dot\})\x20?|\x20dot\x20)"
SPELLED = re.compile(
    rb"[A-Za-z0-9._%+-]{1,64}+(?:\x20?(?:\[at\]|\(at\)|\{at\})\x20?" + LABEL + rb"(?:(?:" + DOT + rb"|\.)" + LABEL + rb")++"
    rb"|\x20at\x20" + LABEL + rb"(?:" + DOT + LABEL + rb")++)", re.IGNORECASE)
ANY = re.compile(rb"[0-9@]")
#: Bytes around a span in its window; windows written, and windows turned into cases, at a time.
AROUND, WRITTEN, TURNED = 64, 5_000, 500
#: Different training cases that are fitted on the driver, and rounds after which margins are written anew in Spark.
LOCAL_CASES, WRITTEN_ROUNDS = 50_000, 10
#: Gradients are added up in whole steps, margins are calibrated in whole ones, and features are cut to two bytes.
GRADIENT_STEP, MARGIN_STEP, MARGIN_MOST, VALUES = 1 << 20, 1 << 10, 32, 1 << 16
ROUNDS, RATE, DEPTH, BINS, RIDGE, LEAST_IN_LEAF = 80, 0.25, 3, 32, 2.0, 12
PRECISION, LEAST_SUPPORT = 0.995, 40
#: Proposals scored at a time.
SCORED = 50_000
CUES = {
    "email": (b"mail", b"contact", b"write"),
    "ip": (b"ip", b"host", b"addr", b"server"),
    "card": (b"card", b"visa", b"credit", b"karte", b"carte", b"tarjeta"),
    "phone": (b"phone", b"tel", b"call", b"fax", b"mobil"),
}

Span = tuple[str, int, int]


def luhn(digits: bytes) -> bool:
    """Whether a string of ASCII digits passes the Luhn check."""
    total = 0
    for place, octet in enumerate(reversed(digits)):
        value = (octet - 48) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def octets_hold(parts: list[bytes]) -> bool:
    return all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in parts)


def _digits(data: bytes) -> bytes:
    return b"".join(GROUP.findall(data))


def _emails(data: bytes) -> list[tuple[int, int, bool]]:
    """(start, end, whether the domain has a dot) around each @ sign, leftmost matches without overlap."""
    out, done, at = [], 0, data.find(b"@")
    while at >= 0:
        start = at
        while start > done and data[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(data, at + 1) if start < at else None
        if m:
            dotted = b"." in m[0]
            out.append((start, m.end(), dotted))
            if dotted:
                done = m.end()
        at = data.find(b"@", at + 1 if not m or not out[-1][2] else done)
    return out


def base_spans(data: bytes) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans of the fixed patterns by start and kind, in bytes, and the matches that their checks drop."""
    kept, dropped = [], []

    def sort(kind: str, m: re.Match, good: bool) -> None:
        (kept if good else dropped).append((kind, *m.span()) if good else m.span())

    if b"@" in data:
        kept += [("email", a, b) for a, b, dotted in _emails(data) if dotted]
    if ANY.search(data):
        for m in IP.finditer(data):
            sort("ip", m, octets_hold(m[0].split(b".")))
        for m in CARD.finditer(data):
            digits = _digits(m[0])
            sort("card", m, 14 <= len(digits) <= 19 and luhn(digits))
    if b"+" in data:
        for m in PHONE.finditer(data):
            sort("phone", m, 10 <= len(_digits(m[0])) <= 15)
    return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0]))), dropped


def proposals(data: bytes) -> list[Span]:
    """All spans the generators propose, in bytes; each at most once."""
    out: list[Span] = []
    if b"@" in data:
        out += [("email", a, b) for a, b, _ in _emails(data)]
    low = data.lower()
    if any(mark in low for mark in (b"dot", b"(at)", b"[at]", b"{at}")):
        out += [("email", *m.span()) for m in SPELLED.finditer(data)]
    if ANY.search(data):
        for m in DOTTED.finditer(data):
            groups = [(m.start() + g.start(), m.start() + g.end()) for g in GROUP.finditer(m[0])]
            out += [("ip", groups[i][0], groups[i + 3][1]) for i in range(len(groups) - 3)]
        for m in CARD.finditer(data):
            out += _grouped("card", m, 13, 19)
        for m in NUMBERS.finditer(data):
            out += _grouped("phone", m, 7, 15)
    return list(dict.fromkeys(out))


def _grouped(kind: str, m: re.Match, least: int, most: int) -> list[Span]:
    """Runs of whole digit groups of a match with a number of digits in the given range."""
    groups = [(m.start() + g.start(), m.start() + g.end()) for g in GROUP.finditer(m[0])]
    out = []
    for i, (start, _) in enumerate(groups):
        if kind == "phone" and start > m.start() and m.string[start - 1:start] in (b"+", b"("):
            start -= 1
        count = 0
        for j in range(i, len(groups)):
            count += groups[j][1] - groups[j][0]
            if count > most:
                break
            if count >= least:
                out.append((kind, start, groups[j][1]))
    return out


FEATURES = (
    *KINDS, "length", "digits", "groups", "longest", "shortest", "first", "last", "blanks", "hyphens", "dots", "parens", "balanced",
    "plus", "paren", "luhn", "octets", "distinct", "lead", "left_letter", "left_digit", "left_sign", "left_number", "right_letter",
    "right_digit", "right_sign", "right_number", "cue_own", "cue_other", "at", "labels", "ending", "local", "spelled", "phone_shape",
    "national_shape", "card_shape")
SIGNS = frozenset(b"=:\"'#/_-.+")


def features(data: bytes, span: Span) -> list[float]:
    """Format and context of a proposal."""
    kind, a, b = span
    text = data[a:b]
    sizes = [len(g) for g in GROUP.findall(text)] or [0]
    digits = _digits(text)
    left, right = data[max(0, a - 1):a], data[b:b + 1]
    before, after = data[max(0, a - 32):a].lower(), data[b:b + 3]
    own = any(c in before for c in CUES[kind])
    other = any(c in before for k in KINDS if k != kind for c in CUES[k])
    blanks, hyphens, dots = text.count(b" "), text.count(b"-"), text.count(b".")
    opened, closed = text.count(b"("), text.count(b")")
    if kind == "email":
        domain = re.split(rb"@|\x20at\x20|[\[({]at[\])}]", text.lower())[-1]
        labels = re.split(rb"\.|\x20dot\x20|[\[({]dot[\])}]", domain)
        address = [float(b"@" in text), float(len(labels)), float(len(labels[-1].strip())),
                   float(len(text) - len(domain)), float(b"dot" in domain or b"@" not in text)]
    else:
        address = [0.0] * 5
    return [
        *(float(kind == k) for k in KINDS), float(min(len(text), 200)), float(len(digits)), float(len(sizes)), float(max(sizes)),
        float(min(sizes)), float(sizes[0]), float(sizes[-1]), float(blanks), float(hyphens), float(dots), float(opened + closed),
        float(opened == closed), float(text[:1] == b"+"), float(text[:1] == b"("), float(bool(digits) and luhn(digits)),
        float(kind == "ip" and octets_hold(text.split(b"."))), float(len(set(digits))), float(digits[0] - 48 if digits else -1),
        float(left.isalpha() or left > b"\x7f"), float(left.isdigit()), float(bool(left) and left[0] in SIGNS),
        float(any(48 <= c <= 57 for c in before[-3:])), float(right.isalpha() or right > b"\x7f"), float(right.isdigit()),
        float(bool(right) and right[0] in SIGNS), float(any(48 <= c <= 57 for c in after)), float(own), float(other), *address,
        float(sizes[-3:] == [3, 3, 4] and len(sizes) == 4), float(sizes == [3, 3, 4]),
        float(sizes in ([4, 4, 4, 4], [4, 6, 5], [16], [15])),
    ]


@dataclass(frozen=True)
class Trees:
    """Boosted trees of one depth: a feature and a cut per inner node, a value per leaf."""

    start: float
    nodes: list[tuple[np.ndarray, np.ndarray]]
    leaves: list[np.ndarray]

    def margin(self, x: np.ndarray, total: np.ndarray | None = None, done: int = 0) -> np.ndarray:
        """The margin of each row; ``total`` is that of the first ``done`` trees."""
        total = np.full(len(x), self.start) if total is None else total
        for (feature, cut), leaf in zip(self.nodes[done:], self.leaves[done:], strict=True):
            total = total + leaf[_node(x, feature, cut, DEPTH) - (1 << DEPTH) + 1]
        return total


def _node(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of a tree that each row reaches after some levels."""
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(levels):
        node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    return node


Sums = tuple[np.ndarray, np.ndarray]


@dataclass
class Cases:
    """Training cases in memory: features, weight of true ones, weight, number, and margin so far."""

    x: np.ndarray
    right: np.ndarray
    weight: np.ndarray
    count: np.ndarray
    margin: np.ndarray | None = None
    done: int = 0

    def advance(self, trees: Trees) -> None:
        self.margin, self.done = trees.margin(self.x, self.margin, self.done), len(trees.nodes)

    def summed(self, measure: Callable[[Cases], Sums], trees: Trees | None = None) -> Sums:
        if trees:
            self.advance(trees)
        return measure(self)


def _by_place(place: np.ndarray, sums: Iterable[np.ndarray]) -> Sums:
    """Whole sums per place; floating sums of them are exact below 2**53."""
    places, at = np.unique(place, return_inverse=True)
    return places, np.array([np.bincount(at, s, len(places)) for s in sums]).astype(np.int64)


def value_counts(cases: Cases) -> Sums:
    """The number of cases per feature and value."""
    width = cases.x.shape[1]
    place = np.arange(width) * VALUES + cases.x.astype(np.int64) + VALUES // 2
    count = np.repeat(cases.count, width)
    return _by_place(place.ravel(), (count, count, count))


def level_sums(cases: Cases, cuts: list[np.ndarray], feature: np.ndarray, cut: np.ndarray, level: int) -> Sums:
    """Gradients, their derivatives and cases per node of a level, feature and bin."""
    p = 1 / (1 + np.exp(-cases.margin))
    g, h = (np.rint(v * GRADIENT_STEP) for v in (cases.right - cases.weight * p, cases.weight * p * (1 - p)))
    code = (_node(cases.x, feature, cut, level) - (1 << level) + 1) * len(cuts)
    size = (1 << level) * len(cuts) * (BINS + 1)
    total = np.zeros((3, size))
    for j, c in enumerate(cuts):
        place = (code + j) * (BINS + 1) + np.searchsorted(c, cases.x[:, j])
        total += [np.bincount(place, v, size) for v in (g, h, cases.count)]
    some = np.flatnonzero(total[2])
    return some, total[:, some].astype(np.int64)


def margin_sums(cases: Cases) -> Sums:
    """Cases, true ones, and twice the weight per kind and whole step of the margin."""
    step = _steps(cases.margin) + MARGIN_MOST * MARGIN_STEP
    kind = cases.x[:, : len(KINDS)].argmax(1)
    return _by_place(step * len(KINDS) + kind, (cases.count, cases.right, 2 * cases.weight))


def _steps(margin: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(margin, -MARGIN_MOST, MARGIN_MOST) * MARGIN_STEP).astype(np.int64)


def quantile_cuts(place: np.ndarray, count: np.ndarray, width: int) -> list[np.ndarray]:
    """Lower quantiles of each feature from the numbers of its values."""
    out = []
    for j in range(width):
        mine = place // VALUES == j
        ends = np.cumsum(count[mine])
        at = np.floor(np.arange(1, BINS) / BINS * (ends[-1] - 1))
        out.append(np.unique(place[mine][np.searchsorted(ends, at, side="right")] % VALUES - VALUES // 2))
    return out


def grow(cases, share: float, cuts: list[np.ndarray]) -> Trees:
    """Fit trees to the logistic loss; each level takes every node's best cut from per-bin sums of all cases."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    trees = Trees(float(np.log(share / (1 - share))), [], [])
    for _ in range(ROUNDS):
        feature, cut = np.zeros((1 << DEPTH) - 1, np.int64), np.full((1 << DEPTH) - 1, np.inf)
        for level in range(DEPTH):
            first, many = (1 << level) - 1, 1 << level
            place, sums = cases.summed(partial(level_sums, cuts=cuts, feature=feature, cut=cut, level=level), trees)
            total = np.zeros((3, many * len(cuts) * (BINS + 1)))
            total[:, place] = sums
            total[:2] /= GRADIENT_STEP
            below = total.reshape(3, many, len(cuts), BINS + 1).cumsum(3)
            whole = below[:, :, 0, -1]
            best, left = np.full(many, 1e-6), whole[:2].copy()
            for j, c in enumerate(cuts):
                (lg, lh, ln), (tg, th, tn) = below[:, :, j, : len(c)], whole[:, :, None]
                gain = lg**2 / (lh + RIDGE) + (tg - lg)**2 / (th - lh + RIDGE) - tg**2 / (th + RIDGE)
                gain[(ln < LEAST_IN_LEAF) | (tn - ln < LEAST_IN_LEAF)] = 0
                at = gain.argmax(1)
                better = gain[np.arange(many), at] > best
                best[better] = gain[np.arange(many), at][better]
                feature[first:first + many][better] = j
                cut[first:first + many][better] = c[at[better]]
                left[:, better] = below[:2, better, j, at[better]]
        sides = np.stack([left, whole[:2] - left], 2).reshape(2, -1)
        trees.nodes.append((feature, cut))
        trees.leaves.append(RATE * sides[0] / (sides[1] + RIDGE))
    return trees


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Trees fitted to rows of whole-number features in memory."""
    cases = Cases(x, weight * y, weight, np.ones(len(x)))
    place, sums = cases.summed(value_counts)
    return grow(cases, (weight * y).sum() / weight.sum(), quantile_cuts(place, sums[0], x.shape[1]))


@dataclass(frozen=True)
class Detector:
    """Trees, the calibration from margins to probabilities, and the least probability per kind."""

    trees: Trees
    margins: np.ndarray
    probabilities: np.ndarray
    least: dict[str, float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.interp(_steps(self.trees.margin(x)) / MARGIN_STEP, self.margins, self.probabilities)


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising probabilities that fit the labels best (pooling of neighbours that do not rise)."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # weight, weighted labels, first and last margin
    for m, label, w in zip(margin[order], y[order], weight[order], strict=True):
        blocks.append([w, w * label, m, m])
        while len(blocks) > 1 and (blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0] or blocks[-2][3] == blocks[-1][2]):
            w2, s2, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + s2, blocks[-1][2], last]
    places = np.array([m for b in blocks for m in (b[2], b[3])])
    return places, np.array([b[1] / b[0] for b in blocks for _ in range(2)])


def _variants(kind: str, window: bytes, a: int, b: int, rng: random.Random) -> list[tuple[bytes, Span | None]]:
    """The window with its true span set beside digits, rewritten, or replaced by a look-alike (no span)."""
    left, span, right = window[:a], window[a:b], window[b:]
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n)).encode()
    put = lambda new, before=b"", after=b"": (left + before + new + after + right, (kind, a + len(before), a + len(before) + len(new)))
    out = [(window, (kind, a, b))]
    if kind in ("card", "phone"):
        out += [put(span, after=b" " + number(rng.choice((2, 3, 5, 7, 9, 16)))), put(span, before=number(rng.choice((1, 2, 4, 7))) + b" ")]
    fakes = [number(rng.choice((7, 8, 9, 10, 11, 12))), b"%04d-%02d-%02d" % (rng.randint(1950, 2030), rng.randint(1, 12), rng.randint(1, 28)),
             b"%s-%s" % (number(4), number(rng.choice((4, 5)))), b"%d:%02d:%02d" % (rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59))]
    if kind == "phone":
        m = re.match(rb"\+[0-9]{1,3}[\x20.-]+(?=\(?[0-9]{3}[)\x20.-]+[0-9]{3}[\x20.-][0-9]{4}\Z)", span)
        if m:
            out.append(put(span[m.end():]))
            digits = _digits(span[m.end():])
            out.append(put(b"-".join((digits[:3], digits[3:6], digits[6:]))))
    elif kind == "card":
        digits = _digits(span)
        broken = digits[:-1] + str((digits[-1] - 48 + rng.randint(1, 9)) % 10).encode()
        grouped = lambda d: b" ".join(d[i:i + 4] for i in range(0, len(d), 4))
        out.append(put(grouped(digits)))
        fakes += [broken, grouped(broken), number(len(digits) - 1) + b"x"]
    elif kind == "ip":
        parts = span.split(b".")
        out.append(put(span, after=rng.choice((b":80", b"/24", b","))))
        spoiled = [*parts]
        spoiled[rng.randrange(4)] = str(rng.randint(256, 999)).encode()
        fakes += [b".".join(spoiled), b"v" + span, b".".join([*parts, number(2), number(1)])]
    else:
        name, _, host = span.partition(b"@")
        mark, dot = rng.choice(((b" [at] ", b" [dot] "), (b"(at)", b"(dot)"), (b" at ", b" dot ")))
        out.append(put(name + mark + host.replace(b".", dot)))
        fakes += [name + b"@", b"@" + name, name + b" at " + name, name + b"@" + host.split(b".")[0] if rng.random() < 0.2 else b"@" + host]
    return out + [(left + fake + right, None) for fake in rng.sample(fakes, 2)]


def examples(kind: str, window: bytes, a: int, b: int) -> Iterator[tuple[list[float], int]]:
    """Features of the proposals in a window and its variants, and which each is: true, false, or false beside a true one."""
    rng = random.Random(_number(kind, window, a, b))
    for text, truth in [(window, None)] if kind == "none" else _variants(kind, window, a, b, rng):
        shift = len(text) - len(window)
        near = (truth[1], truth[2]) if truth else (a, max(a + 1, b + shift))
        for span in proposals(text):
            if span[2] <= near[0] or span[1] >= near[1]:
                continue
            right = span == truth
            if truth and not right and truth[1] <= span[1] and span[2] <= truth[2] and kind == span[0] == "phone":
                continue  # a phone number without its country code, inside one with it: neither true nor false
            yield features(text, span), 0 if right else 1 if truth is None else 2


def _number(kind: str, window: bytes, a: int, b: int) -> int:
    return zlib.crc32(window, zlib.crc32(f"{kind} {a} {b} ".encode()))


def windows_of(data: bytes | None) -> list[tuple[str, bytes, int, int]]:
    """All windows of a text: around base spans, and around proposals far from any pattern."""
    if not data:
        return []
    kept, dropped = base_spans(data)
    spans = list(kept)
    starts, stops = [], []
    for a, b in sorted([(a, b) for _, a, b in kept] + dropped):
        starts.append(a)
        stops.append(max(b, stops[-1]) if stops else b)  # the furthest end so far
    seen = -1
    for _, a, b in sorted(proposals(data), key=lambda s: s[1:]):
        i = bisect_left(starts, b)
        if a >= seen and (i == 0 or stops[i - 1] <= a):
            spans.append(("none", a, b))
            seen = b
    return [(k, data[max(0, a - AROUND):b + AROUND], min(a, AROUND), min(a, AROUND) + b - a) for k, a, b in spans]


WINDOW = T.StructType().add("kind", "string").add("window", "binary").add("a", "integer").add("b", "integer")
CASE = T.StructType().add("x", "binary").add("held", "boolean").add("hits", "long").add("alone", "long").add("beside", "long")
SUMS = T.StructType().add("place", "long").add("s0", "long").add("s1", "long").add("s2", "long")


def _window_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields, found = to_arrow_schema(WINDOW), {}
    for batch in batches:
        for value in batch.column(0):
            for window in windows_of(value.as_py()):
                found[window] = None
                if len(found) >= WRITTEN:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), fields, strict=True)], schema=fields)
                    found = {}
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), fields, strict=True)], schema=fields)


def _case_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different cases of some windows with their numbers; a third of the windows is held out."""
    fields = to_arrow_schema(CASE)
    for batch in batches:
        for at in range(0, len(batch), TURNED):
            windows = list(zip(*(c.to_pylist() for c in batch.slice(at, TURNED).columns), strict=True))
            found: dict[tuple[bytes, bool], list[int]] = {}
            for window in windows:
                held = _number(*window) % 3 == 2
                for x, which in examples(*window):
                    row = np.clip(x, -VALUES // 2, VALUES // 2 - 1).astype("<i2").tobytes()
                    found.setdefault((row, held), [0, 0, 0])[which] += 1
            columns = [*zip(*found, strict=True), *zip(*found.values(), strict=True)] if found else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


def _cases(table: pa.Table | pa.RecordBatch) -> Cases:
    hits, alone, beside = (table.column(c).to_numpy().astype(float) for c in ("hits", "alone", "beside"))
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), "<i2").reshape(len(hits), len(FEATURES))
    margin = table.column("margin").to_numpy() if "margin" in table.schema.names else None
    return Cases(x, hits, hits + alone + beside / 2, hits + alone + beside, margin)


class SpreadCases:
    """Training cases in a Spark table; each measure is one job, and only its sums reach the driver."""

    def __init__(self, table: DataFrame):
        self.table, self.done = table, 0

    def advance(self, trees: Trees) -> None:
        """Write the margins of the trees so far, so that a job adds few trees."""
        done, written = self.done, T.StructType([*CASE.fields, T.StructField("margin", T.DoubleType())])

        def run(batches):
            for batch in batches:
                cases = _cases(batch)
                cases.done = done
                cases.advance(trees)
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in CASE), pa.array(cases.margin)], schema=to_arrow_schema(written))

        self.table, self.done = stage_table(self.table.mapInArrow(run, written), "span-margins"), len(trees.nodes)

    def summed(self, measure: Callable[[Cases], Sums], trees: Trees | None = None) -> Sums:
        if trees and len(trees.nodes) - self.done >= WRITTEN_ROUNDS:
            self.advance(trees)
        done = self.done

        def run(batches):
            for batch in batches:
                cases = _cases(batch)
                cases.done = done
                place, sums = cases.summed(measure, trees)
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), *map(pa.array, sums)], schema=to_arrow_schema(SUMS))

        names = [f.name for f in SUMS][1:]
        table = self.table.mapInArrow(run, SUMS).groupBy("place").agg(*(F.sum(n).alias(n) for n in names)).orderBy("place").toArrow()
        return table["place"].to_numpy(), np.array([table[n].to_numpy() for n in names])


def learn(docs: DataFrame, text: str = "text", local_cases: int = LOCAL_CASES) -> Detector | None:
    """Train on the windows of all texts; None without true and false cases on both sides."""
    texts = docs.select(utf8(text).alias("__text")).where(F.col("__text").isNotNull())
    parts = 4 * docs.sparkSession.sparkContext.defaultParallelism  # windows are small and cases cost time, so they are not left in few tasks
    windows = texts.mapInArrow(_window_rows, WINDOW).repartition(parts, *WINDOW.names).dropDuplicates()
    numbers = ("hits", "alone", "beside")
    table = stage_table(windows.mapInArrow(_case_rows, CASE).groupBy("x", "held").agg(*(F.sum(n).alias(n) for n in numbers)), "span-cases")
    total = {r.held: r for r in table.groupBy("held").agg(F.count("*").alias("cases"), *(F.sum(n).alias(n) for n in numbers)).collect()}
    if len(total) < 2 or not all(r.hits for r in total.values()) or not any(r.alone + r.beside for r in total.values()):
        return None
    fit, held = (table.where(F.col("held") == side) for side in (False, True))
    fit, held = (_cases(t.toArrow()) if total[side].cases <= local_cases else SpreadCases(t) for side, t in ((False, fit), (True, held)))
    place, sums = fit.summed(value_counts)
    of = total[False]
    trees = grow(fit, of.hits / (of.hits + of.alone + of.beside / 2), quantile_cuts(place, sums[0], len(FEATURES)))
    return calibrated(trees, *held.summed(margin_sums, trees))


def calibrated(trees: Trees, place: np.ndarray, sums: np.ndarray) -> Detector:
    """The detector from sums of held-out cases per kind and step of the margin."""
    margin, of_kind = (place // len(KINDS) - MARGIN_MOST * MARGIN_STEP) / MARGIN_STEP, place % len(KINDS)
    count, right, weight = sums[0], sums[1], sums[2] / 2
    places, probabilities = isotonic(margin, right / weight, weight)
    score = np.interp(margin, places, probabilities)
    least = {}
    for k, kind in enumerate(KINDS):
        rows = of_kind == k
        order = np.argsort(-score[rows], kind="stable")
        s, hits = score[rows][order], right[rows][order].cumsum()
        precision = hits / count[rows][order].cumsum()
        ends = np.append(s[1:] != s[:-1], True) if len(s) else np.zeros(0, bool)
        good = np.flatnonzero(ends & (precision >= PRECISION) & (hits >= LEAST_SUPPORT))
        least[kind] = max(0.5, float(s[good[-1]])) if len(good) else 2.0
    return Detector(trees, places, probabilities, least)


def chosen_spans(data: bytes, detector: Detector | None) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of a text, in bytes."""
    base, _ = base_spans(data)
    found = proposals(data) if detector else []
    if not found:
        return base, []
    starts, stops = [a for _, a, _ in base], []
    for _, _, b in base:  # the furthest end so far
        stops.append(max(b, stops[-1]) if stops else b)

    def free(a: int, b: int) -> bool:
        i = bisect_left(starts, b)
        return i == 0 or stops[i - 1] <= a

    found = [s for s in found if free(s[1], s[2])]
    picked: list[tuple[float, Span]] = []
    for at in range(0, len(found), SCORED):
        some = found[at:at + SCORED]
        scores = detector.scores(np.array([features(data, s) for s in some]))
        picked += [(float(p), s) for p, s in zip(scores, some, strict=True) if p >= detector.least[s[0]]]
    added: list[tuple[int, int, str]] = []
    for _, (kind, a, b) in sorted(picked, key=lambda x: (-x[0], x[1][1] - x[1][2], x[1][1], KINDS.index(x[1][0]))):
        i = bisect_left(added, (a, 0, ""))
        if (i == 0 or added[i - 1][1] <= a) and (i == len(added) or added[i][0] >= b):
            added.insert(i, (a, b, kind))
    return base, [(k, a, b) for a, b, k in added]


def in_code_points(data: bytes, spans: list[Span]) -> list[Span]:
    if not spans or data.isascii():
        return spans
    places, at, points = {}, 0, 0
    for place in sorted({p for s in spans for p in s[1:]}):
        points += len(data[at:place].decode("utf-8", "ignore"))
        places[place], at = points, place
    return [(kind, places[a], places[b]) for kind, a, b in spans]


def find_spans(data: bytes | None, detector: Detector | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, in code points, by start, then by kind as listed."""
    if not data:
        return [], []
    base, added = chosen_spans(data, detector)
    both = sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return in_code_points(data, base), in_code_points(data, both)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at, stop = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a >= stop:
            out += [text[at:a], f"[{kind.upper()}]"]
        stop = at = max(stop, b)
    return "".join([*out, text[at:]])


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_private(docs: DataFrame, key: str = "doc_id", text: str = "text", local_cases: int = LOCAL_CASES) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for each row."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, text, local_cases))

    def make():
        detector = sent.value

        def run(values):
            found = [find_spans(v, detector) for v in values]
            return {
                **{f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS},
                "base_sha256": [hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found],
                "spans": [_listed(spans) for _, spans in found],
                "n_added": [len(spans) - len(base) for base, spans in found],
            }
        return run

    fields = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    return map_rows(docs.select(F.col(key), utf8(text).alias("__text")), "__text", make, fields)


def redact_private(docs: DataFrame, text: str = "text", local_cases: int = LOCAL_CASES) -> DataFrame:
    """The rows with every span in ``text`` replaced by its kind; null texts stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, text, local_cases))

    def make():
        detector = sent.value
        return lambda values: {"clean": [None if v is None else redact(v, find_spans(v.encode(), detector)[1]) for v in values]}

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text).alias("raw"))
    clean = map_rows(rows, "raw", make, "clean string")
    return clean.select(*(F.col("clean").alias(text) if c == text else F.col(f"row.`{c}`") for c in docs.columns))
