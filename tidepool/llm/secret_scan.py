"""Secret scan: an Aho-Corasick keyword pass, anchored patterns at its hits, then embedded checksums.

Kinds, in the order in which ties are listed: ``assign`` (a password-like name given a value),
``access`` (cloud access key id), ``hex`` (long lower-case hex run), ``github`` and ``npm`` (service
tokens whose last six characters are the CRC-32 of the others in base 62). The first three have no
checksum and are reported as matched; the last two only if the checksum holds.

The text is scanned as UTF-8 bytes, as every pattern is made of ASCII characters; spans are given in
code points, end exclusive. A hex run has no keyword: its prefilter searches the text mapped to
"hex digit or not" for sixteen marks in a row. Null and empty texts have no spans.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.rows import map_rows, utf8

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm")
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
SERVICE = {"github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
           "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])")}
LEAST = {"assign": 12, "access": 18, "hex": 16}
KEYWORDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",),
            "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",)}
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_MARK = bytes(49 if chr(c) in "0123456789abcdef" else 48 for c in range(256))
HEX_RUN = b"1" * LEAST["hex"]

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def _keywords() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def checksum_holds(body: bytes) -> bool:
    """Whether the last six base-62 digits are the CRC-32 of what precedes them."""
    rest, digits = zlib.crc32(body[:-6]), []
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits.append(DIGITS[digit])
    return rest == 0 and "".join(reversed(digits)).encode() == body[-6:]


def _at(kind: str, data: bytes, start: int) -> tuple[int, bool] | None:
    """End of the match of ``kind`` at ``start`` and whether it counts; None where there is none."""
    pattern = {"assign": ASSIGN, "access": ACCESS}.get(kind) or SERVICE[kind]
    m = pattern.match(data, start)
    if m is None:
        return None
    if kind == "assign":
        return m.end(), len(m[2]) >= LEAST[kind]
    if kind == "access":
        return m.end(), len(m[0]) >= LEAST[kind]
    return m.end(), checksum_holds(m[1])


def _byte_spans(data: bytes) -> list[Span]:
    spans: list[Span] = []
    done = dict.fromkeys(KINDS, 0)
    hits = [(end + 1 - n, kind) for end, (kind, n) in _keywords().iter(data.lower().decode("latin-1"))]
    for start, kind in sorted(hits):
        if start < done[kind]:
            continue  # inside an earlier match of this kind, counted or not
        got = _at(kind, data, start)
        if got:
            done[kind] = got[0]
            if got[1]:
                spans.append((kind, start, got[0]))
    marks, at = data.translate(HEX_MARK), 0
    while (at := marks.find(HEX_RUN, at)) >= 0:
        end = HEX.match(data, at).end()
        spans.append(("hex", at, end))
        at = end
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def find_spans(data: bytes | None) -> list[Span]:
    """(kind, start, end) in code points, by start, then by kind as listed."""
    spans = _byte_spans(data) if data else []
    if not spans or data.isascii():
        return spans
    places, at, points = {}, 0, 0
    for place in sorted({p for s in spans for p in s[1:]}):
        points += len(data[at:place].decode("utf-8", "ignore"))
        places[place], at = points, place
    return [(kind, places[a], places[b]) for kind, a, b in spans]


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by a mark."""
    out, at = [], 0
    stop = -1
    for _, a, b in sorted(find_spans(text.encode()), key=lambda s: s[1]):
        if a >= max(stop, 0):
            out += [text[at:a] if stop < 0 else text[stop:a], mark]
        stop = max(stop, b)
    return "".join([*out, text[max(stop, 0):]])


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, kinds) for each row."""

    def make():
        def run(values):
            found = [find_spans(v) for v in values]
            base = [[s for s in spans if s[0] in BASE] for spans in found]
            return {
                **{f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in BASE},
                "base_sha256": [hashlib.sha256(_listed(b).encode()).hexdigest() for b in base],
                "spans": [_listed(s) for s in found],
                "n_checked": [len(s) - len(b) for s, b in zip(found, base, strict=True)],
            }
        return run

    return map_rows(docs.select(F.col(key), utf8(text).alias("__text")), "__text", make,
                    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_checked long")


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every secret in ``text`` replaced by a mark; null texts stay null."""

    def make():
        return lambda values: {"__clean": [None if v is None else redact(v) for v in values]}

    columns = docs.columns
    copied = docs.withColumn("__raw", F.col(text))
    clean = map_rows(copied, "__raw", make, "__clean string").withColumn(text, F.col("__clean"))
    return clean.select(*columns)
