"""Alignment of two tokenizers by as-of merges of token starts, with corpus-wide link counts.

A is a byte-level BPE vocabulary in JSON form, B a sentence-piece model; both encode a space and the
text, without special tokens. Byte offsets that end a token on both sides cut the tokens into groups.
An A and a B token are linked where their byte ranges overlap: ``pandas.merge_asof`` per batch, keyed by
the text part, finds for each token's start the covering token of the other side, and the union of both
directions gives each overlap once.

* A text is cut into parts at single blanks between two characters that are not white space. Both
  tokenizers cut there as well (A's pattern starts a piece at such a blank, and no piece of B holds its
  blank mark behind another character), so a part that occurs again has the same tokens and is aligned
  once per batch, or taken from a bounded store of earlier parts. Other texts are one part each.
* A first pass writes each text's counts and its linked id pairs with their numbers; an aggregation over
  that table gives the corpus count of each pair and the highest count of each B id. Pairs are bounded by
  the two vocabularies only, so their counts are broadcast to the second pass only below ``SENT_PAIRS``
  rows; beyond that, the second pass joins on the pair, to the same result.

Null and empty texts, and texts whose tokens' bytes on either side are not a space and the text, have no
tokens: zeros and the empty digest. Repeated rows and null keys stay as they are; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tidepool.session import stage_table

MARK = "▁"
BORDER = re.compile(r"(?<=\S) (?=\S)")
#: Parts kept between batches, bytes of a part that is kept at most, and bytes of texts worked on at a time.
KEPT_PARTS, KEPT_LENGTH, BLOCK = 400_000, 64, 1 << 21
#: Regular parts are encoded together in runs of about this many characters.
RUN = 1 << 16
#: Counts of at most this many pairs (13 bytes each) are broadcast.
SENT_PAIRS = 4_000_000
PASS = ("n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, times array<int>")


def byte_of_letter() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as themselves, then 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes = token_bytes
        self.lengths = np.fromiter(map(len, token_bytes), np.int64, len(token_bytes))
        self.numerals = pa.array([str(i) for i in range(len(token_bytes))], pa.string())

    def ids(self, texts: list[str]) -> list[list[int]]:
        """The tokens of a space and each text."""
        raise NotImplementedError

    def spells(self, ids: list[int], data: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == data


class JsonSide(Side):
    """A byte-level vocabulary in JSON form."""

    def __init__(self, source: str):
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.encode_special_tokens = True
        letters = byte_of_letter()
        count = self.tokenizer.get_vocab_size()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(count)]
        super().__init__([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in tokens])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]


class PieceSide(Side):
    """A sentence-piece model, which puts the space before the text itself."""

    def __init__(self, source: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=source)
        count = self.model.get_piece_size()
        super().__init__([
            bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()
            for i, piece in enumerate(map(self.model.id_to_piece, range(count)))])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def overlaps(part_a: np.ndarray, start_a: np.ndarray, part_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers (i, j) of all overlapping pairs, in order; starts rise over the whole batch."""
    a = pd.DataFrame({"part": part_a, "start": start_a, "i": np.arange(len(start_a))})
    b = pd.DataFrame({"part": part_b, "start": start_b, "j": np.arange(len(start_b))})
    of_a = pd.merge_asof(a, b, on="start", by="part")
    of_b = pd.merge_asof(b, a, on="start", by="part")
    i, j = of_b["i"].to_numpy(), of_b["j"].to_numpy()
    later = start_a[i] < start_b[j]  # tokens that start together are found from both sides
    i, j = np.concatenate([of_a["i"].to_numpy(), i[later]]), np.concatenate([of_a["j"].to_numpy(), j[later]])
    order = np.argsort(i * (len(b) + 1) + j, kind="stable")  # merges two rising runs
    return i[order], j[order]


def _among(values: np.ndarray, rising: np.ndarray) -> np.ndarray:
    """Whether each value is one of the rising ones."""
    at = np.minimum(np.searchsorted(rising, values), len(rising) - 1)
    return rising[at] == values if len(rising) else np.zeros(len(values), bool)


class Numbers(dict):
    """Numbers of strings; one met for the first time gets a running negative number, until it has its own."""

    def __init__(self, known: dict[str, int] | None = None):
        super().__init__(known or {})
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self.new.append(key)
        number = self[key] = -1 - len(self.new)
        return number


def _runs(parts: list[str]) -> Iterator[list[str]]:
    """Neighbouring parts, about ``RUN`` characters at a time."""
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    cuts = np.flatnonzero(np.diff(np.concatenate([[-1], ends // RUN]))).tolist()
    for start, stop in zip(cuts, [*cuts[1:], len(parts)], strict=False):
        yield parts[start:stop]


def _joined(strings: pa.Array, starts: np.ndarray, by: str) -> pa.Array:
    """Strings joined from each start to the next."""
    offsets = pa.array(np.concatenate([starts, [len(strings)]]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, strings), by)


class Parts:
    """Aligned text parts: counts, groups and linked id pairs of each, by number."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.clear()

    def clear(self) -> None:
        self.regular = Numbers()  # -1: white space at its start or end, so no part of its own
        self.odd: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, whether the bytes fit
        self.pairs, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int64)

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The part numbers of the texts, one after another, and how many each has; new parts are aligned first."""
        if len(self.groups) > KEPT_PARTS:
            self._forget()
        cut = [t.split(" ") for t in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = np.fromiter(map(self.regular.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        fresh, self.regular.new = self.regular.new, []
        plain = [w for w in fresh if w and w == w.strip()]
        self.regular.update(dict.fromkeys(fresh, -1))
        self.regular.update(zip(plain, range(len(self.groups), len(self.groups) + len(plain)), strict=True))
        place = np.fromiter(map(self.regular.__getitem__, fresh), np.int64, len(fresh))
        flat[flat < -1] = place[-2 - flat[flat < -1]]
        self._align([(run, True) for run in _runs(plain)])
        row = np.repeat(np.arange(len(cut)), sizes)
        strange = np.unique(row[flat < 0]).tolist()
        if not strange:
            return flat, sizes
        ends = np.cumsum(sizes)
        out = [flat[e - n:e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        pieces = {k: BORDER.split(" " + texts[k]) for k in strange}
        for k, found in pieces.items():
            pieces[k] = [found[0][1:], *found[1:]]
        fresh = [p for p in dict.fromkeys(p for found in pieces.values() for p in found) if p not in self.odd]
        self.odd.update(zip(fresh, range(len(self.groups), len(self.groups) + len(fresh)), strict=True))
        self._align([([p], False) for p in fresh])
        for k, found in pieces.items():
            out[k] = np.array([self.odd[p] for p in found], np.int64)
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _forget(self) -> None:
        """Keep the short parts used most, half the room at most."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: KEPT_PARTS // 2])
        keep = keep[self.uses[keep] > 1]
        place = np.full(len(self.groups), -1, np.int64)
        place[keep] = np.arange(len(keep))
        self.regular = Numbers({w: int(place[i]) for w, i in self.regular.items() if i >= 0 and place[i] >= 0 and len(w) <= KEPT_LENGTH})
        self.odd = {w: int(place[i]) for w, i in self.odd.items() if place[i] >= 0 and len(w) <= KEPT_LENGTH}
        self.groups = [self.groups[i] for i in keep]
        self.pairs, sizes = self.links(keep)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.counts, self.uses = self.counts[keep], self.uses[keep] // 2

    def links(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The linked pairs of the parts, one after another, and how many each has."""
        sizes = self.first[parts + 1] - self.first[parts]
        before = np.cumsum(sizes) - sizes
        return self.pairs[np.repeat(self.first[parts] - before, sizes) + np.arange(int(sizes.sum()))], sizes

    def _align(self, runs: list[tuple[list[str], bool]]) -> None:
        """Encode runs of parts and store the alignment of each part."""
        if not runs:
            return
        texts = [" ".join(run) for run, _ in runs]
        ids = [self.a.ids(texts), self.b.ids(texts)]
        lengths: list[int] = []  # of parts, in bytes
        right: list[bool] = []
        for k, (run, regular) in enumerate(runs):
            data = (" " + texts[k]).encode()
            fits = MARK not in texts[k] and self.a.spells(ids[0][k], data) and self.b.spells(ids[1][k], data)
            if not fits and len(run) > 1:  # find the parts that do not fit: encode each alone
                alone = [(part, self.a.ids([part])[0], self.b.ids([part])[0]) for part in run]
                ids[0][k], ids[1][k] = [], []
                for part, i, j in alone:
                    data = (" " + part).encode()
                    good = MARK not in part and self.a.spells(i, data) and self.b.spells(j, data)
                    right.append(good)
                    lengths.append(len(data) if good else 0)
                    ids[0][k] += i if good else []
                    ids[1][k] += j if good else []
            elif not fits:
                ids[0][k], ids[1][k] = [], []
                right.append(False)
                lengths.append(0)
            else:
                right += [True] * len(run)
                lengths += pc.add(pc.binary_length(pa.array(run, pa.large_string())), 1).to_pylist()
        n = len(lengths)
        stops = np.cumsum(lengths)
        begins = stops - lengths
        token, stop, part = [], [], []
        for side, found in zip((self.a, self.b), ids, strict=True):
            flat = np.fromiter(chain.from_iterable(found), np.int64, sum(map(len, found)))
            end = np.cumsum(side.lengths[flat])
            token.append(flat)
            stop.append(end)
            part.append(np.searchsorted(begins, end - side.lengths[flat], side="right") - 1)
        if not all(_among(stops[stops > 0], end).all() for end in stop):
            raise ValueError("a token reaches over the border of a part")
        both = stop[0][_among(stop[0], stop[1])]
        of_group = np.searchsorted(begins, both - 1, side="right") - 1
        sides = []
        for side, flat, end in zip((self.a, self.b), token, stop, strict=True):
            starts = np.concatenate([[0], np.searchsorted(end, both[:-1], side="right")]) if len(both) else both
            sides.append(_joined(side.numerals.take(flat), starts, ",") if len(both) else pa.array([], pa.string()))
        strings = pc.binary_join_element_wise(*sides, "|")
        n_groups = np.bincount(of_group, minlength=n)
        some = np.flatnonzero(n_groups)
        names = np.full(n, "", object)
        if len(some):
            names[some] = _joined(strings, np.cumsum(n_groups)[some] - n_groups[some], ";").to_pylist()
        i, j = overlaps(part[0], stop[0] - self.a.lengths[token[0]], part[1], stop[1] - self.b.lengths[token[1]])
        of_link = part[0][i]
        n_links = np.bincount(of_link, minlength=n)
        codes = (token[0][i] * len(self.b.bytes) + token[1][j]).astype(np.int32)
        self.groups += names.tolist()
        counts = [np.bincount(p, minlength=n) for p in part] + [n_groups, n_links, np.array(right, np.int64)]
        self.counts = np.concatenate([self.counts, np.column_stack(counts)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n_links)])
        self.pairs = np.concatenate([self.pairs, codes])
        self.uses = np.concatenate([self.uses, np.zeros(n, np.int64)])


def align_block(parts: Parts, texts: list[str | None], digest: bool = True) -> list:
    """Columns of ``PASS`` for some texts."""
    good = [k for k, t in enumerate(texts) if t and MARK not in t]
    flat, sizes = parts.number([texts[k] for k in good])
    names = list(map(parts.groups.__getitem__, flat.tolist()))
    ends = np.cumsum(sizes).tolist()
    row = np.repeat(np.array(good, np.int64), sizes)
    parts.uses += np.bincount(flat, minlength=len(parts.uses))
    wrong = np.zeros(len(texts), bool)
    wrong[row[parts.counts[flat, 4] == 0]] = True
    fine = ~wrong[row]
    flat, row = flat[fine], row[fine]
    counts = np.column_stack([np.bincount(row, c, len(texts)) for c in parts.counts[flat, :4].T]).astype(np.int64)
    groups = [""] * len(texts)
    for k, begin, end in zip(good, [0, *ends], ends, strict=False):
        if not wrong[k]:
            groups[k] = ";".join(names[begin:end])
            if digest:
                groups[k] = hashlib.sha256(groups[k].encode()).hexdigest()
    codes, n = parts.links(flat)
    span = np.int64(len(parts.a.bytes)) * len(parts.b.bytes)
    found, times = np.unique(np.repeat(row, n) * span + codes, return_counts=True)
    offsets = pa.array(np.searchsorted(found, np.arange(len(texts) + 1) * span).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in ((found % span).astype(np.int32), times.astype(np.int32))]
    return [*(pa.array(c, pa.int64()) for c in counts.T), pa.array(groups, pa.string()), *lists]


_built: dict[str, Parts] = {}


def link_texts(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = True) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups, pairs, times) of each whole text.

    ``groups`` lists the ids of each group, or is the SHA-256 of that list with ``digest``; ``pairs`` are
    the linked ids (A's times B's vocabulary size, plus B's), each with how often it is linked. The files'
    contents are broadcast, a fixed size of a few megabytes.
    """
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        source = a.read(), b.read()
    if JsonSide(source[0]).lengths.size * PieceSide(source[1]).lengths.size >= 1 << 31:
        raise ValueError("pairs of these vocabularies do not fit into 31 bits")
    sent = docs.sparkSession.sparkContext.broadcast(source)
    name = hashlib.sha256(source[0].encode() + source[1]).hexdigest()
    chosen = docs.select(F.col(key), F.col(text).alias("__text"))
    schema = T.StructType([chosen.schema[key], *T.StructType.fromDDL(PASS).fields])

    def run(batches):
        if name not in _built:
            _built.clear()
            _built[name] = Parts(JsonSide(sent.value[0]), PieceSide(sent.value[1]))
        arrow, parts = to_arrow_schema(schema), _built[name]
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.flatnonzero(np.diff(np.concatenate([[0], sizes // BLOCK]))) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if start < stop:
                    rows = batch.slice(start, stop - start)
                    columns = align_block(parts, rows.column(1).to_pylist(), digest)
                    yield pa.RecordBatch.from_arrays([rows.column(0), *columns], schema=arrow)

    return chosen.mapInArrow(run, schema)


def pair_counts(linked: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best): how often each pair is linked, and whether no pair of its B id has more."""
    pairs = linked.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    top = Window.partitionBy(F.col("pair") % b_size)  # at most as many rows as A has ids
    return pairs.withColumn("best", F.col("n") == F.max("n").over(top))


def _sums(times: Column, n: Column, best: Column) -> list[Column]:
    return [F.sum(F.when(best, times).otherwise(0)).alias("n_best"), F.sum(times * n).alias("count_sum")]


def _by_join(linked: DataFrame, counts: DataFrame) -> DataFrame:
    rows = linked.select("__row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = rows.join(counts, "pair").groupBy("__row").agg(*_sums(F.col("times"), F.col("n"), F.col("best")))
    return linked.join(sums, "__row", "left").fillna(0, ["n_best", "count_sum"])


def _by_broadcast(linked: DataFrame, counts: DataFrame) -> DataFrame:
    table = counts.orderBy("pair").toArrow()
    columns = [table[c].to_numpy() for c in ("pair", "n", "best")]
    sent = linked.sparkSession.sparkContext.broadcast(columns)
    schema = T.StructType([*linked.schema.fields, *T.StructType.fromDDL("n_best long, count_sum long").fields])

    def run(batches):
        pair, n, best = sent.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times")
            at = np.searchsorted(pair, lists.flatten().to_numpy())
            weight = times.flatten().to_numpy().astype(np.int64)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            sums = [np.concatenate([[0], np.cumsum(v)])[np.concatenate([[0], ends])] for v in (weight * best[at], weight * n[at])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.diff(s), pa.int64()) for s in sums)],
                                             schema=to_arrow_schema(schema))

    return linked.mapInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = True,
          sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups or groups_sha256) of each row."""
    linked = stage_table(link_texts(docs, a_path, b_path, key, text, digest)
                         .withColumn("__row", F.monotonically_increasing_id()), "token-links")
    with open(b_path, "rb") as b:
        size = sentencepiece.SentencePieceProcessor(model_proto=b.read()).get_piece_size()
    counts = stage_table(pair_counts(linked, size), "pair-counts")
    summed = (_by_broadcast if counts.count() <= sent_pairs else _by_join)(linked, counts)
    return summed.select(key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                         F.col("groups").alias("groups_sha256" if digest else "groups"))
