"""Phrase collocations by marginalising the counts of the longest word windows.

A text is lower-cased (A to Z only), cut into pieces at punctuation and line ends, and pieces into
words at blanks and tabs. Every word starts one window: itself and its two lead columns, padded where
the piece ends. Only these windows are counted. ``ROLLUP(lang, w1, w2, w3)`` then sums them over ever
shorter prefixes, so one aggregation gives the count of every three-word phrase, of every two-word
phrase, of every word, and the number of words of the language; no shorter phrase is ever listed.

* Windows are made and counted per block of text as arrays; a block sends one row per language and
  first word with all its tails, so the exchange carries each first word once per block.
* The exchange is by language and first word. First words that are common in a bounded sample of
  texts are spread by their second word, and common pairs by their third; the sample decides only
  where rows go, never what is counted.
* Behind the exchange, tails that cannot reach the least count are folded into their prefix, as their
  exact sum is known there: memory holds one block of tails. A first word with more tails than a block
  is only pre-added, not folded, and so are spread pairs; the ROLLUP sums what is left either way.
* Phrases and their parts meet in joins on (lang, words); a part is one row, so a common part is only
  probed, and adaptive execution splits its partition.

Null texts have no words, null languages are ``und``; empty pieces and texts give nothing, repeated rows
count as often as they occur, and other columns are not read. All counts are whole numbers and scores
are computed in 38-digit decimals, so nothing is rounded before the floor.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.rows import utf8

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
CUTS = b".,;:!?\n\x0b\x0c\r"
CLEAN = bytes.maketrans(UPPER + CUTS + b"\t", LOWER + b"\n" * len(CUTS) + b" ")
BLANK, END = 32, 10
#: Texts, and tails behind the exchange, are counted in blocks of about this many bytes.
BLOCK = 1 << 23
#: Documents looked at to find first words and pairs that need spreading, and the share that makes them common.
SAMPLE_DOCS, COMMON_SHARE = 4000, 1 / 300
SPREAD = 61
WINDOWS = "lang string, w1 string, salt int, tails string"
SUMS = "lang string, w1 string, w2 string, w3 string, n long"
COUNT = "decimal(15,0)"


def _spans(octets: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """The byte ranges, which rise and do not overlap, as an Arrow array of strings."""
    length = stop - start
    marks = np.zeros(len(octets) + 1, np.int8)
    some = length > 0
    marks[start[some]] += 1
    marks[stop[some]] -= 1
    inside = np.cumsum(marks[:-1], dtype=np.int8).view(bool)
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(octets[inside])])


def _numbers(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different words and the number of each."""
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def count_rows(columns: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows of whole numbers in order, and how often (or with what weight) each occurs."""
    sizes = [int(c.max(initial=0)) + 1 for c in columns]
    code, back = columns[0], []
    room = sizes[0]
    for column, size in zip(columns[1:], sizes[1:], strict=True):
        known = None
        if room * size >= 1 << 62:  # number the rows so far
            known, code = np.unique(code, return_inverse=True)
            room = len(known)
        code, room = code * size + column, room * size
        back.append((size, known))
    if weights is None:
        code, counts = np.unique(code, return_counts=True)
    else:
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        counts = np.add.reduceat(weights[order], first) if len(code) else weights
        code = code[first]
    out = []
    for size, known in reversed(back):
        out.append(code % size)
        code = code // size
        if known is not None:
            code = known[code]
    return [code, *reversed(out)], counts.astype(np.int64)


def block_windows(texts: list[bytes]) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """Words (0 is the padding), the three columns of the different windows, and how often each occurs."""
    octets = np.frombuffer(b"\n".join(texts).translate(CLEAN), np.uint8)
    inside = (octets != BLANK) & (octets != END)
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    words, ids = _numbers(_spans(octets, start, stop))
    words = pa.concat_arrays([pa.array([b""], pa.binary()), words])
    piece = np.cumsum(octets == END)[start] if len(start) else start
    first = ids + 1
    second, third = np.zeros_like(first), np.zeros_like(first)
    second[:-1] = np.where(piece[1:] == piece[:-1], first[1:], 0)
    third[:-2] = np.where(piece[2:] == piece[:-2], first[2:], 0)
    windows, counts = count_rows([first, second, third])
    return words, windows, counts


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about a block at a time."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            value = text.as_py()
            if value:
                held.setdefault(lang, []).append(value)
                size[lang] = size.get(lang, 0) + len(value)
                if size[lang] >= BLOCK:
                    yield lang, held.pop(lang)
                    size[lang] = 0
    yield from held.items()


def _hashed(words: pa.Array, ids: np.ndarray) -> np.ndarray:
    used, place = np.unique(ids, return_inverse=True)
    return np.fromiter((zlib.crc32(w) % SPREAD for w in words.take(used).to_pylist()), np.int64, len(used))[place]


def _rows(lang: str, texts: list[bytes], firsts: set[bytes], pairs: set[tuple[bytes, bytes]]) -> pa.RecordBatch:
    """One row per first word (and salt) of a block, its tails as lines ``w2 w3 count``."""
    words, (w1, w2, w3), counts = block_windows(texts)
    salt = np.zeros(len(w1), np.int64)
    place = {w: i for w in firsts | {x for p in pairs for x in p} if (i := pc.index(words, pa.scalar(w, pa.binary())).as_py()) >= 0}
    hot = [place[w] for w in firsts | {a for a, _ in pairs} if w in place]
    if hot:
        spread = np.isin(w1, hot)
        salt[spread] = 1 + _hashed(words, w2[spread])
        for a, b in pairs:
            if a in place and b in place:
                rows = (w1 == place[a]) & (w2 == place[b])
                salt[rows] = 1 + SPREAD + _hashed(words, w3[rows])
        order = np.lexsort((salt, w1))
        w1, w2, w3, salt, counts = (x[order] for x in (w1, w2, w3, salt, counts))
    strings = words.cast(pa.string())
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(w1) != 0) | (np.diff(salt) != 0)])) if len(w1) else w1
    lines = pc.binary_join_element_wise(strings.take(w2), strings.take(w3), pa.array(counts).cast(pa.string()), " ")
    offsets = pa.array(np.concatenate([starts, [len(w1)]]).astype(np.int32))
    tails = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n") if len(w1) else pa.array([], pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(starts), pa.string()), strings.take(w1[starts]), pa.array(salt[starts], pa.int32()), tails],
        names=["lang", "w1", "salt", "tails"])


def fold_tails(rows: pa.Table, group: np.ndarray, least: int, whole: np.ndarray) -> pa.RecordBatch:
    """Rows (lang, w1, w2, w3, n) whose sums over any prefix equal those of the tails.

    ``group`` numbers the rows' (lang, w1, salt) from 0; in groups marked ``whole``, phrases below ``least``
    are folded into their prefix.
    """
    offsets = np.concatenate([[0], np.cumsum(pc.binary_length(rows["tails"]).to_numpy() + 1)])
    octets = np.frombuffer("\n".join([*rows["tails"].to_pylist(), ""]).encode(), np.uint8)
    cut = np.flatnonzero((octets == BLANK) | (octets == END))
    parts = _spans(octets, np.concatenate([[0], cut[:-1] + 1]), cut)
    line = np.searchsorted(offsets, cut[2::3], side="left") - 1
    at = np.arange(0, len(parts), 3)
    n = parts.take(at + 2).cast(pa.string()).cast(pa.int64()).to_numpy()
    words, ids = _numbers(pa.concat_arrays([pa.array([b""], pa.binary()), parts.take(at), parts.take(at + 1)]))
    w2, w3 = ids[1: len(at) + 1], ids[len(at) + 1:]
    (g, w2, w3), n3 = count_rows([group[line], w2, w3], n)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(g) != 0) | (np.diff(w2) != 0)]))
    pair = np.cumsum(np.bincount(first, minlength=len(g))) - 1
    n2 = np.add.reduceat(n3, first)[pair]
    salt = rows["salt"].to_numpy()
    row = np.zeros(len(whole), np.int64)
    row[group] = np.arange(len(group))
    fold = whole[g]
    w3 = np.where(fold & (n3 < least), 0, w3)
    w2 = np.where(fold & (n2 < least) & (salt[row[g]] <= SPREAD), 0, w2)
    (g, w2, w3), n = count_rows([g, w2, w3], n3)
    strings, row = words.cast(pa.string()), row[g]
    return pa.RecordBatch.from_arrays(
        [rows["lang"].combine_chunks().take(row), rows["w1"].combine_chunks().take(row), strings.take(w2), strings.take(w3), pa.array(n)],
        names=["lang", "w1", "w2", "w3", "n"])


def _folded(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Fold sorted rows, a block of tails at a time; a group that does not fit is only added up."""
    held: list[pa.RecordBatch] = []
    open_key = None  # the group whose first rows went out before

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, open_key
        table = pa.Table.from_batches(held).combine_chunks()
        changed = np.zeros(len(table), bool)
        for name in ("lang", "w1", "salt"):
            changed[1:] |= pc.not_equal(table[name].slice(1), table[name].slice(0, len(table) - 1)).to_numpy()
        group, key = np.cumsum(changed), [table[c][0].as_py() for c in ("lang", "w1", "salt")]
        whole = np.ones(int(group[-1]) + 1, bool)
        whole[0] = key != open_key
        stop = len(table) if last else int(np.searchsorted(group, group[-1]))
        held = [] if stop == len(table) else table.slice(stop).combine_chunks().to_batches()
        if not stop:  # one group fills the block
            stop, whole[0], open_key, held = len(table), False, key, []
        found = fold_tails(table.slice(0, stop), group[:stop], least, whole)
        for at in range(0, len(found), 50_000):
            yield found.slice(at, 50_000)

    size = 0
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.slice(at, 2000)
            if not len(part):
                continue
            held.append(part)
            size += pc.sum(pc.binary_length(part.column("tails"))).as_py()
            if size >= BLOCK:
                yield from flush(False)
                size = sum(pc.sum(pc.binary_length(b.column("tails"))).as_py() for b in held)
    if held:
        yield from flush(True)


def common_starts(docs: DataFrame) -> tuple[set[bytes], set[tuple[bytes, bytes]]]:
    """First words, and pairs, that make up more than a share of the windows of a bounded sample."""
    total = docs.count()
    if not total:
        return set(), set()
    sampled = docs.sample(min(1.0, SAMPLE_DOCS / total), 11).limit(2 * SAMPLE_DOCS)

    def run(batches):
        for lang, texts in _blocks(batches):
            words, (w1, w2, _), counts = block_windows(texts)
            (a, b), n = count_rows([w1, w2], counts)
            first = np.bincount(w1, counts, len(words)).astype(np.int64)
            least = COMMON_SHARE / 10 * counts.sum()  # a common one has this share in some block
            rows = [(words[i].as_py(), None, int(first[i])) for i in np.flatnonzero(first > least)]
            rows += [(words[a[i]].as_py(), words[b[i]].as_py(), int(n[i])) for i in np.flatnonzero((n > least) & (b > 0))]
            rows.append((None, None, int(counts.sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.binary(), pa.int64()), strict=True)],
                names=["a", "b", "n"])

    found = sampled.mapInArrow(run, "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n")).limit(int(4 / COMMON_SHARE)).collect()
    least = COMMON_SHARE * next((r.n for r in rows if r.a is None), 0)
    common = [r for r in rows if r.a is not None and r.n > least]
    return ({bytes(r.a) for r in common if r.b is None}, {(bytes(r.a), bytes(r.b)) for r in common if r.b is not None})


def count_windows(docs: DataFrame, starts: tuple[set, set] | None = None) -> DataFrame:
    """(lang, w1, salt, tails): the padded windows of all texts, counted per block."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), utf8().alias("text")).where(F.length("text") > 0)
    firsts, pairs = common_starts(texts) if starts is None else starts

    def run(batches):
        for lang, block in _blocks(batches):
            rows = _rows(lang, block, firsts, pairs)
            for at in range(0, len(rows), 20_000):
                yield rows.slice(at, 20_000)

    return texts.mapInArrow(run, WINDOWS)


def phrase_counts(docs: DataFrame, least: int = 10, starts: tuple[set, set] | None = None) -> DataFrame:
    """(lang, w1, w2, w3, level, f): exact counts of words and phrases with at least ``least`` occurrences.

    ``level`` is how many words a phrase has; level 0 is the language's number of words, given however small.
    """
    keys = ["lang", "w1", "salt"]
    rows = count_windows(docs, starts).repartition(*keys).sortWithinPartitions(*keys)
    folded = rows.mapInArrow(lambda batches: _folded(batches, least), SUMS)
    level = F.when(F.col("g") == 0, 3).when(F.col("g") == 1, 2).when(F.col("g") == 3, 1).otherwise(0)
    wanted = ((F.col("g") == 0) & (F.col("w3") != "")) | ((F.col("g") == 1) & (F.col("w2") != "")) | F.col("g").isin(3, 7)
    sums = folded.rollup("lang", "w1", "w2", "w3").agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    return sums.where(wanted & ((F.col("f") >= least) | (F.col("g") == 7))).select("lang", "w1", "w2", "w3", level.alias("level"), "f")


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    whole = lambda c: c.cast(COUNT)
    top = (whole(a) * whole(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (whole(l) * whole(r)).cast("decimal(31,0)")).cast("long")


def mine(docs: DataFrame, staged: Callable[[DataFrame], DataFrame], least: int = 10, top: int = 2000, cover: int = 50,
         starts: tuple[set, set] | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two and three words.

    ``staged`` writes the small table of frequent counts once, as five joins read it.
    """
    counts = staged(phrase_counts(docs, least, starts=starts))
    part = lambda level, name, *words: counts.where(F.col("level") == level).select(
        "lang", *[F.col(w).alias(to) for w, to in zip(("w1", "w2", "w3"), words, strict=False)], F.col("f").alias(name))
    two = (part(2, "a", "w1", "w2").join(part(1, "l", "w1"), ["lang", "w1"]).join(part(1, "r", "w2"), ["lang", "w2"])
           .withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"))))
    three = (part(3, "a", "w1", "w2", "w3")
             .join(part(1, "l1", "w1"), ["lang", "w1"]).join(part(2, "r1", "w2", "w3"), ["lang", "w2", "w3"])
             .join(part(2, "l2", "w1", "w2"), ["lang", "w1", "w2"]).join(part(1, "r2", "w3"), ["lang", "w3"]))
    s1, s2 = _score(F.col("a"), F.col("l1"), F.col("r1")), _score(F.col("a"), F.col("l2"), F.col("r2"))
    early = s1 <= s2
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least(s1, s2).alias("score"))
    longer = counts.where("level = 3")
    longer = longer.select("lang", "w1", "w2", "f").unionByName(longer.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f"))
    longer = longer.groupBy("lang", "w1", "w2").agg(F.max("f").alias("longer"))
    two = two.join(longer, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    phrases = three.unionByName(two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    phrases = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for group in (["lang", "part"], ["lang"]):  # a language's best are among the best of its parts
        best = Window.partitionBy(*group).orderBy(*order)
        phrases = phrases.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    words = counts.where("level = 0").select("lang", F.col("f").alias("n"))
    return phrases.join(F.broadcast(words), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
