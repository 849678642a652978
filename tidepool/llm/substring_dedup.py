"""Substring dedup: suffix automata of reference shards, documents streamed for matching statistics.

A window is ``LENGTH`` consecutive words of one document. A word goes if a window that covers it also
starts in a document with a smaller id. Words are runs of characters other than space and 09 to 0D,
unchanged; they are compared by 64-bit hashes.

Sharding. A reference that grows with the corpus cannot be broadcast, so each document part goes to the
one shard that can match it. A window's anchor is the smallest hash among its ``GRAM``-word pieces: equal
windows have equal anchors. Consecutive windows with one anchor form a run, and a run's words its
content. Anchors met in a single document end there. Of the others, each distinct content goes once,
with the smallest id that has it, to the shard of its anchor. There the automaton of the shard's contents
is built, each state knowing the smallest id that reaches it, and every content is streamed through it:
where the match is at least ``LENGTH`` words long, the state of its last ``LENGTH`` words tells the
smallest id with that window. Documents then compare their own id with what their contents found.
Anchors with more than ``HOT`` contents (the edges of a passage that very many documents share) would
make one large shard; their windows are spread by the hash of the whole window instead, and the
smallest id of each is an ordinary partial and final aggregation.

Rows with one id are one document as regards who was first, and are answered row by row. Rows without an
id neither remove nor lose words. Null and empty texts have no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.hashing import Ranges, hash_words
from tidepool.llm.rows import map_rows, sorted_groups, utf8
from tidepool.session import shuffles_dropped, stage_table

LENGTH, GRAM, HOT = 13, 6, 2_000
PIECES = LENGTH - GRAM + 1


class Runs:
    """The runs of a document: first word, number of windows, anchor and content hash of each."""

    def __init__(self, data: bytes):
        self.hashes = hash_words(data)
        n = len(self.hashes) - LENGTH + 1
        if n < 1:
            empty = np.zeros(0, dtype=np.int64)
            self.start, self.windows, self.anchor, self.content = empty, empty, empty, empty
            return
        self.ranges = Ranges(self.hashes)
        at = np.arange(len(self.hashes) - GRAM + 1)
        least, width = self.ranges.of(at, at + GRAM), 1
        while width < PIECES:  # minima over 1, 2, 4, .. neighbouring pieces
            step = min(width, PIECES - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        self.start = first
        self.windows = np.diff(np.concatenate([first, [n]]))
        self.anchor = least[first].view(np.int64)
        self.content = self.ranges.of(first, first + self.windows + LENGTH - 1).view(np.int64)

    def places(self, contents: list[int]) -> dict[int, tuple[int, int, int]]:
        """(first word, windows, anchor) of the first run of each of these contents."""
        at = np.flatnonzero(np.isin(self.content, np.array(contents, dtype=np.int64)))[::-1]
        rows = zip(self.start[at].tolist(), self.windows[at].tolist(), self.anchor[at].tolist(), strict=True)
        return dict(zip(self.content[at].tolist(), rows, strict=True))


def _content_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, content, doc) of each document, each content once."""
    for batch in batches:
        anchors, contents, docs = [], [], []
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
            runs = Runs(text)
            content, at = np.unique(runs.content, return_index=True)
            anchors.append(runs.anchor[at])
            contents.append(content)
            docs.append(np.full(len(at), doc, dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (anchors, contents, docs)],
            names=["anchor", "content", "doc"])


class Automaton:
    """Suffix automaton of several sequences; each state has the smallest id among its occurrences."""

    def __init__(self):
        self.edges: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]

    def add(self, sequence: list[int], owner: int) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)
            self._meet(last, owner)

    def _meet(self, state: int, owner: int) -> None:
        if self.least[state] is None or owner < self.least[state]:
            self.least[state] = owner

    def _new(self, edges: dict[int, int], link: int, length: int) -> int:
        self.edges.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.least.append(None)
        return len(self.link) - 1

    def _split(self, above: int, state: int, symbol: int) -> int:
        """A state for the shorter strings of ``state`` that end an edge from ``above``."""
        clone = self._new(dict(self.edges[state]), self.link[state], self.length[above] + 1)
        self.link[state] = clone
        while above >= 0 and self.edges[above].get(symbol) == state:
            self.edges[above][symbol] = clone
            above = self.link[above]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        there = self.edges[last].get(symbol)
        if there is not None:  # met before, in this or an earlier sequence
            return there if self.length[there] == self.length[last] + 1 else self._split(last, there, symbol)
        state = self._new({}, 0, self.length[last] + 1)
        above = last
        while above >= 0 and symbol not in self.edges[above]:
            self.edges[above][symbol] = state
            above = self.link[above]
        if above >= 0:
            there = self.edges[above][symbol]
            fits = self.length[there] == self.length[above] + 1
            self.link[state] = there if fits else self._split(above, there, symbol)
        return state

    def finish(self) -> None:
        """Hand the smallest ids down the suffix links, longest strings first."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.least[state] is not None and self.link[state] > 0:
                self._meet(self.link[state], self.least[state])

    def first_owners(self, sequence: list[int], length: int) -> list[int | None]:
        """For each window of ``length`` symbols the smallest id that has it, from matching statistics."""
        state, matched, out = 0, 0, []
        for place, symbol in enumerate(sequence):
            while state and symbol not in self.edges[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.edges[state]:
                state, matched = self.edges[state][symbol], matched + 1
            if place >= length - 1:
                if matched >= length:
                    while self.length[self.link[state]] >= length:
                        state = self.link[state]
                    matched = min(matched, self.length[state])
                    out.append(self.least[state])
                else:
                    out.append(None)
        return out


def _shard_answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(content, place, firsts): for each content of a shard the smallest id per window."""
    contents, firsts = [], []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(contents, pa.int64()), pa.array([0] * len(contents), pa.int32()),
             pa.array(firsts, pa.list_(pa.int64()))], names=["content", "place", "firsts"])

    for _, rows in sorted_groups(batches, "anchor"):
        rows = list({r["content"]: r for r in rows}.values())
        if len(rows) == 1:  # nothing else in the shard
            windows = len(rows[0]["words"]) // 8 - LENGTH + 1
            contents.append(rows[0]["content"])
            firsts.append([rows[0]["first_doc"]] * windows)
        else:
            sequences = [np.frombuffer(r["words"], np.uint64).tolist() for r in rows]
            automaton = Automaton()
            for sequence, row in zip(sequences, rows, strict=True):
                automaton.add(sequence, row["first_doc"])
            automaton.finish()
            for sequence, row in zip(sequences, rows, strict=True):
                contents.append(row["content"])
                firsts.append(automaton.first_owners(sequence, LENGTH))
        if len(contents) >= 20_000:
            yield out()
            contents, firsts = [], []
    yield out()


def _read_contents(docs: DataFrame, contents: DataFrame) -> DataFrame:
    """The words of each content, read from the first document that has it.

    Rows: (anchor, content, first_doc, words, windows), where only hot contents have ``windows``, the
    hashes of their whole windows, and only the others have ``words``.
    """
    wanted = contents.groupBy("first_doc").agg(F.collect_list(F.struct("content", "hot")).alias("wanted"))
    both = docs.join(wanted, F.col("doc") == F.col("first_doc")).drop("doc")
    found = "array<struct<anchor: long, content: long, words: binary, windows: array<long>>>"

    def make():
        def run(values):
            out = []
            for value in values:
                runs, rows = Runs(value["text"]), []
                hot = {w["content"]: w["hot"] for w in value["wanted"]}
                for content, (start, windows, anchor) in runs.places(list(hot)).items():
                    row = {"anchor": anchor, "content": content, "words": None, "windows": None}
                    if hot[content]:
                        at = np.arange(start, start + windows)
                        row["windows"] = runs.ranges.of(at, at + LENGTH).view(np.int64).tolist()
                    else:
                        row["words"] = runs.hashes[start:start + windows + LENGTH - 1].tobytes()
                    rows.append(row)
                out.append(rows)
            return {"found": out}
        return run

    packed = both.select("first_doc", F.struct("text", "wanted").alias("__both"))
    return map_rows(packed, "__both", make, f"found {found}").select("first_doc", F.inline("found"))


def first_owners(docs: DataFrame, survivors: DataFrame) -> DataFrame:
    """(content, firsts): for each window of a content the smallest document id that has it."""
    contents = survivors.groupBy("content").agg(
        F.first("anchor").alias("anchor"), F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    with shuffles_dropped(docs.sparkSession):
        contents = stage_table(contents, "contents")
        hot = contents.groupBy("anchor").agg(F.count("*").alias("m")).where(F.col("m") > HOT).select(
            "anchor", F.lit(True).alias("hot"))
        marked = contents.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
        words = stage_table(_read_contents(docs, marked), "content-words")
        cold = words.where(F.col("words").isNotNull()).select("anchor", "content", "first_doc", "words")
        answers = (cold.repartition("anchor").sortWithinPartitions("anchor", "content")
                   .mapInArrow(_shard_answers, "content long, place int, firsts array<long>"))
        windows = words.where(F.col("windows").isNotNull()).select(
            "content", "first_doc", F.posexplode("windows").alias("place", "window"))
        least = windows.groupBy("window").agg(F.min("first_doc").alias("least"))
        spread = windows.select("content", "place", "window").distinct().join(least, "window").select(
            "content", "place", F.array("least").alias("firsts"))
        parts = answers.unionByName(spread).groupBy("content").agg(
            F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "firsts"))), lambda p: p["firsts"]))
            .alias("firsts"))
        found = parts.join(contents.select("content", "last_doc"), "content")
        return stage_table(found.where(F.array_min("firsts") < F.col("last_doc")).select("content", "firsts"), "firsts")


def _strip(data: bytes, masks: dict[int, list[bool]]) -> np.ndarray:
    """Which words stay, given for each content which of its windows came first elsewhere."""
    runs = Runs(data)
    gone = np.zeros(len(runs.hashes) + 1, dtype=np.int64)
    at = np.flatnonzero(np.isin(runs.content, np.fromiter(masks, np.int64, len(masks))))
    starts = [start + np.flatnonzero(masks[content]) for start, content in
              zip(runs.start[at].tolist(), runs.content[at].tolist(), strict=True)]
    if starts:
        found = np.concatenate(starts)
        gone[found] = 1  # windows of different runs start at different words
        np.subtract.at(gone, found + LENGTH, 1)
    return np.cumsum(gone)[:-1] <= 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of each row; ids are whole numbers."""
    spark = docs.sparkSession
    read = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("doc"), utf8(text).alias("text"))
    rows = read.mapInArrow(_content_rows, "anchor long, content long, doc long")
    holders = Window.partitionBy("anchor")
    with shuffles_dropped(spark):  # documents are cut into contents once, and contents cross the network once
        met = rows.withColumns({"__a": F.min("doc").over(holders), "__b": F.max("doc").over(holders)})
        survivors = stage_table(met.where("__a < __b").select("anchor", "content", "doc"), "survivors")
    firsts = first_owners(read, survivors)
    hits = survivors.select("content", "doc").join(firsts, "content").where(F.array_min("firsts") < F.col("doc"))
    masks = hits.groupBy(F.col("doc").alias("__doc")).agg(F.collect_list(F.struct(
        "content", F.transform("firsts", lambda x: x < F.col("doc")).alias("mask"))).alias("__masks"))
    with shuffles_dropped(spark):
        masks = stage_table(masks, "masks")
    every = docs.select(F.col(key), utf8(text).alias("__text"))
    joined = every.join(masks, F.col(key).cast("long") == F.col("__doc"), "left")

    def make():
        def run(values):
            out = {"n_words": [], "n_removed": [], "kept_sha256": []}
            for value in values:
                words = value["text"].split() if value["text"] else []
                kept = words
                if words and value["masks"]:
                    stay = _strip(value["text"], {m["content"]: m["mask"] for m in value["masks"]})
                    kept = list(compress(words, stay.tolist()))
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            return out
        return run

    packed = F.struct(F.col("__text").alias("text"), F.col("__masks").alias("masks")).alias("__both")
    return map_rows(joined.select(F.col(key), packed), "__both", make, "n_words long, n_removed long, kept_sha256 string")
