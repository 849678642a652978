"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document is contaminated by an item if some stretch of its words is within an edit distance of
``EDITS`` x (words of the item), in words (ASCII letters lower-cased), of the whole item.

The CGK embedding reads a word sequence with a pointer. At step j it writes the word under the pointer
and moves on if a random bit of (step, word) says so; the same randomness is used everywhere, so two
sequences that differ by a few edits fall into step again and their embeddings differ in few places.
An LSH key is a few sampled places of the embedding. Both sides are embedded from the same anchors:
words that are rare among the items, several per item from the part where walks start, wherever they
occur. At an anchor that lies
``o`` words into an item, a hit opens the item-sized window that begins ``o`` words earlier in the
document, and the window (with room for the allowed edits) is verified by exact edit distance.

Walks are added until each item is estimated to be found with ``RECALL``: edited copies of it, with
random words around them, are looked up by each walk, and the share of walks that find a copy gives the
chance that all of them miss it. Items that do not get there in ``MAX_WALKS`` are found exactly: of an item cut
into one piece more than it may have edits, one piece at least stands unedited in the document.

Items are a query set: they are read in blocks of at most ``BLOCK_WORDS`` words, each block's index is
broadcast, and all documents pass each block. Nothing of the documents is shuffled with one block.

Items without words match nothing. Null and empty texts have no hits. Equal items are hit together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidepool.llm.rows import map_rows, utf8

EDITS = 0.2
RECALL = 0.995
BLOCK_WORDS = 100_000
ANCHORS = 8
STEPS = (2, 6, 12, 24)
PLACES, KEYS_PER_WALK, MAX_WALKS = 5, 6, 12
#: Words of several documents that are embedded together.
GROUP_WORDS = 100_000
TRIALS = 16
GOLDEN = 0x9E3779B97F4A7C15
MIX = np.uint64(GOLDEN)


def words_of(data: bytes | None) -> list[bytes]:
    return data.lower().split() if data else []


def _scramble(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def embed(hashes: np.ndarray, starts: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """CGK embedding (starts x steps) of the word sequence read from each start; 0 past the end."""
    own = _scramble(hashes + np.uint64((walk + 1) * GOLDEN & 0xFFFFFFFFFFFFFFFF))  # a fresh set of 64 random bits per word and walk
    own, padded = np.append(own, np.uint64(0)), np.append(hashes, np.uint64(0))
    at, end = starts.astype(np.int64), len(hashes)
    out = np.empty((len(starts), steps), dtype=np.uint64)
    for j in range(steps):
        out[:, j] = padded[at]
        at = np.minimum(at + ((own[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int64), end)
    return out


def keys_of(embedded: np.ndarray, places: np.ndarray, salt: int) -> np.ndarray:
    key = np.full(len(embedded), salt, dtype=np.uint64)
    for place in places:
        key = _scramble(key * MIX + embedded[:, place])
    return key


def edit_distance(a: list, b: list, most: int, free_ends: bool = False) -> tuple[int, int]:
    """(distance, end in b) of the nearest stretch of ``b`` (or all of it), or most + 1 if farther."""
    codes: dict = {}
    x = [codes.setdefault(w, len(codes)) for w in a]
    y = np.array([codes.setdefault(w, len(codes)) for w in b], dtype=np.int64)
    steps = np.arange(len(y) + 1)
    row = np.zeros(len(y) + 1, dtype=np.int64) if free_ends else steps.copy()
    for i, word in enumerate(x, 1):
        step = np.minimum(row[:-1] + (y != word), row[1:] + 1)
        # insertions in b: a running minimum of value - place
        row = np.minimum.accumulate(np.concatenate([[i], step]) - steps) + steps
        if row.min() > most:
            return most + 1, 0
    end = int(row.argmin()) if free_ends else len(y)
    return int(row[end]), end


Match = tuple[object, int, int, int]


class Index:
    """LSH keys of one block of items."""

    def __init__(self, items: list[tuple[object, list[bytes]]], recall: float = RECALL, seed: int = 5):
        self.items = [(i, w) for i, w in items if w]
        self.anchors: set[bytes] = set()
        self.walks: list[list[tuple[int, np.ndarray]]] = []
        self.tables: dict[int, list[tuple[int, int]]] = {}
        self.recall = 1.0
        #: Items that the walks do not find with the target recall, and their pieces by length: key -> (item, offset).
        self.exact: list[int] = []
        self.codes: dict[bytes, int] = {}
        self.pieces: dict[int, dict[int, list[tuple[int, int]]]] = {}
        if not self.items:
            return
        counts: dict[bytes, int] = defaultdict(int)
        for _, words in self.items:
            for w in set(words):
                counts[w] += 1
        self.steps = [self._steps(len(w)) for _, w in self.items]
        for (_, words), steps in zip(self.items, self.steps, strict=True):
            first = set(words[:self._last(len(words), steps)])
            self.anchors.update(sorted(first, key=lambda w: (counts[w], -len(w), w))[:ANCHORS])
        rng = np.random.default_rng(seed)
        trials = _Trials(self, rng)
        while len(self.walks) < MAX_WALKS:
            trials.count(self._add_walk(rng), len(self.walks) - 1)
            estimates = trials.recalls()
            if estimates.min() >= recall:
                break
        self.exact = np.flatnonzero(estimates < recall).tolist()
        self.recall = float(estimates[estimates >= recall].min(initial=1.0))
        self._cut_pieces()
        self._arrays()

    @staticmethod
    def _steps(n: int) -> int:
        """Embedding steps for an item of n words: those that stay inside its second half."""
        return max([s for s in STEPS if s <= max(n // 2, STEPS[0])])

    @staticmethod
    def _last(n: int, steps: int) -> int:
        """Walks of an item start before this word, so that most of their steps read words of the item."""
        return max(n - steps // 2, 1)

    @staticmethod
    def _edited(words: list[bytes], rng: np.random.Generator) -> list[bytes]:
        """The item with as many random word edits as are allowed."""
        out = list(words)
        for _ in range(int(EDITS * len(words))):
            at, kind = int(rng.integers(0, max(len(out), 1))), int(rng.integers(0, 3))
            if kind < 2 and out:
                del out[at]
            if kind > 0:
                out.insert(at, b"\x00%d" % rng.integers(1 << 40))
        return out

    def _add_walk(self, rng: np.random.Generator) -> dict[tuple[int, int], list[int]]:
        """One more walk over all items; its keys by item, with their offsets."""
        walk, own = len(self.walks), defaultdict(list)
        self.walks.append([])
        for steps in sorted(set(self.steps)):
            for number in range(KEYS_PER_WALK):
                size = min(PLACES, steps)
                places = np.sort(rng.choice(steps, size, replace=False))
                salt = (walk * 64 + number) * 64 + steps
                self.walks[walk].append((steps, places, salt))
        for k, (_, words) in enumerate(self.items):
            hashes = np.array([xxh64_intdigest(w) for w in words], dtype=np.uint64)
            last = self._last(len(words), self.steps[k])
            starts = np.array([o for o in range(last) if words[o] in self.anchors], dtype=np.int64)
            embedded = embed(hashes, starts, self.steps[k], walk)
            for steps, places, salt in self.walks[walk]:
                if steps == self.steps[k]:
                    for key, o in zip(keys_of(embedded, places, salt).tolist(), starts.tolist(), strict=True):
                        self.tables.setdefault(key, []).append((k, o))
                        own[key, k].append(o)
        return own

    def _cut_pieces(self) -> None:
        for k in self.exact:
            words = self.items[k][1]
            parts = int(EDITS * len(words)) + 1
            cuts = [i * len(words) // parts for i in range(parts + 1)]
            for low, high in zip(cuts, cuts[1:]):
                codes = np.array([self.codes.setdefault(w, len(self.codes) + 1) for w in words[low:high]], dtype=np.uint64)
                key = int(self._piece_keys(codes, high - low)[0])
                self.pieces.setdefault(high - low, {}).setdefault(key, []).append((k, low))
        self.piece_keys = {n: np.array(sorted(t), dtype=np.uint64) for n, t in self.pieces.items()}

    @staticmethod
    def _piece_keys(codes: np.ndarray, length: int) -> np.ndarray:
        """Key of the ``length`` words from each place."""
        places = max(len(codes) - length + 1, 0)
        key = np.full(places, length, dtype=np.uint64)
        for i in range(length):
            key = _scramble(key * MIX + codes[i:i + places])
        return key

    def _piece_hits(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(item, window start, place) for every piece that stands in the words."""
        if not self.pieces:
            return
        codes = np.fromiter((self.codes.get(w, 0) for w in words), dtype=np.uint64, count=len(words))
        for length, table in self.pieces.items():
            keys, known = self._piece_keys(codes, length), self.piece_keys[length]
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            for i in np.flatnonzero(known[at] == keys).tolist():
                for item, offset in table[int(keys[i])]:
                    yield item, i - offset, i

    def _arrays(self) -> None:
        self.known = np.array(sorted(self.tables), dtype=np.uint64)
        self.longest = max(self.steps)

    def _hits_of(self, words: list[bytes]) -> set[tuple[int, int, int]]:
        """(item, window start, anchor) for every key or piece of the words that is in the index."""
        starts = np.array([i for i, w in enumerate(words) if w in self.anchors], dtype=np.int64)
        found = set(self._piece_hits(words))
        if not len(starts):
            return found
        # only the words that walks from anchors can reach are hashed
        reached = np.zeros(len(words) + 1, dtype=np.int32)
        np.add.at(reached, starts, 1)
        np.add.at(reached, np.minimum(starts + max(self.steps), len(words)), -1)
        near = np.flatnonzero(np.cumsum(reached)[:-1])
        hashes = np.zeros(len(words), dtype=np.uint64)
        hashes[near] = [xxh64_intdigest(words[i]) for i in near]
        for walk in range(len(self.walks)):
            embedded = embed(hashes, starts, max(self.steps), walk)
            for _, places, salt in self.walks[walk]:
                keys = keys_of(embedded, places, salt)
                at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
                hit = np.flatnonzero(self.known[at] == keys)
                for i in hit:
                    for item, offset in self.tables.get(int(keys[i]), ()):
                        found.add((item, int(starts[i]) - offset, int(starts[i])))
        return found

    def matches(self, texts: list[bytes | None]) -> list[list[Match]]:
        """For each text its (item id, start, end, edits): the nearest stretch of words for each item."""
        out: list[list[Match]] = []
        group: list[list[bytes]] = []
        size = 0
        for text in texts:
            group.append(words_of(text))
            size += len(group[-1])
            if size >= GROUP_WORDS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, docs: list[list[bytes]]) -> list[list[Match]]:
        """Documents are embedded as one sequence; a hit belongs to the document of its anchor."""
        out: list[list[Match]] = [[] for _ in docs]
        if not self.items or not docs:
            return out
        borders = np.cumsum([0, *map(len, docs)])
        of: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for k, begin, anchor in self._hits_of([w for words in docs for w in words]):
            doc = int(np.searchsorted(borders, anchor, side="right")) - 1
            of[doc][k].add(begin - int(borders[doc]))
        for doc, by_item in of.items():
            for k, begins in sorted(by_item.items()):
                found = self._verify(docs[doc], k, sorted(begins))
                if found:
                    out[doc].append(found)
        return out

    def _verify(self, words: list[bytes], k: int, begins: list[int]) -> Match | None:
        """The nearest stretch around any of the windows, if it is within the item's distance."""
        key, item = self.items[k]
        most, best = int(EDITS * len(item)), None
        for begin in begins:
            low, high = max(0, begin - 2 * most), min(len(words), begin + len(item) + 2 * most)
            window = words[low:high]
            if sum(map(set(window).__contains__, item)) < len(item) - most:
                continue  # every word of the item that is missing costs an edit
            edits, end = edit_distance(item, window, most, free_ends=True)
            if edits <= most and (best is None or edits < best[3]):
                length = edit_distance(item[::-1], window[:end][::-1], most, free_ends=True)[1]
                best = key, low + end - length, low + end, edits
        return best


class _Trials:
    """Edited copies of each item between random words, and how many walks have found each."""

    def __init__(self, index: Index, rng: np.random.Generator):
        self.index, self.walks = index, 0
        words: list[bytes] = []
        self.item, self.begin, self.end = [], [], []
        for k, (_, item) in enumerate(index.items):
            for _ in range(TRIALS):
                words += [b"\x00%d" % n for n in rng.integers(1 << 40, size=max(index.steps))]
                self.begin.append(len(words))
                words += index._edited(item, rng)
                self.end.append(len(words))
                self.item.append(k)
        words += [b"\x00%d" % n for n in rng.integers(1 << 40, size=max(index.steps))]
        self.found = np.zeros(len(self.item), dtype=np.int64)
        self.starts = np.array([i for i, w in enumerate(words) if w in index.anchors], dtype=np.int64)
        self.of = np.searchsorted(np.array(self.begin), self.starts, side="right") - 1
        self.hashes = np.array([xxh64_intdigest(w) for w in words], dtype=np.uint64)

    def count(self, own: dict[tuple[int, int], list[int]], walk: int) -> None:
        """Add the copies that a walk finds, that is, opens a window on that holds the whole copy."""
        self.walks += 1
        items, hit = self.index.items, np.zeros(len(self.found), dtype=bool)
        steps = np.array(self.index.steps)[np.array(self.item)[self.of]] if len(self.of) else np.zeros(0)
        for size, places, salt in self.index.walks[walk]:
            mine = np.flatnonzero((steps == size) & ~hit[self.of])
            keys = keys_of(embed(self.hashes, self.starts[mine], size, walk), places, salt).tolist()
            for i, key in zip(mine.tolist(), keys, strict=True):
                t = int(self.of[i])
                for offset in own.get((key, self.item[t]), ()):
                    n = len(items[self.item[t]][1])
                    low = int(self.starts[i]) - offset
                    room = 2 * int(EDITS * n)
                    if low - room <= self.begin[t] and self.end[t] <= low + n + room:
                        hit[t] = True
        self.found += hit

    def recalls(self) -> np.ndarray:
        """Estimate for each item: the mean over its copies of the chance that some walk finds it."""
        miss = (1 - self.found / (self.walks + 1)) ** self.walks
        return 1 - miss.reshape(-1, TRIALS).mean(axis=1)


def item_blocks(items: DataFrame, key: str, text: str, block_words: int = BLOCK_WORDS) -> Iterator[list]:
    """Items in blocks of bounded size, one partition at a time."""
    block, size = [], 0
    for row in items.select(F.col(key), utf8(text)).toLocalIterator():
        words = words_of(row[1])
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    if block:
        yield block


HITS = "array<struct<item_id: long, start: long, stop: long, edits: int>>"


def _pass(docs: DataFrame, index: Index, text: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def make():
        def run(values: Iterable):
            return {"__hits": [[dict(item_id=i, start=a, stop=b, edits=e) for i, a, b, e in found]
                               for found in sent.value.matches(values)]}
        return run

    return map_rows(docs.withColumn("__raw", utf8(text)), "__raw", make, f"__hits {HITS}")


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id",
               text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, edits): each document and item within the distance."""
    slim = docs.select(F.col(key), F.col(text))
    found = None
    for block in item_blocks(items, item_key, text, block_words):
        hits = _pass(slim, Index(block), text).select(F.col(key), F.inline("__hits"))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = slim.where(F.lit(False)).select(F.col(key), F.inline(F.array().cast(HITS)))
    return found.select(F.col(key), F.col("item_id").alias("item_id"), F.col("start").alias("start_word"),
                        F.col("stop").alias("end_word"), "edits")


def drop_contaminated(docs: DataFrame, items: DataFrame, item_key: str = "item_id", text: str = "text",
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without a hit, with their columns; each block of items filters what is left."""
    kept, columns = docs, docs.columns
    for block in item_blocks(items, item_key, text, block_words):
        kept = _pass(kept, Index(block), text).where(F.size("__hits") == 0).select(*columns)
    return kept
