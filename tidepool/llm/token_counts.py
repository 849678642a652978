"""Token counts by linear longest match: a vocabulary trie with failure links that carry token counts.

Greedy longest match takes, again and again, the longest vocabulary entry that the rest of a piece
starts with. A trie node stands for what has been read since the last certain token. Where a byte has no
edge, the node's failure link leads to the node for what remains after the certain tokens are taken off,
and says how many those are; so each byte is read once and no piece is ever built. Every single byte is
made an entry, so every text can be counted. Pieces are cut by the vocabulary's split pattern.

Null and empty texts count 0.
"""

from __future__ import annotations

from collections import deque

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.bpe import read_ranks, split_pattern
from tidepool.llm.rows import map_rows

CACHED_WORDS, CACHED_LENGTH = 400_000, 64


class Matcher:
    """Trie edges keyed by node * 256 + byte; node 0 is the root."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.pattern = split_pattern(pattern)
        self.edges: dict[int, int] = {}
        self.words: dict[str, int] = {}
        ends = {0: False}
        for token in sorted({*tokens, *(bytes([b]) for b in range(256))}):
            node = 0
            for byte in token:
                node = self.edges.setdefault(node << 8 | byte, len(ends))
                ends.setdefault(node, False)
            ends[node] = True
        self.fail, self.popped = self._links(ends)

    def _links(self, ends: dict[int, bool]) -> tuple[list[int], list[int]]:
        """Failure target and number of tokens taken off, breadth first."""
        fail, popped = [0] * len(ends), [0] * len(ends)
        children: dict[int, list[tuple[int, int]]] = {}
        for key, child in self.edges.items():
            children.setdefault(key >> 8, []).append((key & 255, child))
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for byte, child in children.get(node, ()):
                if ends[child]:
                    fail[child], popped[child] = 0, 1  # all that was read is one token
                else:
                    fail[child], popped[child] = self._step(node, byte, fail, popped)
                queue.append(child)
        return fail, popped

    def _step(self, node: int, byte: int, fail: list[int], popped: list[int]) -> tuple[int, int]:
        """Follow failure links from ``node`` until one has an edge for ``byte``."""
        taken = 0
        while node:
            taken += popped[node]
            node = fail[node]
            nearer = self.edges.get(node << 8 | byte)
            if nearer is not None:
                return nearer, taken
        raise AssertionError("the root has an edge for every byte")

    def count_bytes(self, piece: bytes) -> int:
        node, taken = 0, 0
        edges, fail, popped = self.edges, self.fail, self.popped
        for byte in piece:
            there = edges.get(node << 8 | byte)
            while there is None:
                taken += popped[node]
                node = fail[node]
                there = edges.get(node << 8 | byte)
            node = there
        while node:
            taken += popped[node]
            node = fail[node]
        return taken

    def _pieces(self, text: str) -> int:
        return sum(self.count_bytes(p.encode()) for p in self.pattern.findall(text))

    def count(self, text: str) -> int:
        """Greedy tokens of a text; words met before are not read again (see ``bpe.Vocabulary.encode``)."""
        first, *rest = text.split(" ")
        if not first or first[-1].isspace() or any(not w or w[0].isspace() or w[-1].isspace() for w in rest):
            return self._pieces(text)
        total, words = self._pieces(first), self.words
        for word in rest:
            n = words.get(word)
            if n is None:
                n = self._pieces(" " + word)
                if len(word) <= CACHED_LENGTH:
                    if len(words) >= CACHED_WORDS:
                        words.clear()
                    words[word] = n
            total += n
        return total


_built: dict[tuple[int, str], Matcher] = {}


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(key, n_tokens) for each row; the vocabulary, of fixed size, is broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(sorted(read_ranks(path)))

    def make():
        at = hash(tuple(sent.value)), pattern
        if at not in _built:
            _built.clear()
            _built[at] = Matcher(sent.value, pattern)
        matcher = _built[at]
        return lambda values: {"n_tokens": [matcher.count(v) if v else 0 for v in values]}

    return map_rows(docs.select(F.col(key), F.col(text).alias("__text")), "__text", make, "n_tokens long")
