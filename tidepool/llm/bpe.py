"""Byte-level BPE by prefix dynamic programming, exact against rank-order merging.

For every prefix of a byte string the last token of its encoding is unique: it is the one token that
ends there and may follow the last token of the prefix before it. Two tokens may follow each other if
merging their joined bytes by rank gives back just those two. So one array, "last token of each
prefix", holds the encoding of every prefix: appending bytes only extends the array, and after an edit
only the part from the edit on is filled again. Ranks are read from a vocabulary file whose path is a
parameter; a piece that is itself a token is that token, as rank-order encoders do.

Null texts encode to no tokens. Work per piece is linear in its length (times the few tokens that end
at a byte), so one very long run of letters does not make it quadratic.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.rows import map_rows

CACHED_WORDS = 300_000
CACHED_PIECES = 200_000
CACHED_PAIRS = 1_000_000
NEVER = 1 << 60
#: Texts are encoded together up to about this many characters.
BLOCK = 1 << 20
#: A pair of tokens as one number; NONE stands on the left of a piece's first token.
PAIR, NONE = 1 << 31, -1
#: Longer pieces are not cached, and caches keep this many tokens per entry at most, so that they are bounded in bytes too.
CACHED_LENGTH, CACHED_TOKENS = 64, 16
#: Tokens of a text that are spelled out for a digest at a time.
SPELLED = 1 << 22
MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (base64 and rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def split_pattern(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode's property, which excludes the four separators 1C to 1F."""
    inside = pattern.replace(r"[^\s", r"[^\p{White_Space}")
    return regex.compile(inside.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


def merge_by_rank(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Plain rank-order merging: the definition of an encoding, used on joined pairs of tokens."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Prefixes:
    """The last token of every prefix of a growing byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the string; what is known of earlier prefixes stays as it is."""
        start, self.data = len(self.data), self.data + more
        self.vocabulary.extend(self.data, self.last, start)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Edit a range; prefixes that end before it are kept."""
        tail = self.data[stop:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(new + tail)

    def tokens(self, length: int | None = None) -> list[int]:
        """The encoding of the first ``length`` bytes (all of them by default)."""
        at, out = len(self.data) if length is None else length, []
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


def _gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges of an array that begin at ``first``, one after another."""
    before = np.cumsum(size) - size
    return flat[np.repeat(first - before, size) + np.arange(int(size.sum()))]


class Table:
    """Whole numbers by keys that are whole numbers too, looked up many at a time; -1 where there is none."""

    def __init__(self, room: int):
        bits = max(4, (2 * room).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        self.count = 0

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIX) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        place = self._places(keys)
        found = self.keys[place]
        out = np.where(found == keys, self.values[place], -1)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at = place[todo] = (place[todo] + 1) & self.mask
            found = self.keys[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            todo = todo[~hit & (found != -1)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are not there yet, each once."""
        place, todo = self._places(keys), np.arange(len(keys))
        while len(todo):
            at = place[todo]
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[todo[free]]  # of several, one stays
            mine = self.keys[at] == keys[todo]
            self.values[at[mine]] = values[todo[mine]]
            todo = todo[~mine]
            place[todo] = (place[todo] + 1) & self.mask
        self.count += len(keys)


class Kept(dict):
    """Numbers of strings met before, and their tokens by number (size -1: none of its own).

    A string met for the first time gets the next number; ``fill`` then adds the tokens of all such.
    """

    def __init__(self):
        self.new: list[str] = []
        self.flat, self.first, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self.first) + len(self.new)
        self.new.append(key)
        return number

    def full(self, most: int) -> bool:
        return len(self.first) > most or len(self.flat) > CACHED_TOKENS * most

    def numbers(self, keys: Iterable[str], count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, count)

    def fill(self, older: Kept, encode) -> None:
        """Tokens of the new strings: those of the older generation, or encoded ones."""
        new = self.new
        if not new:
            return
        known = np.fromiter(map(older.get, new, repeat(-1)), np.int64, len(new))
        fresh = np.flatnonzero(known < 0)
        met = np.flatnonzero(known >= 0)
        flat, sizes = encode([new[i] for i in fresh.tolist()])
        first, size = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        size[fresh], size[met] = sizes, older.size[known[met]]
        held = np.maximum(sizes, 0)
        first[fresh], first[met] = len(older.flat) + np.cumsum(held) - held, older.first[known[met]]
        held = np.maximum(size, 0)
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(held) - held])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, _gather(np.concatenate([older.flat, flat.astype(np.int32)]), first, held)])
        for key in new:
            if len(key) > CACHED_LENGTH:
                del self[key]
        self.new = []

    def tokens(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[numbers]
        return _gather(self.flat, self.first[numbers], size), size


class Vocabulary:
    """Ranks with what encoding and decoding need; building it reads the ranks once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, split_pattern(pattern)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.ends.add_word(token.decode("latin-1"), rank)
        self.ends.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.alone: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.pieces, self.older_pieces, self.words, self.older_words = Kept(), Kept(), Kept(), Kept()
        self.lengths = np.zeros(max(self.bytes_of, default=0) + 1, np.int64)
        for rank, token in self.bytes_of.items():
            self.lengths[rank] = len(token)
        self.known = Table(CACHED_PAIRS)  # checked pairs
        self._grow_trie()

    def _grow_trie(self) -> None:
        """Tokens as paths of bytes from a root, the first two bytes of a path by plain place."""
        steps: dict[int, int] = {}
        token_of = [NONE]
        for token, rank in self.ranks.items():
            node = 0
            for octet in token:
                step = node << 8 | octet
                node = steps.get(step)
                if node is None:
                    node = steps[step] = len(token_of)
                    token_of.append(NONE)
            token_of[node] = rank
        self.token_of = np.array(token_of, np.int64)
        self.one, self.two, self.steps = np.full(256, NONE), np.full(1 << 16, NONE), Table(max(1, len(steps)))
        keys, nodes = np.array(list(steps), np.int64), np.array(list(steps.values()), np.int64)
        root = keys < 256
        self.one[keys[root]] = nodes[root]
        for octet, node in zip(keys[root].tolist(), nodes[root].tolist(), strict=True):
            below = keys >> 8 == node
            self.two[octet << 8 | keys[below] & 255] = nodes[below]
        self.steps.put(keys[~root], nodes[~root])

    def _found(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte, last byte, token) of all tokens that lie in the data without passing the stop of their first byte."""
        at, out, depth = np.arange(len(data)), [], 0
        node = self.one[data]
        while len(at):
            alive = node >= 0
            at, node = at[alive], node[alive]
            token = self.token_of[node]
            hit = token >= 0
            out.append((at[hit], at[hit] + depth, token[hit]))
            depth += 1
            more = at + depth < stop[at]
            at, node = at[more], node[more]
            octet = data[at + depth].astype(np.int64)
            node = self.two[data[at].astype(np.int64) << 8 | octet] if depth == 1 else self.steps.get(node << 8 | octet)
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def reachable(self, token: int) -> bool:
        """Whether merging a token's own bytes gives the token."""
        if token not in self.alone:
            self.alone[token] = merge_by_rank(self.bytes_of[token], self.ranks) == [token]
        return self.alone[token]

    def spine(self, token: int, right: bool) -> tuple[tuple[int, bytes], ...] | None:
        """The token's parts along its right (or left) edge, from one byte to the whole, with ranks.

        None if ranks do not rise along the way: then merges are not made in the order of these parts.
        """
        known = self.spines[right].get(token, False)
        if known is not False:
            return known
        data = self.bytes_of[token]
        if len(data) == 1:
            found = ((token, data),)
        else:
            parts = merge_by_rank(data, {k: v for k, v in self._inside(data).items() if k != data})
            part = parts[-1 if right else 0]
            before = self.spine(part, right)
            rising = len(parts) == 2 and all(p < token or len(self.bytes_of[p]) == 1 for p in parts)
            found = (*before, (token, data)) if before and rising else None
        self.spines[right][token] = found
        return found

    def _inside(self, data: bytes) -> dict[bytes, int]:
        spans = (data[i:j] for i in range(len(data)) for j in range(i + 1, len(data) + 1))
        return {s: self.ranks[s] for s in spans if s in self.ranks}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when their joined bytes are merged by rank.

        The parts that touch the border change as either token is built up. They stay apart if no
        part on the left ever joins one on the right before one of the two has grown further.
        """
        known = self.pairs.get((left, right))
        if known is None:
            a, b = self.spine(left, True), self.spine(right, False)
            if a is None or b is None or not (self.reachable(left) and self.reachable(right)):
                joined = self.bytes_of[left] + self.bytes_of[right]
                known = merge_by_rank(joined, self.ranks) == [left, right]
            else:
                known = self._apart(a, b)
            if len(self.pairs) >= CACHED_PIECES:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _apart(self, a: tuple, b: tuple) -> bool:
        i = j = 0
        while True:
            across = self.ranks.get(a[i][1] + b[j][1], NEVER)
            grow_a = a[i + 1][0] if i + 1 < len(a) else NEVER
            grow_b = b[j + 1][0] if j + 1 < len(b) else NEVER
            # of equal ranks the leftmost merge comes first: inside a, then across, then inside b
            if across < grow_a and across <= grow_b and across != NEVER:
                return False
            if grow_a == grow_b == NEVER:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[int], start: int) -> None:
        """Fill ``last`` from byte ``start`` on, given its entries before that."""
        back = max(0, start - self.longest + 1)  # tokens that end later begin after this
        pairs, found, bytes_of = self.pairs, len(last), self.bytes_of
        for end, token in self.ends.iter(data[back:].decode("latin-1")):
            end += back
            if end < found:
                continue  # its last token is known
            at = end - len(bytes_of[token])
            if at < 0:
                fits = self.reachable(token)
            else:
                fits = pairs.get((last[at], token))
                if fits is None:
                    fits = self.may_follow(last[at], token)
            if fits:
                last.append(token)
                found += 1

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        return (whole,) if whole is not None else tuple(Prefixes(self, piece).tokens())

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of many pieces, one after another, and how many each has.

        One pass of the recurrence over all of them, prefix length by prefix length: all tokens that end
        somewhere are found at once; at each prefix length, the candidates of all pieces are checked together
        against the last tokens of the shorter prefixes.
        """
        whole = np.fromiter(map(self.ranks.get, pieces, repeat(NONE)), np.int64, len(pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        long = np.flatnonzero((whole < 0) & (lengths > CACHED_LENGTH))
        todo = np.flatnonzero((whole < 0) & (lengths <= CACHED_LENGTH))
        spelled = [np.array(Prefixes(self, pieces[i]).tokens(), np.int64) for i in long.tolist()]
        ids, counts = self._recurrence([pieces[i] for i in todo.tolist()], lengths[todo])
        flat = np.concatenate([whole, ids, *spelled])
        size, first = np.ones(len(pieces), np.int64), np.arange(len(pieces))
        size[todo], size[long] = counts, [len(x) for x in spelled]
        first[todo] = len(pieces) + np.cumsum(counts) - counts
        first[long] = len(pieces) + len(ids) + np.cumsum(size[long]) - size[long]
        return _gather(flat, first, size), size

    def _recurrence(self, pieces: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        stop = np.cumsum(size)  # of each piece in the data
        begin = stop - size
        start, end, token = self._found(data, np.repeat(stop, size))
        first = np.repeat(begin, size)[start]  # where the token's piece begins
        reach = (end - first).astype(np.int16)
        order = np.argsort(reach, kind="stable")
        start, end, token, first = start[order], end[order], token[order], first[order]
        bounds = np.searchsorted(reach[order], np.arange(int(size.max()) + 1))
        last = np.full(len(data), -1, np.int64)
        for low, high in zip(bounds, bounds[1:], strict=False):
            e, t, s = end[low:high], token[low:high], start[low:high]
            left = np.where(s == first[low:high], NONE, last[s - 1])
            fits = self._fits(left, t)
            last[e[fits]] = t[fits]
        return self._walk_back(last, begin, stop)

    def _walk_back(self, last: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces, one after another, and how many each has."""
        rows, at, steps = np.arange(len(stop)), stop - 1, []
        while len(rows):
            found = last[at]
            steps.append((rows, found))
            at = at - self.lengths[found]
            more = at >= begin[rows]
            rows, at = rows[more], at[more]
        counts = np.zeros(len(stop), np.int64)
        for rows, _ in steps:
            counts[rows] += 1
        ends, flat = np.cumsum(counts), np.zeros(int(counts.sum()), np.int64)
        for step, (rows, found) in enumerate(steps):
            flat[ends[rows] - 1 - step] = found
        return flat, counts

    def _fits(self, left: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token may follow the one on its left; with none there, whether it is reachable."""
        keys = (left + 1) * PAIR + token
        answer = self.known.get(keys)
        unknown = np.flatnonzero(answer < 0)
        if len(unknown):
            fresh, place = np.unique(keys[unknown], return_inverse=True)
            found = np.fromiter((self.reachable(b) if a == NONE else self.may_follow(a, b) for a, b in zip(
                (fresh // PAIR - 1).tolist(), (fresh % PAIR).tolist(), strict=True)), np.int32, len(fresh))
            if self.known.count + len(fresh) > CACHED_PAIRS:
                self.known = Table(max(CACHED_PAIRS, len(fresh)))
            self.known.put(fresh, found)
            answer[unknown] = found[place]
        return answer == 1

    def encode(self, text: str) -> list[int]:
        return self.encode_texts([text])[0]

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        """Tokens of each text."""
        flat, counts = self.encode_together(texts)
        ids, ends = flat.tolist(), np.cumsum(counts).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts, one after another, and how many each has.

        A space between two characters that are not white space always begins a piece, so what
        follows it up to the next such space is encoded by itself and remembered. New words and pieces
        of all texts are encoded together. Words and pieces are kept for two generations: when the newer
        one is full it becomes the older one, whose entries come back as they are met again.
        """
        if self.words.full(CACHED_WORDS):
            self.words, self.older_words = Kept(), self.words
        words, cut = self.words, [t.split(" ") for t in texts]
        behind = np.fromiter(map(len, cut), np.int64, len(cut)) - 1
        numbers = words.numbers(chain.from_iterable(parts[1:] for parts in cut), int(behind.sum()))
        words.fill(self.older_words, self._new_words)
        text = np.repeat(np.arange(len(cut)), behind)
        whole = np.array([len(parts) > 1 and (not parts[0] or parts[0][-1].isspace()) for parts in cut], bool)
        whole[text[words.size[numbers] < 0]] = True
        heads, head_counts = self._by_piece([texts[k] if odd else cut[k][0] for k, odd in enumerate(whole.tolist())])
        numbers, behind = numbers[~whole[text]], np.where(whole, 0, behind)
        at = np.cumsum(behind + 1) - behind - 1  # of the heads among heads and words
        head = np.zeros(len(cut) + len(numbers), bool)
        head[at] = True
        first, size = np.zeros(len(head), np.int64), np.zeros(len(head), np.int64)
        first[head], size[head] = len(words.flat) + np.cumsum(head_counts) - head_counts, head_counts
        first[~head], size[~head] = words.first[numbers], words.size[numbers]
        ends = np.cumsum(size)
        return (_gather(np.concatenate([words.flat, heads.astype(np.int32)]), first, size),
                np.diff(np.concatenate([[0], ends[at + behind]])))

    def _new_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words that a space precedes; joined by spaces they are cut just as each alone. Size -1: not such a word."""
        size = np.full(len(words), -1, np.int64)
        plain = [i for i, w in enumerate(words) if w and len(w) <= CACHED_LENGTH and not w[0].isspace() and not w[-1].isspace()]
        if not plain:
            return np.zeros(0, np.int64), size
        found = self.pattern.findall(" " + " ".join([words[i] for i in plain]))
        tokens, counts = self._pieces(found)
        ends = np.cumsum(np.fromiter((len(words[i]) + 1 for i in plain), np.int64, len(plain)))
        word = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))
        size[plain] = np.bincount(word, counts, len(plain))
        return tokens, size

    def _pieces(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of pieces, one after another, and how many each has."""
        if self.pieces.full(CACHED_PIECES):
            self.pieces, self.older_pieces = Kept(), self.pieces
        numbers = self.pieces.numbers(found, len(found))
        self.pieces.fill(self.older_pieces, lambda new: self.encode_pieces([p.encode() for p in new]))
        return self.pieces.tokens(numbers)

    def _by_piece(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.pattern.findall(t) for t in texts]
        tokens, counts = self._pieces(list(chain.from_iterable(found)))
        text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, found), np.int64, len(found)))
        return tokens, np.bincount(text, counts, len(texts)).astype(np.int64)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class EditableText:
    """A text and its encoding, encoded again only around an edit.

    Pieces that end two pieces before the edit cannot change; behind it, encoding stops as soon as a
    new piece border meets an old one, since pieces depend only on what follows them.
    """

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, ""
        self.stops: list[int] = []  # end of each piece
        self.ids: list[tuple[int, ...]] = []
        self.encoded = 0  # pieces encoded so far, for tests and metrics
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        first = max(0, bisect_right(self.stops, start) - 2)
        begin = self.stops[first - 1] if first else 0
        shift = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        old = {end + shift: i for i, end in enumerate(self.stops) if end > stop}
        stops, ids, rest = [], [], len(self.stops)
        for m in self.vocabulary.pattern.finditer(self.text, begin):
            stops.append(m.end())
            ids.append(self.vocabulary.encode_piece(m[0].encode()))
            self.encoded += 1
            if m.end() in old:
                rest = old[m.end()] + 1
                break
        self.stops[first:] = stops + [e + shift for e in self.stops[rest:]]
        self.ids[first:] = ids + self.ids[rest:]

    def tokens(self) -> list[int]:
        return [t for ids in self.ids for t in ids]


def blocks(texts: list[str | None]) -> Iterator[list[str]]:
    """Neighbouring texts, about ``BLOCK`` characters at a time; null is the empty text."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


_built: dict[tuple[int, str], Vocabulary] = {}


def shared_vocabulary(spark: SparkSession, path: str, pattern: str):
    """A function that gives the vocabulary inside a task, built once per Python worker.

    The ranks travel as a broadcast: a vocabulary file has a fixed size (about a megabyte), whatever
    the corpus.
    """
    sent = spark.sparkContext.broadcast(read_ranks(path))

    def get() -> Vocabulary:
        key = (hash(frozenset(sent.value.items())), pattern)
        if key not in _built:
            _built.clear()
            _built[key] = Vocabulary(sent.value, pattern)
        return _built[key]

    return get


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(key, ids) with the tokens of each whole text as an array; null texts have none."""
    vocabulary = shared_vocabulary(docs.sparkSession, path, pattern)

    def make():
        encode = vocabulary().encode_texts
        return lambda values: {"ids": [ids for block in blocks(values) for ids in encode(block)]}

    return map_rows(docs.select(F.col(key), F.col(text).alias("__text")), "__text", make, "ids array<int>")


def decode_ids(tokens: DataFrame, path: str, key: str = "doc_id", ids: str = "ids",
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(key, decoded) with the bytes that each array of tokens stands for."""
    vocabulary = shared_vocabulary(tokens.sparkSession, path, pattern)

    def make():
        decode = vocabulary().decode
        return lambda values: {"decoded": [decode(v or []) for v in values]}

    return map_rows(tokens.select(F.col(key), F.col(ids).alias("__ids")), "__ids", make, "decoded binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode each text, decode the ids, digest both."""
    vocabulary = shared_vocabulary(docs.sparkSession, path, pattern)

    def make():
        vocab = vocabulary()
        some = range(len(vocab.lengths))
        numerals = pa.array([f"{r}," if r in vocab.bytes_of else "" for r in some], pa.string())
        spelled = pa.array([vocab.bytes_of.get(r, b"") for r in some], pa.binary())

        def run(values):
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for block in blocks(values):
                flat, counts = vocab.encode_together(block)
                ends = np.cumsum(counts).tolist()
                out["n_tokens"] += counts.tolist()
                for a, b in zip([0, *ends], ends, strict=False):
                    out["ids_sha256"].append(_digest(numerals, flat[a:b], 1))
                    out["decoded_sha256"].append(_digest(spelled, flat[a:b]))
            return out
        return run

    return map_rows(docs.select(F.col(key), F.col(text).alias("__text")), "__text", make,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _digest(strings: pa.Array, ids: np.ndarray, less: int = 0) -> str:
    """SHA-256 of what the ids stand for, joined, without the last ``less`` bytes."""
    digest = hashlib.sha256()
    for at in range(0, len(ids), SPELLED):
        some = ids[at:at + SPELLED]
        _, ends, data = strings.take(pa.array(some)).buffers()
        size = int(np.frombuffer(ends, np.int32, len(some) + 1)[-1])
        digest.update(memoryview(data)[: size if at + SPELLED < len(ids) else size - less])
    return digest.hexdigest()
