"""Jaccard join, substring dedup and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidepool.llm import decontaminate, jaccard_join, substring_dedup

FOLDER = "/root/testdata/sf0.001"


def words(rng, n, size=3000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus(seed=11):
    """Copies, near copies, shared passages, common lines, short, empty and null texts."""
    rng = random.Random(seed)
    passage = words(rng, 30)
    texts = [None, "", "  \n", "one", "one", "one two three four", "one two three four", "one two three four five"]
    for _ in range(25):
        texts.append(" ".join(words(rng, rng.randint(20, 120))))
    base = words(rng, 100)
    for k in range(40):
        edited = list(base)
        for _ in range(k % 4):
            edited[rng.randrange(100)] = f"e{rng.randrange(9999)}"
        texts.append(" ".join(edited))
    texts += [texts[10]] * 12
    for _ in range(15):
        texts.append(" ".join(words(rng, 20) + passage + words(rng, 20)))
    texts.append(" ".join(words(rng, 15_000)))
    texts.append(" ".join(texts[-1].split()[:14_000]))
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(3 * i + 1, texts[k]) for i, k in enumerate(order)]


def plain_links(rows):
    sets = []
    for _, text in rows:
        w = (text or "").split()
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    links, head = Counter(), list(range(len(rows)))

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                head[top(i)] = top(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (key, _) in enumerate(rows):
        least[top(i)] = min(least[top(i)], key)
    return Counter((key, least[top(i)], links[i]) for i, (key, _) in enumerate(rows))


@pytest.mark.parametrize("limits", [{}, {"LEAF": 8, "BLOCK_RECORDS": 12}, {"BLOCK_SHINGLES": 2_000, "SMALL_GROUP": 3}])
def test_links_equal_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    rows = corpus()
    got = jaccard_join.link_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "class_id", "n_links"]
    assert Counter(tuple(r) for r in got.collect()) == plain_links(rows)


def test_links_on_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in jaccard_join.link_classes(docs).collect()) == plain_links(rows)


def test_links_edges(spark):
    text = " ".join(words(random.Random(1), 60))
    rows = [(5, text, "x"), (5, text, "x"), (None, text, "y"), (2, "other words of this text here", "z"), (2, text + " more", "z"), (None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rec string")
    got = Counter(tuple(r) for r in jaccard_join.link_classes(docs).collect())
    assert got == Counter({(5, 2, 3): 2, (None, 2, 3): 1, (2, 2, 0): 1, (2, 2, 3): 1, (None, None, 0): 1})
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.rec) for r in kept.collect()) == Counter({(2, "z"): 2, (None, "y"): 1, (None, "n"): 1})
    assert jaccard_join.link_classes(docs.limit(0)).collect() == []


def test_rows_without_an_id_stay(spark):
    """Equal rows without an id are all kept and never met with one another; near copies of them are linked."""
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "last"])
    rows = [(None, text)] * 3 + [(None, None)] * 2 + [(None, near)] * 2 + [(7, near), (7, near), (9, text)] + [(7, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_join.link_classes(docs).collect())
    # text 4 and near 4 link; every row of both has 7 others
    assert got == Counter({(None, 7, 7): 5, (None, None, 0): 2, (7, 7, 7): 2, (9, 7, 7): 1, (7, 7, 0): 1})
    kept = Counter(tuple(r) for r in jaccard_join.keep_one(docs).collect())
    assert kept == Counter({(None, text): 3, (None, None): 2, (None, near): 2, (7, near): 1, (7, "other words"): 1})


def test_intersections_equal_sets():
    rng = random.Random(5)
    import numpy as np

    sets = [np.unique(np.array([rng.randrange(300) for _ in range(rng.randint(1, 120))], dtype=np.uint64)) for _ in range(40)]
    both = jaccard_join.intersections(sets)
    assert all(both[i, j] == len({*sets[i].tolist()} & {*sets[j].tolist()}) for i in range(40) for j in range(40) if i != j)


def plain_dedup(rows):
    first = {}
    for key, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - 12):
            gram = tuple(w[i:i + 13])
            if key is not None:
                first[gram] = min(first.get(gram, key), key)
    out = Counter()
    for key, text in rows:
        w = (text or "").encode().split()
        stay = [True] * len(w)
        for i in range(len(w) - 12):
            if key is not None and first[tuple(w[i:i + 13])] < key:
                stay[i:i + 13] = [False] * 13
        kept = [x for x, s in zip(w, stay) if s]
        out[key, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [2_000, 3, 0])
def test_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rows = corpus(12) + [(None, corpus(12)[20][1]), (4, "a b " * 60), (1000, "a b " * 50), (1001, "x " * 30), (1002, "x " * 40)]
    rows += [rows[30], (rows[30][0], "clash of ids " + (rows[31][1] or ""))]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, anchor string")
    got = substring_dedup.remove_repeats(docs)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_dedup(rows)


def test_dedup_on_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in substring_dedup.remove_repeats(docs).collect()) == plain_dedup(rows)
    assert substring_dedup.remove_repeats(docs.limit(0)).collect() == []


def test_dedup_cuts_documents_into_contents_once(spark, monkeypatch):
    """Finding the anchors that several documents share takes no pass of its own over the texts."""
    staged, write = {}, substring_dedup.stage_table

    def seen(df, label):
        staged[label] = df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
        return write(df, label)

    monkeypatch.setattr(substring_dedup, "stage_table", seen)
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, "x " + text), (3, "y")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(docs).collect()) == [(1, 0), (2, 40), (3, 0)]
    assert staged["survivors"] == 1 and "anchors" not in staged


def test_automaton_first_owners():
    rng = random.Random(8)
    for _ in range(200):
        texts = [[rng.randrange(3) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(1, 6))]
        owners = [rng.randrange(100) for _ in texts]
        automaton = substring_dedup.Automaton()
        for text, owner in zip(texts, owners):
            automaton.add(text, owner)
        automaton.finish()
        for query in [*texts, [rng.randrange(3) for _ in range(12)]]:
            want = []
            for i in range(len(query) - 3):
                piece = query[i:i + 4]
                having = [o for t, o in zip(texts, owners) if any(t[k:k + 4] == piece for k in range(len(t) - 3))]
                want.append(min(having, default=None))
            assert automaton.first_owners(query, 4) == want


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_distance_equals_plain():
    rng = random.Random(9)
    for _ in range(400):
        a = [rng.randrange(4) for _ in range(rng.randint(0, 9))]
        b = [rng.randrange(4) for _ in range(rng.randint(0, 12))]
        assert decontaminate.edit_distance(a, b, 99)[0] == edits(a, b)
        free = min(edits(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert decontaminate.edit_distance(a, b, 99, free_ends=True)[0] == free


def test_leaks_of_edited_items_are_found(spark):
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    rng = random.Random(10)
    rows, want = [], set()
    for k, item in enumerate(items.collect()):
        source = item.text.split()
        leak = list(source)
        for _ in range(rng.randint(0, int(decontaminate.EDITS * len(source)))):
            at = rng.randrange(len(leak))
            leak[at:at + 1] = rng.choice([[], ["changed"], [leak[at], "added"]])
        rows.append((k, " ".join(words(rng, 60) + leak + words(rng, 60))))
        want.add((k, item.item_id))
        rows.append((10_000 + k, " ".join(words(rng, 30) + source[: len(source) // 2] + words(rng, 90))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert len(found & want) >= 0.99 * len(want)
    assert not {d for d, _ in found} & {d for d, _ in rows if d >= 10_000}
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items, block_words=2_000).collect()}
    assert len(blocks & want) >= 0.99 * len(want)
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, items, block_words=2_000).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in blocks}


def test_leak_edges(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "alpha beta gamma delta epsilon zeta"), (3, "alpha beta gamma delta epsilon zeta"),
                                   (None, "uno dos tres quatro cinco seis siete")], "item_id long, text string")
    text = "x y Alpha beta gamma delta epsilon zeta q"
    docs = spark.createDataFrame([(1, text, 0), (1, text, 0), (2, None, 0), (None, "uno dos tres quatro cinco seis siete", 0),
                                  (4, "", 0), (5, "k " * 100_000 + text, 0)], "doc_id long, text string, item_id int")
    got = Counter((r.doc_id, r.item_id, r.start_word, r.end_word, r.edits) for r in decontaminate.find_leaks(docs, items).collect())
    assert got == Counter({(1, 3, 2, 8, 0): 4, (None, None, 0, 7, 0): 1, (5, 3, 100_002, 100_008, 0): 2})
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {2, 4}
    assert decontaminate.drop_contaminated(docs, items).columns == docs.columns
    assert decontaminate.find_leaks(docs, items.limit(0)).collect() == []
    assert decontaminate.find_leaks(docs.limit(0), items).collect() == []
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == 6


def test_items_that_differ_in_their_tail_are_found():
    """A shared template and a tail of own words: the rarest words stand where no walk starts."""
    template = [b"w%d" % i for i in range(42)]
    items = [(k, template + [b"own%dx%d" % (k, i) for i in range(8)]) for k in range(30)]
    index = decontaminate.Index(items)
    docs = [b" ".join([b"before"] * 5 + words + [b"after"] * 5) for _, words in items]
    for (k, _), found in zip(items, index.matches(docs), strict=True):
        assert (k, 5, 55, 0) in found


def test_each_item_is_found_with_the_target_recall(monkeypatch):
    """Walks alone miss items (one word, words that all repeat); those are found by their pieces."""
    rng = random.Random(3)
    items = [(0, [b"single"]), (1, [b"two", b"words"])]
    items += [(k, [b"r%d" % rng.randint(0, 3) for _ in range(30)]) for k in range(2, 6)]
    items += [(k, [b"c%d" % rng.randint(0, 400) for _ in range(rng.randint(3, 60))]) for k in range(6, 60)]
    monkeypatch.setattr(decontaminate, "MAX_WALKS", 1)
    index = decontaminate.Index(items)
    edited = np.random.default_rng(1)
    docs, want = [], []
    for _ in range(8):
        for k, words in items:
            around = [b"z%d" % rng.randint(0, 99) for _ in range(9)]
            docs.append(b" ".join(around + index._edited(words, edited) + around))
            want.append(k)
    found = [{m[0] for m in hits} for hits in index.matches(docs)]
    assert all(k in hits for k, hits in zip(want, found, strict=True))
    assert index.exact
