"""Personal data: base spans against plain expressions, and what the trained proposals add."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import personal_data as pd_

FOLDER = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = "".join(re.findall("[0-9]", m[0]))
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 14 <= len(digits) <= 19 and plain_luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pd_.KINDS.index(s[0])))


def with_luhn(digits):
    return next(digits + str(d) for d in range(10) if plain_luhn(digits + str(d)))


def test_base_spans_equal_plain_search():
    rng = random.Random(2)
    parts = ["a", "B.", "é", "@", "@", ".", "..", "-", " ", "  ", "+", "+1", "(", ")", "12", "345", "6789", "1234567", "0", "255", "256", "001",
             "com", "_", "%", "４", "\n", "4111111111111111", "10.0.0.1", " at ", "[dot]"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        base, spans = pd_.find_spans(text.encode(), None)
        assert base == spans == plain_base(text)


def test_proposals_cover_base_spans_and_stay_linear():
    rng = random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choice(["a@b.c", "1.2.3.4", "+1 (234) 567-8901", "4111 1111 1111 1111", " ", "x", ".", "9", "+", "-"]) for _ in range(8))
        found = pd_.proposals(text.encode())
        assert len(set(found)) == len(found)
        for kind, a, b in pd_.base_spans(text.encode())[0]:
            if kind != "phone":
                assert (kind, a, b) in found
    for text in ("1 " * 40_000, "1." * 40_000, "a@" * 40_000, "9" * 100_000, "+" * 50_000, "a at b dot " * 5_000, "z" * 300_000 + " dot"):
        assert len(pd_.proposals(text.encode())) <= 20 * len(text)


@pytest.fixture(scope="module")
def detector(spark):
    return pd_.learn(spark.read.parquet(f"{FOLDER}/../sf0.1/documents.parquet"))


def plant(texts, spans, seed):
    """Texts of words only, each with one span put between two words, and where it is."""
    rng, out = random.Random(seed), []
    for text, span in zip(texts, spans, strict=True):
        words = [w for w in text.split(" ") if w.isalpha()][:80]
        at = rng.randint(1, len(words) - 1)
        before = " ".join(words[:at]) + " "
        out.append((before + span + " " + " ".join(words[at:]), len(before), len(before) + len(span)))
    return out


def test_added_spans_are_found_and_clean_texts_left_alone(spark, detector):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("length(text) > 600").orderBy("doc_id").select("text").limit(400).collect()
    texts = [r.text for r in docs if len([w for w in r.text.split(" ") if w.isalpha()]) > 20]
    rng = random.Random(8)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    beside = [f"+1 ({rng.randint(200, 999)}) 555-{number(4)} {number(7)}" for _ in texts]
    hits = 0
    for (text, a, b), span in zip(plant(texts, beside, 1), beside, strict=True):
        base, spans = pd_.find_spans(text.encode(), detector)
        assert [s for s in base if s[0] == "phone"] == []
        hits += ("phone", a, a + 17) in spans
    assert hits >= 0.8 * len(texts)
    cards = [f"{number(7)} {with_luhn(number(15))}" for _ in texts]
    hits = sum(("card", a + 8, b) in pd_.find_spans(text.encode(), detector)[1] for text, a, b in plant(texts, cards, 2))
    assert hits >= 0.8 * len(texts)
    wrong = 0
    fakes = [rng.choice([number(8), "2021-03-04", number(10), f"v{rng.randint(1, 9)}.2.3.4.5", f"{number(3)}.{number(2)}", f"{number(4)}-{number(4)}"]) for _ in texts]
    for text, _, _ in plant(texts, fakes, 3):
        base, spans = pd_.find_spans(text.encode(), detector)
        wrong += len(spans) > len(base)
    assert wrong <= 0.02 * len(texts)


def test_written_out_addresses(detector):
    for text in ("write to jo.doe [at] mail7.example [dot] com now", "jo.doe at mail7 dot example dot com", "jo.doe(at)mail7.example.com"):
        kind, a, b = pd_.find_spans(text.encode(), detector)[1][0]
        assert kind == "email" and text[a:b].startswith("jo.doe") and text[a:b].endswith("com")
    for text in ("we met at noon. Of the dots one", "look at that. dot", "he was at home.Then dot", "a at b"):
        assert pd_.find_spans(text.encode(), detector)[1] == []


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, (4000, 6)).astype(float)
    y = ((x[:, 0] > 2) & (x[:, 3] < 2) | (x[:, 5] == 4)).astype(float)
    trees = pd_.boost(x[:3000], y[:3000], np.ones(3000))
    margin = trees.margin(x[3000:])
    assert ((margin > 0) == (y[3000:] == 1)).mean() > 0.98
    places, p = pd_.isotonic(margin, y[3000:], np.ones(1000))
    assert (np.diff(places) >= 0).all() and (np.diff(p) >= -1e-12).all() and 0 <= p.min() and p.max() <= 1
    noisy = rng.random(1000)
    labels = (rng.random(1000) < noisy).astype(float)
    places, p = pd_.isotonic(noisy, labels, np.ones(1000))
    assert abs(np.interp(0.8, places, p) - 0.8) < 0.1 and abs(np.interp(0.2, places, p) - 0.2) < 0.1


def test_rows(spark, detector):
    long = "x " * 60_000 + "mail to é a.b@c-d.org now"
    card = with_luhn("411111111111111")
    docs = spark.createDataFrame([(1, long, "q"), (1, long, "r"), (2, None, None), (None, "", "s"), (3, f"é 10.0.0.255, {card}, +49 (30) 123456-7", "t")],
                                 "doc_id long, text string, spans string")
    got = pd_.find_private(docs).collect()
    assert [r.n_email for r in got] == [1, 1, 0, 0, 0] and [r.n_ip for r in got] == [0, 0, 0, 0, 1]
    for r, text in zip(got, [long, long, "", "", docs.collect()[4].text], strict=True):
        base = plain_base(text)
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) - {""} <= set(r.spans.split(","))
    clean = pd_.redact_private(docs)
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert rows[0].text == "x " * 60_000 + "mail to é [EMAIL] now" and rows[2].text is None and rows[3].text == ""
    assert "[IP]" in rows[4].text and "[PHONE]" in rows[4].text and card not in rows[4].text
    assert pd_.find_private(docs.limit(0)).collect() == []
    odd = docs.select("doc_id", F.col("text").alias("raw"), F.col("text").alias("clean"), "text", F.lit(1).alias("row"))
    assert pd_.redact_private(odd).columns == odd.columns


def test_base_of_supplied_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in pd_.find_private(docs).collect()}
    for row in docs.collect():
        base = plain_base(row.text or "")
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        found = got[row.doc_id]
        assert found.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [found.n_email, found.n_ip, found.n_card, found.n_phone] == [sum(s[0] == k for s in base) for k in pd_.KINDS]


def test_training_takes_every_window(spark):
    """No text is left out of training, and no window of one, however many there are."""
    text = "; ".join(f"call +1 (234) 555-{1000 + i} at {i % 9}{i:04d}" for i in range(40))
    assert [k for k, *_ in pd_.windows_of(text.encode())].count("phone") == 40
    docs = spark.createDataFrame([(f"mail a{i}@b{i % 7}.org, tel +1 (234) 555-{1000 + i}",) for i in range(4000)], "text string").repartition(4)
    seen = spark.createDataFrame(
        [(pd_._number(*w) % 3 == 2, len(list(pd_.examples(*w)))) for r in docs.collect() for w in pd_.windows_of(r.text.encode())], "held boolean, n int")
    want = {r.held: r.n for r in seen.groupBy("held").agg(F.sum("n").alias("n")).collect()}
    got, plain = {}, pd_.stage_table

    def kept(frame, label, *by):
        table = plain(frame, label, *by)
        if label == "span-cases":
            got.update({r.held: r.n for r in table.groupBy("held").agg(F.sum(F.expr("hits + alone + beside")).alias("n")).collect()})
        return table

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pd_, "stage_table", kept)
        patch.setattr(pd_, "ROUNDS", 3)
        assert pd_.learn(docs) is not None
    assert got == want


def test_spread_training_gives_the_same_detector(spark, monkeypatch):
    monkeypatch.setattr(pd_, "ROUNDS", 6)
    monkeypatch.setattr(pd_, "WRITTEN_ROUNDS", 2)
    docs = spark.read.parquet(f"{FOLDER}/../sf0.1/documents.parquet").where("doc_id % 5 = 0")
    here, spread = pd_.learn(docs), pd_.learn(docs.repartition(3), local_cases=0)
    assert here.least == spread.least and here.trees.start == spread.trees.start
    for a, b in zip([*here.trees.leaves, here.margins, here.probabilities], [*spread.trees.leaves, spread.margins, spread.probabilities], strict=True):
        assert a.tolist() == b.tolist()
    assert all(f.tolist() == g.tolist() and c.tolist() == d.tolist() for (f, c), (g, d) in zip(here.trees.nodes, spread.trees.nodes, strict=True))
