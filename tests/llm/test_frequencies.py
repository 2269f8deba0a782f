"""Near-duplicates weighed by the document frequency of every shingle."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

from silverlode.llm import neardup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def true_classes(docs) -> dict[int, int]:
    """Brute force over all pairs: TF-IDF weighted Jaccard, then the smallest id reachable."""
    rows = docs.collect()
    bags = {}
    for r in rows:
        if r.doc_id is not None and (w := WORD.findall((r.text or "").lower())):
            bags[r.doc_id] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    df = Counter(s for b in bags.values() for s in b)
    n = sum(bool(WORD.search(r.text or "")) for r in rows)
    weights = {d: {s: (1 + np.log(c)) * np.log(1 + n / df[s]) for s, c in b.items()} for d, b in bags.items()}
    root = {d: d for d in bags}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in weights:
        for b in weights:
            if a < b and not weights[a].keys().isdisjoint(weights[b]):
                low = sum(min(w, weights[b].get(s, 0)) for s, w in weights[a].items())
                if low >= 0.8 * (sum(weights[a].values()) + sum(weights[b].values()) - low):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: find(d) for d in bags}


def test_rare_shingles_have_their_own_frequency(spark, monkeypatch):
    """A phrase of 15 in 600 documents weighs less than the words that only two of them share."""
    monkeypatch.setattr(neardup, "CHUNK_BYTES", 20_000)
    rng = np.random.default_rng(21)
    phrase = [f"p{i}" for i in range(60)]
    rows = [(d, " ".join(f"x{d}_{i}" for i in range(30))) for d in range(600)]
    for d in range(15):  # mostly the phrase: one class if all weigh alike, none if the phrase weighs little
        rows.append((1000 + d, " ".join(phrase + [f"o{d}_{i}" for i in range(7)])))
    for d in range(10):  # a pair that differs in a part of the phrase only
        own = [f"y{d}_{i}" for i in range(120)]
        rows += [(2000 + d, " ".join(own + phrase[:16])), (3000 + d, " ".join(own + phrase[30:36] + ["end"] * int(rng.integers(1, 5))))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = true_classes(docs)
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == expected
    assert sum(expected[2000 + d] == expected[3000 + d] for d in range(10)) and expected[1001] == 1001


def test_frequencies_are_those_of_all_texts(spark, monkeypatch, documents, odd):
    """Every chunk gets the totals over all chunks; classes are those of the comparison of all pairs."""
    monkeypatch.setattr(neardup, "CHUNK_BYTES", 50_000)
    signed, count = neardup.signatures(documents.select("doc_id", "text"))
    words = {r.doc_id: WORD.findall((r.text or "").lower()) for r in documents.collect()}
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in words.items() if w}
    df = Counter(s for b in sets.values() for s in b)
    found = {r.doc_id: Counter(np.frombuffer(r.frequencies, "<u4").tolist()) for r in signed.where("one is not null").collect()}
    assert count == len(sets) and found == {d: Counter(df[s] for s in b) for d, b in sets.items()}
    for docs in (documents, odd):
        known = true_classes(docs)
        assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect() if r.doc_id in known} == known


def test_large_bands_are_compared_whole_by_true_weights(spark, monkeypatch):
    """The table of the test of that name in test_text_operators.py, whose reference holds the former cap on frequencies."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = np.random.default_rng(3)
    rows = []
    for d in range(60):
        text = [f"b{i}" for i in range(150)]
        for i in rng.choice(150, d % 7, replace=False):
            text[i] = f"e{d}_{i}"
        rows.append((d, " ".join(text)))
    rows += [(100 + d, " ".join(f"f{d}_{i}" for i in range(50))) for d in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == true_classes(docs)
