from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from silverlode.llm import divergence, passage_quality, spelling, terms
from silverlode.llm.oracle import ORACLE_SQL

SCHEMA = "doc_id long, text string, lang string, source string"


def lowered(run: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def by_sql(name: str, docs) -> list[str]:
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pandas(docs.select("doc_id", "text", "lang", "source").toPandas().astype({"doc_id": "Int64"})))
    result = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    return sorted(repr(tuple(r[columns.index(c)] for c in sorted(columns))) for r in result.fetchall())


def ours(df) -> list[str]:
    return sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aBzZ ×÷ÀÿĀ日0@[`{\x7f\x80¿\n"))))
def test_runs_equal_patterns(texts):
    for inside, pattern in (
        (terms.letters_and_wide, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), (terms.latin_letters, r"[A-Za-zÀ-ÿ]+"),
    ):
        found = terms.runs(pa.array(texts, pa.string()), inside)
        names = found.names.to_pylist()
        assert [(r, names[c]) for r, c in zip(found.rows, found.codes)] == [
            (i, lowered(w)) for i, t in enumerate(texts) for w in re.findall(pattern, t or "")
        ]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(), st.text()), st.text(max_size=80)), min_size=1))
def test_put_together_hashes_equal_crc32(pairs):
    ids, names = [None if p[0] is None else str(p[0]) for p in pairs], [p[1].encode() for p in pairs]
    places = np.arange(len(pairs))
    assert spelling._hashes(ids, names, places, places).tolist() == [
        -1 if i is None else zlib.crc32(f"{i}:".encode() + n) for i, n in zip(ids, names)
    ]


def test_divergence_equals_sql(spark, odd, empty, documents):
    for docs in (odd, documents):
        assert ours(divergence.source_divergence(docs)) == by_sql("op11_source_divergence", docs)
    assert divergence.source_divergence(empty).isEmpty()


def test_divergence_of_ties_nulls_and_groups_without_terms(spark):
    names = " ".join("x" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(300))
    rows = [(1, names, "en", "a"), (1, names, "en", "a"), (2, names, "en", None), (3, None, "en", "b"), (4, "12 34", None, None),
            (5, "Only here", "de", "a"), (6, "日本 " * 3, "fr", "a"), (7, "日本 É é", "fr", "b"), (8, "日本", "fr", "b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = divergence.source_divergence(docs)
    assert ours(found) == by_sql("op11_source_divergence", docs)
    assert found.where("lang = 'en' and source = 'a' and part = 'term'").count() == 0
    more = spark.createDataFrame([*rows, *[(i, "other " * 500, "en", "b") for i in (9, 10, 11)]], SCHEMA)
    found = divergence.source_divergence(more)
    assert ours(found) == by_sql("op11_source_divergence", more)
    # 300 equal values: the first 200 by name.
    tied = found.where("lang = 'en' and source = 'a' and part = 'term'").orderBy("rank").collect()
    assert [r.item for r in tied] == sorted(names.split())[:200] and [r.rank for r in tied] == list(range(1, 201))


def test_shares_are_exact_beyond_longs(spark):
    n, total, kept = 40_000_000_000, 90_000_000_000_007, 12_345_678
    p, q = (1 + 10**9 * (c + 1) // (total + kept) for c in (n, 3))
    row = spark.range(1).selectExpr(
        f"{divergence.share(f'{n}L', f'{total}L', f'{kept}L')} as p", f"{divergence.gap('1000000001L', '1L')} as most"
    ).first()
    assert (row.p, row.most) == (p, 10**18) and q == 1


def expected_spelling(rows) -> dict:
    counts = Counter()
    for doc_id, text in rows:
        for run in map(lowered, re.findall(r"[A-Za-zÀ-ÿ]+", text or "")):
            h = None if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 3 and len(w) >= 5}
    letters = sorted({c for w in n for c in w})

    def near(w):
        found = {w[:i] + w[i + 1 :] for i in range(len(w))}
        found |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        found |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        return [v for v in found - {w} if v in n]

    forms = {}
    for w in n:
        best = min(near(w), key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= 2 * n[w] else None
    result = {}
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        result[w] = (forms[w], root, n[w], len(near(w)), n.get(forms[w]))
    return result


def spelt(df) -> dict:
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("seed, letters, longest", [(1, "ab", 9), (2, "abÉé×", 7), (3, "aab", 14)])
def test_spelling_equals_brute_force_on_crowded_words(spark, seed, letters, longest):
    rng = random.Random(seed)
    pool = ["".join(rng.choices(letters, k=rng.randint(4, longest))) for _ in range(250)]
    rows = [(i, ". ".join(w.title() if rng.random() < 0.2 else w for w in rng.choices(pool, [1 / (k + 1) for k in range(250)], k=150))) for i in range(40)]
    found = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert spelt(found) == expected_spelling(rows)


def test_spelling_of_odd_and_long_words(spark, odd, empty, documents):
    long = "".join(random.Random(5).choices("abc", k=3000))
    chain = [("zzzza", 3), ("zzzzb", 6), ("zzzbb", 12), ("zzbbb", 24)]
    rows = [(1, f"{long} " * 3), (2, f"{long[:-1]}d " * 6), (3, f"{long[:1500]}{long[1501:]} " * 3), (None, "hello " * 3), (4, None), (4, ""),
            *[(10 + i, f"{w} " * k) for i, (w, k) in enumerate(chain)], (30, "a" * 200 + " " + "a" * 199), (30, "a" * 200 + " " + "a" * 199), (30, "a" * 200 + " " + "a" * 199)]
    found = spelt(spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == expected_spelling(rows)
    assert found["zzzza"][1] == "zzbbb" and found[long][0] == long[:-1] + "d" and found["hello"][3] == 0
    assert ours(spelling.spelling_variants(odd)) == by_sql("op12_spelling_variants", odd)
    assert ours(spelling.spelling_variants(documents)) == by_sql("op12_spelling_variants", documents)
    assert spelling.spelling_variants(empty).isEmpty()


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    n, width = 7, passage_quality.FEATURES
    x, seg, firsts = rng.normal(size=(n, width)), np.array([0, 0, 0, 1, 2, 2, 2]), np.array([0, 3, 4])
    shapes = {"encode": (width, 4), "encode_bias": (4,), "tanh": (4, 3), "gate": (4, 3), "attend": (3,), "score": (4,), "bias": (1,)}
    w = {k: rng.normal(size=s) * 0.3 for k, s in shapes.items()} | {"mean": np.zeros(width), "scale": np.ones(width)}
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.5, 0.3])

    def loss(parts):
        a, logit = passage_quality._weights(x, seg, firsts, parts)[-3::2]
        assert np.allclose(np.add.reduceat(a, firsts), 1)
        return float((weight * (np.logaddexp(0, logit) - y * logit)).sum())

    grads = passage_quality._gradients(x, seg, firsts, w, y, weight)
    for name in shapes:
        at = tuple(rng.integers(s) for s in shapes[name])
        up, down = ({**w, name: w[name].copy()} for _ in range(2))
        up[name][at] += 1e-6
        down[name][at] -= 1e-6
        assert np.isclose((loss(up) - loss(down)) / 2e-6, grads[name][at], atol=1e-6)


def test_one_bad_passage_draws_the_attention():
    rng = np.random.default_rng(2)
    good = [" ".join(rng.choice(["river", "stone", "light", "under"], 600)) for _ in range(120)]
    bad = [g[:1500] + " " + "BUY!!! " * 128 + g[1500:] for g in good]
    column = pa.array(good + bad)
    rows, x = passage_quality.passage_features(column)
    bags = [x[rows == i].ravel() for i in range(len(column))]
    model = passage_quality.fit(pd.DataFrame({"label": [1] * 120 + [0] * 120, "bag": bags}))
    scores = passage_quality.attention_scores(model, column)
    assert scores[:120].min() > 0.5 > scores[120:].max()
    a = passage_quality._weights(x, rows, np.searchsorted(rows, np.arange(len(column))), model.parts)[3]
    loud = x[:, 0] > 0.2
    assert a[loud].mean() > a[~loud & (rows >= 120)].mean()


def test_quality_scores_hold_on_held_out_documents(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in passage_quality.passage_quality(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in found.items())
    held = [(r.quality, found[r.doc_id].predicted) for r in labels.collect() if r.doc_id in found and found[r.doc_id].held_out]
    assert sum(p == q for q, p in held) >= 0.9 * len(held)
    scores = passage_quality.passage_quality(odd, labels)
    assert scores.count() == odd.count() and scores.where("score is null or held_out is null").isEmpty()
    assert passage_quality.passage_quality(empty, labels).isEmpty()
    assert passage_quality.passage_quality(odd, labels.where("false")).select("score").distinct().count() == 1


def test_fitting_rows_are_bounded_and_other_columns_ignored(spark, monkeypatch):
    monkeypatch.setattr(passage_quality, "SAMPLE", 5)
    text = "word " * (passage_quality.PASSAGE_WORDS * 40)
    docs = spark.createDataFrame([(i % 30, text, "a", "b") for i in range(600)], "doc_id long, text string, label string, `meta.a` string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] * 3 + [(None, 1), (3, None)], "doc_id long, quality int")
    bags = passage_quality.training_bags(docs, labels)
    assert len(bags) == 10 and bags.doc_id.is_unique and sorted(bags.label) == [0] * 5 + [1] * 5
    assert {len(b) for b in bags.bag} == {passage_quality.BAG * passage_quality.FEATURES}
    assert all(zlib.crc32(str(i).encode()) % 5 for i in bags.doc_id)
    assert passage_quality.passage_quality(docs, labels).count() == 600
