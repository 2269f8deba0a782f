from __future__ import annotations

from collections import Counter

import numpy as np

from silverlode.llm import neighbours, quotes
from silverlode.llm.graph import components
from tests.llm.conftest import SF


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)] + [(200, 201), (201, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).isEmpty()


def brute_vectors(rows):
    ok = {r.vec_id: np.asarray(r.embedding, float) for r in rows if r.embedding and None not in r.embedding and np.isfinite(np.asarray(r.embedding, float)).all() and any(r.embedding) and r.vec_id is not None}
    ids = list(ok)
    links = Counter()
    root = {i: i for i in ids}
    for a in range(len(ids)):
        for b in range(a):
            x, y = ok[ids[a]], ok[ids[b]]
            if len(x) == len(y) and x @ y >= 0.9 * np.linalg.norm(x) * np.linalg.norm(y):
                links[ids[a]] += 1
                links[ids[b]] += 1
                low, high = sorted((root[ids[a]], root[ids[b]]))
                root = {k: low if v == high else v for k, v in root.items()}
    return links, root


def test_near_vectors_equal_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rng = np.random.default_rng(1)
    centre = rng.normal(size=8)
    extra = [(1000 + i, (centre + 0.05 * rng.normal(size=8)).tolist(), 1) for i in range(40)]
    extra += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 8, 1), (2003, [1.0, None], 1), (2004, [float("nan")] * 8, 1), (None, [1.0] * 8, 1)]
    extra += [extra[0]]
    odd = spark.createDataFrame([(*r, "x", "y") for r in extra], "vec_id long, embedding array<double>, label int, unit string, n_links string")
    for rows in (table, odd):
        links, root = brute_vectors(set(map(lambda r: r, rows.collect())) if False else list({(r.vec_id, tuple(r.embedding) if r.embedding is not None else None): r for r in rows.collect()}.values()))
        for r in neighbours.near_vectors(rows).collect():
            assert (r.n_links, r.component_id) == (links.get(r.vec_id, 0), root.get(r.vec_id, r.vec_id)), r
    assert neighbours.near_vectors(odd.where("false")).isEmpty()


def test_quotes_are_linked_in_reply_order(spark):
    rows = [
        (1, 0, "user", "How do I  start?\nSecond line."), (1, 1, "assistant", "> how do i start?\nLike this."),
        (1, 2, "user", ">> How do I start?\n> Like this.\nThanks!"), (1, 3, "user", "No quote"), (2, 0, "user", "> Like this.\nElsewhere"),
        (2, 1, "user", "> never said\nx"), (3, 0, None, None), (3, 1, "user", ""), (None, 0, "user", "> Like this."), (1, 3, "user", "No quote"),
    ]
    messages = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    found = {(r.conv_id, r.turn): r for r in quotes.conversations(messages).collect()}
    assert (found[1, 1].to_turn, found[1, 1].text) == (0, "Like this.")
    assert (found[1, 2].to_turn, found[1, 2].root_turn, found[1, 2].depth, found[1, 2].text, found[1, 2].n_quoted) == (1, 0, 2, "Thanks!", 2)
    assert (found[2, 0].to_conv, found[2, 0].to_turn, found[2, 0].root_conv, found[2, 0].depth) == (1, 1, 1, 2)
    assert found[2, 1].to_conv is None and found[1, 3].depth == 0 and found[3, 0].text == ""
    assert quotes.conversations(messages).count() == len(rows)
    assert quotes.conversations(messages.where("false")).isEmpty()


def planted_vectors(spark, seed=7):
    """Two groups of twelve near copies with 0.92 across, a large group of copies, pairs, and vectors without links."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v)
    a = unit(rng.normal(size=32))
    side = rng.normal(size=32)
    side = unit(side - side @ a * a)
    b = 0.92 * a + np.sqrt(1 - 0.92**2) * side
    vectors = [unit(c + 1e-4 * rng.normal(size=32)) for c in (a, b) for _ in range(12)]
    vectors += [unit(rng.normal(size=32))] * 200
    for _ in range(20):
        one = unit(rng.normal(size=32))
        vectors += [one, unit(one + 0.05 * unit(rng.normal(size=32)))]
    vectors += [unit(rng.normal(size=32)) for _ in range(100)]
    # No id is a multiple of the audit's old step.
    return spark.createDataFrame([(51 * 50 * i + 1, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")


def assert_brute_force(table):
    links, root = brute_vectors(table.collect())
    for r in neighbours.near_vectors(table).collect():
        assert (r.n_links, r.component_id) == (links.get(r.vec_id, 0), root[r.vec_id]), r


def test_links_between_full_lists_are_kept(spark):
    table = planted_vectors(spark)
    assert brute_vectors(table.collect())[0][1] == 23
    assert_brute_force(table)


def test_audit_does_not_grade_its_own_links(spark, monkeypatch):
    """A search that finds nothing must not pass the audit."""
    nothing = spark.createDataFrame([], "u long, v long, sim double, link boolean")
    monkeypatch.setattr(neighbours, "_initial", lambda *_: nothing)
    monkeypatch.setattr(neighbours, "_round", lambda *_: nothing)
    assert_brute_force(planted_vectors(spark))


def test_tables_grow_with_bits():
    for bits in range(1, 25):
        same = (1 - np.arccos(neighbours.THRESHOLD) / np.pi) ** bits
        assert (1 - same) ** neighbours._tables(bits) <= 0.0501


def test_tiny_and_huge_vectors_are_compared(spark):
    rows = [(1, [1e-200] * 8), (2, [1.0] * 8), (3, [1e300] * 8), (4, [5e-324] * 8), (5, [1e-200, -1e-200] * 4), (6, [0.0] * 8), (7, [float("inf")] * 8)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {**{i: (3, 1) for i in range(1, 5)}, **{i: (0, i) for i in (5, 6, 7)}}
