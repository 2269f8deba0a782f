"""Seeds joined to their first holders in one sorted pass, against plain loops."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa

from silverlode.llm import passages
from silverlode.session import shared_root

COLUMNS = ["doc_id", "seed", "pos", "context"]


def _expected(rows):
    """Matches by the definition: first place of each seed, further ones by their context."""
    found = []
    for seed in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == seed), key=lambda r: (r[0], r[2]))
        first, several = own[0], own[-1][0] > own[0][0]
        for doc, _, pos, context in own:
            further = several and len(own) > 2 and None not in (context, first[3]) and context != first[3]
            if doc > first[0] or further:
                found.append((doc, first[0], pos, first[2], context is not None, seed if further else None, context if further else None))
    return sorted(found, key=repr)


def test_places_are_joined_to_the_first_one_across_batches(monkeypatch):
    random = np.random.default_rng(5)
    rows = [
        (int(random.integers(1, 6)), seed, place, int(random.integers(3)) if seed % 2 else None)
        for seed in range(60)
        for place in range([1, 2, 3, 40][seed % 4])
    ]
    rows.sort(key=lambda r: (r[1], r[0], r[2]))
    table = pa.table(dict(zip(COLUMNS, zip(*rows))), pa.schema([("doc_id", pa.int64()), ("seed", pa.int64()), ("pos", pa.int32()), ("context", pa.int64())]))
    for at_once in (1, 7, 32_000):
        monkeypatch.setattr(passages, "MATCHED_AT_ONCE", at_once)
        found = [tuple(r.values()) for b in passages._matched(iter(table.to_batches(max_chunksize=5))) for r in b.to_pylist()]
        assert sorted(found, key=repr) == _expected(rows)


def test_seeds_are_not_stored(spark):
    """They outweigh the texts; stored and shuffled twice they took more disk than the job may have."""
    words = np.random.default_rng(3).integers(0, 10**6, (3, 80))
    texts = [" ".join(map(str, w)) for w in words]
    docs = spark.createDataFrame([(0, texts[0]), (1, texts[1]), (2, texts[2] + " " + texts[0])], "doc_id long, text string")
    before = set(Path(shared_root(spark), "silverlode").glob("seeds-*"))
    found = passages.aligned_spans(docs).collect()
    assert [(r.doc_id, [(s.other, s.begin, s.end) for s in r.spans]) for r in found] == [(2, [(0, 80, 160)])]
    assert set(Path(shared_root(spark), "silverlode").glob("seeds-*")) == before
