"""What a Python worker keeps of a task that has ended."""

from __future__ import annotations

import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from silverlode.llm import common, neardup, quality
from silverlode.llm.words import Words


def _resident_mb() -> float:
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6


@pytest.mark.skipif(not Path("/proc/self/statm").exists(), reason="reads /proc")
def test_a_worker_gives_memory_back_when_its_partition_ends():
    last = []

    def run(batches):
        blocks = [bytes(1000) for _ in range(200_000)]
        last.append(bytes(1000))  # lies behind the blocks, so the heap can't shrink by itself
        yield from batches
        del blocks

    rows = common.tidy(run)(iter([1, 2]))
    assert next(rows) == 1
    held = _resident_mb()
    assert list(rows) == [2]
    assert _resident_mb() < held - 150


def _peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_the_words_of_a_batch_are_counted_in_pieces():
    texts = pa.array([" ".join(f"w{i * j % 9973}" for i in range(4000)) for j in range(1, 320)] + [None, ""])
    assert texts.nbytes > 6e6
    assert _peak_mb(lambda: quality.counts(texts)) < 60
    parts = pa.concat_arrays([quality.counts(texts.slice(i, 1)) for i in range(len(texts))])
    assert quality.counts(texts).equals(parts)
    assert len(quality.counts(texts.slice(0, 0))) == 0


def test_words_are_hashed_in_blocks():
    texts = [" ".join(f"word{i * j % 9973}" for i in range(3000)) for j in range(1, 200)]
    words = Words(pa.array([*texts, "x" * 300_000 + " y", None, ""]))
    assert _peak_mb(words.hashes) < 40
    alone = np.concatenate([Words(pa.array([t])).hashes() for t in [*texts[:3], "x" * 300_000 + " y"]])
    assert (words.hashes()[[*range(9000), -2, -1]] == alone).all()


def _signed(texts: list[str], chunks: int) -> pa.Table:
    place = np.arange(len(texts), dtype=np.int32) % chunks
    order = np.argsort(place, kind="stable")
    rows = pa.table({"chunk": place[order], "doc_id": order, "text": pa.array(texts).take(pa.array(order))})
    sent = pa.Table.from_batches(neardup._chunk_shingles(1)(rows.to_batches())).sort_by("range")
    totals = pa.Table.from_batches(neardup._totals(sent.to_batches()))
    rows = rows.append_column("frequencies", pa.nulls(len(rows), pa.binary()))
    both = pa.concat_tables([rows, totals.drop_columns("range")], promote_options="default").sort_by([("chunk", "ascending"), ("doc_id", "ascending")])
    return pa.Table.from_batches(neardup._signatures(len(texts))(both.combine_chunks().to_batches())).sort_by("doc_id")


def test_texts_are_sampled_together_with_the_same_keys(monkeypatch):
    texts = [" ".join(f"v{i * j % 61}" for i in range(3 + j)) for j in range(1, 90)] + ["a b c d e " * 30, "", "a"]
    calls, sample = [], neardup.Sampler.sample
    monkeypatch.setattr(neardup.Sampler, "sample", lambda self, *parts: calls.append(1) or sample(self, *parts))
    together = _signed(texts, 1)
    assert len(calls) == 1
    assert together.equals(_signed(texts, len(texts)))
    assert together.column("bands").null_count == 1
