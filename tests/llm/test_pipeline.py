from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import SF


def test_stages_keep_the_columns_and_the_clean(spark, odd):
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries() and all(any(q.startswith(f"op{n}_") for q in __spark_entry__.queries()) for n in range(1, 14))
    docs, before = odd, odd.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd.columns, name
    assert docs.count() <= 3 * before


def test_run_packs_what_is_left(spark):
    pieces = corpus_pipeline.run(spark, SF)
    rows = pieces.collect()
    assert rows and sum(r.length for r in rows) > 0
    assert sorted(map(tuple, rows)) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
