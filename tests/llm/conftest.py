from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, kept string, score string, row string, n_links string, quality string"


def words(start: int, count: int) -> str:
    return " ".join(f"w{i * 7919 % 100003}x{i}" for i in range(start, start + count))


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, long, repeated and copied texts; null keys; columns with clashing names."""
    base = words(0, 120)
    near = base.replace("w0x0 ", "changed ")
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (3, near, "en", "b"),
        (4, None, None, None), (5, "", "en", None), (6, " \n\t ", None, "a"), (7, words(1000, 30000), "de", "a"),
        (None, words(50000, 60), "en", "a"), (8, "one two three", "en", "a"), (9, words(60000, 60) + "\n" + words(20, 80), "fr", "c"),
        (10, "a b c d e " * 40, "en", "a"), (11, "É # $ | é\nÉ # $ | é\n" + words(70000, 20), "fr", "c"),
    ]
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    from silverlode.llm.common import table

    return table(spark, SF, "documents")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where(F.lit(False))
