from __future__ import annotations

from pathlib import Path

from pyspark.sql import types as T

from silverlode.session import shared_root
from silverlode.sources import csv_blocks


def test_lines_with_quotes_are_shuffled_without_file_names_and_not_stored(spark, tmp_path):
    """Records over two lines in every block, one over all blocks; lines of such blocks were stored once more before."""
    cells = [(str(i), f"{i}\nsecond" if i % 3 else "plain") for i in range(40)] + [("40", "\n".join("long" * 5 for _ in range(60)))]
    path = tmp_path / "notes.csv"
    path.write_text("id,note\n" + "".join(f'{i},"{note}"\n' for i, note in cells))
    schema = T.StructType.fromDDL("id STRING, note STRING")
    before = set(Path(shared_root(spark), "silverlode").glob("quoted-lines-*"))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        found = csv_blocks.read_named(spark, str(path), schema).select("id", "note")
        assert sorted(map(tuple, found.collect())) == sorted(cells)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert set(Path(shared_root(spark), "silverlode").glob("quoted-lines-*")) == before
