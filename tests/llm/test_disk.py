"""Shuffle files that a stored result leaves behind."""

from __future__ import annotations

import time
from pathlib import Path

from silverlode.llm import common


def test_shuffles_of_stored_results_go(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(d.toString()) for d in manager.localDirs()]

    def held() -> set[Path]:
        return {f for folder in folders for f in folder.glob("*/shuffle_*.data")}

    before, setting = held(), spark.conf.get(common._CLEAN_UP, None)
    found = common.store(spark.range(1000).repartition(4, "id"), "spread")
    for _ in range(20):
        if not held() - before:
            break
        time.sleep(0.1)
    assert not held() - before
    assert spark.conf.get(common._CLEAN_UP, None) == setting
    assert found.count() == 1000
