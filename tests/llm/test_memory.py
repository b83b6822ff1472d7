from __future__ import annotations

from pathlib import Path

import pytest
from feedloom.llm import common
from feedloom.llm.common import released
from feedloom.llm.simhash import near_duplicates


def resident() -> int:
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096


@pytest.mark.skipif(not Path("/proc/self/statm").exists(), reason="memory can't be read here")
def test_tasks_give_freed_memory_back():
    """Pipeline: what a task freed between pieces still in use isn't kept by its worker, also if its rows aren't all taken."""
    for whole in (True, False):
        pinned = []

        def run(batches, pinned=pinned):
            for batch in batches:
                held = [bytearray(2000) for _ in range(50_000)]
                pinned.append(held[-1])
                del held
                yield batch

        task = released(run)(iter([1, 2]))
        assert next(task) == 1
        before = resident()
        assert list(task) == [2] if whole else task.close() is None
        assert before - resident() > 50_000_000


def test_small_tables_are_few_plain_files(spark, monkeypatch):
    """Pipeline, op10: each file makes the executor's JVM start processes, so small tables get few, without checksum files."""
    made, path = {}, common.new_path
    monkeypatch.setattr(common, "new_path", lambda spark, name: made.setdefault(f"{name} {len(made)}", path(spark, name)))
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame([(i, f"some words of text {i % 20} and a few more") for i in range(60)], "doc_id long, text string")
        assert near_duplicates(docs, radius=24).select("component_id").distinct().count() <= 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rounds = sorted((int(x.split()[1]), x) for x in made if x.startswith("edges"))[1:]
    few = [x for x in made if x.startswith("distinct-fingerprints")] + [x for _, x in rounds]
    assert rounds and all(len(list(Path(made[x].removeprefix("file:")).glob("part-*.parquet"))) <= 1 for x in few)
    assert not [f for x in made.values() for f in Path(x.removeprefix("file:")).glob(".*.crc")]
