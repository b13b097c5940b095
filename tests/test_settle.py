"""Files that still grow are not read."""

from __future__ import annotations

import os
import time

import pytest

from starlane.plans.load import Loader
from starlane.sinks.store import Store
from starlane.streaming.ingest import ingest, settled_paths


def test_a_growing_file_waits(spark, tmp_path):
    drops = tmp_path / "in"
    drops.mkdir()
    (drops / "done file.json").write_text("[1]")
    (drops / "growing.json").write_text("[")
    (drops / "removed.json").write_text("[")
    released = []

    def note(rows, number):
        for r in rows.collect():
            name = r["path"].rsplit("/", 1)[1].replace("%20", " ")
            released.append((name, os.path.getsize(drops / name)))

    stream = settled_paths(spark, str(drops), 100, 6.0)
    query = (
        stream.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint"))
        .foreachBatch(note)
        .trigger(processingTime="500 milliseconds")
        .start()
    )
    try:
        (drops / "removed.json").unlink()
        text, end = "[", time.time() + 120
        for i in range(8):
            time.sleep(2)
            text += f"{i},"
            (drops / "growing.json").write_text(text)
            assert "growing.json" not in dict(released)
        while len(released) < 2 and time.time() < end:
            time.sleep(0.5)
        time.sleep(2)
    finally:
        query.stop()
    assert sorted(released) == [("done file.json", 3), ("growing.json", len(text))]


def test_settling_takes_a_running_stream(spark, tmp_path):
    loader = Loader(Store(spark, str(tmp_path / "store")))
    with pytest.raises(ValueError, match="settle"):
        ingest(loader, "orders", str(tmp_path), str(tmp_path / "checkpoint"), settle=1.0)
