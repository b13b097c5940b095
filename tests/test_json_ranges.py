"""Records found in ranges of JSON files, against the standard parser."""

from __future__ import annotations

import json
import random

import pytest

from tests.conftest import rows_of
from starlane.sources import files, ledger
from starlane.sources.json_ranges import _cut, _summaries, record_texts
from starlane.sources.ranges import listed, split_files, task_count

AWKWARD = ['a "q" \\', "\\\\\"", "{[", "]}", "é日本", "", '"', "\\", "x" * 40, '\\"}{', "\n\t"]


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def _found(path, keyed, span, piece):
    """What the tasks of one file find, with the running sums taken plainly."""
    import pyarrow as pa

    length = len(open(path, "rb").read())
    rows = [{"path": f"file:{path}", "length": length, "start": s} for s in range(0, length, span)]
    sums = [r for b in _summaries(span, piece)([pa.RecordBatch.from_pylist(rows)]) for r in b.to_pylist()]
    root = next((s["root"] for s in sums if s["root"]), "[")
    quoted = depth = 0
    out = []
    for row, s in zip(rows, sums):
        state = {"quoted": quoted, "depth": depth, "base": 0 if root == "{" and not keyed else 1}
        out += [json.loads(t) for t in _cut({**row, **state}, span, piece)]
        depth += s["inside"] if quoted else s["outside"]
        quoted = (quoted + s["quotes"]) % 2
    return out


@pytest.mark.parametrize("seed", range(10))
def test_ranges_and_pieces_of_any_size(tmp_path, seed):
    pick = random.Random(seed)

    def value(deep=0):
        kind = pick.randrange(5 if deep < 3 else 2)
        if kind < 2:
            return pick.choice(AWKWARD)
        if kind == 2:
            return pick.choice([None, 1.5, True])
        if kind == 3:
            return [value(deep + 1) for _ in range(pick.randrange(4))]
        return {pick.choice(AWKWARD) + str(i): value(deep + 1) for i in range(pick.randrange(4))}

    records = [{"k" + str(i): value() for i in range(pick.randrange(4))} for _ in range(pick.randrange(12))]
    layout = {"ensure_ascii": pick.random() < 0.5, "indent": pick.choice([None, 1])}
    array = _write(tmp_path / "a.json", json.dumps(records, **layout))
    keyed = _write(tmp_path / "b.json", json.dumps({pick.choice(AWKWARD) + str(i): r for i, r in enumerate(records)}, **layout))
    one = _write(tmp_path / "c.json", json.dumps({"only": records}, **layout))
    for span, piece in [(2, 1), (7, 100), (64, 5), (10**6, 10**6), (10**6, 3)]:
        assert _found(array, False, span, piece) == records
        assert _found(keyed, True, span, piece) == records
        assert _found(one, False, span, piece) == [{"only": records}]


def test_readers_give_the_same_rows(spark, tmp_path):
    columns = ["k", "v"]
    records = [{"k": i, "v": AWKWARD[i % len(AWKWARD)], "w": {"k": [1, {"v": 2}]}} for i in range(200)]
    array = _write(tmp_path / "a.json", json.dumps(records))
    keyed = _write(tmp_path / "b.json", json.dumps({str(i): r for i, r in enumerate(records)}))
    whole = rows_of(files.read_json(spark, array, columns))
    assert len(whole) == 200
    split = files.read_json(spark, array, columns, span=256)
    assert rows_of(split) == whole
    assert rows_of(files.read_keyed_json(spark, keyed, columns, span=256)) == whole
    assert rows_of(files.read_json(spark, array, span=256), *columns) == whole
    assert files.read_json(spark, array, span=256).columns == ["k", "v", "w"]
    names = files.header_names(spark, [array], "json", span=256).first()
    assert sorted(names["names"]) == ["k", "v", "w"]


def test_ranges_are_spread_over_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    path = _write(tmp_path / "a.json", json.dumps([{"k": i} for i in range(5000)]))
    found = listed(spark, path)
    ranges = split_files(found, 1024, task_count(found, 1024))
    assert ranges.select(F.spark_partition_id()).distinct().count() > 1
    texts = record_texts(found, span=1024)
    assert texts.count() == 5000
    assert texts.select(F.spark_partition_id()).distinct().count() > 1
    assert ledger.hash_files(spark, path, large=1, span=1024).count() == 1


def test_empty_cut_off_and_scalar_values(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _write(folder / "a.json", "")
    _write(folder / "b.json", "[]")
    _write(folder / "c.json", '[null, 1, "x{", [{"k": 9}], {"k": 1}]')
    _write(folder / "d.json", '﻿[{"k": 2}, {"k": "3')
    found = rows_of(record_texts(listed(spark, str(folder)), span=4), "record")
    assert found == [('{"k": "3',), ('{"k": 1}',), ('{"k": 2}',)]


def test_header_cells_with_commas(spark, tmp_path):
    path = _write(tmp_path / "t.csv", '"a,b",c, "d ""e""" ,\n1,2,3,4\n')
    names = files.header_names(spark, [path], "csv").first()["names"]
    assert names == ["a,b", "c", 'd "e"', ""]
    assert files.read_csv(spark, path).columns[:2] == names[:2]


def test_lists_of_names_are_told_apart_before_they_are_opened(spark, tmp_path):
    path = _write(tmp_path / "t.json", json.dumps([{"a": i, "b": "x"} for i in range(50)] + [{"c": None}]))
    names = files.header_names(spark, [path], "json", span=64)
    assert [sorted(r.names) for r in names.collect()] == [["a", "b", "c"]]
    plan = names._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [" in plan.split("Generate explode(names", 1)[1]
