"""Array files cut at record borders by many tasks."""

from __future__ import annotations

import json
import random

import pytest

from payrisk.session import setting
from payrisk.sources import json_arrays
from payrisk.sources.tables import read_json

SCHEMA = "id long, text string, inner struct<a: array<struct<b: string>>, c: string>"


def records(n: int, seed: int) -> list[dict]:
    """Braces, quotes, escapes and line ends in strings; nested objects; some long records."""
    pick = random.Random(seed)
    bits = ["{", "}", '"', "\\", "\n", ",", "[", "]", "é", "😀", "x", '\\"}', "}}", "{{"]

    def text():
        return "".join(pick.choice(bits) for _ in range(pick.choice([0, 3, 9, 9, 400])))

    return [
        {"id": i, "text": text(), "inner": {"a": [{"b": text()} for _ in range(pick.randrange(3))], "c": text()}}
        for i in range(n)
    ]


def found(frame):
    return sorted((r.asDict(True) for r in frame.collect()), key=lambda r: r["id"])


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", ["300", "5000", "128m"])
def test_many_tasks_cut_one_file(spark, tmp_path, indent, size):
    rows = records(120, 5)
    (tmp_path / "one.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False), "utf-8")
    with setting(spark, "spark.sql.files.maxPartitionBytes", size), setting(spark, "spark.sql.files.openCostInBytes", "0"):
        frame = json_arrays.read_json_arrays(spark, str(tmp_path), T_SCHEMA(spark))
        assert found(frame) == rows
        parts = spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions()
        assert (parts > 10) == (size != "128m")


def T_SCHEMA(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_any_kind_of_file(spark, tmp_path):
    """Arrays, single records, lines, empty arrays and files, blanks, folders, other names."""
    rows = records(7, 3)
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.json").write_text(json.dumps(rows[:2]) + "\n\n", "utf-8")
    (tmp_path / "deep" / "b.json").write_text(" " + json.dumps(rows[2], indent=1), "utf-8")
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, rows[3:])), "utf-8")
    (tmp_path / "d.json").write_text("[ ]", "utf-8")
    (tmp_path / "e.json").write_text("", "utf-8")
    (tmp_path / "f.txt").write_text(json.dumps(rows), "utf-8")
    frame = read_json(spark, str(tmp_path), T_SCHEMA(spark), whole_files=True)
    assert found(frame) == rows


def test_broken_and_partial_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": x}, {"id": 2, "other": {}}, {"id": 3', "utf-8")
    frame = json_arrays.read_json_arrays(spark, str(tmp_path), T_SCHEMA(spark))
    assert sorted(str(r["id"]) for r in frame.collect()) == ["1", "2", "3", "None"]


def test_quotes_and_braces():
    assert json_arrays.quote_places('a"b\\"c"') == [1, 6]
    assert json_arrays.quote_places('"\\\\"') == [0, 3]
    assert json_arrays.opened('{"{" {', [1, 3], False) == 2
    assert json_arrays.opened('{"{" {', [1, 3], True) == 1
    assert json_arrays.opened("{{", [], True) == 0
