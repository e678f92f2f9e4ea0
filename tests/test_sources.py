"""Multi-line CSV over byte ranges, JSON lines of unknown shape."""

import csv
import json
import random

import pytest

from featuremill.sources.records import begins_inside_quotes, csv_records, read_multiline_csv, _lines
from featuremill.sources.shred import Shape, infer_shape, read_variants, shred, shred_lines

SCHEMA = "id long, text string, x double"


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 3,000 bytes: every file has many."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(path, rows, terminator="\n"):
    with open(path, "w", newline="", encoding="utf8") as f:
        w = csv.writer(f, lineterminator=terminator)
        w.writerow(["id", "text", "x"])
        w.writerows(rows)


def _rows(seed, n):
    r = random.Random(seed)
    parts = ["plain", "a,b", 'say "no"', 'x"y', "line\nfeed", "two\n\nfeeds", '"', "\r\nwin", "end\n", 'é,"\n"🙂', "\n" * 9]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(1, 4))) + str(i), r.random()) for i in range(n)]
    # records longer than several ranges, of line feeds and of one line
    rows[n // 3] = (n // 3, 'begin "\n' * 2500 + "end", 0.5)
    rows[n // 2] = (n // 2, "y" * 20000, 0.25)
    rows[n // 2 + 1] = (n // 2 + 1, "\n" * 9000, 0.125)
    return rows


def test_multiline_csv_over_ranges(spark, small_ranges, tmp_path):
    rows = _rows(1, 900)
    _write(tmp_path / "a.csv", rows[:600])
    _write(tmp_path / "b.csv", rows[600:])
    one = read_multiline_csv(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert one.rdd.getNumPartitions() > 5  # one file, many tasks
    assert sorted(map(tuple, one.collect())) == rows[:600]
    assert sorted(map(tuple, read_multiline_csv(spark, str(tmp_path), SCHEMA).collect())) == rows
    lines = _lines(spark, str(tmp_path / "a.csv"))
    starts = begins_inside_quotes(lines).collect()
    assert {r.inside for r in starts} == {True, False}
    text = (tmp_path / "a.csv").read_bytes()
    for r in starts:  # a range begins with the line after the first line feed in it
        at = 0 if r.range == 0 else text.index(b"\n", r.range) + 1
        assert r.inside == (text[:at].count(b'"') % 2 == 1)


def test_multiline_csv_odd_files(spark, small_ranges, tmp_path):
    _write(tmp_path / "win.csv", [(1, "a\nb", 1.0), (2, "c", 2.0)], terminator="\r\n")
    assert sorted(map(tuple, read_multiline_csv(spark, str(tmp_path / "win.csv"), SCHEMA).collect())) == [
        (1, "a\nb", 1.0), (2, "c", 2.0)]
    (tmp_path / "odd.csv").write_bytes(b'id,text,x\n1,,\n\n2,"",x\n3,"open\nto the end')
    got = read_multiline_csv(spark, str(tmp_path / "odd.csv"), SCHEMA).collect()
    assert sorted(map(tuple, got)) == [(1, None, None), (2, "", None), (3, "open\nto the end", None)]
    (tmp_path / "head.csv").write_bytes(b"id,text,x\n")
    assert read_multiline_csv(spark, str(tmp_path / "head.csv"), SCHEMA).collect() == []
    (tmp_path / "same.csv").write_bytes(b"id,text,x\nid,text,x\n7,z,1\n")  # a row like the header stays
    assert len(csv_records(spark, str(tmp_path / "same.csv")).collect()) == 2
    assert read_multiline_csv(spark, str(tmp_path / "same.csv"), SCHEMA, header=False).count() == 3


def _shape_of(spark, tmp_path, lines, **more):
    (tmp_path / "lines.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    v = read_variants(spark, str(tmp_path / "lines.json"))
    shape = infer_shape(v, **more)
    return shape, *shred(v, shape)


def test_lines_are_typed_or_quarantined(spark, tmp_path):
    lines = [{"a": 1, "b": "x", "c": {"d": True, "e": 1.5}}, {"a": 2, "b": None, "c": {"d": False, "e": 2}}, {"a": "three"},
             {"b": "y", "c": 7}, "{broken", "[1, 2]", '"text"', "  ", {"a": 4, "c": {"e": "no"}}, {}, {"a": None, "f": [1, {"g": 2}]}]
    shape, typed, bad = _shape_of(spark, tmp_path, lines)
    assert dict(shape.paths) == {("a",): "integer", ("b",): "text", ("c",): "object", ("c", "d"): "boolean",
                                 ("c", "e"): "number", ("f",): "array"}
    assert typed.dtypes == [("a", "bigint"), ("b", "string"), ("c_d", "boolean"), ("c_e", "double"), ("f", "string"),
                            ("rest", "string")]
    assert sorted(map(str, (tuple(r) for r in typed.collect()))) == sorted(map(str, [
        (1, "x", True, 1.5, None, None), (2, None, False, 2.0, None, None), (None, None, None, None, None, None),
        (None, None, None, None, '[1,{"g":2}]', None)]))
    assert sorted((r.line, r.reason) for r in bad.collect()) == sorted([
        (json.dumps({"a": "three"}), "a is not integer"), (json.dumps({"b": "y", "c": 7}), "c is not object"),
        ("{broken", "no JSON"), ("[1, 2]", "no object"), ('"text"', "no object"),
        (json.dumps({"a": 4, "c": {"e": "no"}}), "c_e is not number")])


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"a": 1, "c": {"d": true}}\n{"a": "x"}\n{"a": 2, "e": [{"f": 1}], "c": {}}\n3\nno')
    v = read_variants(spark, str(tmp_path / "lines.json"))
    shape = infer_shape(v)
    assert shape.paths == ((("a",), "integer"), (("c",), "object"), (("c", "d"), "boolean"), (("e",), "array"))
    lines = shred_lines(v, shape)
    for df in (lines, lines.select("typed.a", "reason"), *shred(v, shape)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("parseJson") == 1, plan
    assert {r.line: (r.reason, *r.typed) for r in lines.collect()} == {
        '{"a": 1, "c": {"d": true}}': (None, 1, True, None, None), '{"a": "x"}': ("a is not integer", *4 * [None]),
        '{"a": 2, "e": [{"f": 1}], "c": {}}': (None, 2, None, '[{"f":1}]', None),
        "3": ("no object", *4 * [None]), "no": ("no JSON", *4 * [None])}


def test_paths_beyond_the_columns_stay(spark, tmp_path):
    lines = [{"a": i, f"key{i}": i} for i in range(30)]
    shape, typed, bad = _shape_of(spark, tmp_path, lines, most=2)
    assert [p for p, _ in shape.paths] == [("a",), ("key0",)]
    rows = {r.a: r for r in typed.collect()}
    assert len(rows) == 30 and bad.count() == 0
    assert rows[0].rest is None and all(json.loads(rows[i].rest) == lines[i] for i in range(1, 30))


def test_shape_of_nothing_and_clashing_paths(spark, tmp_path):
    shape, typed, bad = _shape_of(spark, tmp_path, ["no", "{}"])
    assert shape == Shape(()) and typed.count() == 1 and bad.count() == 1
    with pytest.raises(ValueError):
        Shape(((("a", "b"), "text"), (("a_b",), "text"))).columns()
