"""Rendering and edits; what is written reads back the same."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cif_lake.functions import render
from cif_lake.operators import edit
from cif_lake.plans import corpus
from cif_lake.sources import read, write


def test_value_quoting(spark):
    cases = {
        "plain": "plain", "": "?", "a b": "'a b'", "it's": '"it\'s"', 'a"b': "'a\"b'", "data_x": "'data_x'", "_x": "'_x'",
        "[1]": "'[1]'", "a_b": "a_b", "x;y": "x;y", ";x": "';x'", "l\nm": ";l\nm\n;", "both ' \"": ";both ' \"\n;", ".": "'.'", "?": "'?'",
        "Stop_x": "'Stop_x'", "a\tb": "'a\tb'",
    }
    frame = spark.createDataFrame([(k,) for k in cases], "v string").selectExpr("v", f"{render.value('v')} AS t")
    assert {r["v"]: r["t"] for r in frame.collect()} == cases
    with pytest.raises(Exception, match="cannot write"):
        spark.createDataFrame([("a\n;b",)], "v string").selectExpr(render.value("v")).collect()


def test_round_trip(spark):
    """Random text of awkward characters survives as loop and as key-value rows."""
    rng = random.Random(7)
    words = ["'", '"', ";", "\n", " ", "#", "_", "a", "loop_", "data_", ".", "?", "\t", "\r", "é", "'''", "$", "[", "save_"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 7))) for _ in range(900)]
    values = [(n // 3, n % 3, t, rng.choice(texts), n) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(values, "fkey long, row_id long, a string, b string, n long")
    frame = frame.filter(f"NOT {render.unwritable('a')} AND NOT {render.unwritable('b')}")
    for loops in (True, False):
        texts = render.categories({"t": (frame, ["a", "n", "b"])}, ["fkey"], loops=loops)
        src = texts.selectExpr("0 AS file_ord", "CAST(fkey AS string) AS path", "concat('data_x\\n', text) AS content")
        back = read.scan(src, "t", column_source="files", filename=False)
        want = {r["n"]: (r["a"] or None, r["b"] or None) for r in frame.collect()}
        got = {int(r["n"]): (r["a"], r["b"]) for r in back.collect()}
        assert got == want


def test_edits(spark):
    table = spark.createDataFrame([("f", 0, "a", 1), ("f", 1, "b", None), ("f", 2, "c", 3)], "filename string, row_id long, id string, n long")
    new = spark.createDataFrame([("f", 0, "d"), ("f", 1, "e"), ("g", 0, "h")], "filename string, ord long, id string")
    got = edit.insert_rows(table, new).orderBy("filename", "row_id").select("filename", "row_id", "id", "n").collect()
    assert [tuple(r) for r in got][3:] == [("f", 3, "d", None), ("f", 4, "e", None), ("g", 0, "h", None)]
    swapped = edit.update_rows(table, {"id": F.col("n").cast("string"), "n": F.length("id").cast("long")}, F.col("n") > 1)
    assert [tuple(r) for r in swapped.select("id", "n").collect()] == [("a", 1), ("b", None), ("3", 1)]
    assert [r["id"] for r in edit.delete_rows(table, F.col("n") > 1).collect()] == ["a", "b"]


def test_keep_in_follows_not_in(spark):
    table = spark.createDataFrame([(f, v) for f in "xyz" for v in ("1", "2", None)], "filename string, v string")
    allowed = spark.createDataFrame([("x", "1"), ("y", "1"), ("y", None)], "filename string, a string")
    got = sorted(edit.keep_in(table, "v", allowed).collect(), key=str)
    # x: 2 goes; y: a NULL in the set keeps all; z: an empty set keeps nothing.
    assert sorted(tuple(r) for r in got if r["v"]) == [("x", "1"), ("y", "1"), ("y", "2")]
    assert sorted(r["filename"] for r in got if r["v"] is None) == ["x", "y"]


def test_write_files(spark, tmp_path):
    frame = spark.createDataFrame([("s/a.cif", "data_a\n_e.i 1\n"), ("s/b.cif.gz", "data_b\n_e.i 2\n")], "path string, content string")
    write.write_files(frame, f"file://{tmp_path}")
    assert (tmp_path / "s" / "a.cif").read_text() == "data_a\n_e.i 1\n"
    assert (tmp_path / "s" / "b.cif.gz").read_bytes()[:2] == b"\x1f\x8b"
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if not p.name.startswith(".")) == ["a.cif", "b.cif.gz"]
    back = read.scan_paths(spark, str(tmp_path / "s" / "*.cif*"), "e", column_source="files")
    assert sorted(r["i"] for r in back.collect()) == ["1", "2"]


def test_write_lines(spark, tmp_path):
    """One file in the order of the rows, written by a task for each partition."""
    lines = spark.range(0, 1000, numPartitions=5).selectExpr("concat(id, repeat('x', id % 7), IF(id % 10 = 0, '\nü', '')) AS line")
    write.write_lines(lines.sort("line").coalesce(1).union(lines), f"file://{tmp_path}/out", "all.cif")
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["all.cif"]
    rows = [r["line"] for r in lines.collect()]
    assert (tmp_path / "out" / "all.cif").read_text() == "".join(f"{line}\n" for line in sorted(rows) + rows)


def test_large_file_has_many_writers(spark, tmp_path, monkeypatch):
    """The sorted rows come to the writer in more than one partition."""
    for name, columns in (("lineitem", corpus.LINE_TYPES), ("documents", dict.fromkeys(corpus.DOC_COLUMNS, "string") | {"doc_id": "bigint"})):
        cells = ["DATE '2020-01-01' AS l_shipdate" if c == "l_shipdate" else f"CAST(id AS {t}) AS {c}" for c, t in columns.items()]
        spark.range(500).selectExpr(*cells).write.parquet(f"{tmp_path}/{name}.parquet")
    seen = []
    monkeypatch.setattr(corpus, "write_lines", lambda lines, *_: seen.append(lines.rdd.getNumPartitions()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        corpus.large_file(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert seen == [2]


def test_write_files_dealt_over_folders(spark, tmp_path):
    """No folder takes all files, a path that comes again keeps its place, and every file is read back under its name."""
    frame = spark.range(64).selectExpr("concat('two/', id % 48, '.cif') AS path", "concat('data_', id % 48, '\n') AS content")
    assert write.write_files(frame, f"file://{tmp_path}", folders=8) == 64
    names = [p.name for p in tmp_path.rglob("*.cif")]
    assert sorted(names) == sorted(f"{n}.cif" for n in range(48))
    assert len(list(tmp_path.iterdir())) > 1 and all((p / "two").is_dir() for p in tmp_path.iterdir())
    assert all(p.read_text() == f"data_{p.stem}\n" for p in tmp_path.rglob("*.cif"))


def test_row_of_many_strings(spark):
    """Old and plain reading of a row agree, and its code stays small enough for the JVM to compile (8,000 bytes), however many strings it has."""
    names = [f"s{n}" for n in range(16)]
    marks = [None, "", "a b", "it's", "l\nm", "both ' \"", ";x", ".", "_x", "plain"]
    rows = [(n, *(marks[(n + i * i) % len(marks)] for i in range(16)), n / 4) for n in range(40)]
    frame = spark.createDataFrame(rows, f"n long, {', '.join(f'{s} string' for s in names)}, d double")
    columns = ["n", *names, "d"]
    made = frame.select("n", render.row(frame, columns).alias("line"))
    shown = lambda v: next(t for t in [
        "?" if v in (None, "") else None, f";{v}\n;" if "\n" in v or ("'" in v and '"' in v) else None, f'"{v}"' if "'" in v else None,
        f"'{v}'" if " " in v or v[0] in ";_" or v == "." else None, v,
    ] if t) if v else "?"
    for n, line in made.collect():
        cells = [str(n), *(shown(v) for v in rows[n][1:17]), str(rows[n][17])]
        want = cells[0]
        for a, b in zip(cells, cells[1:]):
            want += ("\n" if ";" in (a[0], b[0]) else " ") + b
        assert line == want
    plan = spark.range(8).select(*[F.col("id").cast("string").alias(s) for s in names])
    code = plan.select(render.row(plan, names).alias("line"))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    )
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000
