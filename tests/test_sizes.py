"""What a query sends to the driver, and what it leaves on disk, does not grow with its files."""

import datetime
import gzip
import os
import time

import pytest

from cif_lake.plans import editing, relational, scans
from cif_lake.sources import large, read, write


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(2020, 1, 2)
    made = [(k, k * 3, "OFP"[k % 3], 100.5 + k, day, f"{1 + k % 5}-X") for k in range(1, 80)]
    frame = spark.createDataFrame(made, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    frame.write.parquet(f"{folder}/orders.parquet")
    made = [(k, f"Customer#{k}", k % 25, 1.5 * k, "MACHINERY") for k in range(40)]
    frame = spark.createDataFrame(made, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    frame.write.parquet(f"{folder}/customer.parquet")
    return folder


def executed(frame):
    rows = sorted(map(tuple, frame.collect()))
    return rows, frame._jdf.queryExecution().executedPlan().toString()


def test_categories_of_files_are_not_broadcast(spark, orders, monkeypatch):
    """Spark guesses the size of the categories from the columns of the table, and would build its hash table of them."""
    rows, plan = executed(scans.list_relationships(spark, orders))
    assert "BuildLeft" not in plan and "BuildRight" in plan
    assert len(rows) == sum(2 + (k % 5 != 0) + (k % 7 != 0) for k in range(1, 80))
    monkeypatch.setattr(read, "BROADCAST_LINKS", 1)
    again, plan = executed(scans.list_relationships(spark, orders))
    assert again == rows and "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_dealt_files_are_read_as_they_are(spark, tmp_path, monkeypatch):
    texts = {f"a/{n}{'.cif.gz' if n % 3 == 0 else '.cif'}": f"data_{n}\n_e.id é{n}\n" * (n % 4) for n in range(50)}
    frame = spark.createDataFrame(list(texts.items()), "path string, content string")
    write.write_files(frame, f"file://{tmp_path}", folders=8)
    # What a lost task has left is no file.
    (tmp_path / "3").mkdir(exist_ok=True)
    (tmp_path / "3" / "1.cif.0a1b2c3d.tmp").write_text("data_ha")
    monkeypatch.setattr(read, "READ_FILES", 3)
    got = read.dealt_files(spark, f"file://{tmp_path}", 8)
    inside = lambda path: path.removeprefix(f"file:{tmp_path}/").split("/", 1)[1]
    assert {inside(r.path): plain(r.content) for r in got.collect()} == {p: t.encode() for p, t in texts.items()}
    whole = read.source(spark, f"file://{tmp_path}/*/a/*")
    # Spark's reader leaves empty files out.
    assert sorted((n, p, bytes(c)) for n, p, c in got.collect() if c) == sorted((n, p, bytes(c)) for n, p, c in whole.collect())


def plain(content):
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else bytes(content)


def test_files_are_listed_by_tasks(spark, orders):
    """The status of every file, held by Spark's readers, does not fit the driver where files are millions."""
    names, plan = executed(relational.read_whole_file(spark, orders))
    assert [n for n, _ in names] == sorted(f"{k}.cif" for k in range(40)) and "binaryFile" not in plan
    assert dict(names)["7.cif"].endswith("B 2 'MACHINERY'\n")


def test_written_blocks_are_listed_by_tasks_and_parsed_once(spark, orders):
    rows, plan = executed(editing.write_block(spark, orders).select("t", "fkey", "id"))
    assert {t for t, _, _ in rows} == {"atom_site", "entity", "struct_asym"} and "binaryFile" not in plan
    assert sorted(i for t, _, i in rows if t == "atom_site") == sorted(str(k) for k in range(1, 80) if k % 13 == 0 or k * 3 % 2 == 0)
    assert plan.split("== Initial Plan ==")[0].count("MapInArrow") == 1


def test_large_file_leaves_no_copies(spark, tmp_path, monkeypatch):
    """The parts of the file are held compressed, the shuffles of what is written and the pieces go."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffled = lambda: sum(os.path.getsize(f) for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and os.path.exists(f))
    before, dropped, drop = shuffled(), {}, write.drop_folder

    def seen(session, folder):
        at = folder.removeprefix("file:")
        dropped[folder] = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(at) for f in names if not f.startswith((".", "_")))
        drop(session, folder)

    monkeypatch.setattr(write, "drop_folder", seen)
    lines = spark.range(20_000).selectExpr("id", "CASE WHEN id % 5000 = 4000 THEN NULL WHEN id = 0 THEN 'data_x\nloop_\n_v.a' ELSE concat('é ''', id % 10, '''') END AS line")
    write.write_lines(lines.orderBy("id").select("line"), f"file://{tmp_path}/in", "all.cif")
    want = ["data_x\nloop_\n_v.a" if n == 0 else "" if n % 5000 == 4000 else f"é '{n % 10}'" for n in range(20_000)]
    text = (tmp_path / "in" / "all.cif").read_bytes()
    assert text == "".join(f"{line}\n" for line in want).encode()
    assert 0 < sum(dropped.values()) < len(text) / 2
    # What stays is of the few rows that say where the parts go; the files go in the background.
    for _ in range(50):
        if shuffled() - before < len(text) / 10:
            break
        time.sleep(0.2)
    assert shuffled() - before < len(text) / 10
    found = large.index(spark, f"{tmp_path}/in", f"{tmp_path}/index")
    assert sorted(os.listdir(tmp_path / "index")) == ["parts", "records", "units"] and len(dropped) == 2
    assert large.row_counts(found).select("category", "n_rows").collect() == [("v", 2 * 19_995)]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
