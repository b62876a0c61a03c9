"""Queries that read several categories of a corpus parse its texts once: what they return reads the stored rows."""

import datetime

import pytest

from cif_lake.plans import relational, structural


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(2020, 1, 2)
    made = [(k, k * 3, "OFP"[k % 3], 100.5 + k, day, f"{1 + k % 5}-X") for k in range(1, 80)]
    frame = spark.createDataFrame(made, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    frame.write.parquet(f"{folder}/orders.parquet")
    return folder


def parses(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")


def test_join_left(spark, orders):
    out = relational.join_left(spark, orders)
    assert parses(out) == 0
    assert sorted(map(tuple, out.collect())) == sorted((f"O{k}", 100.5 + k if k % 5 else None) for k in range(1, 80))


def test_entry_summary(spark, orders):
    out = structural.entry_summary(spark, orders)
    assert parses(out) == 0
    assert {r["id"]: r["resolution"] for r in out.collect()} == {f"O{k}": 100.5 + k if k % 5 else None for k in range(1, 80)}


def test_structure_tables(spark, orders):
    tables = structural.structure_tables(spark, orders)
    assert all(parses(t) == 0 for t in tables.values())
    assert tables["struct_ref"].count() == 79


def test_tags_are_cut_without_regular_expressions(spark):
    """As the regular expressions would: white space of six kinds behind the word goes, any other character stays."""
    import re

    from cif_lake.functions import grammar as g

    words = ["_a.b", "_a.b.c", "_a.", "_.b", "_ab", "_a.puff", "_A.B\x1c", "_a.b\xa0", "_ä.é", "_a.b\x85", "_a.u000b"]
    spaces = ["", " ", "\n", "\r\n", "\t", "\x0b", "\x0c", " \n \t\x0b\x0c\r", "f"]
    starts = ["data_x", "DATA_", "Loop_\n", "save_", "stop_ ", "Global_", "global", "globals_x", "data", "x_", "", "'_a'"]
    texts = [w + s for w in words for s in spaces] + starts
    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    assert "regexp_extract" not in g.tag_part("x", 2) and "RLIKE" not in g.may_be_structural("x")
    for r in frame.selectExpr("x", f"{g.tag_part('x', 2)} AS item", f"{g.may_be_structural('x')} AS may").collect():
        found = re.match(r"(?s)^[^.]*\.([^ \t\n\x0b\f\r]*)", r.x)
        if "." in r.x and r.x.startswith("_"):
            assert r.item == found[1], r.x
        assert r.may or not re.match(r"(?:_|(?i:data_|loop_|save_|stop_|global_))", r.x), r.x
