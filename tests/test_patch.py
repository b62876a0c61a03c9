"""Write-back. Each case states one rule; the texts of all cases are patched in one job and compared byte by byte."""

import pytest

from cif_lake.operators import patch
from cif_lake.sources import read

EDITS = "path string, block_name string, category string, op string, row_id long, item string, value string"

# A shop, not a molecule: a key-value category, a loop, and comments in all places.
SHOP = (
    "# written by hand\ndata_shop\n_owner.name 'Ada B.'   # since May\n_owner.since 1999\n\nloop_\n_stock.code\n_stock.label\n_stock.price\n"
    "a1 tea 2.50\nb2   'green tea' 3\n# seasonal\nc3 \"mum's mix\" 4\n#\n"
)
HEAD = "data_q\nloop_\n_q.a\n_q.b\n"


def change(category, row, item, value, block=None):
    return (block, category, "update", row, item, value)


def drop(category, *rows, block=None):
    return [(block, category, "delete", row, None, None) for row in rows]


def new(category, row, block=None, **cells):
    return [(block, category, "insert", row, item, value) for item, value in cells.items()]


# rule: (text, edits, [(old, new), ...]) where the pieces of text that change are named, nothing else may.
RULES = {
    "a cell of a loop": (SHOP, [change("stock", 1, "price", "3.20")], [("'green tea' 3\n", "'green tea' 3.20\n")]),
    "names in any case": (SHOP, [change("STOCK", 0, "Label", "coffee")], [("a1 tea", "a1 coffee")]),
    "a value that needs quotes": (SHOP, [change("stock", 0, "label", "black tea")], [("a1 tea 2", "a1 'black tea' 2")]),
    "a value that loses its quotes": (SHOP, [change("stock", 2, "label", "mix")], [('"mum\'s mix"', "mix")]),
    "a null": (SHOP, [change("stock", 0, "price", None)], [("2.50", "?")]),
    "text that looks like a null": (SHOP, [change("stock", 0, "label", "?")], [("tea 2.50", "'?' 2.50")]),
    "a key-value cell before a comment": (SHOP, [change("owner", 0, "name", "Eve")], [("'Ada B.'   # since", "Eve   # since")]),
    "several cells of a row": (SHOP, [change("stock", 1, "code", "B"), change("stock", 1, "label", "x")], [("b2   'green tea'", "B   x")]),
    "a first row goes": (SHOP, drop("stock", 0), [("a1 tea 2.50\n", "")]),
    "a row goes, the comment in front of it stays": (SHOP, drop("stock", 2), [("c3 \"mum's mix\" 4\n", "")]),
    "all rows go": (SHOP, drop("stock", 0, 1, 2), [("a1 tea 2.50\nb2   'green tea' 3\n", ""), ("c3 \"mum's mix\" 4\n", "")]),
    "a new last row": (SHOP, new("stock", 0, code="d4", label="ice tea", price="5"), [("mix\" 4\n", "mix\" 4\nd4 'ice tea' 5\n")]),
    "new rows in their order": (SHOP, [*new("stock", 7, code="z"), *new("stock", 3, code="y")], [("mix\" 4\n", "mix\" 4\ny ? ?\nz ? ?\n")]),
    "a value of two lines": (SHOP, [change("owner", 0, "since", "one\ntwo")], [("_owner.since 1999\n", "_owner.since \n;one\ntwo\n;\n")]),
    "a row of a line that others share": ("data_q\nloop_\n_q.a\n_q.b\n 1 2  3 4\n5 6\n", drop("q", 1), [(" 1 2  3 4\n", " 1 2\n")]),
    "a new row without a line end before it": (HEAD + "1 2", new("q", 0, a="3", b="4"), [("1 2", "1 2\n3 4\n")]),
    "into a loop without rows": ("data_q\nloop_\n_q.a\n_r.x 1\n", new("q", 0, a="7"), [("_q.a\n", "_q.a\n7\n")]),
    "a second row makes a loop": (
        "data_q\n_q.a 1\n_q.b 2\n", new("q", 0, a="3", b="4"), [("_q.a 1\n_q.b 2\n", "loop_\n_q.a\n_q.b\n 1\n 2\n3 4\n")]
    ),
    "one row for another": ("data_q\n_q.a 1\n_q.b 2\n", [*drop("q", 0), *new("q", 0, a="8", b="9 9")], [("_q.a 1\n_q.b 2\n", "_q.a 8\n_q.b '9 9'\n")]),
    "a tag without its value": ("data_q\n_q.a\n_q.b 2\n", [change("q", 0, "a", "v")], [("_q.a\n", "_q.a v\n")]),
    "line ends of the file": (
        "data_q\r\nloop_\r\n_q.a\r\n_q.b\r\n1 2\r\n", [change("q", 0, "b", "x\ny"), *new("q", 0, a="5")], [("1 2\r\n", "1 \r\n;x\ny\r\n;\r\n5 ?\r\n")]
    ),
    "the first block unless one is named": ("data_u\n_q.a 1\ndata_V\n_q.a 1\n", [change("q", 0, "a", "2")], [("data_u\n_q.a 1", "data_u\n_q.a 2")]),
    "a named block": ("data_u\n_q.a 1\ndata_V\n_q.a 1\n", [change("q", 0, "a", "2", block="v")], [("data_V\n_q.a 1", "data_V\n_q.a 2")]),
    "letters beyond ASCII": (SHOP, [change("owner", 0, "since", "größe")], [("1999", "größe")]),
    "a cut-short row in front of a new one": (HEAD + "1 x\n2\n", new("q", 0, a="3", b="z"), [("2\n", "2 ?\n3 z\n")]),
    "a missing cell of a cut-short row": (HEAD + "1 x\n2 # end\n", [change("q", 1, "b", "y")], [("2 # end", "2 y # end")]),
    "another cell of a cut-short row": (HEAD + "1 x\n2\n", [change("q", 1, "a", "9")], [("2\n", "9\n")]),
    "several values missing": ("data_q\nloop_\n_q.a\n_q.b\n_q.c\n1\n", [change("q", 0, "c", "3")], [("1\n", "1 ? 3\n")]),
}


def expected(text, changes):
    for old, replacement in changes:
        assert text.count(old) == 1, old
        text = text.replace(old, replacement)
    return text


def run(spark, source, cases):
    edits = spark.createDataFrame([(path, *e) for path, (_, es) in cases.items() for e in es], EDITS)
    out = patch.patch_files(source({path: text for path, (text, _) in cases.items()}), edits).collect()
    return {r["path"]: bytes(r["content"]).decode() for r in out}


@pytest.fixture(scope="module")
def patched(spark, source):
    return run(spark, source, {rule: (text, edits) for rule, (text, edits, _) in RULES.items()})


@pytest.mark.parametrize("rule", RULES)
def test_rule(patched, rule):
    text, _, changes = RULES[rule]
    assert patched[rule] == expected(text, changes)


def test_files_without_edits_are_not_returned(spark, source):
    cases = {"a": (SHOP, [change("owner", 0, "since", "2000")]), "b": (SHOP, [])}
    assert list(run(spark, source, cases)) == ["a"]


def test_other_bytes_survive(spark):
    content = b"data_q\n# caf\xe9 \xff\n_q.a 1\n"
    src = spark.createDataFrame([(0, "f", bytearray(content))], "file_ord int, path string, content binary")
    out = patch.patch_files(src, spark.createDataFrame([("f", *change("q", 0, "a", "2"))], EDITS)).collect()
    assert bytes(out[0]["content"]) == content.replace(b"q.a 1", b"q.a 2")


FAULTS = {
    "no such file": [("elsewhere", *change("stock", 0, "price", "1"))],
    "no block none": [("f", *change("stock", 0, "price", "1", block="none"))],
    "is not in the block": [("f", *change("nothing", 0, "price", "1"))],
    "no item colour": [("f", *change("stock", 0, "colour", "red"))],
    "no item size": [("f", *e) for e in new("stock", 0, code="x", size="9")],
    "no row 3": [("f", *change("stock", 3, "price", "1"))],
    "no row 17": [("f", *e) for e in drop("stock", 17)],
    "no row -1": [("f", *e) for e in drop("stock", -1)],
    "no row 1 in owner": [("f", *change("owner", 1, "since", "1"))],
    "without a row_id": [("f", *change("stock", None, "price", "1"))],
    "without an item": [("f", *change("stock", 0, None, "1"))],
    "two operations": [("f", *change("stock", 0, "price", "1")), *[("f", *e) for e in drop("stock", 0)]],
    "two operations on row 1": [("f", *e) for e in drop("stock", 1, 1)],
    "two values": [("f", *change("stock", 0, "price", "1")), ("f", *change("stock", 0, "PRICE", "2"))],
    "unknown operation": [("f", None, "stock", "replace", 0, "price", "1")],
    "cannot write": [("f", *change("stock", 0, "label", "a\n;b"))],
}


@pytest.mark.parametrize("fault", [f for f in FAULTS if f != "cannot write"])
def test_an_edit_without_a_place_stops_the_job(spark, source, fault):
    """One good edit and the faulty ones: none gets through."""
    good = ("f", *change("owner", 0, "since", "2001"))
    with pytest.raises(Exception, match=fault):
        patch.patch_files(source({"f": SHOP}), spark.createDataFrame([good, *FAULTS[fault]], EDITS)).collect()


@pytest.mark.parametrize("fault", ["no row 3", "cannot write"])
def test_nothing_is_written_then(spark, source, fault):
    with pytest.raises(Exception, match=fault):
        patch.patch_files(source({"f": SHOP}), spark.createDataFrame(FAULTS[fault], EDITS)).collect()


def test_an_ambiguous_block(spark, source):
    text = "data_u\n_q.a 1\ndata_U\n_q.a 2\n"
    with pytest.raises(Exception, match="ambiguous"):
        patch.patch_files(source({"f": text}), spark.createDataFrame([("f", *change("q", 0, "a", "3", block="u"))], EDITS)).collect()


def test_what_is_written_reads_back(spark, source):
    awkward = ["plain", "two words", "it's", 'say "x"', "both ' and \"", "_tag", "#no comment", "data_x", "loop_", "a\nb", "; semicolon", ".", "?", "é漢"]
    text = HEAD + "".join(f"{i} v{i}\n" for i in range(len(awkward)))
    edits = spark.createDataFrame([("f", *change("q", i, "b", v)) for i, v in enumerate(awkward)], EDITS)
    out = patch.patch_files(source({"f": text}), edits)
    rows = read.scan(out, "q", column_source="files", filename=False, row_id=True).orderBy("row_id").collect()
    assert [r["b"] for r in rows] == awkward


def test_the_text_is_not_shuffled(spark, source, monkeypatch):
    """Edits that were measured to be small go to the files; larger ones meet them by a shuffle, with the same result."""
    src = source({"f": SHOP, "g": SHOP}).repartition(2)
    edits = spark.createDataFrame([("f", *change("stock", 1, "price", "7")), ("g", *change("owner", 0, "since", "2"))], EDITS)
    small = patch.patch_files(src, edits)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    expected = sorted((r["path"], bytes(r["content"])) for r in small.collect())
    monkeypatch.setattr(patch, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(patch.F, "broadcast", None)
    assert sorted((r["path"], bytes(r["content"])) for r in patch.patch_files(src, edits).collect()) == expected


def test_overlapping_splices_stop_the_job(spark):
    one = "named_struct('begin', {}, 'width', {}, 'text', '{}')"
    frame = spark.range(1).selectExpr("'f' AS path", "'abcdef' AS t", f"array({one.format(2, 2, 'X')}, {one.format(4, 0, 'Y')}, {one.format(6, 1, '')}) AS cuts")
    assert frame.selectExpr(patch.spliced("t", "cuts")).first()[0] == "aXYde"
    clash = frame.selectExpr("path", "t", f"array({one.format(2, 3, 'X')}, {one.format(4, 1, 'Y')}) AS cuts")
    with pytest.raises(Exception, match="overlap in f"):
        clash.selectExpr(patch.spliced("t", "cuts")).collect()


def test_rows_between_edits_keep_their_bytes(spark, source):
    """Few edits in a long loop: first, last and some rows in between."""
    lines = [f"{i}{' ' * (1 + i % 4)}'v {i}'\t\n" if i % 9 == 0 else f"{i} v{i}\n" for i in range(3000)]
    picked = [0, 1, 700, 1499, 2998, 2999]
    edits = [e for i in picked for e in ([change("q", i, "b", "new")] if i % 2 else drop("q", i))]
    out = run(spark, source, {"f": (HEAD + "".join(lines), edits)})["f"]
    assert out == HEAD + "".join(line if i not in picked else f"{i} new\n" if i % 2 else "" for i, line in enumerate(lines))


def test_the_edits_of_patch_files_parse_a_text_once(spark, tmp_path, monkeypatch):
    """Updates of one category and deletes of another come from one pass; the key of a deleted row is even, values are one higher."""
    from cif_lake.functions import grammar
    from cif_lake.plans import editing

    rows = [(k, 1.5 * k, f"2020-01-{1 + k:02d}", "1-URGENT") for k in range(1, 25)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_totalprice double, day string, o_orderpriority string").selectExpr("*", "CAST(day AS date) AS o_orderdate")
    orders.drop("day").write.parquet(str(tmp_path / "orders.parquet"))
    held = []
    monkeypatch.setattr(editing.patch, "patch_files", lambda src, edits: held.append(edits) or src)
    editing.patch_files(spark, str(tmp_path))
    assert held[0]._jdf.queryExecution().optimizedPlan().toString().count(grammar.LEXEME[:12]) == 1
    found = {(r["path"], r["category"]): (r["op"], r["row_id"], r["item"], r["value"]) for r in held[0].collect()}
    want = {}
    for k, price, _, _ in rows:
        path = f"entries/{k}.cif"
        want[path, "struct"] = ("update", 0, "title", f"changed\norder {k}")
        if k % 5:
            want[path, "refine"] = ("update", 0, "ls_d_res_high", str(price + 1))
        if k % 7 and k % 2 == 0:
            want[path, "pdbx_database_status"] = ("delete", 0, None, None)
    assert found == want
