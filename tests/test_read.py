"""Reader: tokens, blocks, files, schemas, types and errors, each on a text made for it."""

import gzip

import pytest
from pyspark.sql import functions as F

from cif_lake.plans import corpus
from cif_lake.sources import read
from cif_lake.sources.dictionary import Dictionary


def rows(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


def cells(source, body, category="v", **options):
    """Rows of one category of a text, as tuples in the order of the items."""
    return [tuple(r) for r in read.scan(source("data_t\n" + body), category, column_source="files", filename=False, **options).collect()]


def test_tokens(source):
    # (token as written, value)
    tokens = [
        ("word", "word"), ("12", "12"), ("'two words'", "two words"), ('"with \' inside"', "with ' inside"), ("'don't'", "don't"), ("O5'", "O5'"),
        ("a#b", "a#b"), ("\n;first\n second\n;", "first\n second"), ("\n;\n;", ""), ("'''a 'quoted' word'''", "a 'quoted' word"), ('"""two\nlines"""', "two\nlines"),
        (";x", ";x"), ("'?'", "?"), ("?", None), (".", None), ("'.'", "."), ("'#'", "#"),
    ]
    body = "loop_\n_v.x\n" + "".join(f" {written} # remark 'x\n" for written, _ in tokens)
    assert cells(source, body) == [(value,) for _, value in tokens]


def test_key_value_pairs(source):
    body = "_v.a 1\n_v.b\n\n# here\n 'on a later line'\n_v.none\n_v.field\n;of\ntext\n;\n_v.LAST z\n"
    assert cells(source, body) == [("1", "on a later line", None, "of\ntext", "z")]


def test_loops(source):
    assert cells(source, "loop_\n_v.a\n_v.b\n1 2 3\n4\n5 6\n") == [("1", "2"), ("3", "4"), ("5", "6")]
    assert cells(source, "loop_\n_v.a\n_v.b\n1 2\n3\n") == [("1", "2"), ("3", None)]
    assert cells(source, "loop_\n_v.a\n_v.b\n_w.c 1\n") == []
    assert cells(source, "loop_ # why not\n_v.a\n# nor here\n1\n2") == [("1",), ("2",)]
    assert cells(source, "loop_\n_v.a\n_v.b\n1 _odd\n2 loop_\n") == [("1", "_odd"), ("2", "loop_")]
    assert cells(source, "_v.a first\n_w.x 1\n_v.a second\n") == [("first",)]


def test_long_cells_and_counts(source):
    text = "data_t\n_one.k 'v w'\nloop_\n_two.x\n_two.y\n1 ?\n2 'b'\n3\n"
    found = {(r["category"], r["row_id"], r["item"]): r["value"] for r in read.long_cells(source(text)).collect()}
    assert found == {
        ("one", 0, "k"): "v w", ("two", 0, "x"): "1", ("two", 0, "y"): None, ("two", 1, "x"): "2", ("two", 1, "y"): "b", ("two", 2, "x"): "3", ("two", 2, "y"): None,
    }
    assert dict(rows(read.row_counts(source(text)), "category", "n_rows")) == {"one": 1, "two": 3}


STATIONS = {
    "north.cif": "data_n\nloop_\n_atom_site.Cartn_y\n_atom_site.id\n0.5 n1\n1.5 n2\n_cell.entry_id N\n",
    "south.cif": "data_s\nloop_\n_ATOM_SITE.ID\n_ATOM_SITE.occupancy\ns1 0.25\n_entry.id S\n_entry.mood calm\n",
    "west.cif": "data_w\n_atom_site.id\n_cell.entry_id W\n",
    "east.cif": "data_e\n_entry.id E\n",
}


def test_items_of_all_files(source):
    src = source(STATIONS)
    assert read.present_items(src, "atom_site") == ["Cartn_y", "id", "occupancy"]
    got = read.scan(src, "atom_site", column_source="files", row_id=True).orderBy("file_ord", "row_id")
    assert rows(got, "id", "Cartn_y", "occupancy", "filename") == [
        ("n1", 0.5, None, "north.cif"), ("n2", 1.5, None, "north.cif"), ("s1", None, 0.25, "south.cif"), (None, None, None, "west.cif"),
    ]


def test_items_of_the_dictionary(source):
    src = source(STATIONS)
    scanned = read.scan(src, "atom_site")
    assert {"id", "Cartn_x", "label_seq_id", "filename"} <= set(scanned.columns) and scanned.columns == sorted(scanned.columns[:-1]) + ["filename"]
    assert dict(scanned.dtypes)["label_seq_id"] == "bigint" and scanned.count() == 4
    assert read.scan(src, "refine").count() == 0
    assert rows(read.unknown_items(src, "entry", Dictionary.seed(src.sparkSession)), "path", "item") == [("south.cif", "mood")]


@pytest.mark.parametrize(
    "category, options, fault",
    [
        ("entry", {}, "mood"),
        ("weather", {}, "not in the dictionary"),
        ("weather", {"column_source": "files"}, "not present"),
        ("cell", {"columns": ["colour"]}, "no such items"),
        ("cell", {"column_source": "guess"}, "column_source"),
    ],
)
def test_schema_errors(source, category, options, fault):
    with pytest.raises(Exception, match=fault):
        read.scan(source(STATIONS), category, **options).collect()


def test_scan_many_as_single_scans(source):
    src = source({k: v.replace("_entry.mood calm\n", "") for k, v in STATIONS.items()})
    wanted = {"atom_site": ["id", "Cartn_y"], "entry": ["id"], "cell": ["entry_id"]}
    many = read.scan_many(src, wanted, row_id=True)
    for category, items in wanted.items():
        alone = read.scan(src, category, columns=items, row_id=True)
        mine = many.filter(F.col("category") == category).select(f"{category}.*", "file_ord", "block_ord", "row_id", "filename")
        assert sorted(map(str, mine.collect())) == sorted(map(str, alone.collect()))
    plan = many.groupBy("filename").agg(F.min("entry.id"), F.max("atom_site.Cartn_y"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 2 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    with pytest.raises(Exception, match="mood"):
        read.scan_many(source(STATIONS), wanted).collect()
    for bad in ({"weather": ["x"]}, {"cell": ["colour"]}):
        with pytest.raises(ValueError):
            read.scan_many(src, bad)


BOOK = "# data_no\ndata_One\n_entry.id 1\n_struct.title\n;data_neither\n;\n_entity.id 7\ndata_two\n_entry.id 'data_quoted'\nloop_\n_struct_asym.id\n_struct_asym.entity_id\nP 7\nQ 7\n_entity.id 7\ndata_\n"


def test_blocks(source):
    src = source(BOOK)
    assert rows(read.list_blocks(src).orderBy("block_ord"), "block_name") == [("One",), ("two",), ("",)]
    ids = lambda block: rows(read.scan(src, "entry", data_block=block), "id")
    assert ids(None) == [("1",)] and ids("TWO") == [("data_quoted",)] and sorted(ids("*")) == [("1",), ("data_quoted",)]
    assert "".join(r[0] for r in rows(read.split_blocks(src).orderBy("block_ord"), "text")) == BOOK.split("\n", 1)[1]
    for text, fault in ((BOOK, "not present"), (BOOK + "data_three\ndata_THREE\n", "ambiguous")):
        with pytest.raises(Exception, match=fault):
            read.scan(source(text), "entry", data_block="three").collect()


def test_opening_a_block(source):
    src, seed = source(BOOK), None
    seed = Dictionary.seed(src.sparkSession)
    tables = read.open_block(src, seed, "two", views="book_")
    assert {k: v.count() for k, v in tables.items() if k} == {"entry": 1, "struct_asym": 2, "entity": 1}
    assert rows(src.sparkSession.sql("SELECT id, entity_id FROM book_struct_asym ORDER BY id"), "id", "entity_id") == [("P", "7"), ("Q", "7")]
    tables[""].unpersist()
    assert rows(read.list_relationships(src, seed, "two"), "parent_table", "child_table") == [("entity", "struct_asym")]


DOUBLES = {"1.5": 1.5, "-.5": -0.5, "+2.": 2.0, "1e3": 1000.0, "2E-1": 0.2, "' 7 '": 7.0, "inf": float("inf"), "-Infinity": float("-inf")}
NO_DOUBLES = ["1.5d", "2f", "0x1p3", "1e400", "1_0", "1,5", "1.2(3)", "--1", "e5", ".", "''"][:-2] + ["'1 2'", "infinit"]
WHOLES = {"12": 12, "-3": -3, "+4": 4, "2.5": 3, "-2.5": -3, "2.49999999999999999999999": 2, "0.49999999999": 0, "1e2": 100, "9223372036854775807": 2**63 - 1, "' 8 '": 8}
NO_WHOLES = ["99999999999999999999", "9223372036854775808", "1e30", "0x10", "1l", "nan", "abc"]


@pytest.mark.parametrize("item, good, bad", [("Cartn_x", DOUBLES, NO_DOUBLES), ("label_seq_id", WHOLES, NO_WHOLES)])
def test_numbers(source, item, good, bad):
    text = f"data_t\nloop_\n_atom_site.{item}\n"
    read_back = lambda written, **options: [r[0] for r in rows(read.scan(source(text + "\n".join(written) + "\n"), "atom_site", **options), item)]
    assert read_back(good) == list(good.values())
    assert read_back(bad, on_malformed="null") == [None] * len(bad)
    for one in bad:
        with pytest.raises(Exception, match=f"malformed .* in atom_site.{item} of f.cif"):
            read_back([one])


def test_nan(source):
    (value,) = (r[0] for r in rows(read.scan(source("data_t\n_atom_site.Cartn_x NaN\n"), "atom_site"), "Cartn_x"))
    assert value != value


def test_paths_globs_and_lists(spark, tmp_path):
    base, deep = str(tmp_path), tmp_path / "2020" / "may"
    deep.mkdir(parents=True)
    entry = "data_x\n_entry.id {}\n".format
    (tmp_path / "top.cif").write_text(entry("top"))
    (tmp_path / "with[set].cif").write_text(entry("set"))
    (deep / "low.cif").write_text(entry("low"))
    (deep / "packed").write_bytes(gzip.compress(entry("packed").encode()))
    ids = lambda paths: sorted(r[0] for r in rows(read.scan_paths(spark, paths, "entry"), "id"))
    assert ids(f"{base}/*.cif") == ["set", "top"]
    assert ids(f"{base}/**/*.cif") == ["low", "set", "top"]
    assert ids(f"{base}/with[set].cif") == ["set"]
    assert ids(f"{base}/2020/may/packed") == ["packed"]
    assert ids([f"{base}/top.cif", f"{base}/top.cif"]) == ["top", "top"]
    named = lambda paths: "filename" in read.scan_paths(spark, paths, "entry").columns
    assert not named(f"{base}/top.cif") and named(f"{base}/*.cif") and named([f"{base}/top.cif", f"{base}/2020/may/packed"])
    for bad in ([], [None], f"{base}/**/*.none"):
        with pytest.raises(ValueError):
            read.source(spark, bad)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read.scan_paths(spark, f"{base}/no*.cif", "entry")


def test_one_cut_for_filters_on_several_columns(source):
    scanned = read.scan(source(STATIONS), "atom_site").filter("Cartn_y > 1 AND id LIKE 'n%' AND label_seq_id IS NULL")
    plan = scanned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(row#") == 1
    assert rows(scanned, "id") == [("n2",)]


def test_size_costs_no_stack(spark):
    """A loop of many rows and a text field of megabytes."""
    n = 80_000
    lines = f"transform(sequence(1, {n}), i -> concat(i, CASE WHEN i % 2 = 0 THEN ' \\'it\\'s\\' ' ELSE ' plain ' END, i % 11))"
    field = "repeat('words _tag loop_ \\' \" #\\n', 90000)"
    content = f"concat('data_b\\nloop_\\n_v.n\\n_v.w\\n_v.m\\n', array_join({lines}, '\\n'), '\\n_w.x\\n;', {field}, '\\n;\\n_u.id 7\\n')"
    src = spark.range(1).selectExpr("0 AS file_ord", "'big' AS path", f"{content} AS content")
    got = read.scan(src, "v", column_source="files").agg(F.count("*"), F.sum(F.col("n").cast("long")), F.count_if(F.col("w") == "it's"), F.max(F.col("m").cast("int")))
    assert tuple(got.first()) == (n, n * (n + 1) // 2, n // 2, 10)
    assert read.scan(src, "w", column_source="files").select(F.length("x")).first()[0] == 90_000 * len("words _tag loop_ ' \" #\n")
    assert rows(read.scan(src, "u", column_source="files"), "id") == [("7",)]


def test_gzip_goes_to_python_by_rows(spark, source):
    """Batches of Arrow would hold the texts of thousands of files, however large, in one Python process."""
    src = corpus.zipped(source({f"{n}.cif": f"data_a\n_entry.id {n}\n" for n in range(7)}), F.col("file_ord") % 2 == 0)
    found = read.scan(src, "entry", columns=["id"])
    assert "Arrow" not in found._jdf.queryExecution().executedPlan().toString()
    ends = {0: ".cif.gz", 1: ".cif"}
    assert rows(found, "filename", "id") == sorted((f"{n}{ends[n % 2]}", str(n)) for n in range(7))
    assert [bytes(r["content"])[:2] == b"\x1f\x8b" for r in src.orderBy("file_ord").collect()] == [n % 2 == 0 for n in range(7)]


def test_list_relationships_parses_once(spark, source):
    """One parse of the text, and the links of a path named twice come twice."""
    text = "data_a\n_entry.id 1\n_struct.entry_id 1\ndata_b\n_exptl.entry_id 1\n"
    src = spark.createDataFrame([(0, "f.cif", text), (1, "f.cif", text)], "file_ord int, path string, content string")
    found = read.list_relationships(src, Dictionary.seed(spark))
    lexed = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if " AS lex#" in line]
    assert sum("regexp_extract_all(" in line for line in lexed) == 1
    assert rows(found, "path", "parent_table", "child_table") == [("f.cif", "entry", "struct")] * 2
    both = read.list_relationships(src, Dictionary.seed(spark), "*")
    assert sorted(rows(both, "parent_table", "child_table")) == [("entry", "exptl")] * 2 + [("entry", "struct")] * 2


def test_scan_apart_parses_once(source):
    """The frames are those of single scans, and none of them holds the parse."""
    src = source(STATIONS)
    wanted = {"atom_site": ["id", "Cartn_y"], "Cell": ["entry_id"]}
    apart = read.scan_apart(src, wanted, row_id=True)
    for category, items in wanted.items():
        columns = [*items, "row_id", "filename"]
        assert apart[category].columns == columns
        assert sorted(rows(apart[category], *columns), key=str) == sorted(rows(read.scan(src, category, columns=items, row_id=True), *columns), key=str)
        assert "regexp_extract_all" not in apart[category]._jdf.queryExecution().optimizedPlan().toString()
