"""Dictionary compile jobs, on a small vocabulary of a library made for the tests."""

import pytest

from cif_lake.sources import dictionary as d


def pairs(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def category(name, key=None, **more):
    """Frame of a category."""
    lines = [f"save_{name}", f"_category.id {name}"]
    if key:
        lines.append(f"_category_key.name '_{name}.{key}'")
    lines += [f"_category.{item} {value}" for item, value in more.items()]
    return "\n".join([*lines, "save_", ""])


def item(name, code=None, parents=()):
    """Frame of an item; ``parents`` are linked by a loop."""
    lines = [f"save__{name}", f"_item.name '_{name}'"]
    if code:
        lines.append(f"_item_type.code {code}")
    if parents:
        lines += ["loop_", "_item_linked.parent_name", "_item_linked.child_name", *[f"'{p}' '_{name}'" for p in parents]]
    return "\n".join([*lines, "save_", ""])


def test_types_of_items(source):
    codes = {"int": "bigint", "float": "double", "line": "string", "code": "string", "positive_int": "bigint"}
    text = "data_lib\n_dictionary.version 7.2\n" + category("shelf", "no") + "".join(item(f"shelf.{c}", c) for c in codes)
    frames = d.dict_frames(source(text)).cache()
    assert pairs(d.dict_item_types(frames), "item", "dtype") == sorted((f"_shelf.{c}", t) for c, t in codes.items())
    assert pairs(d.dict_categories(frames), "key", "category") == [("shelf", "shelf")]
    assert pairs(d.dict_versions(frames), "version") == [("7.2",)]


def test_links_of_items(source):
    """From a loop of a frame, from a pair, and from a list outside of all frames; unknown parents are not links."""
    text = "data_lib\n" + category("book", "id") + category("loan", "id") + item("book.id") + item("loan.book", parents=["_book.id", "?"])
    text += "save__loan.copy\n_item.name '_loan.copy'\n_item_linked.parent_name '_book.id'\n_item_linked.child_name '_loan.copy'\nsave_\n"
    text += "loop_\n_pdbx_item_linked_group_list.parent_name\n_pdbx_item_linked_group_list.child_name\n'_book.id' '_loan.first'\n"
    frames = d.dict_frames(source(text)).cache()
    links = pairs(d.dict_relationships(frames), "parent", "child")
    assert {("_book.id", "_loan.book"), ("_book.id", "_loan.first")} <= set(links)
    assert all("?" not in link for link in links)


@pytest.mark.parametrize(
    "tail, fault",
    [
        ("loop_\n_item_linked.child_name\n_item_linked.parent_name\n'_a.b' '_c.d' '_a.e'\n", "incomplete loop"),
        ("_item.name\n_item_type.code int\n", "missing value"),
        ("_item_description.description \"open\n", "unterminated"),
        ("_item_description.description\n;never closed\n", "unterminated"),
    ],
)
def test_malformed_sources(source, tail, fault):
    with pytest.raises(Exception, match=fault):
        d.dict_frames(source("data_lib\n" + item("a.b", "int") + tail)).collect()


SOURCES = [("main", 0, "doc/main"), ("local", 1, "doc/local"), ("guest", 2, "doc/guest")]


@pytest.fixture(scope="module")
def merge(spark):
    sources = spark.createDataFrame(SOURCES, "source string, priority int, documentation_url string")

    def run(rows, reviewed=None):
        items = spark.createDataFrame(rows, "source string, item string, dtype string")
        resolutions = reviewed and spark.createDataFrame(reviewed, "key string, types map<string,string>, use string")
        return items, sources, resolutions, lambda: pairs(d.dict_merge(items, sources, resolutions), "item", "dtype", "url")

    return run


def test_the_first_source_names_an_item(merge):
    *_, merged = merge([("guest", "_Shelf.No", "bigint"), ("local", "_shelf.NO", "bigint"), ("guest", "_x.y", "string")])
    assert merged() == [("_shelf.NO", "bigint", "doc/local"), ("_x.y", "string", "doc/guest")]


TWO = [("main", "_shelf.no", "bigint"), ("local", "_shelf.no", "string")]
SEEN = {"main": "bigint", "local": "string"}


@pytest.mark.parametrize(
    "rows, reviewed, fault",
    [
        (TWO, None, "unresolved"),
        (TWO, [("_shelf.no", {"main": "bigint", "local": "double"}, "main")], "unresolved"),
        (TWO, [("_shelf.no", SEEN, "guest")], "invalid"),
        ([("main", "_shelf.no", "bigint")], [("_shelf.no", SEEN, "main")], "stale"),
        (TWO, [("_shelf.no", SEEN, "local")], None),
    ],
)
def test_conflicting_types(merge, rows, reviewed, fault):
    items, _, resolutions, merged = merge(rows, reviewed)
    if fault is None:
        assert merged() == [("_shelf.no", "string", "doc/local")]
        return
    if resolutions is not None:
        assert pairs(d.dict_conflicts(items, resolutions), "status") == [(fault,)]
    with pytest.raises(Exception, match=fault):
        merged()


def test_links_take_the_names_of_the_merge(spark, merge):
    items, sources, _, _ = merge([("main", "_Book.Id", "string")])
    links = spark.createDataFrame([("_BOOK.ID", "_loan.book"), ("_book.id", "_LOAN.Book")], "parent string, child string")
    assert pairs(d.dict_canonical_links(links, d.dict_merge(items, sources)), "parent", "child") in ([("_Book.Id", "_loan.book")], [("_Book.Id", "_LOAN.Book")])


# What a category's key points to, and how many rows it may then have: one, many, or not to be told.
KEYS = {
    "entry": ([], True),
    "reader": ([], False),
    "profile": (["_entry.id"], True),
    "photo": (["_profile.id"], True),
    "visit": (["_reader.id"], False),
    "stamp": (["_visit.id"], False),
    "either": (["_reader.id", "_entry.id"], True),
    "lost": (["_reader.id", "_nowhere.id"], None),
    "unsaid": (["?"], None),
    "aside": (["_reader.nickname"], None),
    "hen": (["_egg.id"], None),
    "egg": (["_hen.id"], None),
}


def test_row_limits_follow_the_keys(source):
    text = "data_lib\n" + "".join(category(c, "id") + item(f"{c}.id", parents=parents) for c, (parents, _) in KEYS.items())
    text += item("reader.nickname") + category("keyless")
    frames = d.dict_frames(source(text)).cache()
    limits = d.dict_row_constraints(d.dict_category_metadata(frames), d.dict_parents(frames), d.dict_item_names(frames))
    got = {r["category"]: r["is_single_row"] for r in limits.collect()}
    assert got == {c: limit for c, (_, limit) in KEYS.items()} | {"keyless": None}


ABOUT = "First line: it's \"all\" here;\n\tsecond \\ line,\n  third."


def test_category_metadata_survives_the_long_form(source):
    text = "data_lib\nsave_shelf\n_category.id shelf\n_category_key.name '_shelf.no'\n_category.mandatory_code no\n_category.description\n;" + ABOUT
    text += "\n;\nloop_\n_category_group.id\nfurniture\nall\nfurniture\nsave_\n" + category("note", description=".", mandatory_code="perhaps")
    meta = d.dict_category_metadata(d.dict_frames(source(text)))
    got = {r["category"]: r for r in meta.collect()}
    assert got["note"]["description"] is None and got["note"]["is_mandatory"] is None and got["note"]["keys"] in (None, [])
    assert got["shelf"]["description"] == ABOUT and got["shelf"]["is_mandatory"] is False and got["shelf"]["keys"] == ["_shelf.no"]
    assert got["shelf"]["groups"] == ["all", "furniture"]
    long = d.dict_long_rows(meta.selectExpr("*", "CAST(NULL AS boolean) AS is_single_row"))
    written = {(r["category"], r["field"]): r["value"] for r in long.collect()}["shelf", "description"]
    assert "\n" not in written and "\t" not in written
    back = {r["category"]: r for r in d.dict_from_long_rows(long).collect()}
    assert all(back["shelf"][c] == got["shelf"][c] for c in ("description", "keys", "is_mandatory"))


def test_compiling_writing_and_loading(spark, source, tmp_path):
    main = "data_main\n_dictionary.version 3\n" + category("Entry", "id", description="'The record'") + item("Entry.id", "int")
    local = "data_local\n_dictionary.version 4\n" + category("entry", description="'Ours'") + category("profile", "id") + item("profile.id", parents=["_ENTRY.id"])
    src = source({"main.dic": main, "local.dic": local})
    sources = spark.createDataFrame([("main.dic", 0, "doc/main"), ("local.dic", 1, "doc/local")], "source string, priority int, documentation_url string")
    compiled = d.compile_dictionary(src, sources)
    meta = {r["category"]: r for r in compiled.category_metadata.collect()}
    assert meta["Entry"]["description"] == "The record" and meta["Entry"]["url"] == "doc/main"
    assert meta["profile"]["is_single_row"] is True and meta["profile"]["url"] == "doc/local"
    assert pairs(compiled.links(), "parent_table", "child_table") == [("Entry", "profile")]
    assert compiled.columns("entry") == ["id"] and compiled.item_type("ENTRY", "Id") == "bigint"
    folder = str(tmp_path / "out")
    d.write_artifacts(compiled, folder)
    loaded = d.read_artifacts(spark, folder)
    assert pairs(loaded.items, "item", "dtype", "url") == pairs(compiled.items, "item", "dtype", "url")
    lines = [r[0] for r in spark.read.text(f"{folder}/types").collect()]
    assert sorted(lines) == sorted(f"{i}\t{t}" for i, t in pairs(compiled.items, "item", "dtype"))


@pytest.mark.parametrize("fault", ["checksum mismatch", "version mismatch"])
def test_verifying_sources(spark, source, fault):
    src = source({"main.dic": "data_main\n_dictionary.version 3\n" + category("entry", "id") + item("entry.id")})
    sums = src.selectExpr("path AS source", "sha2(CAST(content AS binary), 256) AS sha256")
    right = sums.selectExpr("*", "'3' AS version")
    versions = d.dict_versions(d.dict_frames(src))
    assert all(r["ok"] for r in d.dict_verify(src, right, versions).collect())
    wrong = right.selectExpr("source", "sha256", "'2' AS version") if "version" in fault else right.selectExpr("source", "repeat('0', 64) AS sha256", "version")
    with pytest.raises(Exception, match=fault):
        d.dict_verify(src, wrong, versions).collect()
