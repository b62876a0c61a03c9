"""Large files read piece by piece, against the reader that takes a file whole."""

import pytest
from pyspark.sql import functions as F

from cif_lake.functions import grammar as g
from cif_lake.sources import large, read

#: Values that begin, end or look like something in a line of their own or with others.
AWKWARD = """data_first
_entry.id 'it''s one' # a remark with a ' quote
_entry.note
;a field
loop_
_not.a tag
 ;not the end
;
_entry.more
'''three
;lines
of it'''
loop_
_v.a
_v.b # remark between
_v.c
1 O5' "x ' y"
# a line; with "marks" '
2
;one
two 'three
;
'4 4' 5 a#b
;x 1 2
;
6
\"\"\"seven
; 7
seven\"\"\" 8 ;9
10 'open
and closed' 11 12 . ?
13
_w.x 1
_w.y 2
loop_
_u.only
;f
;
;
g
;
h i
data_second
loop_
_V.A
_V.c
21 22
23
save_frame
_v.a 5
_entry.id second
"""


@pytest.fixture(scope="module")
def write_texts(spark, tmp_path_factory):
    def make(**texts):
        folder = tmp_path_factory.mktemp("large")
        for name, text in texts.items():
            (folder / f"{name}.cif").write_bytes(text.encode())
        return str(folder)

    return make


def everything(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_states_compose():
    text = "\n" + AWKWARD
    for cut in range(0, len(text), 7):
        if text[cut] != "\n":
            continue
        before, behind = text[:cut].encode(), text[cut:].encode()
        start = large.end_states(before)[0]
        for state in range(6):
            whole = large.end_states(text.encode())[state]
            middle = large.end_states(before)[state] if before else state
            assert large.end_states(behind)[middle] == whole, (cut, state, start)


def test_states_agree_with_the_lexer(spark):
    texts = ["\n" + line for line in (AWKWARD, AWKWARD[:200], "a 'b", "a 'b'c", ";x", "'''a''''b", "'a'\n;", '"" "', "# '", "x'''", "''''", "a ;b\n;c")]
    for text in texts:
        last = spark.range(1).select(F.expr(g.lexemes(g.lit(text)))).first()[0][-1]
        state = large.end_states(text.encode())[0]
        opener = large.OPENERS[state]
        closed = large._closed(last.encode(), len(opener), state) >= 0 if state else True
        assert last.startswith(opener) and not (state and closed), (text, state, last)


@pytest.mark.parametrize("piece_bytes", [1, 9, 40, 150, 1 << 20])
def test_equal_to_whole_files(spark, write_texts, piece_bytes):
    folder = write_texts(a=AWKWARD, b=AWKWARD.replace("data_second", "_v2.q 1"), c="_v.a 1\n_v.c 'no block'\n", d="data_empty\n", e="")
    src, found = read.source(spark, folder), large.index(spark, folder, piece_bytes=piece_bytes)
    for category in ("v", "entry", "u", "w"):
        options = dict(column_source="files", data_block="*", row_id=True)
        want, got = read.scan(src, category, **options), large.scan(found, category, **options)
        assert everything(got.select(want.columns)) == everything(want), category
    first = dict(column_source="files", row_id=True)
    assert everything(large.scan(found, "v", **first)) == everything(read.scan(src, "v", **first))
    counts = ["path", "block_ord", "block_name", "category", "n_rows"]
    assert everything(large.row_counts(found)) == everything(read.row_counts(src).select(counts))


def test_splits_of_one_file(spark, write_texts):
    rows = "".join(f"{i} 'r {i % 7}'\n" + (f";field {i}\n'\n;\n" if i % 5 == 0 else "plain\n") for i in range(400))
    folder = write_texts(a=f"data_x\nloop_\n_v.a\n_v.b\n_v.c\n{rows}_w.x 1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = large.index(spark, folder, piece_bytes=300)
        assert found.units.select("split").distinct().count() > 5
        got = large.scan(found, "v", column_source="files", row_id=True)
        want = read.scan(read.source(spark, folder), "v", column_source="files", row_id=True)
        assert everything(got) == everything(want) and got.count() == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_blocks_by_name_and_faults(spark, write_texts):
    folder = write_texts(a=AWKWARD)
    found = large.index(spark, folder, piece_bytes=64)
    got = large.scan(found, "v", column_source="files", data_block="SECOND", row_id=True)
    assert [tuple(r) for r in got.select("row_id", "A", "c").orderBy("row_id").collect()] == [(0, "21", "22"), (1, "23", None)]
    with pytest.raises(Exception, match="not present"):
        large.scan(found, "v", column_source="files", data_block="third", columns=["a"]).collect()
    with pytest.raises(ValueError, match="not present"):
        large.scan(found, "nothing", column_source="files")
    with pytest.raises(Exception, match="not in the dictionary"):
        large.scan(found, "entry").collect()


def test_a_scan_reads_its_category_only(spark, write_texts, tmp_path):
    body = "".join(f"{i} {i}\n" for i in range(300))
    folder = write_texts(a=f"data_x\n_w.x 1\nloop_\n_v.a\n_v.b\n{body}_u.y 2\n")
    large.index(spark, folder, str(tmp_path / "index"), piece_bytes=200)
    found = large.Index.load(spark, str(tmp_path / "index"))
    scan = large.scan(found, "v", column_source="files", columns=["a"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(key,v)" in plan and "content" not in plan
    assert scan.count() == 300 and large.scan(found, "w", column_source="files").count() == 1
    # Few rows cross the end of a piece: no others are shuffled.
    assert found.parts.filter("key = 'v' AND edge").count() <= 2 * found.units.filter("k = 'P'").count() < 30


def test_many_pieces_meet_by_a_shuffle(spark, write_texts, monkeypatch):
    folder = write_texts(a=AWKWARD)
    want = everything(large.scan(large.index(spark, folder, piece_bytes=40), "v", column_source="files", row_id=True))
    monkeypatch.setattr(large, "BROADCAST_PIECES", 1)
    assert everything(large.scan(large.index(spark, folder, piece_bytes=40), "v", column_source="files", row_id=True)) == want
