"""Edits, write-back and export; each query reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from cif_lake.operators import edit, patch
from cif_lake.plans import corpus
from cif_lake.plans.registry import query
from cif_lake.plans.relational import S
from cif_lake.plans.scans import SHOWN, A, atoms
from cif_lake.plans.structural import _CHAIN, numbered, structure, structure_tables
from cif_lake.sources import read, write


def placed_atoms(spark, sf):
    return atoms(spark, sf, filename=True, row_id=True).drop("file_ord", "block_ord")


_POS = "p AS (SELECT *, row_id - min(row_id) OVER (PARTITION BY fkey) AS pos, count(*) OVER (PARTITION BY fkey) AS n FROM atoms)"


@query(
    A + f""", {_POS} SELECT fkey, pos AS row_id, id, "Cartn_x", type_symbol FROM p
    UNION ALL SELECT fkey, n + pos, 'copy of ' || id, "Cartn_x", NULL FROM p WHERE label_comp_id = 'LIG'"""
)
def insert_rows(spark, sf):
    """Rows inserted from a query on the table itself: it reads the table as it was."""
    table = placed_atoms(spark, sf).select("filename", "row_id", "id", "Cartn_x", "type_symbol", "label_comp_id")
    new = table.filter(F.col("label_comp_id") == "LIG").select(
        "filename", F.col("row_id").alias("ord"), F.concat(F.lit("copy of "), "id").alias("id"), "Cartn_x"
    )
    return numbered(edit.insert_rows(table, new).drop("label_comp_id"))


@query(
    A + """SELECT id, CASE WHEN c THEN "Cartn_y" ELSE "Cartn_x" END AS "Cartn_x", CASE WHEN c THEN "Cartn_x" ELSE "Cartn_y" END AS "Cartn_y"
    FROM (SELECT *, coalesce(label_seq_id > 10, false) AS c FROM atoms)"""
)
def update_rows(spark, sf):
    """Both expressions read the old values."""
    swap = {"Cartn_x": F.col("Cartn_y"), "Cartn_y": F.col("Cartn_x")}
    return edit.update_rows(placed_atoms(spark, sf), swap, F.col("label_seq_id") > 10).select("id", "Cartn_x", "Cartn_y")


@query(A + "SELECT id FROM atoms WHERE NOT coalesce(label_seq_id % 2 = 0, false)")
def delete_rows(spark, sf):
    return edit.delete_rows(placed_atoms(spark, sf), F.col("label_seq_id") % 2 == 0).select("id")


@query(
    A + """SELECT id FROM atoms a WHERE NOT EXISTS (SELECT 1 FROM (SELECT fkey, label_asym_id FROM atoms GROUP BY 1, 2 HAVING max("B_iso_or_equiv") <= 50) d
    WHERE d.fkey = a.fkey AND d.label_asym_id = a.label_asym_id)"""
)
def delete_by_group(spark, sf):
    return edit.delete_by_group(placed_atoms(spark, sf), ["label_asym_id"], F.max("B_iso_or_equiv") <= 50).select("id")


# --- write-back -----------------------------------------------------------------------------------------------------


def _path(frame):
    return frame.withColumnRenamed("filename", "path")


@query(A + f"""SELECT {SHOWN.replace('label_atom_id', "CASE WHEN type_symbol = 'S' THEN 'new H''' || id ELSE label_atom_id END AS label_atom_id")} FROM atoms""")
def patch_update(spark, sf):
    a = _path(placed_atoms(spark, sf)).filter(F.col("type_symbol") == "S")
    new = a.select("path", "row_id", F.concat(F.lit("new H'"), "id").alias("label_atom_id"))
    edits = patch.edits_of(new, "atom_site", "update", ["label_atom_id"])
    return read.scan(patch.patch_files(corpus.atoms(spark, sf), edits), "atom_site", columns=corpus.ATOM_COLUMNS, filename=False)


@query(A + f", {_POS} SELECT fkey, id, row_number() OVER (PARTITION BY fkey ORDER BY pos) - 1 AS row_id FROM p WHERE label_comp_id <> 'HOH'")
def patch_delete(spark, sf):
    gone = _path(placed_atoms(spark, sf)).filter(F.col("label_comp_id") == "HOH").select("path", "row_id")
    out = patch.patch_files(corpus.atoms(spark, sf), patch.edits_of(gone, "atom_site", "delete", []))
    return numbered(read.scan(out, "atom_site", columns=["id"], row_id=True).drop("file_ord", "block_ord"))


def _texts(patched):
    """Whole texts of patched files."""
    return patched.select("path", F.decode("content", "UTF-8").alias("text"))


@query(
    f"""WITH {corpus.ENTRY_PARTS_SQL} SELECT 'entries/' || k || '.cif' AS path, head || title || method || refine || price || refine_end || status || status_end
    || software || '3 "it''s new"' || nl || software_end AS text FROM entry_parts"""
)
def patch_insert(spark, sf):
    """A new row in a loop of every file; all other bytes stay."""
    src = corpus.entries(spark, sf)
    new = src.select("path", F.lit(0).alias("row_id"), F.lit("3").alias("pdbx_ordinal"), F.lit("it's new").alias("name"))
    return _texts(patch.patch_files(src, patch.edits_of(new, "software", "insert", ["pdbx_ordinal", "name"])))


_BEFORE_SOFTWARE = "head || title || method || refine || price || refine_end || status || status_end"
_SOFTWARE_HEAD = "'loop_' || nl || '_software.pdbx_ordinal' || nl || '_software.name' || nl"


@query(
    f"""WITH {corpus.ENTRY_PARTS_SQL} SELECT 'entries/' || k || '.cif' AS path, {_BEFORE_SOFTWARE} || {_SOFTWARE_HEAD} || '1 REFMAC' || nl
    || '2 "it''s ' || k || '"' || nl || software_end AS text FROM entry_parts WHERE k % 3 <> 0"""
)
def patch_update_text(spark, sf):
    """A cell of a loop in two files of three: whole texts, byte for byte; the other files are not returned."""
    src = corpus.entries(spark, sf)
    key = F.regexp_extract("path", r"(\d+)\.cif$", 1).cast("bigint")
    new = src.filter(key % 3 != 0).select("path", F.lit(1).alias("row_id"), F.concat(F.lit("it's "), key.cast("string")).alias("name"))
    return _texts(patch.patch_files(src, patch.edits_of(new, "software", "update", ["name"])))


@query(
    f"""WITH {corpus.ENTRY_PARTS_SQL} SELECT 'entries/' || k || '.cif' AS path, {_BEFORE_SOFTWARE} || {_SOFTWARE_HEAD}
    || CASE WHEN k % 2 = 0 THEN '' ELSE '1 REFMAC' || nl END
    || CASE WHEN k % 3 = 0 THEN '' WHEN k % 11 = 0 THEN '2 AlphaFold' || nl ELSE '2 ''Coot 1''' || nl END
    || software_end AS text FROM entry_parts WHERE k % 2 = 0 OR k % 3 = 0"""
)
def patch_delete_text(spark, sf):
    """One row, the other or both of a loop deleted: whole texts, byte for byte."""
    src = corpus.entries(spark, sf)
    key = F.regexp_extract("path", r"(\d+)\.cif$", 1).cast("bigint")
    first = src.filter(key % 2 == 0).select("path", F.lit(0).alias("row_id"))
    second = src.filter(key % 3 == 0).select("path", F.lit(1).alias("row_id"))
    gone = patch.union_edits(*(patch.edits_of(f, "software", "delete", []) for f in (first, second)))
    return _texts(patch.patch_files(src, gone))


@query(
    f"""WITH {corpus.ENTRY_PARTS_SQL} SELECT 'entries/' || k || '.cif' AS path, head || ';changed' || nl || 'order ' || k || nl || ';' || nl || method || refine
    || CASE WHEN price <> '' THEN CAST(o_totalprice + 1 AS VARCHAR) ELSE '' END || refine_end || CASE WHEN k % 2 = 0 THEN '' ELSE status END || status_end
    || software || software_end AS text FROM entry_parts"""
)
def patch_files(spark, sf):
    """Updates, deletes and text fields in several categories of every file, as one unit; all other bytes stay."""
    src = corpus.entries(spark, sf)
    wanted = {"refine": ["ls_d_res_high"], "pdbx_database_status": ["entry_id"]}
    many = _path(read.scan_many(src, wanted)).withColumn("row_id", F.lit(0))
    key = F.regexp_extract("path", r"(\d+)\.cif$", 1).cast("bigint")
    # The edits of both categories come from one pass over the rows: the parse runs once for each use of its frame.
    refine = F.col("category") == "refine"
    higher = (F.col("refine.ls_d_res_high") + 1).cast("string")
    scanned = many.filter(refine | (key % 2 == 0)).select(
        "path", F.lit(None).cast("string").alias("block_name"), "category", F.when(refine, "update").otherwise("delete").alias("op"), F.col("row_id").cast("bigint").alias("row_id"),
        F.when(refine, "ls_d_res_high").alias("item"), F.when(refine, higher).alias("value"),
    )
    titles = src.select("path", F.lit(0).alias("row_id"), F.concat(F.lit("changed\norder "), key.cast("string")).alias("title"))
    edits = patch.union_edits(scanned, patch.edits_of(titles, "struct", "update", ["title"]))
    return _texts(patch.patch_files(src, edits))


@query(
    S + """SELECT fkey, align_id, pdbx_strand_id, pdbx_db_accession, db_align_beg, db_align_end FROM struct_ref_seq
    UNION ALL SELECT fkey, 'N99', 'A', 'Q00000', 300, 541 FROM f"""
)
def accession_inject(spark, sf):
    """Add a reference and an alignment to every file and read the mapping back."""
    src = corpus.structures(spark, sf, "struct_ref", "struct_ref_seq")
    one = src.select("path", F.lit(0).alias("row_id"))
    ref = one.select(
        "*", F.lit("N99").alias("id"), F.lit("1").alias("entity_id"), F.lit("UNP").alias("db_name"), F.lit("Q00000").alias("pdbx_db_accession")
    )
    seq = one.select(
        "*", F.lit("N99").alias("align_id"), F.lit("N99").alias("ref_id"), F.lit("A").alias("pdbx_strand_id"),
        F.lit("Q00000").alias("pdbx_db_accession"), F.lit(300).alias("db_align_beg"), F.lit(541).alias("db_align_end"),
    )
    edits = patch.union_edits(
        patch.edits_of(ref, "struct_ref", "insert", ref.columns[2:]), patch.edits_of(seq, "struct_ref_seq", "insert", seq.columns[2:])
    )
    columns = ["align_id", "pdbx_strand_id", "pdbx_db_accession", "db_align_beg", "db_align_end"]
    return numbered(read.scan(patch.patch_files(src, edits), "struct_ref_seq", columns=columns))


# --- files -----------------------------------------------------------------------------------------------------------


@query(A + f"SELECT {SHOWN}, fkey || CASE WHEN fkey % 2 = 0 THEN '.cif.gz' ELSE '.cif' END AS name FROM atoms")
def write_files(spark, sf):
    """One file per path, gzip by name, scanned again from the folder."""
    folder = write.work_folder(spark)
    src = corpus.atoms(spark, sf)
    even = F.regexp_extract("path", r"(\d+)\.cif$", 1).cast("bigint") % 2 == 0
    write.write_files(src.withColumn("path", F.when(even, F.concat("path", F.lit(".gz"))).otherwise(F.col("path"))), folder)
    back = read.scan(read.source(spark, folder + "/atoms/*"), "atom_site", columns=corpus.ATOM_COLUMNS)
    return back.withColumn("name", read.file_name(F.col("filename"))).drop("filename")


@query(
    S + f", {_CHAIN} SELECT 'atom_site' AS t, fkey, id FROM k_atom UNION ALL SELECT 'entity', fkey, id FROM k_entity UNION ALL SELECT 'struct_asym', fkey, id FROM k_asym"
)
def write_block(spark, sf):
    """The edited categories of each file written together to a new folder."""
    kept = edit.keep_chain(structure_tables(spark, sf), "A")
    names = ["atom_site", "entity", "struct_asym"]
    folder = write.work_folder(spark)
    write.write_block({c: (kept[c], corpus.STRUCTURE_COLUMNS[c]) for c in names}, folder, "kept", folders=256)
    # One pass over the files for the three categories; a row has the id of its own.
    many = numbered(read.scan_many(read.dealt_files(spark, folder, folders=256), {c: ["id"] for c in names}))
    return many.select(F.col("category").alias("t"), "fkey", F.coalesce(*[F.col(f"{c}.id") for c in names]).alias("id"))


@query(A + f"SELECT {SHOWN} FROM atoms")
def export_csv(spark, sf):
    folder = write.work_folder(spark)
    table = atoms(spark, sf, columns=corpus.ATOM_COLUMNS)
    write.export_csv(table, folder)
    return spark.read.schema(table.schema).option("header", True).option("escape", '"').csv(folder)
