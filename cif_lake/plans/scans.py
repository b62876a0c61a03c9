"""Queries over scans, listings and the parse jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.functions import grammar as g
from cif_lake.functions import render
from cif_lake.plans import corpus
from cif_lake.plans.corpus import ATOMS_SQL, SAFE_TEXT_SQL, custom_dictionary
from cif_lake.plans.registry import query
from cif_lake.sources import large as large_files
from cif_lake.sources import read
from cif_lake.sources.dictionary import Dictionary

A = f"WITH {ATOMS_SQL} "
SHOWN = (
    '"group_PDB", id, type_symbol, label_atom_id, label_alt_id, label_comp_id, label_asym_id, label_entity_id, label_seq_id, '
    '"Cartn_x", "Cartn_y", "Cartn_z", occupancy, "B_iso_or_equiv", auth_seq_id, auth_asym_id, "pdbx_PDB_model_num"'
)
LINES = "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem"


def atoms(spark, sf, **options) -> DataFrame:
    options.setdefault("filename", False)
    return read.scan(corpus.atoms(spark, sf), "atom_site", **options)


def lines(spark, sf, **options) -> DataFrame:
    options.setdefault("filename", False)
    return read.scan(corpus.lines(spark, sf), "lineitem", corpus.line_dictionary(spark), **options)


@query(A + f"SELECT {SHOWN} FROM atoms")
def scan_category(spark, sf):
    return atoms(spark, sf, columns=corpus.ATOM_COLUMNS)


@query(
    "SELECT CAST(vec_id AS VARCHAR) AS id, CAST(n AS INTEGER) AS file_ord FROM embeddings, (VALUES (0), (1)) t(n)"
)
def scan_file_list(spark, sf):
    """A list that names the same files twice: read twice, in list order."""
    twice = read.in_order([corpus.atoms(spark, sf), corpus.atoms(spark, sf)])
    return read.scan(twice, "atom_site", columns=["id"], row_id=True, filename=False).select("id", "file_ord")


@query(
    A + f"""SELECT {SHOWN}, CAST(NULL AS VARCHAR) AS "pdbx_PDB_ins_code", CAST(NULL AS BIGINT) AS pdbx_formal_charge,
    CAST(NULL AS VARCHAR) AS auth_comp_id, CAST(NULL AS VARCHAR) AS auth_atom_id FROM atoms"""
)
def scan_dictionary_schema(spark, sf):
    """All items of the dictionary, those no file has as typed NULLs."""
    return atoms(spark, sf)


@query(
    """SELECT 'entries/' || o_orderkey || '.cif' AS path, 'ls_d_res_high' AS item FROM orders WHERE o_orderkey % 5 <> 0"""
)
def scan_unknown_items(spark, sf):
    known = custom_dictionary(spark, "refine", {"entry_id": "string"})
    return read.unknown_items(corpus.entries(spark, sf), "refine", known)


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS "Cartn_x",
    CASE WHEN s_suppkey % 2 = 1 THEN 'O' END AS type_symbol FROM supplier"""
)
def scan_files_schema(spark, sf):
    return read.scan(corpus.mixed(spark, sf), "atom_site", column_source="files", filename=False)


@query(
    """SELECT 'cell' AS category, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'entry', count(*) FROM orders
    UNION ALL SELECT 'refine', count(*) FILTER (o_orderkey % 5 <> 0) FROM orders"""
)
def scan_absent_category(spark, sf):
    src = corpus.entries(spark, sf)
    count = lambda c: read.scan(src, c, filename=False).agg(F.lit(c).alias("category"), F.count("*").alias("n"))
    return count("cell").unionAll(count("entry")).unionAll(count("refine"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 2 = 1 THEN 'O' END AS type_symbol FROM supplier")
def scan_case_insensitive(spark, sf):
    return read.scan(corpus.mixed(spark, sf), "Atom_Site", columns=["ID", "Type_Symbol"], filename=False)


@query("SELECT 'O' || o_orderkey AS id, 'entries/' || o_orderkey || '.cif' AS filename FROM orders")
def scan_filename(spark, sf):
    return read.scan(corpus.entries(spark, sf), "entry")


@query(f"SELECT l_returnflag, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM ({LINES}) GROUP BY 1")
def scan_gzip(spark, sf):
    """Plain and gzip files mixed, told apart by their first bytes."""
    return lines(spark, sf).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


@query(
    """SELECT 'two/' || c_custkey || '.cif' AS filename, i AS id, e AS entity_id,
    CASE WHEN i = 'A' THEN CAST(c_nationkey AS VARCHAR) ELSE c_mktsegment END AS details
    FROM customer, (VALUES ('A', '1'), ('B', '2')) t(i, e)"""
)
def scan_data_block(spark, sf):
    return read.scan(corpus.two_blocks(spark, sf), "struct_asym", data_block="SECOND")


@query(
    """SELECT 'multi/' || (o_orderkey // 32) || '.cif' AS path, 'O' || o_orderkey AS block_name,
    CAST(row_number() OVER (PARTITION BY o_orderkey // 32 ORDER BY o_orderkey) - 1 AS INTEGER) AS block_ord FROM orders"""
)
def list_blocks(spark, sf):
    return read.list_blocks(corpus.multi_entries(spark, sf)).drop("file_ord")


_TABLES = """SELECT 'entries/' || o_orderkey || '.cif' AS path, t.* FROM orders, (VALUES
  ('entry', 1, true, 'entry_group,inclusive_group', true), ('struct', 1, true, NULL, NULL), ('exptl', 1, false, NULL, NULL),
  ('refine', 2, false, NULL, false), ('pdbx_database_status', 2, true, NULL, NULL), ('software', 2, false, NULL, NULL))
  t(table_name, column_count, is_single_row, category_groups, is_mandatory)
  WHERE (table_name <> 'refine' OR o_orderkey % 5 <> 0) AND (table_name <> 'pdbx_database_status' OR o_orderkey % 7 <> 0)"""


@query(
    f"""SELECT path, table_name, 'https://mmcif.wwpdb.org/dictionaries/mmcif_pdbx_v50.dic/Categories/' || table_name || '.html' AS comment,
    CAST(column_count AS BIGINT) AS column_count, is_single_row, CAST(NULL AS VARCHAR) AS description, category_groups, is_mandatory FROM ({_TABLES})"""
)
def list_tables(spark, sf):
    out = read.list_tables(corpus.entries(spark, sf), Dictionary.seed(spark))
    return out.withColumn("category_groups", F.array_join("category_groups", ","))


_COLUMNS = """SELECT 'entries/' || o_orderkey || '.cif' AS path, t.* FROM orders, (VALUES
  ('entry', 'id', 1, 'string'), ('struct', 'title', 1, 'string'), ('exptl', 'method', 1, 'string'), ('refine', 'entry_id', 1, 'string'),
  ('refine', 'ls_d_res_high', 2, 'double'), ('pdbx_database_status', 'entry_id', 1, 'string'),
  ('pdbx_database_status', 'recvd_initial_deposition_date', 2, 'string'), ('software', 'pdbx_ordinal', 1, 'bigint'), ('software', 'name', 2, 'string'))
  t(table_name, column_name, column_index, data_type)
  WHERE (table_name <> 'refine' OR o_orderkey % 5 <> 0) AND (table_name <> 'pdbx_database_status' OR o_orderkey % 7 <> 0)"""


@query(
    f"""SELECT path, table_name, column_name, CAST(column_index AS INTEGER) AS column_index, data_type,
    'https://mmcif.wwpdb.org/dictionaries/mmcif_pdbx_v50.dic/Items/_' || table_name || '.' || column_name || '.html' AS comment FROM ({_COLUMNS})"""
)
def list_columns(spark, sf):
    return read.list_columns(corpus.entries(spark, sf), Dictionary.seed(spark))


@query(
    """SELECT 'entries/' || o_orderkey || '.cif' AS path, 'entry' AS parent_table, 'id' AS parent_column, child_table, child_column
    FROM orders, (VALUES ('struct', 'entry_id'), ('exptl', 'entry_id'), ('refine', 'entry_id'), ('pdbx_database_status', 'entry_id')) t(child_table, child_column)
    WHERE (child_table <> 'refine' OR o_orderkey % 5 <> 0) AND (child_table <> 'pdbx_database_status' OR o_orderkey % 7 <> 0)"""
)
def list_relationships(spark, sf):
    return read.list_relationships(corpus.entries(spark, sf), Dictionary.seed(spark))


@query(
    """SELECT 'entry' AS table_name, 1 AS column_count, count(*) AS n FROM customer UNION ALL SELECT 'struct_asym', 3, 2 * count(*) FROM customer"""
)
def open_block(spark, sf):
    tables = read.open_block(corpus.two_blocks(spark, sf), data_block="second", views="block_")
    parts = [
        spark.table(f"block_{name}").agg(
            F.lit(name).alias("table_name"), F.lit(len(frame.columns)).alias("column_count"), F.count("*").alias("n")
        )
        for name, frame in tables.items()
        if name
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@query(
    """SELECT 'two/' || c_custkey || '.cif' AS filename, CAST(c_custkey AS VARCHAR) AS first_id, c_name AS second_id, i AS asym_id
    FROM customer, (VALUES ('A'), ('B')) t(i)"""
)
def blocks_cross_join(spark, sf):
    """Two blocks of one file side by side."""
    src = corpus.two_blocks(spark, sf)
    first = read.scan(src, "entry", data_block="first").withColumnRenamed("id", "first_id")
    second = read.scan(src, "entry", data_block="second").withColumnRenamed("id", "second_id")
    asym = read.scan(src, "struct_asym", data_block="second").select("filename", F.col("id").alias("asym_id"))
    return first.join(second, "filename").join(asym, "filename")


@query(A + "SELECT id, row_id - min(row_id) OVER (PARTITION BY fkey) AS row_id FROM atoms")
def scan_row_id(spark, sf):
    return atoms(spark, sf, columns=["id"], row_id=True).select("id", "row_id")


@query(
    """SELECT 'entries/' || o_orderkey || '.cif' AS path, 'software' AS category, CAST(2 AS BIGINT) AS n_rows FROM orders
    UNION ALL SELECT 'entries/' || o_orderkey || '.cif', 'entry', 1 FROM orders"""
)
def category_row_counts(spark, sf):
    return read.row_counts(corpus.entries(spark, sf), ["software", "entry"]).select("path", "category", "n_rows")


@query(
    """SELECT c_custkey AS key, CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS DOUBLE) AS d, CAST(CAST(c_acctbal AS VARCHAR) AS BIGINT) AS i,
    CAST(NULL AS DOUBLE) AS bad FROM customer"""
)
def typed_cast(spark, sf):
    """Text to the types of the dictionary: whole numbers round half away from zero, malformed text is an error or NULL."""
    text = corpus.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").cast("string").alias("t"), "c_name")
    where = "'acctbal'"
    return text.selectExpr(
        "key",
        f"{g.typed('t', 'double', where)} AS d",
        f"{g.typed('t', 'bigint', where)} AS i",
        f"{g.typed('c_name', 'double', where, 'null')} AS bad",
    )


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS a, r AS row_id,
    CASE WHEN r = 0 THEN (CASE c_custkey % 4 WHEN 2 THEN '.' WHEN 3 THEN '?' END) WHEN r = 1 THEN 'it''s' END AS b,
    CASE r WHEN 0 THEN '?x' WHEN 1 THEN '.5' END AS c FROM customer, (VALUES (0::BIGINT), (1), (2)) t(r)"""
)
def null_markers(spark, sf):
    src = corpus.marked(spark, sf)
    dictionary = custom_dictionary(spark, "p", {"a": "string", "b": "string", "c": "string"})
    return read.scan(src, "p", dictionary, row_id=True, filename=False).select("a", "b", "c", "row_id")


@query(
    """SELECT count(*) AS n, count(DISTINCT l_orderkey) AS orders, CAST(sum(l_partkey) AS BIGINT) AS parts,
    min(strftime(l_shipdate, '%Y-%m-%d')) AS first_ship FROM lineitem"""
)
def scan_parallel_counts(spark, sf):
    rows = lines(spark, sf, columns=["l_orderkey", "l_partkey", "l_shipdate"])
    # Distinct keys through a pre-aggregate instead of one set per task.
    keys = rows.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.sum("l_partkey").alias("p"), F.min("l_shipdate").alias("s")
    )
    return keys.agg(
        F.sum("n").alias("n"), F.count("*").alias("orders"), F.sum("p").alias("parts"), F.min("s").alias("first_ship")
    )


def large(spark, sf) -> large_files.Index:
    return large_files.index(spark, corpus.large_file(spark, sf))


@query(LINES)
def large_file_scan(spark, sf):
    """A loop of one large file, cut by many tasks."""
    return large_files.scan(large(spark, sf), "lineitem", corpus.line_dictionary(spark), columns=list(corpus.LINE_TYPES), filename=False)


@query(
    f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, CAST(doc_id AS VARCHAR) AS doc_id, lang, source,
    nullif({SAFE_TEXT_SQL.format("text")}, '') AS text, CAST(n_chars AS VARCHAR) AS n_chars FROM documents"""
)
def large_file_texts(spark, sf):
    """Rows of text fields behind the first loop, with their numbers in the file."""
    rows = large_files.scan(large(spark, sf), "document", column_source="files", row_id=True, filename=False)
    return rows.select("row_id", *corpus.DOC_COLUMNS)


@query("SELECT 'large' AS block_name, 'lineitem' AS category, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'large', 'document', count(*) FROM documents")
def large_file_counts(spark, sf):
    """Row counts from the index alone."""
    return large_files.row_counts(large(spark, sf)).select("block_name", "category", "n_rows")


@query("SELECT l_quantity, l_orderkey FROM lineitem")
def scan_projected(spark, sf):
    return lines(spark, sf, columns=["l_quantity", "l_orderkey"])


@query(
    """SELECT t.*, true AS listed, true AS opened FROM (VALUES ('entry', 'id', 'string'), ('struct_asym', 'id', 'string'), ('struct_asym', 'entity_id', 'string'),
    ('struct_asym', 'details', 'string')) t(table_name, column_name, data_type) WHERE (SELECT count(*) FROM customer) > 0"""
)
def schema_parity(spark, sf):
    """Columns of the listing and of the opened block side by side."""
    src = corpus.two_blocks(spark, sf)
    dictionary = Dictionary.seed(spark)
    names = ["table_name", "column_name", "data_type"]
    listed = read.list_columns(src, dictionary, "second").select(*names).distinct().withColumn("listed", F.lit(True))
    tables = read.open_block(src, dictionary, "second")
    opened = [(name, field.name, field.dataType.simpleString(), True) for name, frame in tables.items() if name for field in frame.schema]
    tables[""].unpersist()
    opened = spark.createDataFrame(opened, "table_name string, column_name string, data_type string, opened boolean")
    return listed.join(opened, names, "full").fillna(False, subset=["listed", "opened"])


# --- parse jobs ------------------------------------------------------------------------------------------------

_QUOTED_SQL = """(regexp_matches({0}, '[ \\t\\r\\x0b\\x0c\\n''"]') OR regexp_matches({0}, '^[$#_;()\\[\\]{{}}]')
    OR regexp_matches(lower({0}), '^(data_|loop_|save_|stop_|global_)') OR {0} IN ('.', '?'))"""


@query(
    f"""WITH c AS (SELECT conv_id, turn, role, {SAFE_TEXT_SQL.format("text")} AS text FROM conversations)
    SELECT conv_id, turn, ord, CASE ord WHEN 0 THEN CAST(conv_id AS VARCHAR) WHEN 1 THEN role ELSE nullif(text, '') END AS value,
    (ord = 2 AND text = '') AS is_null, (ord = 2 AND text <> '' AND {_QUOTED_SQL.format("text")}) AS quoted FROM c, (VALUES (0), (1), (2)) t(ord)"""
)
def tokenize_values(spark, sf):
    c = corpus.table(spark, sf, "conversations")
    rows = c.select("conv_id", "turn", "role", corpus.safe_text(F.col("text")).alias("text"))
    text = rows.select("conv_id", "turn", render.row(rows, ["conv_id", "role", "text"]).alias("line"))
    return read.tokenize(text, "line", "conv_id", "turn")


@query(
    f"""WITH {corpus.ENTRY_PARTS_SQL} SELECT 'multi/' || (k // 32) || '.cif' AS path, code AS block_name,
    head || title || method || refine || price || refine_end || status || status_end || software || software_end AS text FROM entry_parts"""
)
def split_blocks(spark, sf):
    """Blocks as texts of their own, to spread a file of many blocks over tasks."""
    return read.split_blocks(corpus.multi_entries(spark, sf)).select("path", "block_name", "text")


@query(
    """SELECT 'two/' || c_custkey || '.cif' AS path, t.* FROM customer, (VALUES
    ('first', 'entry', false, 'id'), ('first', 'struct', false, 'title'), ('Second', 'entry', false, 'id'),
    ('Second', 'struct_asym', true, 'id,entity_id,details')) t(block_name, category, is_loop, items)"""
)
def category_headers(spark, sf):
    h = read.headers(read.blocks(corpus.two_blocks(spark, sf)))
    return h.select("path", "block_name", "category", "is_loop", F.array_join("items", ",").alias("items"))


@query(
    f"""WITH d AS (SELECT doc_id // 16 AS fkey, doc_id, lang, source, {SAFE_TEXT_SQL.format("text")} AS text, n_chars FROM documents)
    SELECT 'docs/' || fkey || '.cif' AS path, row_number() OVER (PARTITION BY fkey, item ORDER BY doc_id) - 1 AS row_id, item,
    CASE item WHEN 'doc_id' THEN CAST(doc_id AS VARCHAR) WHEN 'lang' THEN lang WHEN 'source' THEN source WHEN 'text' THEN nullif(text, '')
    ELSE CAST(n_chars AS VARCHAR) END AS value FROM d, (VALUES ('doc_id'), ('lang'), ('source'), ('text'), ('n_chars')) t(item)"""
)
def long_cells(spark, sf):
    return read.long_cells(corpus.docs(spark, sf)).select("path", "row_id", "item", "value")


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, nullif({SAFE_TEXT_SQL.format("text")}, '') AS text, CAST(n_chars AS VARCHAR) AS n_chars FROM documents"""
)
def pivot_cells(spark, sf):
    """Long cells back to the wide form."""
    cells = read.long_cells(corpus.docs(spark, sf))
    wide = cells.groupBy("path", "block_ord", "category", "row_id").pivot("item", corpus.DOC_COLUMNS).agg(F.first("value"))
    return wide.select(*corpus.DOC_COLUMNS)


# --- rendering -----------------------------------------------------------------------------------------------------

_RENDER_SQL = f"""CASE WHEN {{0}} IS NULL OR {{0}} = '' THEN '?'
    WHEN contains({{0}}, chr(10)) OR (contains({{0}}, '''') AND contains({{0}}, '"')) THEN ';' || {{0}} || chr(10) || ';'
    WHEN {_QUOTED_SQL} AND contains({{0}}, '''') THEN '"' || {{0}} || '"'
    WHEN {_QUOTED_SQL} THEN '''' || {{0}} || '''' ELSE {{0}} END"""


@query(
    f"""WITH v AS (SELECT page_id AS key, url AS v FROM pages UNION ALL SELECT page_id, {SAFE_TEXT_SQL.format("html")} FROM pages
    UNION ALL SELECT doc_id, {SAFE_TEXT_SQL.format("text")} FROM documents UNION ALL SELECT doc_id, source FROM documents)
    SELECT key, {_RENDER_SQL.format("v")} AS text FROM v"""
)
def render_value(spark, sf):
    p, d = corpus.table(spark, sf, "pages"), corpus.table(spark, sf, "documents")
    v = p.select(F.col("page_id").alias("key"), F.col("url").alias("v"))
    v = v.unionAll(p.select("page_id", corpus.safe_text(F.col("html")))).unionAll(d.select("doc_id", corpus.safe_text(F.col("text"))))
    return v.unionAll(d.select("doc_id", "source")).selectExpr("key", f"{render.value('v')} AS text")


@query(
    """SELECT c_custkey // 8 AS fkey, 'loop_' || chr(10) || '_customer.id' || chr(10) || '_customer.name' || chr(10) || '_customer.segment' || chr(10) ||
    string_agg(c_custkey || ' ''' || replace(c_name, '#', ' ') || ''' ' || c_mktsegment, chr(10) ORDER BY c_custkey) || chr(10) AS text FROM customer GROUP BY 1"""
)
def render_loop(spark, sf):
    c = corpus.table(spark, sf, "customer")
    rows = c.select(
        F.floor(F.col("c_custkey") / 8).alias("fkey"), F.col("c_custkey").alias("row_id"), F.col("c_custkey").alias("id"),
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"), F.col("c_mktsegment").alias("segment"),
    )
    return render.categories({"customer": (rows, ["id", "name", "segment"])}, ["fkey"], loops=True)


@query(
    f"""SELECT doc_id, '_document.id ' || doc_id || chr(10) || '_document.text' || CASE WHEN contains(t, chr(10)) OR (contains(t, '''') AND contains(t, '"')) THEN chr(10) ELSE ' ' END
    || {_RENDER_SQL.format("t")} || chr(10) AS text FROM (SELECT doc_id, {SAFE_TEXT_SQL.format("text")} AS t FROM documents)"""
)
def render_items(spark, sf):
    d = corpus.table(spark, sf, "documents")
    rows = d.select("doc_id", F.col("doc_id").alias("id"), corpus.safe_text(F.col("text")).alias("text"))
    return rows.select("doc_id", render.pairs(rows, "document", ["id", "text"]).alias("text"))


@query(
    """WITH c AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey // 2 END AS fkey, c_custkey, c_mktsegment FROM customer)
    SELECT fkey, CASE WHEN count(*) > 1 THEN 'loop_' || chr(10) || '_c.id' || chr(10) || '_c.segment' || chr(10) || string_agg(c_custkey || ' ' || c_mktsegment, chr(10) ORDER BY c_custkey) || chr(10)
    ELSE '_c.id ' || min(c_custkey) || chr(10) || '_c.segment ' || min(c_mktsegment) || chr(10) END AS text FROM c GROUP BY 1"""
)
def render_promoted(spark, sf):
    """One row is written as key-value pairs, more rows as a loop."""
    k = F.col("c_custkey")
    rows = corpus.table(spark, sf, "customer").select(
        F.when(k % 2 == 0, k).otherwise(F.floor(k / 2)).alias("fkey"), k.alias("row_id"), k.alias("id"), F.col("c_mktsegment").alias("segment")
    )
    return render.categories({"c": (rows, ["id", "segment"])}, ["fkey"])


@query(
    """WITH d AS (SELECT doc_id, 'text' AS item, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN ';' || text ELSE text || chr(10) || ';end' END AS value FROM documents)
    SELECT * FROM d WHERE (contains(value, chr(10)) OR (contains(value, '''') AND contains(value, '"')))
    AND (starts_with(value, ';') OR contains(value, chr(10) || ';') OR ends_with(value, chr(13)))"""
)
def unwritable_values(spark, sf):
    k, t = F.col("doc_id"), F.col("text")
    d = corpus.table(spark, sf, "documents").select(
        "doc_id", F.when(k % 3 == 0, t).when(k % 3 == 1, F.concat(F.lit(";"), t)).otherwise(F.concat(t, F.lit("\n;end"))).alias("text")
    )
    return render.unwritable_values(d, ["doc_id"], ["text"])
