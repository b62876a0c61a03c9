"""CIF corpora that Spark derives from tables, in memory, for queries and benchmarks.

Files stay small and their number grows with the tables: they are grouped on ranges of a unique key, so no key can make one of
them large, and neither the number of cores nor a retried task changes them.
"""

from __future__ import annotations

import gzip
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cif_lake.functions import render
from cif_lake.functions.grammar import lit
from cif_lake.sources.dictionary import ITEMS_SCHEMA, Dictionary
from cif_lake.sources.write import work_folder, write_lines

ROWS_PER_FILE = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame, key: str) -> DataFrame:
    """Rows dealt by their key over all shuffle partitions: parsing costs more than moving the rows, at every size."""
    return frame.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def pick(number: Column, *names: str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(number, F.lit(len(names))) + 1).cast("int"))


def files(
    tables: dict[str, tuple[DataFrame, Sequence[str]]], name: str, *, order: str = "row_id", loops: bool = False
) -> DataFrame:
    """Source frame with one file per ``fkey``."""
    texts = render.categories(tables, ["fkey"], order, loops)
    path = F.concat(F.lit(f"{name}/"), F.col("fkey").cast("string"), F.lit(".cif"))
    text = F.concat(F.lit(f"data_{name}\n#\n"), F.col("text"), F.lit("#\n"))
    return texts.select(F.lit(0).alias("file_ord"), path.alias("path"), text.alias("content"))


# Rows and not Arrow batches, as in ``read``.
@F.udf(T.BinaryType(), useArrow=False)
def _gzip(content: bytes | None) -> bytes | None:
    return None if content is None else gzip.compress(content, 1, mtime=0)


def zipped(src: DataFrame, where: Column) -> DataFrame:
    """Source frame of bytes, gzip where the condition holds."""
    marked = src.select("file_ord", "path", F.col("content").cast("binary"), where.alias("zip_it"))
    path = F.when(F.col("zip_it"), F.concat("path", F.lit(".gz"))).otherwise(F.col("path"))
    packed = F.coalesce(_gzip(F.when(F.col("zip_it"), F.col("content"))), F.col("content"))
    return marked.select("file_ord", path.alias("path"), packed.alias("content"))


# --- atoms: embeddings -> atom_site ----------------------------------------------------------------

ATOM_COLUMNS = [
    "group_PDB", "id", "type_symbol", "label_atom_id", "label_alt_id", "label_comp_id", "label_asym_id", "label_entity_id",
    "label_seq_id", "Cartn_x", "Cartn_y", "Cartn_z", "occupancy", "B_iso_or_equiv", "auth_seq_id", "auth_asym_id",
    "pdbx_PDB_model_num",
]

# The same rows for the SQL side; fkey is the file.
ATOMS_SQL = """atoms AS (
  SELECT vec_id // 64 AS fkey, vec_id AS row_id,
    CASE WHEN vec_id % 7 = 0 THEN 'HETATM' ELSE 'ATOM' END AS "group_PDB",
    CAST(vec_id AS VARCHAR) AS id,
    (['C','N','O','S'])[1 + vec_id % 4] AS type_symbol,
    (['CA','N','C','O','CB','O5'''])[1 + vec_id % 6] AS label_atom_id,
    CAST(NULL AS VARCHAR) AS label_alt_id,
    (['ALA','GLY','SER','LIG','HOH'])[1 + vec_id % 5] AS label_comp_id,
    chr(CAST(65 + label AS INTEGER)) AS label_asym_id,
    CAST(1 + label % 3 AS VARCHAR) AS label_entity_id,
    CASE WHEN vec_id % 5 = 4 THEN NULL ELSE vec_id // 8 END AS label_seq_id,
    CAST(embedding[1] AS DOUBLE) * 50 AS "Cartn_x",
    CAST(embedding[2] AS DOUBLE) * 50 AS "Cartn_y",
    CAST(embedding[3] AS DOUBLE) * 50 AS "Cartn_z",
    CAST(1 AS DOUBLE) AS occupancy,
    abs(CAST(embedding[4] AS DOUBLE)) * 200 AS "B_iso_or_equiv",
    CAST(vec_id // 4 AS VARCHAR) AS auth_seq_id,
    (['A','B'])[1 + label % 2] AS auth_asym_id,
    CAST(1 AS BIGINT) AS "pdbx_PDB_model_num"
  FROM embeddings)"""


def atom_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    xyz = lambda i: f"CAST(get(embedding, {i}) AS double)"
    named = lambda number, *names: f"get(array({', '.join(lit(n) for n in names)}), CAST({number} % {len(names)} AS int))"
    return table(spark, sf_dir, "embeddings").selectExpr(
        f"vec_id DIV {ROWS_PER_FILE} AS fkey",
        "vec_id AS row_id",
        "CASE WHEN vec_id % 7 = 0 THEN 'HETATM' ELSE 'ATOM' END AS group_PDB",
        "CAST(vec_id AS string) AS id",
        f"{named('vec_id', 'C', 'N', 'O', 'S')} AS type_symbol",
        named("vec_id", "CA", "N", "C", "O", "CB", "O5'") + " AS label_atom_id",
        "CAST(NULL AS string) AS label_alt_id",
        f"{named('vec_id', 'ALA', 'GLY', 'SER', 'LIG', 'HOH')} AS label_comp_id",
        "char(65 + label) AS label_asym_id",
        "CAST(1 + label % 3 AS string) AS label_entity_id",
        "CASE WHEN vec_id % 5 <> 4 THEN vec_id DIV 8 END AS label_seq_id",
        f"{xyz(0)} * 50 AS Cartn_x",
        f"{xyz(1)} * 50 AS Cartn_y",
        f"{xyz(2)} * 50 AS Cartn_z",
        "1D AS occupancy",
        f"abs({xyz(3)}) * 200 AS B_iso_or_equiv",
        "CAST(vec_id DIV 4 AS string) AS auth_seq_id",
        f"{named('label', 'A', 'B')} AS auth_asym_id",
        "1L AS pdbx_PDB_model_num",
    )


def atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files({"atom_site": (atom_rows(spark, sf_dir), ATOM_COLUMNS)}, "atoms")


# --- lines: lineitem -> a custom category -------------------------------------------------------------

LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "bigint", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "string",
}


def custom_dictionary(spark: SparkSession, category: str, types: dict[str, str]) -> Dictionary:
    """A user dictionary for one category."""
    rows = [(f"_{category}.{item}", dtype, "https://example.org/custom.dic") for item, dtype in types.items()]
    empty = "category string, keys array<string>, description string, groups array<string>, is_mandatory boolean, is_single_row boolean, url string"
    return Dictionary(
        spark.createDataFrame(rows, ITEMS_SCHEMA),
        spark.createDataFrame([], empty),
        spark.createDataFrame([], "parent string, child string"),
    )


def line_dictionary(spark: SparkSession) -> Dictionary:
    return custom_dictionary(spark, "lineitem", LINE_TYPES)


#: Orders whose lines make one file: a few hundred rows.
ORDERS_PER_FILE = 256


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per range of orders, every second one gzip."""
    li = table(spark, sf_dir, "lineitem")
    ship = F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate")
    fkey = F.floor(F.col("l_orderkey") / ORDERS_PER_FILE).alias("fkey")
    row_id = (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("row_id")
    rows = li.select(fkey, row_id, *[ship if c == "l_shipdate" else c for c in LINE_TYPES])
    odd = F.regexp_extract("path", r"(\d+)\.cif$", 1).cast("bigint") % 2 == 1
    return zipped(files({"lineitem": (rows, list(LINE_TYPES))}, "lines", loops=True), odd)


# --- documents: text fields ----------------------------------------------------------------------------

DOC_COLUMNS = ["doc_id", "lang", "source", "text", "n_chars"]


def safe_text(text: Column) -> Column:
    """CIF cannot hold a line that starts with ``;`` inside a text field: such lines get a blank."""
    return F.replace(F.regexp_replace(text, r"\A;", " ;"), F.lit("\n;"), F.lit("\n ;"))


SAFE_TEXT_SQL = "replace(CASE WHEN starts_with({0}, ';') THEN ' ' || {0} ELSE {0} END, chr(10) || ';', chr(10) || ' ;')"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rows = d.select(
        F.floor(F.col("doc_id") / 16).alias("fkey"), F.col("doc_id").alias("row_id"), "doc_id", "lang", "source",
        safe_text(F.col("text")).alias("text"), "n_chars",
    )
    return files({"document": (rows, DOC_COLUMNS)}, "docs", loops=True)


def large_file(spark: SparkSession, sf_dir: str) -> str:
    """One file with all lines and all documents as two loops, in a fresh folder; the path of the folder.

    The sorted partitions are written by many tasks, each to its place in the file.
    """
    ship = F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate")
    li = table(spark, sf_dir, "lineitem")
    li = li.select(F.col("l_orderkey").alias("major"), F.col("l_linenumber").cast("bigint").alias("minor"), *[ship if c == "l_shipdate" else c for c in LINE_TYPES])
    d = table(spark, sf_dir, "documents")
    d = d.select(F.col("doc_id").alias("major"), F.lit(0).cast("bigint").alias("minor"), "doc_id", "lang", "source", safe_text(F.col("text")).alias("text"), "n_chars")
    parts = []
    for n, (category, frame, columns) in enumerate((("lineitem", li, list(LINE_TYPES)), ("document", d, DOC_COLUMNS))):
        head = ("data_large\n" if n == 0 else "") + render.header(category, columns).rstrip("\n")
        parts.append(spark.range(1).selectExpr(f"{2 * n} AS cat", "0L AS major", "0L AS minor", f"{lit(head)} AS line"))
        parts.append(frame.select(F.lit(2 * n + 1).alias("cat"), "major", "minor", render.row(frame, columns).alias("line")))
    folder = work_folder(spark)
    lines = reduce(DataFrame.unionAll, parts).orderBy("cat", "major", "minor").select("line")
    write_lines(lines, folder, "large.cif")
    return folder


# --- entries: orders -> key-value categories -----------------------------------------------------------


def entry_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block text per order: ``o_orderkey, block``."""
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    key = F.col("o_orderkey")
    code = F.concat(F.lit("O"), key.cast("string"))
    refine = F.when(
        key % 5 != 0,
        F.concat(F.lit("_refine.entry_id "), code, F.lit("\n_refine.ls_d_res_high "), F.col("o_totalprice").cast("string"), F.lit("\n#\n")),
    )
    status = F.when(
        key % 7 != 0,
        F.concat(
            F.lit("_pdbx_database_status.entry_id "), code,
            F.lit("\n_pdbx_database_status.recvd_initial_deposition_date "), F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.lit("\n#\n"),
        ),
    )
    software = F.concat(
        F.lit("loop_\n_software.pdbx_ordinal\n_software.name\n1 REFMAC\n2 "),
        F.when(key % 11 == 0, "AlphaFold").otherwise("'Coot 1'"),
        F.lit("\n#\n"),
    )
    block = F.concat(
        F.lit("data_"), code, F.lit("\n_entry.id "), code, F.lit("\n#\n_struct.title\n;Order of\ndata_"), code,
        F.lit("\n;\n_exptl.method '"), F.col("o_orderpriority"), F.lit("'\n#\n"), F.coalesce(refine, F.lit("")),
        F.coalesce(status, F.lit("")), software,
    )
    return o.select("o_orderkey", block.alias("block"))


# The same texts for the SQL side, part by part.
ENTRY_PARTS_SQL = """parts AS (SELECT o_orderkey AS k, 'O' || o_orderkey AS code, chr(10) AS nl, o_totalprice, o_orderdate, o_orderpriority FROM orders),
entry_parts AS (SELECT k, code, nl, o_totalprice, o_orderdate,
  'data_' || code || nl || '_entry.id ' || code || nl || '#' || nl || '_struct.title' || nl AS head,
  ';Order of' || nl || 'data_' || code || nl || ';' || nl AS title,
  '_exptl.method ''' || o_orderpriority || '''' || nl || '#' || nl AS method,
  CASE WHEN k % 5 <> 0 THEN '_refine.entry_id ' || code || nl || '_refine.ls_d_res_high ' ELSE '' END AS refine,
  CASE WHEN k % 5 <> 0 THEN CAST(o_totalprice AS VARCHAR) ELSE '' END AS price,
  CASE WHEN k % 5 <> 0 THEN nl || '#' || nl ELSE '' END AS refine_end,
  CASE WHEN k % 7 <> 0 THEN '_pdbx_database_status.entry_id ' || code || nl || '_pdbx_database_status.recvd_initial_deposition_date '
    || strftime(o_orderdate, '%Y-%m-%d') || nl ELSE '' END AS status,
  CASE WHEN k % 7 <> 0 THEN '#' || nl ELSE '' END AS status_end,
  'loop_' || nl || '_software.pdbx_ordinal' || nl || '_software.name' || nl || '1 REFMAC' || nl || '2 '
    || CASE WHEN k % 11 = 0 THEN 'AlphaFold' ELSE '''Coot 1''' END || nl AS software, '#' || nl AS software_end FROM parts)"""


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order."""
    return entry_blocks(spark, sf_dir).select(
        F.lit(0).alias("file_ord"),
        F.concat(F.lit("entries/"), F.col("o_orderkey").cast("string"), F.lit(".cif")).alias("path"),
        F.col("block").alias("content"),
    )


def multi_entries(spark: SparkSession, sf_dir: str, per_file: int = 32) -> DataFrame:
    """Files of up to ``per_file`` data blocks."""
    b = entry_blocks(spark, sf_dir).withColumn("fkey", F.floor(F.col("o_orderkey") / per_file))
    texts = b.groupBy("fkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "block"))).alias("b"))
    return texts.select(
        F.lit(0).alias("file_ord"),
        F.concat(F.lit("multi/"), F.col("fkey").cast("string"), F.lit(".cif")).alias("path"),
        F.array_join(F.transform("b", lambda x: x["block"]), "").alias("content"),
    )


# --- structures: orders -> linked categories -----------------------------------------------------------------

STRUCTURE_COLUMNS = {
    "atom_site": [
        "group_PDB", "id", "type_symbol", "label_comp_id", "label_asym_id", "label_entity_id", "label_seq_id",
        "B_iso_or_equiv", "auth_asym_id",
    ],
    "struct_conf": [
        "conf_type_id", "id", "beg_label_asym_id", "beg_label_seq_id", "end_label_asym_id", "end_label_seq_id",
        "beg_auth_asym_id", "end_auth_asym_id",
    ],
    "struct_sheet_range": [
        "sheet_id", "id", "beg_label_asym_id", "beg_label_seq_id", "end_label_asym_id", "end_label_seq_id",
        "beg_auth_asym_id", "end_auth_asym_id",
    ],
    "struct_conf_type": ["id"],
    "struct_asym": ["id", "entity_id"],
    "pdbx_struct_assembly_gen": ["assembly_id", "oper_expression", "asym_id_list"],
    "pdbx_struct_assembly": ["id", "details"],
    "entity": ["id", "type"],
    "struct_ref": ["id", "entity_id", "db_name", "pdbx_db_accession"],
    "struct_ref_seq": ["align_id", "ref_id", "pdbx_strand_id", "pdbx_db_accession", "db_align_beg", "db_align_end"],
    "chem_comp": ["id", "type"],
}

STRUCTURES_SQL = """o AS (SELECT o_orderkey // 64 AS fkey, o_orderkey AS row_id, o_orderkey AS k, o_custkey AS c, * FROM orders),
f AS (SELECT DISTINCT fkey FROM o),
atom_site AS (SELECT fkey, row_id, 'ATOM' AS "group_PDB", CAST(k AS VARCHAR) AS id, (['C','N','O','S'])[1 + k % 4] AS type_symbol,
  (['ALA','GLY','SER','LIG','HOH'])[1 + k % 5] AS label_comp_id, (['A','B','C','D'])[1 + c % 4] AS label_asym_id,
  CAST(1 + c % 3 AS VARCHAR) AS label_entity_id, c % 50 AS label_seq_id, o_totalprice / 5000 AS "B_iso_or_equiv",
  CASE WHEN k % 13 <> 0 THEN (['A','B'])[1 + c % 2] END AS auth_asym_id FROM o),
struct_conf AS (SELECT fkey, row_id, CASE WHEN o_orderstatus = 'O' THEN 'HELX_P' ELSE 'TURN_P' END AS conf_type_id,
  CAST(k AS VARCHAR) AS id, (['A','B','C','D'])[1 + c % 4] AS beg_label_asym_id, c % 100 AS beg_label_seq_id,
  (['A','B','C','D'])[1 + c % 4] AS end_label_asym_id, c % 100 + k % 20 AS end_label_seq_id,
  (['A','B'])[1 + c % 2] AS beg_auth_asym_id, (['A','B'])[1 + k % 2] AS end_auth_asym_id FROM o),
struct_sheet_range AS (SELECT fkey, row_id, left(o_orderpriority, 1) AS sheet_id, CAST(k AS VARCHAR) AS id,
  (['A','B','C','D'])[1 + c % 4] AS beg_label_asym_id, c % 90 AS beg_label_seq_id,
  (['A','B','C','D'])[1 + c % 4] AS end_label_asym_id, c % 90 + k % 7 AS end_label_seq_id,
  (['A','B'])[1 + c % 2] AS beg_auth_asym_id, (['A','B'])[1 + k % 2] AS end_auth_asym_id
  FROM o WHERE o_orderpriority < '3'),
struct_conf_type AS (SELECT fkey, i AS row_id, (['HELX_P','TURN_P','STRN'])[i + 1] AS id FROM f, range(3) t(i)),
struct_asym AS (SELECT fkey, i AS row_id, (['A','B','C','D'])[i + 1] AS id, CAST(1 + i % 3 AS VARCHAR) AS entity_id FROM f, range(4) t(i)),
pdbx_struct_assembly_gen AS (SELECT fkey, i AS row_id, CAST(i + 1 AS VARCHAR) AS assembly_id, '1' AS oper_expression,
  (['A,C','A,B,C,D'])[i + 1] AS asym_id_list FROM f, range(2) t(i)),
pdbx_struct_assembly AS (SELECT fkey, i AS row_id, CAST(i + 1 AS VARCHAR) AS id, 'assembly of ''x''' AS details FROM f, range(3) t(i)),
entity AS (SELECT fkey, i AS row_id, CAST(i + 1 AS VARCHAR) AS id, 'polymer' AS type FROM f, range(3) t(i)),
struct_ref AS (SELECT fkey, row_id, CAST(k AS VARCHAR) AS id, CAST(1 + c % 3 AS VARCHAR) AS entity_id,
  CASE WHEN o_orderstatus = 'P' THEN 'PDB' ELSE 'UNP' END AS db_name, 'P' || (c % 7) AS pdbx_db_accession FROM o),
struct_ref_seq AS (SELECT fkey, row_id, CAST(k AS VARCHAR) AS align_id, CAST(k AS VARCHAR) AS ref_id,
  (['A','B','C','D'])[1 + k % 4] AS pdbx_strand_id, 'Q' || (c % 5) AS pdbx_db_accession, k % 100 + 1 AS db_align_beg,
  k % 100 + c % 50 + 1 AS db_align_end FROM o),
chem_comp AS (SELECT fkey, i AS row_id, (['ALA','GLY','SER','LIG','HOH','XXX'])[i + 1] AS id, 'NON-POLYMER' AS type FROM f, range(6) t(i))"""


def structure_rows(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = table(spark, sf_dir, "orders").withColumn("fkey", F.floor(k / ROWS_PER_FILE)).withColumn("row_id", k)
    abcd, ab = (lambda n: pick(n, "A", "B", "C", "D")), (lambda n: pick(n, "A", "B"))
    lead = ["fkey", "row_id"]

    def fixed(*columns: Column, rows: int) -> DataFrame:
        """The same few rows in every file."""
        frame = o.select("fkey").distinct()
        return frame.withColumn("row_id", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).select(*lead, *columns)

    i = F.col("row_id")
    number = (i + 1).cast("string")

    def spans(first: Column, modulus: int, length: int) -> DataFrame:
        return o.select(
            *lead, "o_orderpriority", first, k.cast("string").alias("id"),
            abcd(c).alias("beg_label_asym_id"), (c % modulus).alias("beg_label_seq_id"),
            abcd(c).alias("end_label_asym_id"), (c % modulus + k % length).alias("end_label_seq_id"),
            ab(c).alias("beg_auth_asym_id"), ab(k).alias("end_auth_asym_id"),
        )

    helix = F.when(F.col("o_orderstatus") == "O", "HELX_P").otherwise("TURN_P").alias("conf_type_id")
    sheet = F.substring("o_orderpriority", 1, 1).alias("sheet_id")
    return {
        "atom_site": o.select(
            *lead, F.lit("ATOM").alias("group_PDB"), k.cast("string").alias("id"), pick(k, "C", "N", "O", "S").alias("type_symbol"),
            pick(k, "ALA", "GLY", "SER", "LIG", "HOH").alias("label_comp_id"), abcd(c).alias("label_asym_id"),
            (1 + c % 3).cast("string").alias("label_entity_id"), (c % 50).alias("label_seq_id"),
            (F.col("o_totalprice") / 5000).alias("B_iso_or_equiv"), F.when(k % 13 != 0, ab(c)).alias("auth_asym_id"),
        ),
        "struct_conf": spans(helix, 100, 20),
        "struct_sheet_range": spans(sheet, 90, 7).filter(F.col("o_orderpriority") < "3"),
        "struct_conf_type": fixed(pick(i, "HELX_P", "TURN_P", "STRN").alias("id"), rows=3),
        "struct_asym": fixed(abcd(i).alias("id"), (1 + i % 3).cast("string").alias("entity_id"), rows=4),
        "pdbx_struct_assembly_gen": fixed(
            number.alias("assembly_id"), F.lit("1").alias("oper_expression"), pick(i, "A,C", "A,B,C,D").alias("asym_id_list"), rows=2
        ),
        "pdbx_struct_assembly": fixed(number.alias("id"), F.lit("assembly of 'x'").alias("details"), rows=3),
        "entity": fixed(number.alias("id"), F.lit("polymer").alias("type"), rows=3),
        "struct_ref": o.select(
            *lead, k.cast("string").alias("id"), (1 + c % 3).cast("string").alias("entity_id"),
            F.when(F.col("o_orderstatus") == "P", "PDB").otherwise("UNP").alias("db_name"),
            F.concat(F.lit("P"), (c % 7).cast("string")).alias("pdbx_db_accession"),
        ),
        "struct_ref_seq": o.select(
            *lead, k.cast("string").alias("align_id"), k.cast("string").alias("ref_id"), abcd(k).alias("pdbx_strand_id"),
            F.concat(F.lit("Q"), (c % 5).cast("string")).alias("pdbx_db_accession"),
            (k % 100 + 1).alias("db_align_beg"), (k % 100 + c % 50 + 1).alias("db_align_end"),
        ),
        "chem_comp": fixed(pick(i, "ALA", "GLY", "SER", "LIG", "HOH", "XXX").alias("id"), F.lit("NON-POLYMER").alias("type"), rows=6),
    }


def structures(spark: SparkSession, sf_dir: str, *only: str) -> DataFrame:
    rows = structure_rows(spark, sf_dir)
    return files({c: (rows[c], STRUCTURE_COLUMNS[c]) for c in only or rows}, "structures", loops=True)


# --- model quality: events -------------------------------------------------------------------------------------

MODEL_SQL = """local AS (SELECT event_id // 64 AS fkey, event_id AS row_id, event_id AS ordinal_id, 1 + event_id % 2 AS model_id,
  'A' AS label_asym_id, event_id % 64 AS label_seq_id, 1 + event_id % 3 AS metric_id, value AS metric_value FROM events),
f AS (SELECT DISTINCT fkey FROM local),
metric AS (SELECT fkey, i AS row_id, i + 1 AS id, (['pLDDT','PAE','ipTM'])[i + 1] AS name, (['local','global','global'])[i + 1] AS mode FROM f, range(3) t(i)),
model AS (SELECT fkey, i AS row_id, i + 1 AS ordinal_id, i + 1 AS model_id, 'Model ' || (i + 1) AS model_name FROM f, range(2) t(i))"""


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    e = table(spark, sf_dir, "events")
    local = e.select(
        F.floor(n / ROWS_PER_FILE).alias("fkey"), n.alias("row_id"), n.alias("ordinal_id"), (1 + n % 2).alias("model_id"),
        F.lit("A").alias("label_asym_id"), (n % 64).alias("label_seq_id"), (1 + n % 3).alias("metric_id"),
        F.col("value").alias("metric_value"),
    )
    i = F.col("row_id")
    fixed = lambda rows: local.select("fkey").distinct().withColumn("row_id", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    metric = fixed(3).select(
        "fkey", "row_id", (i + 1).alias("id"), pick(i, "pLDDT", "PAE", "ipTM").alias("name"), pick(i, "local", "global", "global").alias("mode")
    )
    model = fixed(2).select(
        "fkey", "row_id", (i + 1).alias("ordinal_id"), (i + 1).alias("model_id"), F.concat(F.lit("Model "), (i + 1).cast("string")).alias("model_name")
    )
    return files(
        {
            "ma_model_list": (model, ["ordinal_id", "model_id", "model_name"]),
            "ma_qa_metric": (metric, ["id", "name", "mode"]),
            "ma_qa_metric_local": (
                local, ["ordinal_id", "model_id", "label_asym_id", "label_seq_id", "metric_id", "metric_value"]
            ),
        },
        "models",
        loops=True,
    )


# --- small shapes: customer, supplier --------------------------------------------------------------------------------


def two_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per customer with the blocks ``first`` and ``Second``; words of the format hide in text and comments."""
    c = spread(table(spark, sf_dir, "customer"), "c_custkey")
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    text = F.concat(
        F.lit("# data_comment\ndata_first\n_entry.id "), key, F.lit("\n_struct.title\n;About\ndata_text\nloop_\n;\n"),
        F.lit("data_Second # _not.a tag\n_entry.id '"), name, F.lit("'\nloop_\n_struct_asym.id\n_struct_asym.entity_id\n_struct_asym.details\n"),
        F.lit("A 1 "), F.col("c_nationkey").cast("string"), F.lit(" # first\nB 2 '"), F.col("c_mktsegment"), F.lit("'\n"),
    )
    path = F.concat(F.lit("two/"), key, F.lit(".cif"))
    return c.select(F.lit(0).alias("file_ord"), path.alias("path"), text.alias("content"))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per supplier; ``atom_site`` with other items and other case in every second one."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    even = F.concat(F.lit("data_a\nloop_\n_atom_site.id\n_atom_site.Cartn_x\n"), key, F.lit(" "), F.col("s_acctbal").cast("string"), F.lit("\n"))
    odd = F.concat(F.lit("data_b\nloop_\n_ATOM_SITE.type_symbol\n_ATOM_SITE.ID\nO "), key, F.lit("\n"))
    text = F.when(F.col("s_suppkey") % 2 == 0, even).otherwise(odd)
    path = F.concat(F.lit("mixed/"), F.lpad(key, 12, "0"), F.lit(".cif"))
    return s.select(F.lit(0).alias("file_ord"), path.alias("path"), text.alias("content"))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per customer: NULL markers bare and quoted, and a last row that is cut short."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    mark = pick(F.col("c_custkey"), ".", "?", "'.'", "'?'")
    text = F.concat(
        F.lit("data_m\nloop_\n_p.a\n_p.b\n_p.c\n"), key, F.lit(" "), mark, F.lit(" ?x\n"), key, F.lit(" \"it's\" .5\n"), key, F.lit(" # cut\n")
    )
    path = F.concat(F.lit("marked/"), key, F.lit(".cif"))
    return c.select(F.lit(0).alias("file_ord"), path.alias("path"), text.alias("content"))


# --- dictionaries: supplier -> .dic ---------------------------------------------------------------------------------------

PER_DIC = 16


def dics(spark: SparkSession, sf_dir: str, conflicts: bool = False) -> DataFrame:
    """Dictionary sources, 16 suppliers each. A category ``c<key>`` has the items ``id`` and ``acctbal``.

    Keys 0, 4, .. link to the entry, 1, 5, .. to nothing, 2, 6, .. to category ``c<key div 4>``, 3, 7, .. to an item nobody
    defines. Every source of the extension repeats the items of its suppliers in other case; with ``conflicts`` some of
    them with another type.
    """
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    n = k.cast("string")
    fkey = F.floor(k / PER_DIC)
    parent = (
        F.when(k % 4 == 0, F.lit("_entry.id"))
        .when(k % 4 == 2, F.concat(F.lit("_c"), F.floor(k / 4).cast("string"), F.lit(".id")))
        .when(k % 4 == 3, F.lit("_absent.id"))
    )
    link = F.when(
        parent.isNotNull(),
        F.concat(F.lit("loop_\n_item_linked.child_name\n_item_linked.parent_name\n'_c"), n, F.lit(".id' '"), parent, F.lit("'\n'_c"), n, F.lit(".other' ?\n")),
    ).otherwise("")
    base = F.concat(
        F.lit("save_c"), n, F.lit("\n_category.id c"), n, F.lit("\n_category.description\n; "), F.col("s_name"), F.lit("\n\tof the lake \n;\n_category.mandatory_code "),
        pick(k, "yes", "no", "conditional"), F.lit("\n_category_key.name '_c"), n, F.lit(".id'\nloop_\n_category_group.id\nz_group\ng"),
        F.col("s_nationkey").cast("string"), F.lit("\nz_group\nsave_\nsave__c"), n, F.lit(".id\n_item.name '_c"), n, F.lit(".id'\n_item_type.code "),
        pick(k, "int", "float", "line"), F.lit("\n"), link, F.lit("save_\nsave__c"), n, F.lit(".acctbal\n_item.name '_c"), n,
        F.lit(".acctbal'\n_item_type.code float\n"), F.when(k % 5 == 0, "_pdbx_item_type.code int-range\n").otherwise(""), F.lit("save_\n"),
    )
    shifted = F.when(k % 7 == 0, pick(k + 1, "int", "float", "line")) if conflicts else F.lit(None).cast("string")
    ext = F.concat(
        F.lit("save__C"), n, F.lit(".ID\n_item_type.code "), F.coalesce(shifted, pick(k, "positive_int", "float", "line")), F.lit("\nsave_\n")
    )
    entry = "save_entry\n_category.id entry\n_category_key.name '_entry.id'\nsave_\nsave__entry.id\n_item.name '_entry.id'\n_item_type.code code\nsave_\n"

    def sources(name: str, text: Column, extra: str) -> DataFrame:
        grouped = s.groupBy(fkey.alias("fkey")).agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), text.alias("t")))).alias("l"))
        content = F.concat(
            F.lit(f"data_{name}\n_dictionary.version 1."), F.col("fkey").cast("string"), F.lit("\n" + extra),
            F.array_join(F.transform("l", lambda x: x["t"]), ""),
        )
        path = F.concat(F.lit(f"{name}"), F.col("fkey").cast("string"), F.lit(".dic"))
        return grouped.select(F.lit(0).alias("file_ord"), path.alias("path"), content.alias("content"))

    return sources("base", base, entry).unionAll(sources("ext", ext, ""))


def dic_sources(src: DataFrame) -> DataFrame:
    """Priority and documentation address of each dictionary source: all base sources come first."""
    base = F.col("path").startswith("base")
    number = F.regexp_extract("path", r"(\d+)\.dic$", 1).cast("bigint")
    return src.select(
        F.col("path").alias("source"),
        F.struct(F.when(base, 0).otherwise(1).alias("rank"), number.alias("number")).alias("priority"),
        F.concat(F.lit("https://example.org/"), "path").alias("documentation_url"),
    )
