"""Structural analyses over collections of files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.operators import analyses, edit, geometry
from cif_lake.plans import corpus
from cif_lake.plans.corpus import MODEL_SQL
from cif_lake.plans.registry import query
from cif_lake.plans.relational import S
from cif_lake.plans.scans import A, atoms
from cif_lake.sources import read
from cif_lake.sources.dictionary import Dictionary



def numbered(frame: DataFrame) -> DataFrame:
    """File name -> number of the file."""
    return frame.withColumn("fkey", F.regexp_extract("filename", r"(\d+)\.cif$", 1).cast("bigint")).drop("filename")


def structure(spark, sf, *names):
    """Scanned categories of the structures corpus, with position."""
    src = corpus.structures(spark, sf, *names)
    return [read.scan(src, c, row_id=True).drop("file_ord", "block_ord") for c in names]


# --- metadata ---------------------------------------------------------------------------------------------------


@query(
    """SELECT 'O' || o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS resolution, o_orderpriority AS method,
    'REFMAC|' || CASE WHEN o_orderkey % 11 = 0 THEN 'AlphaFold' ELSE 'Coot 1' END AS software, o_orderkey % 11 = 0 AS is_alphafold FROM orders"""
)
def entry_summary(spark, sf):
    wanted = {"entry": ["id"], "refine": ["ls_d_res_high"], "exptl": ["method"], "software": ["name"]}
    t = read.scan_apart(corpus.entries(spark, sf), wanted, row_id=True)
    out = analyses.entry_summary(t["entry"], t["refine"], t["exptl"], t["software"])
    return out.drop("filename").withColumn("software", F.array_join("software", "|"))


@query(
    A + """SELECT fkey, count(DISTINCT label_asym_id || ':' || label_seq_id) FILTER ("group_PDB" = 'ATOM') AS total_residues FROM atoms GROUP BY 1"""
)
def residue_count(spark, sf):
    return numbered(analyses.residue_count(atoms(spark, sf, filename=True)))


@query(
    A + """SELECT fkey, label_asym_id AS label_chain, min(auth_asym_id) AS auth_chain, count(*) AS atoms FROM atoms WHERE "group_PDB" = 'ATOM' GROUP BY 1, 2"""
)
def label_auth_chains(spark, sf):
    return numbered(analyses.label_auth_chains(atoms(spark, sf, filename=True)))


@query(
    A + """SELECT fkey, auth_asym_id AS auth_chain, count(DISTINCT label_seq_id) AS chain_length FROM atoms
    WHERE "group_PDB" = 'ATOM' AND label_comp_id NOT IN ('HOH') GROUP BY 1, 2"""
)
def chain_lengths(spark, sf):
    return numbered(analyses.chain_lengths(atoms(spark, sf, filename=True)))


_SEQ = """u AS (SELECT fkey, row_id, align_id, ref_id, pdbx_strand_id AS chain, pdbx_db_accession AS acc, db_align_beg AS b, db_align_end AS e FROM struct_ref_seq s
    WHERE EXISTS (SELECT 1 FROM struct_ref r WHERE r.fkey = s.fkey AND r.id = s.ref_id AND r.db_name = 'UNP'))"""


@query(
    S + f""", {_SEQ} SELECT fkey, chain, acc AS accession, min(b) AS uniprot_start, max(e) AS uniprot_end, CAST(sum(e - b + 1) AS BIGINT) AS aligned_residues FROM u GROUP BY 1, 2, 3"""
)
def chain_accessions(spark, sf):
    ref, seq = structure(spark, sf, "struct_ref", "struct_ref_seq")
    return numbered(analyses.chain_accessions(seq, ref))


@query(
    S + f""", {_SEQ}, c AS (SELECT fkey, auth_asym_id, count(DISTINCT label_seq_id) AS n FROM atom_site WHERE label_comp_id <> 'HOH' GROUP BY 1, 2)
    SELECT c.fkey, c.auth_asym_id AS auth_chain, c.n AS chain_length, u.acc AS uniprot_accession,
    (SELECT label_asym_id FROM atom_site a WHERE a.fkey = c.fkey AND a.auth_asym_id = c.auth_asym_id ORDER BY row_id LIMIT 1) AS label_chain
    FROM c LEFT JOIN u ON u.fkey = c.fkey AND u.chain = c.auth_asym_id"""
)
def chain_metadata(spark, sf):
    a, ref, seq = structure(spark, sf, "atom_site", "struct_ref", "struct_ref_seq")
    return numbered(analyses.chain_metadata(a, seq, ref))


@query(
    """SELECT 'entries/' || o_orderkey || '.cif' AS filename, 'O' || o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS resolution,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS deposit_date FROM orders"""
)
def collection_metadata(spark, sf):
    wanted = {"entry": ["id"], "refine": ["ls_d_res_high"], "pdbx_database_status": ["recvd_initial_deposition_date"]}
    return analyses.collection_metadata(read.scan_many(corpus.entries(spark, sf), wanted))


# --- secondary structure ---------------------------------------------------------------------------------------------


def some_files(spark, sf, *names):
    """Scans of a corpus in which every third file has no helix and every fourth no strand, and the list of its files."""
    rows = corpus.structure_rows(spark, sf)
    rows["struct_conf"] = rows["struct_conf"].filter("fkey % 3 <> 1 OR conf_type_id <> 'HELX_P'")
    rows["struct_sheet_range"] = rows["struct_sheet_range"].filter("fkey % 4 <> 1")
    rows["atom_site"] = rows["atom_site"].filter("fkey % 5 <> 1")
    names = {"struct_conf", "struct_sheet_range", "atom_site", "entity", *names}
    return corpus.files({c: (rows[c], corpus.STRUCTURE_COLUMNS[c]) for c in sorted(names)}, "structures", loops=True)


_SOME = """helix AS (SELECT * FROM struct_conf WHERE conf_type_id = 'HELX_P' AND fkey % 3 <> 1),
    strand AS (SELECT * FROM struct_sheet_range WHERE fkey % 4 <> 1), atom AS (SELECT * FROM atom_site WHERE fkey % 5 <> 1)"""


@query(
    S + f""", {_SOME} SELECT f.fkey, count(h.id) AS nr_helices, CAST(sum(end_label_seq_id - beg_label_seq_id + 1) AS BIGINT) AS nr_helix_residues
    FROM f LEFT JOIN helix h ON h.fkey = f.fkey GROUP BY 1"""
)
def helix_residues(spark, sf):
    src = some_files(spark, sf)
    return numbered(analyses.helix_residues(read.scan(src, "struct_conf"), files=read.file_list(src)))


@query(
    S + f""", {_SOME} SELECT f.fkey, count(s.id) AS nr_strands, CAST(sum(end_label_seq_id - beg_label_seq_id + 1) AS BIGINT) AS nr_sheet_residues
    FROM f LEFT JOIN strand s ON s.fkey = f.fkey GROUP BY 1"""
)
def strand_residues(spark, sf):
    src = some_files(spark, sf)
    return numbered(analyses.strand_residues(read.scan(src, "struct_sheet_range"), files=read.file_list(src)))


@query(
    S + """SELECT fkey, 'helix' AS kind, beg_label_asym_id AS chain, beg_label_seq_id AS start, end_label_seq_id AS finish FROM struct_conf WHERE conf_type_id = 'HELX_P'
    UNION ALL SELECT fkey, 'strand', beg_label_asym_id, beg_label_seq_id, end_label_seq_id FROM struct_sheet_range"""
)
def ss_spans(spark, sf):
    return numbered(analyses.ss_spans(*structure(spark, sf, "struct_conf", "struct_sheet_range")))


_SHARES = f"""{_SOME}, spans AS (SELECT fkey, 'h' AS kind, end_label_seq_id - beg_label_seq_id + 1 AS n FROM helix
      UNION ALL SELECT fkey, 's', end_label_seq_id - beg_label_seq_id + 1 FROM strand),
    shares AS (SELECT fkey, (SELECT count(*) FROM (SELECT DISTINCT label_asym_id, label_seq_id FROM atom a WHERE a.fkey = f.fkey
        AND label_asym_id IS NOT NULL AND label_seq_id IS NOT NULL)) AS residues,
      (SELECT sum(n) FROM spans p WHERE p.fkey = f.fkey AND kind = 'h')::BIGINT AS helix, (SELECT sum(n) FROM spans p WHERE p.fkey = f.fkey AND kind = 's')::BIGINT AS sheet FROM f)"""

_RATIO_ITEMS = {
    "atom_site": ["group_PDB", "label_asym_id", "label_seq_id"],
    "struct_conf": ["conf_type_id", "beg_label_seq_id", "end_label_seq_id"],
    "struct_sheet_range": ["beg_label_seq_id", "end_label_seq_id"],
}


def shares(spark, sf):
    src = some_files(spark, sf)
    return analyses.ss_ratios_of(read.scan_many(src, _RATIO_ITEMS), files=read.file_list(src))


@query(
    S + f""", {_SHARES} SELECT fkey, residues AS nr_residues, helix AS nr_helix_residues, sheet AS nr_sheet_residues,
    round(helix / nullif(residues, 0), 3) AS helix_ratio, round(sheet / nullif(residues, 0), 3) AS sheet_ratio FROM shares"""
)
def ss_ratios(spark, sf):
    return numbered(shares(spark, sf))


@query(S + f""", {_SHARES} SELECT fkey, (helix >= 200 AND sheet / nullif(residues, 0) <= 3.5) AS passed FROM shares""")
def ss_filter(spark, sf):
    return numbered(analyses.ss_filter(shares(spark, sf), 200, 3.5))


# --- confidence ----------------------------------------------------------------------------------------------------------

_RES = """r AS (SELECT fkey, auth_asym_id, label_seq_id, max("B_iso_or_equiv") AS b FROM atoms WHERE "group_PDB" = 'ATOM' AND label_comp_id NOT IN ('HOH') GROUP BY 1, 2, 3)"""


@query(A + f", {_RES} SELECT fkey, auth_asym_id AS chain, count(*) FILTER (b > 20) AS high_conf_residues, count(*) AS total_residues FROM r GROUP BY 1, 2")
def confident_residues(spark, sf):
    return numbered(analyses.confident_residues(atoms(spark, sf, filename=True), 20))


@query(
    A + f""", {_RES} SELECT a.fkey, count(b) FILTER (b > 20) AS high_confidence_residues, count(b) FILTER (b > 20) BETWEEN 8 AND 10000000 AS passed
    FROM (SELECT DISTINCT fkey FROM atoms) a LEFT JOIN r ON r.fkey = a.fkey GROUP BY 1"""
)
def confidence_pass(spark, sf):
    return numbered(analyses.confidence_pass(atoms(spark, sf, filename=True), 20, 8))


_KEPT = """kept AS (SELECT * FROM atoms a WHERE NOT coalesce("group_PDB" = 'ATOM' AND label_comp_id NOT IN ('HOH') AND EXISTS (
    SELECT 1 FROM (SELECT fkey, label_seq_id FROM atoms WHERE "group_PDB" = 'ATOM' AND label_comp_id NOT IN ('HOH') GROUP BY 1, 2 HAVING max("B_iso_or_equiv") <= 20) d
    WHERE d.fkey = a.fkey AND d.label_seq_id = a.label_seq_id), false))"""


@query(A + f", {_KEPT} SELECT id FROM kept")
def drop_low_confidence(spark, sf):
    return analyses.drop_low_confidence(atoms(spark, sf, filename=True), 20).select("id")


@query(
    A + f""", {_KEPT} SELECT fkey, auth_asym_id AS chain, count(DISTINCT label_seq_id) AS residues FROM kept WHERE "group_PDB" = 'ATOM' AND label_comp_id NOT IN ('HOH') GROUP BY 1, 2"""
)
def confidence_recount(spark, sf):
    return numbered(analyses.confidence_recount(analyses.drop_low_confidence(atoms(spark, sf, filename=True), 20)))


@query(
    f"""WITH {MODEL_SQL} SELECT l.fkey, l.ordinal_id, m.name AS metric_name, d.model_name, l.metric_value FROM local l
    JOIN metric m ON m.fkey = l.fkey AND m.id = l.metric_id JOIN model d ON d.fkey = l.fkey AND d.ordinal_id = l.model_id WHERE l.metric_value BETWEEN 0 AND 20"""
)
def quality_metrics(spark, sf):
    src = corpus.models(spark, sf)
    local, metric, model = (read.scan(src, c) for c in ("ma_qa_metric_local", "ma_qa_metric", "ma_model_list"))
    named = analyses.quality_metrics(local.withColumnRenamed("ordinal_id", "ordinal"), metric, model)
    out = named.filter(F.col("metric_value").between(0, 20))
    return numbered(out.select("filename", F.col("ordinal").alias("ordinal_id"), "metric_name", "model_name", "metric_value"))


# --- sequence mapping --------------------------------------------------------------------------------------------------------


@query(
    S + f""", {_SEQ} SELECT fkey, chain, acc AS accession, min(b) AS uniprot_start, max(e) AS uniprot_end, CAST(sum(e - b + 1) AS BIGINT) AS aligned_residues,
    round(sum(e - b + 1) / (max(e) - min(b) + 1), 3) AS sequence_identity FROM u GROUP BY 1, 2, 3"""
)
def accession_flat(spark, sf):
    ref, seq = structure(spark, sf, "struct_ref", "struct_ref_seq")
    return numbered(analyses.chain_accessions(seq, ref, identity=True))


@query(
    S + f""", {_SEQ}, f2 AS (SELECT fkey, chain, acc, CAST(sum(e - b + 1) AS BIGINT) AS aligned FROM u GROUP BY 1, 2, 3)
    SELECT fkey, chain, acc, aligned FROM f2 QUALIFY row_number() OVER (PARTITION BY fkey, chain ORDER BY aligned DESC, acc) = 1"""
)
def accession_best(spark, sf):
    ref, seq = structure(spark, sf, "struct_ref", "struct_ref_seq")
    return numbered(analyses.accession_best(seq, ref))


@query(
    S + """SELECT fkey, pdbx_strand_id AS chain, pdbx_db_accession AS accession, min(db_align_beg) AS start, max(db_align_end) AS finish FROM struct_ref_seq
    WHERE CAST(align_id AS BIGINT) % 2 = 0 GROUP BY 1, 2, 3"""
)
def sifts_segments(spark, sf):
    """Cross-reference segments, best mappings only."""
    (seq,) = structure(spark, sf, "struct_ref_seq")
    segments = seq.select(
        "filename", F.col("pdbx_strand_id").alias("asym_id"), F.col("pdbx_db_accession").alias("unp_acc"),
        F.col("db_align_beg").alias("unp_start"), F.col("db_align_end").alias("unp_end"),
        F.when(F.col("align_id").cast("bigint") % 2 == 0, "y").otherwise("n").alias("best_mapping"),
    )
    return numbered(analyses.sifts_segments(segments))


@query(S + f", {_SEQ} SELECT fkey, align_id, ref_id, chain, acc, b AS db_align_beg, e AS db_align_end FROM u")
def accession_raw(spark, sf):
    ref, seq = structure(spark, sf, "struct_ref", "struct_ref_seq")
    rows = analyses.sequence_segments(seq, ref)
    return numbered(
        rows.select(
            "filename", "align_id", "ref_id", F.col("pdbx_strand_id").alias("chain"), F.col("pdbx_db_accession").alias("acc"), "db_align_beg", "db_align_end"
        )
    )


@query("SELECT count(*) AS atoms FROM embeddings")
def atom_totals(spark, sf):
    return analyses.atom_totals(read.row_counts(corpus.atoms(spark, sf), ["atom_site"]))


# --- keep one chain ----------------------------------------------------------------------------------------------------------

_CHAIN = """lab AS (SELECT DISTINCT fkey, label_asym_id AS x FROM atom_site WHERE auth_asym_id = 'A'),
  ent AS (SELECT DISTINCT fkey, label_entity_id AS x FROM atom_site WHERE auth_asym_id = 'A'),
  k_atom AS (SELECT * FROM atom_site WHERE auth_asym_id = 'A' OR auth_asym_id IS NULL),
  k_conf AS (SELECT * FROM struct_conf WHERE beg_auth_asym_id = 'A' AND end_auth_asym_id = 'A'),
  k_range AS (SELECT * FROM struct_sheet_range WHERE beg_auth_asym_id = 'A' AND end_auth_asym_id = 'A'),
  k_asym AS (SELECT * FROM struct_asym t WHERE id IN (SELECT x FROM lab WHERE lab.fkey = t.fkey)),
  k_gen AS (SELECT * FROM pdbx_struct_assembly_gen t WHERE NOT EXISTS (SELECT 1 FROM unnest(string_split(asym_id_list, ',')) u(p)
    WHERE p NOT IN (SELECT x FROM lab WHERE lab.fkey = t.fkey))),
  k_assembly AS (SELECT * FROM pdbx_struct_assembly t WHERE id IN (SELECT assembly_id FROM k_gen g WHERE g.fkey = t.fkey)),
  k_conf_type AS (SELECT * FROM struct_conf_type t WHERE id IN (SELECT conf_type_id FROM k_conf g WHERE g.fkey = t.fkey)),
  k_ref AS (SELECT * FROM struct_ref t WHERE entity_id IN (SELECT x FROM ent WHERE ent.fkey = t.fkey)),
  k_seq AS (SELECT * FROM struct_ref_seq t WHERE ref_id IN (SELECT id FROM k_ref g WHERE g.fkey = t.fkey)),
  k_entity AS (SELECT * FROM entity t WHERE id IN (SELECT x FROM ent WHERE ent.fkey = t.fkey)),
  k_comp AS (SELECT * FROM chem_comp t WHERE id IN (SELECT label_comp_id FROM k_atom a WHERE a.fkey = t.fkey))"""

_KEPT_TABLES = {
    "atom_site": "k_atom", "struct_conf": "k_conf", "struct_sheet_range": "k_range", "struct_asym": "k_asym",
    "pdbx_struct_assembly_gen": "k_gen", "pdbx_struct_assembly": "k_assembly", "struct_conf_type": "k_conf_type", "struct_ref": "k_ref",
    "struct_ref_seq": "k_seq", "entity": "k_entity", "chem_comp": "k_comp",
}


def structure_tables(spark, sf) -> dict[str, DataFrame]:
    """All categories of the structures corpus; the text is parsed, cut and typed once, as the rules read most of them often."""
    return read.scan_apart(corpus.structures(spark, sf), corpus.STRUCTURE_COLUMNS, row_id=True)


def _long(tables: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """``t, fkey, row_id`` of every kept row."""
    parts = [numbered(t.select("filename", "row_id")).select(F.lit(c).alias("t"), "fkey", "row_id") for c, t in tables.items()]
    return reduce(DataFrame.unionAll, parts)


@query(
    S + f", {_CHAIN} " + " UNION ALL ".join(f"SELECT '{t}' AS t, fkey, count(*) AS n FROM {k} GROUP BY fkey" for t, k in _KEPT_TABLES.items())
)
def keep_chain(spark, sf):
    kept = edit.keep_chain(structure_tables(spark, sf), "A")
    return _long(kept).groupBy("t", "fkey").agg(F.count("*").alias("n"))


@query(
    S + f""", {_CHAIN} SELECT 'atom_site' AS t, fkey, count(*) AS n, count(*) FILTER (auth_asym_id <> 'A') AS other_chain FROM k_atom GROUP BY fkey
    UNION ALL SELECT 'struct_conf', fkey, count(*), 0 FROM k_conf GROUP BY fkey UNION ALL SELECT 'entity', fkey, count(*), 0 FROM k_entity GROUP BY fkey"""
)
def keep_chain_check(spark, sf):
    kept = edit.keep_chain(structure_tables(spark, sf), "A")
    return numbered(edit.keep_chain_check({c: kept[c] for c in ("atom_site", "struct_conf", "entity")}, "A"))


@query(
    S + """SELECT fkey, id, CASE WHEN auth_asym_id = 'B' THEN 'Z' ELSE auth_asym_id END AS auth, CASE WHEN label_asym_id = 'B' THEN 'Z' ELSE label_asym_id END AS label FROM atom_site
    UNION ALL SELECT fkey, 'c' || id, CASE WHEN end_auth_asym_id = 'B' THEN 'Z' ELSE end_auth_asym_id END, CASE WHEN beg_label_asym_id = 'B' THEN 'Z' ELSE beg_label_asym_id END FROM struct_conf
    UNION ALL SELECT fkey, 'r' || align_id, CASE WHEN pdbx_strand_id = 'B' THEN 'Z' ELSE pdbx_strand_id END, NULL FROM struct_ref_seq
    UNION ALL SELECT fkey, 'a' || id, CASE WHEN id = 'B' THEN 'Z' ELSE id END, entity_id FROM struct_asym"""
)
def rename_chain(spark, sf):
    names = ["atom_site", "struct_conf", "struct_ref_seq", "struct_asym"]
    before = dict(zip(names, structure(spark, sf, *names)))
    t = edit.rename_chain(before, "B", "Z")
    asym = t["struct_asym"].join(before["struct_asym"].select("filename", "row_id", F.col("id").alias("old")), ["filename", "row_id"])
    out = t["atom_site"].select("filename", "id", F.col("auth_asym_id").alias("auth"), F.col("label_asym_id").alias("label"))
    out = out.unionAll(t["struct_conf"].select("filename", F.concat(F.lit("c"), "id"), "end_auth_asym_id", "beg_label_asym_id"))
    out = out.unionAll(t["struct_ref_seq"].select("filename", F.concat(F.lit("r"), "align_id"), "pdbx_strand_id", F.lit(None).cast("string")))
    return numbered(out.unionAll(asym.select("filename", F.concat(F.lit("a"), "old"), "id", "entity_id")))


@query(
    """SELECT fkey, t, col, ns FROM (SELECT DISTINCT o_orderkey // 64 AS fkey FROM orders), (VALUES ('struct_conf', 'beg_auth_asym_id', 'auth'), ('struct_conf', 'end_auth_asym_id', 'auth'),
    ('struct_conf', 'beg_label_asym_id', 'label'), ('struct_sheet_range', 'beg_auth_asym_id', 'auth'), ('struct_sheet_range', 'end_auth_asym_id', 'auth'),
    ('atom_site', 'label_asym_id', 'label')) x(t, col, ns)"""
)
def chain_columns(spark, sf):
    """Chain columns of the categories of each file, found through the links."""
    links = read.list_relationships(corpus.structures(spark, sf), Dictionary.seed(spark))
    # The links carry the file along.
    found = edit.chain_columns(links.withColumn("child_table", F.concat_ws("\t", F.col("path"), "child_table")))
    parts = F.split("t", "\t")
    return numbered(found.select(F.get(parts, 0).alias("filename"), F.get(parts, 1).alias("t"), "col", "ns"))


@query(S + f", {_CHAIN} SELECT fkey, assembly_id FROM k_gen")
def assembly_filter(spark, sf):
    a, gen = structure(spark, sf, "atom_site", "pdbx_struct_assembly_gen")
    labels = a.filter(F.col("auth_asym_id") == "A").select("filename", "label_asym_id")
    return numbered(edit.assembly_filter(gen, labels).select("filename", "assembly_id"))


# --- geometry ------------------------------------------------------------------------------------------------------------------

_D = """sqrt((l."Cartn_x"-a."Cartn_x")*(l."Cartn_x"-a."Cartn_x") + (l."Cartn_y"-a."Cartn_y")*(l."Cartn_y"-a."Cartn_y") + (l."Cartn_z"-a."Cartn_z")*(l."Cartn_z"-a."Cartn_z"))"""
_POCKET = f"""c AS (SELECT a.fkey, a.auth_seq_id, a.label_comp_id, a.label_atom_id, l.label_atom_id AS ligand_atom, {_D} AS d FROM atoms l JOIN atoms a ON l.fkey = a.fkey
    WHERE l.label_comp_id = 'LIG' AND l.auth_asym_id = 'A' AND a.auth_asym_id = 'A' AND a.label_comp_id NOT IN ('LIG', 'HOH') AND {_D} <= 8)"""


@query(A + """SELECT id, "Cartn_x" AS x, "Cartn_y" AS y, "Cartn_z" AS z FROM atoms WHERE "Cartn_x" IS NOT NULL""")
def points3d(spark, sf):
    return geometry.points3d(atoms(spark, sf)).select("id", "point.x", "point.y", "point.z")


@query(
    A + """SELECT id, round(sqrt("Cartn_x" * "Cartn_x" + "Cartn_y" * "Cartn_y" + "Cartn_z" * "Cartn_z"), 6) AS dist FROM atoms"""
)
def distance3d(spark, sf):
    p = geometry.points3d(atoms(spark, sf)).withColumn("origin", F.struct(*[F.lit(0.0).alias(i) for i in "xyz"]))
    return p.select("id", F.round(geometry.distance("point", "origin"), 6).alias("dist"))


@query(
    A + """SELECT fkey, round(max("Cartn_x") - min("Cartn_x"), 1) AS width_x, round(max("Cartn_y") - min("Cartn_y"), 1) AS width_y, round(max("Cartn_z") - min("Cartn_z"), 1) AS depth_z FROM atoms GROUP BY 1"""
)
def bounding_box(spark, sf):
    return numbered(geometry.bounding_box(atoms(spark, sf, filename=True)))


@query(
    A + f", {_POCKET} SELECT fkey, auth_seq_id AS seq, label_comp_id AS res, count(DISTINCT label_atom_id) AS atoms_in_contact, round(min(d), 2) AS min_dist FROM c GROUP BY 1, 2, 3"
)
def pocket_residues(spark, sf):
    return numbered(geometry.pocket_residues(atoms(spark, sf, filename=True), "LIG", "A", 8.0, salts=4))


@query(
    A + f""", {_POCKET} SELECT fkey, auth_seq_id AS seq, label_comp_id AS res, ligand_atom, round(d, 2) AS dist FROM c
    QUALIFY row_number() OVER (PARTITION BY fkey, auth_seq_id ORDER BY d, label_comp_id, ligand_atom) = 1"""
)
def pocket_closest(spark, sf):
    return numbered(geometry.pocket_closest(atoms(spark, sf, filename=True), "LIG", "A", 8.0, salts=4))


@query(
    A + f"""SELECT a.fkey, a.label_comp_id || a.auth_seq_id AS res_a, l.label_comp_id || l.auth_seq_id AS res_b, count(*) AS atom_pairs, round(min({_D}), 2) AS min_dist
    FROM atoms a JOIN atoms l ON a.fkey = l.fkey WHERE a.auth_asym_id = 'A' AND l.auth_asym_id = 'B' AND a.label_comp_id NOT IN ('LIG', 'HOH')
    AND l.label_comp_id NOT IN ('LIG', 'HOH') AND {_D} <= 8 GROUP BY 1, 2, 3"""
)
def interface_pairs(spark, sf):
    return numbered(geometry.interface_pairs(atoms(spark, sf, filename=True), "A", "B", 8.0, ("LIG", "HOH"), salts=4).withColumn("atom_pairs", F.col("atom_pairs").cast("bigint")))


@query(
    A + f"""SELECT a.fkey, a.auth_seq_id AS water_seq, count(*) AS ligand_atom_contacts, round(min({_D}), 2) AS min_dist FROM atoms l JOIN atoms a ON l.fkey = a.fkey
    WHERE l.label_comp_id = 'LIG' AND l.auth_asym_id = 'A' AND a.label_comp_id = 'HOH' AND a.auth_asym_id = 'A' AND {_D} <= 8 GROUP BY 1, 2"""
)
def hydration_shell(spark, sf):
    return numbered(geometry.hydration_shell(atoms(spark, sf, filename=True), "LIG", "A", 8.0, salts=4))


@query(
    A + """, c AS (SELECT fkey, avg("Cartn_x") AS cx, avg("Cartn_y") AS cy, avg("Cartn_z") AS cz FROM atoms GROUP BY 1)
    SELECT id, round(cy - "Cartn_y", 6) AS x, round("Cartn_x" - cx, 6) AS y, round("Cartn_z" - cz, 6) AS z FROM atoms JOIN c USING (fkey)"""
)
def rigid_transform(spark, sf):
    t = geometry.rigid_transform(atoms(spark, sf, filename=True))
    return t.select("id", *[(F.round(f"after.{i}", 6) + 0.0).alias(i) for i in "xyz"])


@query(
    A + """SELECT fkey, auth_asym_id, count(*) AS ca_atoms, count(*) AS ca_trace_points, string_agg(id, ',' ORDER BY auth_seq_id, "Cartn_x") AS ids
    FROM atoms WHERE label_atom_id = 'CA' AND label_comp_id NOT IN ('HOH') GROUP BY 1, 2"""
)
def ca_trace(spark, sf):
    a = atoms(spark, sf, filename=True)
    traced = geometry.ca_trace(a)
    # The points of the trace in order, as atom ids.
    points = traced.select("filename", "auth_asym_id", "ca_atoms", "ca_trace_points", F.posexplode(F.split(F.regexp_extract("trace", r"\((.*)\)", 1), ", ")).alias("pos", "p"))
    xy = a.filter(F.col("label_atom_id") == "CA").select("filename", "id", F.concat_ws(" ", F.col("Cartn_x").cast("string"), F.col("Cartn_y").cast("string")).alias("p"))
    ids = points.join(xy, ["filename", "p"]).groupBy("filename", "auth_asym_id", "ca_atoms", "ca_trace_points")
    listed = F.array_sort(F.collect_list(F.struct("pos", "id")))
    return numbered(ids.agg(F.array_join(F.transform(listed, lambda x: x["id"]), ",").alias("ids")))
