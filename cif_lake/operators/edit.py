"""Edits as DataFrame transforms: the input is never changed, the result is written to a new place.

Tables carry the ``keys`` of their file (by default ``filename``) and the position ``row_id``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cif_lake.operators.relational import use_checkpoints

KEYS = ("filename",)


def insert_rows(table: DataFrame, rows: DataFrame, keys: Sequence[str] = KEYS, order: str = "ord") -> DataFrame:
    """Append rows behind the last row of their file; columns they do not name are NULL.

    ``rows`` has ``keys``, ``order`` (position among the new rows of the file, from 0) and any columns of the table.
    """
    last = table.groupBy(*keys).agg(F.max("row_id").alias("last"))
    placed = rows.join(last, list(keys), "left").withColumn("row_id", F.coalesce("last", F.lit(-1)) + 1 + F.col(order))
    return table.unionByName(placed.drop("last", order), allowMissingColumns=True)


def update_rows(table: DataFrame, changes: dict[str, Column], where: Column) -> DataFrame:
    """Set columns where the condition is true. One select: all expressions read the old values."""
    hit = F.coalesce(where, F.lit(False))
    return table.select(
        *[
            F.when(hit, changes[c]).otherwise(F.col(c)).cast(table.schema[c].dataType).alias(c) if c in changes else F.col(c)
            for c in table.columns
        ]
    )


def delete_rows(table: DataFrame, where: Column) -> DataFrame:
    """Drop the rows whose condition is true; an unknown (NULL) condition keeps the row."""
    return table.filter(~F.coalesce(where, F.lit(False)))


def delete_by_group(
    table: DataFrame, group: Sequence[str], having: Column, where: Column | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Drop the rows whose group satisfies an aggregate condition; both decided on the table as it was."""
    where = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    marked = table.withColumn("in_scope", where)
    bad = marked.filter("in_scope").groupBy(*keys, *group).agg(having.alias("bad")).filter("bad").drop("bad")
    on = [*keys, *group, "in_scope"]
    return marked.join(bad.withColumn("in_scope", F.lit(True)), on, "left_anti").select(*table.columns)


def keep_in(table: DataFrame, column: str, allowed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """What ``DELETE ... WHERE column NOT IN (allowed)`` leaves, file by file.

    ``allowed`` has ``keys`` and one more column. NULL follows NOT IN: a NULL value stays unless the set is empty, and a NULL in
    the set keeps every row of that file.
    """
    name = next(c for c in allowed.columns if c not in keys)
    # The set is used twice and is often the result of other edits: computed once, kept in the checkpoint folder.
    use_checkpoints(table.sparkSession)
    allowed = allowed.select(*keys, F.col(name).alias("allowed")).distinct().checkpoint()
    stats = allowed.groupBy(*keys).agg(F.count("*").alias("size"), F.count_if(F.col("allowed").isNull()).alias("nulls"))
    hit = allowed.filter(F.col("allowed").isNotNull()).withColumn("hit", F.lit(True))
    marked = table.withColumn("allowed", F.col(column)).join(hit, [*keys, "allowed"], "left").join(stats, list(keys), "left")
    unknown = (F.coalesce("size", F.lit(0)) > 0) & (F.col(column).isNull() | (F.col("nulls") > 0))
    return marked.filter(F.col("hit").isNotNull() | unknown).select(*table.columns)


def assembly_filter(
    table: DataFrame, labels: DataFrame, column: str = "asym_id_list", keys: Sequence[str] = KEYS
) -> DataFrame:
    """Drop rows whose comma list names a chain that is not in ``labels``."""
    name = next(c for c in labels.columns if c not in keys)
    labels = labels.select(*keys, F.col(name).alias("part")).distinct()
    open_files = labels.filter(F.col("part").isNull()).select(*keys)  # NOT IN is never true there
    parts = table.select(*keys, "row_id", F.explode(F.split(F.col(column), ",")).alias("part"))
    bad = parts.join(labels, [*keys, "part"], "left_anti").join(open_files, list(keys), "left_anti")
    return table.join(bad.select(*keys, "row_id").distinct(), [*keys, "row_id"], "left_anti").select(*table.columns)


# --- keep one chain of a structure ------------------------------------------------------------------------

# Which columns name a chain or point to a row of another category.
AUTHOR_CHAIN = {
    "atom_site": ["auth_asym_id"],
    "pdbx_unobs_or_zero_occ_atoms": ["auth_asym_id"],
    "pdbx_unobs_or_zero_occ_residues": ["auth_asym_id"],
    "pdbx_validate_torsion": ["auth_asym_id"],
    "struct_site_gen": ["auth_asym_id"],
    "struct_site": ["pdbx_auth_asym_id"],
    "struct_conf": ["beg_auth_asym_id", "end_auth_asym_id"],
    "struct_sheet_range": ["beg_auth_asym_id", "end_auth_asym_id"],
    "pdbx_refine_tls_group": ["beg_auth_asym_id", "end_auth_asym_id"],
    "pdbx_struct_sheet_hbond": ["range_1_auth_asym_id", "range_2_auth_asym_id"],
    "pdbx_poly_seq_scheme": ["pdb_strand_id"],
    "pdbx_nonpoly_scheme": ["pdb_strand_id"],
}
# Author columns that are renamed but do not decide which rows stay.
AUTHOR_CHAIN_NAMES = {
    "struct_ref_seq": ["pdbx_strand_id"],
    "struct_ref_seq_dif": ["pdbx_pdb_strand_id"],
    "entity_poly": ["pdbx_strand_id"],
}
LABEL_CHAIN = {
    "atom_site": ["label_asym_id"],
    "pdbx_unobs_or_zero_occ_atoms": ["label_asym_id"],
    "pdbx_unobs_or_zero_occ_residues": ["label_asym_id"],
    "struct_site_gen": ["label_asym_id"],
    "struct_conf": ["beg_label_asym_id", "end_label_asym_id"],
    "struct_sheet_range": ["beg_label_asym_id", "end_label_asym_id"],
    "pdbx_refine_tls_group": ["beg_label_asym_id", "end_label_asym_id"],
    "pdbx_struct_sheet_hbond": ["range_1_label_asym_id", "range_2_label_asym_id"],
    "pdbx_poly_seq_scheme": ["asym_id"],
    "pdbx_nonpoly_scheme": ["asym_id"],
    "struct_asym": ["id"],
}
# child category, child column, parent category, parent column; in order.
STILL_REFERENCED = [
    ("pdbx_struct_assembly_prop", "biol_id", "pdbx_struct_assembly_gen", "assembly_id"),
    ("pdbx_struct_assembly", "id", "pdbx_struct_assembly_gen", "assembly_id"),
    ("pdbx_struct_oper_list", "id", "pdbx_struct_assembly_gen", "oper_expression"),
    ("struct_sheet", "id", "struct_sheet_range", "sheet_id"),
    ("struct_site", "id", "struct_site_gen", "site_id"),
    ("pdbx_refine_tls", "id", "pdbx_refine_tls_group", "refine_tls_id"),
    ("struct_conf_type", "id", "struct_conf", "conf_type_id"),
]
BY_ENTITY = [
    "entity_name_com", "entity_poly", "entity_poly_seq", "entity_src_gen", "pdbx_entity_src_syn", "pdbx_entity_nonpoly",
    "struct_ref",
]
SEQUENCE_REFERENCES = [
    ("struct_ref_seq", "ref_id", "struct_ref", "id"),
    ("struct_ref_seq_dif", "align_id", "struct_ref_seq", "align_id"),
]
BY_COMPONENT = {"chem_comp_atom": "comp_id", "chem_comp_bond": "comp_id", "chem_comp": "id"}


def keep_chain(
    tables: dict[str, DataFrame], chain: str, keys: Sequence[str] = KEYS, strand_rows: bool = False
) -> dict[str, DataFrame]:
    """Keep one author chain and everything that still belongs to it, in all categories given.

    The label chains and entities of the chain are taken before any row goes. A strand list that names the chain among
    others is reduced to it. ``strand_rows`` also drops alignments of other strands from ``struct_ref_seq``.
    """
    out = dict(tables)
    kept = tables["atom_site"].filter(F.col("auth_asym_id") == chain)
    labels = kept.select(*keys, "label_asym_id").distinct()
    entities = kept.select(*keys, "label_entity_id").distinct()

    def refer(child: str, column: str, parent: DataFrame, parent_column: str) -> None:
        known = parent.filter(F.col(parent_column).isNotNull()).select(*keys, parent_column)
        out[child] = keep_in(out[child], column, known, keys)

    for category, columns in AUTHOR_CHAIN.items():
        if category in out:
            other = reduce(lambda a, b: a | b, [F.col(c) != chain for c in columns])
            out[category] = delete_rows(out[category], other)
    if "entity_poly" in out and "pdbx_strand_id" in out["entity_poly"].columns:
        strands = F.transform(F.split("pdbx_strand_id", ","), lambda s: F.trim(s))
        one = F.when(F.array_contains(strands, chain), F.lit(chain)).otherwise(F.col("pdbx_strand_id"))
        out["entity_poly"] = out["entity_poly"].withColumn("pdbx_strand_id", one)
    if "struct_asym" in out:
        out["struct_asym"] = keep_in(out["struct_asym"], "id", labels, keys)
    if "pdbx_struct_assembly_gen" in out:
        out["pdbx_struct_assembly_gen"] = assembly_filter(out["pdbx_struct_assembly_gen"], labels, keys=keys)
    for child, column, parent, parent_column in STILL_REFERENCED:
        if child in out and parent in out:
            refer(child, column, out[parent], parent_column)
    for category in BY_ENTITY:
        if category in out:
            out[category] = keep_in(out[category], "entity_id", entities, keys)
    for child, column, parent, parent_column in SEQUENCE_REFERENCES:
        if child in out and parent in out:
            refer(child, column, out[parent], parent_column)
            if strand_rows and child == "struct_ref_seq":
                out[child] = delete_rows(out[child], F.col("pdbx_strand_id") != chain)
    if "entity" in out:
        out["entity"] = keep_in(out["entity"], "id", entities, keys)
    used = out["atom_site"].select(*keys, F.col("label_comp_id").alias("comp"))
    if "entity_poly_seq" in out:
        used = used.unionAll(out["entity_poly_seq"].select(*keys, F.col("mon_id").alias("comp")))
    used = used.filter(F.col("comp").isNotNull()).distinct()
    for category, column in BY_COMPONENT.items():
        if category in out:
            out[category] = keep_in(out[category], column, used, keys)
    return out


def rename_chain(tables: dict[str, DataFrame], old: str, new: str) -> dict[str, DataFrame]:
    """Rename a chain in every author and label column."""
    out = dict(tables)
    for category, table in tables.items():
        names = [c for rules in (AUTHOR_CHAIN, AUTHOR_CHAIN_NAMES, LABEL_CHAIN) for c in rules.get(category, [])]
        if names:
            out[category] = table.select(
                *[
                    F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
                    for c in table.columns
                ]
            )
    return out


def chain_columns(links: DataFrame) -> DataFrame:
    """Columns that hold chain names, found from the dictionary links: ``t, col, ns``."""
    parent = lambda table, column: (F.col("parent_table") == table) & (F.col("parent_column") == column)
    ns = (
        F.when(parent("atom_site", "auth_asym_id"), "auth")
        .when(parent("atom_site", "label_asym_id") | parent("struct_asym", "id"), "label")
    )
    return links.select(F.col("child_table").alias("t"), F.col("child_column").alias("col"), ns.alias("ns")).filter(
        F.col("ns").isNotNull()
    )


def keep_chain_check(tables: dict[str, DataFrame], chain: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of each category, and how many of them name another author chain."""
    parts = []
    for category, table in tables.items():
        columns = [c for c in AUTHOR_CHAIN.get(category, []) if c in table.columns]
        other = reduce(lambda a, b: a | b, [F.col(c) != chain for c in columns]) if columns else F.lit(False)
        parts.append(
            table.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(other).alias("other_chain"))
            .withColumn("t", F.lit(category))
        )
    return reduce(DataFrame.unionByName, parts)
