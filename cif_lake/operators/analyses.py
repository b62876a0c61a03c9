"""Analyses over scanned categories, per file.

Each function takes scanned frames that carry the ``keys`` columns (by default ``filename``) and gives one result for every
file, so a collection is analysed in one job. ``keys=()`` analyses all rows as one structure.

Distinct residues are counted in two steps (group by residue, then count), so a huge chain is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("filename",)
WATER = ("HOH",)


def _polymer(atoms: DataFrame, skip: Sequence[str] = WATER) -> DataFrame:
    return atoms.filter((F.col("group_PDB") == "ATOM") & ~F.col("label_comp_id").isin(*skip))


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    return left.join(right, list(keys), how) if keys else left.join(right, how="cross")


def _every_file(result: DataFrame, files: DataFrame | None, seen: DataFrame, keys: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """The result with a row for each file of ``files`` (without it, of the frame that was analysed): counts are 0, sums NULL.

    Without keys all rows are one structure, and the result has its one row already.
    """
    if not keys:
        return result
    listed = (seen if files is None else files).select(*keys).distinct()
    out = listed.join(result, list(keys), "left")
    return out.fillna(0, subset=list(zero)) if zero else out


# --- metadata ----------------------------------------------------------------------------------------


def entry_summary(
    entry: DataFrame, refine: DataFrame, exptl: DataFrame, software: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Id, resolution, method, software in file order, and whether a predicted-model program took part."""

    def only(frame: DataFrame, column: str, name: str) -> DataFrame:
        # A scalar subquery: more than one row of a file is an error.
        one = frame.groupBy(*keys).agg(F.count("*").alias("n"), F.first(column).alias(name))
        return one.filter(
            F.when(F.col("n") <= 1, True).otherwise(
                F.raise_error(F.lit(f"more than one row for {column}")).cast("boolean")
            )
        ).drop("n")

    programs = software.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("row_id", "name"))).alias("listed"),
        F.count_if(F.col("name").isin("AlphaFold", "alphafill")).alias("predicted"),
    )
    out = _join(entry, only(refine, "ls_d_res_high", "resolution"), keys)
    out = _join(out, only(exptl, "method", "method"), keys)
    out = _join(out, programs, keys)
    return out.select(
        *keys,
        "id",
        "resolution",
        "method",
        F.transform("listed", lambda x: x["name"]).alias("software"),
        (F.coalesce("predicted", F.lit(0)) > 0).alias("is_alphafold"),
    )


def residue_count(atoms: DataFrame, keys: Sequence[str] = KEYS, files: DataFrame | None = None) -> DataFrame:
    """Distinct (chain, sequence number) over polymer atoms; residues without a number are not counted.

    ``files`` lists the files by ``keys``; one without any such residue has 0.
    """
    residues = (
        atoms.filter((F.col("group_PDB") == "ATOM") & F.col("label_asym_id").isNotNull() & F.col("label_seq_id").isNotNull())
        .select(*keys, "label_asym_id", "label_seq_id")
        .distinct()
    )
    counted = residues.groupBy(*keys).agg(F.count("*").alias("total_residues"))
    return _every_file(counted, files, atoms, keys, ["total_residues"])


def label_auth_chains(atoms: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return (
        atoms.filter(F.col("group_PDB") == "ATOM")
        .groupBy(*keys, F.col("label_asym_id").alias("label_chain"))
        .agg(F.min("auth_asym_id").alias("auth_chain"), F.count("*").alias("atoms"))
    )


def chain_lengths(atoms: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    residues = _polymer(atoms).select(*keys, "auth_asym_id", "label_seq_id").distinct()
    return residues.groupBy(*keys, F.col("auth_asym_id").alias("auth_chain")).agg(
        F.count("label_seq_id").alias("chain_length")
    )


def sequence_segments(ref_seq: DataFrame, ref: DataFrame, database: str = "UNP", keys: Sequence[str] = KEYS) -> DataFrame:
    """Alignments whose reference is in the given sequence database."""
    ids = ref.filter(F.col("db_name") == database).select(*keys, F.col("id").alias("ref_id"))
    return ref_seq.join(ids, [*keys, "ref_id"], "left_semi")


def chain_accessions(
    ref_seq: DataFrame, ref: DataFrame, database: str = "UNP", keys: Sequence[str] = KEYS, identity: bool = False
) -> DataFrame:
    """Accession range per chain; ``identity`` adds the covered share of the range."""
    beg, end = F.col("db_align_beg"), F.col("db_align_end")
    aligned = F.sum(end - beg + 1)
    out = [
        F.min(beg).alias("uniprot_start"),
        F.max(end).alias("uniprot_end"),
        aligned.alias("aligned_residues"),
    ]
    if identity:
        out.append(F.round(aligned / (F.max(end) - F.min(beg) + 1), 3).alias("sequence_identity"))
    return (
        sequence_segments(ref_seq, ref, database, keys)
        .groupBy(*keys, F.col("pdbx_strand_id").alias("chain"), F.col("pdbx_db_accession").alias("accession"))
        .agg(*out)
    )


def chain_metadata(
    atoms: DataFrame, ref_seq: DataFrame, ref: DataFrame, database: str = "UNP", keys: Sequence[str] = KEYS
) -> DataFrame:
    """Length, accession and label chain of every author chain; the label chain is that of the first atom."""
    first = (
        atoms.filter(F.col("group_PDB") == "ATOM")
        .groupBy(*keys, F.col("auth_asym_id").alias("auth_chain"))
        .agg(F.min_by("label_asym_id", "row_id").alias("label_chain"))
    )
    accessions = sequence_segments(ref_seq, ref, database, keys).select(
        *keys, F.col("pdbx_strand_id").alias("auth_chain"), F.col("pdbx_db_accession").alias("uniprot_accession")
    )
    on = [*keys, "auth_chain"]
    return (
        chain_lengths(atoms, keys)
        .join(accessions, on, "left")
        .join(first, on, "left")
        .select(*on, "chain_length", "uniprot_accession", "label_chain")
    )


def collection_metadata(many: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Best resolution and first deposition date of every entry of a collection.

    ``many`` is one scan of ``entry``, ``refine`` and ``pdbx_database_status`` (``read.scan_many``). A file without an entry has
    no row.
    """
    date = F.to_date("pdbx_database_status.recvd_initial_deposition_date")
    out = many.groupBy(*keys).agg(
        F.count_if(F.col("category") == "entry").alias("entries"),
        F.min("entry.id").alias("id"),
        F.min("refine.ls_d_res_high").alias("resolution"),
        F.min(date).alias("deposit_date"),
    )
    return out.filter("entries > 0").drop("entries")


# --- secondary structure -------------------------------------------------------------------------------


def _span() -> Column:
    return F.col("end_label_seq_id").cast("bigint") - F.col("beg_label_seq_id").cast("bigint") + 1


def helix_residues(conf: DataFrame, keys: Sequence[str] = KEYS, files: DataFrame | None = None) -> DataFrame:
    """Helices and the residues in them; a file without helices has 0 and an empty sum."""
    helix = F.col("conf_type_id") == "HELX_P"
    counted = conf.groupBy(*keys).agg(F.count_if(helix).alias("nr_helices"), F.sum(F.when(helix, _span())).alias("nr_helix_residues"))
    return _every_file(counted, files, conf, keys, ["nr_helices"])


def strand_residues(sheet_range: DataFrame, keys: Sequence[str] = KEYS, files: DataFrame | None = None) -> DataFrame:
    """Strands and the residues in them; a file without strands has 0 and an empty sum."""
    counted = sheet_range.groupBy(*keys).agg(F.count("*").alias("nr_strands"), F.sum(_span()).alias("nr_sheet_residues"))
    return _every_file(counted, files, sheet_range, keys, ["nr_strands"])


def ss_spans(conf: DataFrame, sheet_range: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    def rows(frame: DataFrame, kind: str) -> DataFrame:
        return frame.select(
            *keys,
            F.lit(kind).alias("kind"),
            F.col("beg_label_asym_id").alias("chain"),
            F.col("beg_label_seq_id").alias("start"),
            F.col("end_label_seq_id").alias("finish"),
        )

    return rows(conf.filter(F.col("conf_type_id") == "HELX_P"), "helix").unionByName(rows(sheet_range, "strand"))


def ss_ratios(
    atoms: DataFrame, conf: DataFrame, sheet_range: DataFrame, keys: Sequence[str] = KEYS, files: DataFrame | None = None
) -> DataFrame:
    """Share of helix and sheet residues; a structure without helices has a NULL sum, as an empty sum does."""
    out = residue_count(atoms, keys, files).withColumnRenamed("total_residues", "nr_residues")
    out = _join(out, helix_residues(conf, keys).drop("nr_helices"), keys)
    out = _join(out, strand_residues(sheet_range, keys).drop("nr_strands"), keys)
    return _ratios(out, keys)


def _ratios(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    ratio = lambda n: F.round(F.try_divide(F.col(n), F.col("nr_residues")), 3)
    return counts.select(
        *keys,
        "nr_residues",
        "nr_helix_residues",
        "nr_sheet_residues",
        ratio("nr_helix_residues").alias("helix_ratio"),
        ratio("nr_sheet_residues").alias("sheet_ratio"),
    )


def ss_ratios_of(many: DataFrame, keys: Sequence[str] = KEYS, files: DataFrame | None = None) -> DataFrame:
    """``ss_ratios`` from one scan of ``atom_site``, ``struct_conf`` and ``struct_sheet_range`` (``read.scan_many``).

    Atoms are reduced to their residues by the first aggregate; the spans pass through it as they are, summed up.
    """
    span = lambda c: F.col(f"{c}.end_label_seq_id").cast("bigint") - F.col(f"{c}.beg_label_seq_id").cast("bigint") + 1
    polymer = F.col("atom_site.group_PDB") == "ATOM"
    rows = many.select(
        *keys,
        F.when(polymer, F.col("atom_site.label_asym_id")).alias("chain"),
        F.when(polymer, F.col("atom_site.label_seq_id")).alias("number"),
        F.when(F.col("struct_conf.conf_type_id") == "HELX_P", span("struct_conf")).alias("helix"),
        F.when(F.col("category") == "struct_sheet_range", span("struct_sheet_range")).alias("sheet"),
    )
    residues = rows.groupBy(*keys, "chain", "number").agg(F.sum("helix").alias("helix"), F.sum("sheet").alias("sheet"))
    counted = residues.groupBy(*keys).agg(
        F.count_if(F.col("chain").isNotNull() & F.col("number").isNotNull()).alias("nr_residues"),
        F.sum("helix").alias("nr_helix_residues"),
        F.sum("sheet").alias("nr_sheet_residues"),
    )
    return _ratios(_every_file(counted, files, many, keys, ["nr_residues"]), keys)


def ss_filter(ratios: DataFrame, min_helix_residues: int, max_sheet_ratio: float, keys: Sequence[str] = KEYS) -> DataFrame:
    share = F.try_divide(F.col("nr_sheet_residues"), F.col("nr_residues"))
    return ratios.select(
        *keys, ((F.col("nr_helix_residues") >= min_helix_residues) & (share <= max_sheet_ratio)).alias("passed")
    )


# --- confidence ------------------------------------------------------------------------------------------


def _residue_confidence(atoms: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _polymer(atoms).groupBy(*keys, "auth_asym_id", "label_seq_id").agg(F.max("B_iso_or_equiv").alias("b"))


def confident_residues(atoms: DataFrame, threshold: float = 70, keys: Sequence[str] = KEYS) -> DataFrame:
    """Residues of each chain whose best atom is above the threshold."""
    return (
        _residue_confidence(atoms, keys)
        .groupBy(*keys, F.col("auth_asym_id").alias("chain"))
        .agg(F.count_if(F.col("b") > threshold).alias("high_conf_residues"), F.count("*").alias("total_residues"))
    )


def confidence_pass(
    atoms: DataFrame, threshold: float = 70, low: int = 200, high: int = 10_000_000, keys: Sequence[str] = KEYS, files: DataFrame | None = None
) -> DataFrame:
    """Whether the number of residues above the threshold lies in a range; a file without polymer atoms has 0."""
    n = _residue_confidence(atoms, keys).groupBy(*keys).agg(
        F.count_if(F.col("b") > threshold).alias("high_confidence_residues")
    )
    n = _every_file(n, files, atoms, keys, ["high_confidence_residues"])
    return n.withColumn("passed", F.col("high_confidence_residues").between(low, high))


def drop_low_confidence(
    atoms: DataFrame, threshold: float = 70, keys: Sequence[str] = KEYS, per_chain: bool = False
) -> DataFrame:
    """Drop polymer residues none of whose atoms is above the threshold.

    Residues are told apart by sequence number only, across chains, unless ``per_chain``.
    """
    on = [*keys, *(["auth_asym_id"] if per_chain else []), "label_seq_id"]
    low = _polymer(atoms).groupBy(*on).agg(F.max("B_iso_or_equiv").alias("b")).filter(F.col("b") <= threshold)
    low = low.select(*on).withColumn("polymer", F.lit(True))
    flag = F.coalesce((F.col("group_PDB") == "ATOM") & ~F.col("label_comp_id").isin(*WATER), F.lit(False))
    flagged = atoms.withColumn("polymer", flag)
    return flagged.join(low, [*on, "polymer"], "left_anti").select(*atoms.columns)


def confidence_recount(atoms: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return chain_lengths(atoms, keys).select(
        *keys, F.col("auth_chain").alias("chain"), F.col("chain_length").alias("residues")
    )


def quality_metrics(local: DataFrame, metric: DataFrame, model: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Local quality values with the name of their metric and model."""
    names = metric.select(*keys, F.col("id").alias("metric_id"), F.col("name").alias("metric_name"), "mode")
    models = model.select(*keys, F.col("ordinal_id").alias("model_id"), "model_name")
    return local.join(names, [*keys, "metric_id"]).join(models, [*keys, "model_id"])


# --- sequence mapping ----------------------------------------------------------------------------------------


def accession_best(ref_seq: DataFrame, ref: DataFrame, database: str = "UNP", keys: Sequence[str] = KEYS) -> DataFrame:
    """Accession with most aligned residues of each chain, ties in alphabetical order.

    The best one is an aggregate, so the many accessions of one chain are reduced before the shuffle.
    """
    flat = chain_accessions(ref_seq, ref, database, keys)
    best = F.min_by(F.struct("accession", "aligned_residues"), F.struct(-F.col("aligned_residues"), F.col("accession")))
    return flat.groupBy(*keys, "chain").agg(best.alias("b")).select(
        *keys, "chain", F.col("b.accession").alias("acc"), F.col("b.aligned_residues").alias("aligned")
    )


def sifts_segments(ref_seq: DataFrame, best: bool = True, keys: Sequence[str] = KEYS) -> DataFrame:
    """Range of each (chain, accession) of cross-reference segments ``unp_acc, unp_num, best_mapping``."""
    rows = ref_seq.filter(F.col("best_mapping") == "y") if best else ref_seq
    return rows.groupBy(*keys, F.col("asym_id").alias("chain"), F.col("unp_acc").alias("accession")).agg(
        F.min("unp_start").alias("start"), F.max("unp_end").alias("finish")
    )


def atom_totals(counts: DataFrame) -> DataFrame:
    """Rows of a category over a collection, from the per-file counts."""
    return counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("atoms"))


def element_counts(atoms: DataFrame) -> DataFrame:
    return atoms.groupBy("type_symbol").agg(F.count("*").alias("n"))


def ranked(frame: DataFrame, partition: Sequence[str], *order: Column, keep: int = 1) -> DataFrame:
    """First rows of each partition by ``row_number``; Spark limits the groups before the shuffle."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return frame.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= keep).drop("rn")
