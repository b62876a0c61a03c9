"""Analyses on a few rows: files without what is counted, empty categories, chains that are kept and renamed."""

from cif_lake.operators import analyses, edit
from cif_lake.operators.relational import shared_folder
from cif_lake.sources import read

import pytest

FILES = {
    "full.cif": "data_f\n_entry.id F\nloop_\n_atom_site.group_PDB\n_atom_site.label_comp_id\n_atom_site.label_asym_id\n_atom_site.auth_asym_id\n_atom_site.label_seq_id\n"
    "_atom_site.B_iso_or_equiv\nATOM ALA A X 1 80\nATOM ALA A X 1 10\nATOM GLY A X 2 90\nHETATM HOH B X . 99\n"
    "loop_\n_struct_conf.id\n_struct_conf.conf_type_id\n_struct_conf.beg_label_seq_id\n_struct_conf.end_label_seq_id\n1 HELX_P 1 2\n2 TURN_P 1 1\n"
    "loop_\n_struct_sheet_range.id\n_struct_sheet_range.beg_label_seq_id\n_struct_sheet_range.end_label_seq_id\n1 2 2\n",
    "turns.cif": "data_t\n_entry.id T\n_struct_conf.id 1\n_struct_conf.conf_type_id TURN_P\n_atom_site.group_PDB HETATM\n_atom_site.label_comp_id HOH\n",
    "bare.cif": "data_b\n_entry.id B\n",
}


def table(frame, *columns):
    return {r["filename"]: tuple(r[c] for c in columns) for r in frame.collect()}


def test_every_file_has_its_row(source):
    src = source(FILES)
    files = read.file_list(src)
    atoms, conf, sheet = (read.scan(src, c) for c in ("atom_site", "struct_conf", "struct_sheet_range"))
    assert table(analyses.residue_count(atoms, files=files), "total_residues") == {"full.cif": (2,), "turns.cif": (0,), "bare.cif": (0,)}
    assert table(analyses.helix_residues(conf, files=files), "nr_helices", "nr_helix_residues") == {"full.cif": (1, 2), "turns.cif": (0, None), "bare.cif": (0, None)}
    assert table(analyses.helix_residues(conf), "nr_helices") == {"full.cif": (1,), "turns.cif": (0,)}
    assert table(analyses.strand_residues(sheet, files=files), "nr_strands", "nr_sheet_residues") == {"full.cif": (1, 1), "turns.cif": (0, None), "bare.cif": (0, None)}
    assert table(analyses.confidence_pass(atoms, 70, 1, files=files), "high_confidence_residues", "passed") == {"full.cif": (2, True), "turns.cif": (0, False), "bare.cif": (0, False)}


def test_shares_from_one_scan_as_from_three(source):
    src = source(FILES)
    files = read.file_list(src)
    apart = analyses.ss_ratios(*(read.scan(src, c) for c in ("atom_site", "struct_conf", "struct_sheet_range")), files=files)
    wanted = {"atom_site": ["group_PDB", "label_asym_id", "label_seq_id"], "struct_conf": ["conf_type_id", "beg_label_seq_id", "end_label_seq_id"], "struct_sheet_range": ["beg_label_seq_id", "end_label_seq_id"]}
    together = analyses.ss_ratios_of(read.scan_many(src, wanted), files=files)
    columns = ["nr_residues", "nr_helix_residues", "nr_sheet_residues", "helix_ratio", "sheet_ratio"]
    assert table(together, *columns) == table(apart, *columns) == {
        "full.cif": (2, 2, 1, 1.0, 0.5), "turns.cif": (0, None, None, None, None), "bare.cif": (0, None, None, None, None),
    }


def test_one_structure_with_empty_categories(source):
    src = source({"a.cif": "data_a\n_entry.id A\n"})
    entry, refine, exptl, software = (read.scan(src, c, row_id=True) for c in ("entry", "refine", "exptl", "software"))
    row = analyses.entry_summary(entry, refine, exptl, software, keys=()).first()
    assert (row["id"], row["resolution"], row["method"], row["is_alphafold"]) == ("A", None, None, False)


def test_a_kept_chain_can_be_renamed_in_strand_lists(spark):
    atoms = spark.createDataFrame([("f", "D", "L", "1", "ALA"), ("f", "C", "K", "1", "ALA")], "filename string, auth_asym_id string, label_asym_id string, label_entity_id string, label_comp_id string")
    poly = spark.createDataFrame([("f", "1", "C, D"), ("f", "2", "B"), ("f", "1", None)], "filename string, entity_id string, pdbx_strand_id string")
    kept = edit.rename_chain(edit.keep_chain({"atom_site": atoms, "entity_poly": poly}, "D"), "D", "A")
    assert [r["auth_asym_id"] for r in kept["atom_site"].collect()] == ["A"]
    assert sorted(str(r["pdbx_strand_id"]) for r in kept["entity_poly"].collect()) == ["A", "None"]


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
